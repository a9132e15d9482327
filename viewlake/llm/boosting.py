"""Gradient-boosted trees for two classes, grown from sums over all examples.

A value stands as its level, the first of ``LEVELS`` that is not below it; every level
can be a cut. Equal examples of a kind are one row with their number, so a table of them
grows slower than what they were taken from. A task adds up whole numbers for its rows,
Spark adds up the tasks, and the driver holds the sums of one level of one tree for each
kind at a time: the trees are the same however the rows are divided.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlake.llm.scratch import cut

TREES = 40
DEPTH = 3
RATE = 0.2
#: Whole numbers one by one where formats differ, then each the double of the one before.
LEVELS = np.concatenate([np.arange(-1.0, 257.0), 2.0 ** np.arange(9, 32)])
CELLS = len(LEVELS) + 1
#: Gradients are summed in these units, scores are counted in steps.
UNIT = 2.0**24
STEPS = 2**14
#: Rows of counted examples for a task.
TASK_ROWS = 100_000

COUNTED = "kind int, levels binary, positive boolean, held boolean, n long"


class Block(NamedTuple):
    """Counted examples of one kind."""

    levels: np.ndarray
    positive: np.ndarray
    held: np.ndarray
    n: np.ndarray


def levels_of(x: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, x, "left").astype("<i2")


class BoostedTrees:
    """Logistic boosting; a tree is the (features, places) of each level's nodes and leaf
    values. ``growing`` holds the levels of the next tree."""

    def __init__(self, share: float, weight: float):
        share = min(max(share, 1e-3), 1 - 1e-3)
        self.start, self.weight = float(np.log(share / (1 - share))), weight
        self.trees: list[tuple[list, np.ndarray]] = []
        self.growing: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _nodes(levels: np.ndarray, splits: list) -> np.ndarray:
        """Children are numbered 2 * parent and 2 * parent + 1."""
        node, rows = np.zeros(len(levels), np.int64), np.arange(len(levels))
        for feature, place in splits:
            node = 2 * node + (levels[rows, feature[node]] > place[node])
        return node

    def _scores(self, levels: np.ndarray) -> np.ndarray:
        score = np.full(len(levels), self.start)
        for splits, leaves in self.trees:
            score += leaves[self._nodes(levels, splits)]
        return 1 / (1 + np.exp(-score))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of the positive class."""
        return self._scores(levels_of(x))

    def sums(self, block: Block) -> np.ndarray:
        """Gradient and curve of the examples not held out, for each node, feature and level."""
        levels, positive, _, n = (part[~block.held] for part in block)
        p = self._scores(levels)
        weight = np.where(positive, 1.0, self.weight) * UNIT
        features = levels.shape[1]
        cell = ((self._nodes(levels, self.growing)[:, None] * features + np.arange(features)) * CELLS + levels).ravel()
        size = 2 ** len(self.growing) * features * CELLS
        parts = (np.rint((positive - p) * weight) * n, np.rint(np.maximum(p * (1 - p), 1e-6) * weight) * n)
        return np.stack([np.bincount(cell, np.repeat(part, features), size) for part in parts], 1).astype(np.int64)

    def split(self, sums: np.ndarray) -> None:
        """Grow a level; a node without a useful split sends all its rows to the left."""
        nodes = 2 ** len(self.growing)
        left = np.cumsum((sums / UNIT).reshape(nodes, -1, CELLS, 2), 2)
        # Every feature sums to the same; the first stands for all.
        g, h = np.moveaxis(left[:, :1, -1:], -1, 0)
        left_g, left_h = np.moveaxis(left, -1, 0)
        gain = (left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)).reshape(nodes, -1)
        best = gain.argmax(1)
        useful = gain[np.arange(nodes), best] > 1e-6
        feature, place = np.where(useful, best // CELLS, 0), np.where(useful, best % CELLS, CELLS - 1)
        self.growing.append((feature, place))
        if len(self.growing) == DEPTH:
            at_left = left[np.arange(nodes), feature, place]
            leaf = np.stack([at_left, left[:, 0, -1] - at_left], 1).reshape(-1, 2)
            self.trees.append((self.growing, leaf[:, 0] / (leaf[:, 1] + 1) * RATE))
            self.growing = []

    def steps(self, block: Block) -> np.ndarray:
        """Held-out examples, negative and positive, at each step of their score."""
        levels, positive, _, n = (part[block.held] for part in block)
        step = (self._scores(levels) * STEPS).astype(np.int64)
        return np.stack([np.bincount(step[of], n[of], STEPS + 1) for of in (~positive, positive)], 1).astype(np.int64)


def class_counts(block: Block) -> np.ndarray:
    """Negative and positive examples: those to learn from, then those held out."""
    return np.array([[block.n[(block.held == held) & (block.positive == positive)].sum() for positive in (False, True)] for held in (False, True)], np.int64)


Work = Callable[[int, Block], np.ndarray]


def added_up(work: Work, kinds: Iterable[int], blocks: Iterable[tuple[int, Block]]) -> dict[int, np.ndarray]:
    """The sum of ``work`` over the blocks of each kind."""
    total: dict[int, np.ndarray] = {}
    for kind, block in blocks:
        if kind in kinds:
            found = work(kind, block)
            total[kind] = total[kind] + found if kind in total else found
    return total


def blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """The examples of each kind in batches of rows as ``COUNTED`` has them."""
    for batch in batches:
        kinds, levels, positive, held, n = (batch.column(name) for name in ("kind", "levels", "positive", "held", "n"))
        kinds, positive, held, n = (c.to_numpy(zero_copy_only=False) for c in (kinds, positive, held, n))
        if len(kinds):
            levels = np.frombuffer(b"".join(levels.to_pylist()), "<i2").reshape(len(kinds), -1)
        for kind in np.unique(kinds).tolist():
            of = kinds == kind
            yield kind, Block(levels[of], positive[of], held[of], n[of])


class SparkExamples:
    """Examples counted in Spark; each total is one pass over them."""

    def __init__(self, counted: DataFrame):
        counted = cut(counted)
        tasks = 1 + counted.count() // TASK_ROWS
        # Read some hundred times, so in few files.
        self._counted = cut(counted.coalesce(tasks))

    def total(self, work: Work, kinds: list[int], cells: int) -> dict[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for kind, sums in added_up(work, kinds, blocks_of(batches)).items():
                cell = np.flatnonzero(sums.any(1))
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(cell), pa.int32()), "cell": cell, "a": sums[cell, 0], "b": sums[cell, 1]})

        parts = self._counted.mapInArrow(run, "kind int, cell long, a long, b long")
        found = parts.groupBy("kind", "cell").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
        kind, cell, a, b = (found.column(name).to_numpy() for name in ("kind", "cell", "a", "b"))
        total = {k: np.zeros((cells, 2), np.int64) for k in np.unique(kind).tolist()}
        for k, sums in total.items():
            sums[cell[kind == k]] = np.stack([a, b], 1)[kind == k]
        return total


class LocalExamples:
    """Counted examples in hand."""

    def __init__(self, blocks: list[tuple[int, Block]]):
        self._blocks = blocks

    def total(self, work: Work, kinds: list[int], cells: int) -> dict[int, np.ndarray]:
        return added_up(work, kinds, self._blocks)


Examples = SparkExamples | LocalExamples


def boost(examples: Examples, trees: dict[int, BoostedTrees], features: int) -> None:
    """Grow the trees of all kinds, level by level."""
    for _ in range(TREES if trees else 0):
        for level in range(DEPTH):
            for kind, sums in examples.total(lambda kind, block: trees[kind].sums(block), list(trees), 2**level * features * CELLS).items():
                trees[kind].split(sums)
