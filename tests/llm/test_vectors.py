"""Exact top-k: SQL parity and brute force on awkward vectors."""

import numpy as np
import parity
import pytest
from llm_support import SMALL, shipped  # noqa: F401
from pyspark.sql import functions as F

from viewlake.llm import vectors
from viewlake.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark):
    con = parity.connect(SMALL)
    assert parity.difference(QUERIES["op5_exact_top_k"](spark, SMALL), con, ORACLES["op5_exact_top_k"]) is None


def brute(rows, k=10):
    ids, x = np.array([i for i, _ in rows]), np.floor(1024 * np.array([v for _, v in rows], float)).astype(int)
    found = []
    for i, v in zip(ids, x):
        if i % 100 == 0:
            scores = x @ v
            best = [a for a in np.lexsort((ids, -scores)) if ids[a] != i][:k]
            found += [(i, n, ids[a], scores[a]) for n, a in enumerate(best, 1)]
    return sorted(found)


def test_ties_signs_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VECTORS", 50)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 6 * 120)  # several meetings in a task
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(700)]
    rows += [(int(i), [0.5, -0.5, 0.0, 1.0, 0.0, 0.0]) for i in range(1000, 1400)]
    rows += [(2000, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert got == brute(rows)


def test_early_stop_is_exact():
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, (3000, 4))
    x[:5] *= 40
    ids = np.arange(3000)
    for q, (best, scores) in enumerate(vectors.block_top_k(ids, x, ids[:20], x[:20], 5)):
        want = x @ x[q]
        assert [i for i in np.lexsort((ids, -want)) if i != q][:5] == best.tolist()
        assert want[best].tolist() == scores.tolist()


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, [1.0, 0.0]), (6, [1.0, 0.0]), (0, [1.0, 2.0]), (100, []), (7, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = sorted(tuple(r) for r in vectors.top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert got == [(0, 1, 6, 1024**2), (0, 2, 6, 1024**2), (100, 1, 7, 0)]


def test_scores_that_do_not_fit_are_an_error(spark):
    for large in (3_000_000.0, 1e16):
        df = spark.createDataFrame([(i, [large] * 8) for i in range(3)], "vec_id long, embedding array<double>")
        with pytest.raises(ArithmeticError):
            vectors.top_k(df, F.col("vec_id") == 0)
    df = spark.createDataFrame([(i, [1_000_000.0] * 8) for i in range(3)], "vec_id long, embedding array<double>")
    assert {r["score"] for r in vectors.top_k(df, F.col("vec_id") == 0).collect()} == {8 * 1_024_000_000**2}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.top_k(df, F.col("vec_id") == 0).count() == 0
