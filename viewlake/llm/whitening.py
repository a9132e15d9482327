"""Operator 11: embedding whitening by slicing the spectrum of the covariance.

Entries become whole numbers, so sums and the covariance are exact: vectors are centred
on the whole part of their mean before they are multiplied, products are summed as
integers, and the rest of the mean is taken out as integers too. Reruns and other
partitionings give the same bits.

The eigenvalues are isolated by Sylvester's law: the LDL^T factors of the covariance less
a shift have as many positive pivots as there are eigenvalues above the shift. Bisection
by such counts puts each leading eigenvalue in an interval of its own; Rayleigh quotient
iteration converges to it from there, and counts just above and below the results
certify that the k-th found is the k-th largest. Eigenvalues nearer to each other than
rounding lets one tell form a cluster, of which any orthonormal basis is right.

The fit list, each distinct vector once, is written to the shared folder and read three
times: sums, products, and the covariance of what the whitening makes of it. Tasks send
sums, of which there are as many as dimensions, or products, as dimensions squared; those
meet by cell. One task factors one matrix. The models reach the driver and the tasks that
whiten; their size is that of 16 vectors for each length of vectors.

Edge cases: rows whose vector is NULL or has an entry that is NULL, NaN or infinite go.
Vectors of one length are a population of their own, and the identity error is the
largest of all. Components whose eigenvalue is 0 (more than the rank) cannot be whitened
and are left out, so a single distinct vector, or one without entries, has no rows. Rows
that repeat are returned each, ids may be NULL, an empty table gives an empty table, and
other columns are not read. An entry beyond 2**62 ends the job with an error.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlake.llm.scratch import drop_folder, new_folder

COMPONENTS = 16
#: Entries of vectors a task takes at once.
BLOCK_ENTRIES = 1_000_000
#: Bytes of models that may reach the driver, 144 bytes for each entry of a vector
#: length. Twenty lengths of ten thousand entries are far below.
MOST_MODEL_BYTES = 256_000_000
#: Eigenvalues below this share of the largest count as 0; those closer count as equal.
ZERO, EQUAL = 1e-12, 1e-11

# The spectrum of a symmetric matrix


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above the shift: the positive pivots of LDL^T.

    Pivots are chosen on the diagonal, or as a block of two where none is large enough
    (Bunch and Parlett), so that the factors do not grow.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound, positive = (1 + 17**0.5) / 8, 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        r, s = divmod(int(off.argmax()), len(a))
        if diagonal[i] == 0 and off[r, s] == 0:
            break  # what is left is zero: eigenvalues at the shift are not above it
        if diagonal[i] >= bound * off[r, s]:
            positive += int(a[i, i] > 0)
            column = np.delete(a[:, i], i)
            rest = np.delete(np.delete(a, i, 0), i, 1)
            a = rest - np.outer(column, column / a[i, i])
        else:
            positive += 1  # a block whose off-diagonal rules has one pivot of each sign
            block = a[np.ix_([r, s], [r, s])]
            columns = np.delete(a[:, [r, s]], [r, s], 0)
            rest = np.delete(np.delete(a, [r, s], 0), [r, s], 1)
            a = rest - columns @ np.linalg.solve(block, columns.T)
            a = (a + a.T) / 2
    return positive


@dataclass
class Slices:
    """Shifts with the counts of eigenvalues above them, kept in order."""

    matrix: np.ndarray
    shifts: list[float]
    counts: list[int]

    @classmethod
    def of(cls, matrix: np.ndarray) -> Slices:
        reach = float(np.abs(matrix).sum(1).max()) * 1.01 + 1e-300  # Gershgorin
        return cls(matrix, [-reach, reach], [len(matrix), 0])

    def add(self, shift: float) -> int:
        """Factor at the shift."""
        at = int(np.searchsorted(self.shifts, shift))
        if self.shifts[at] != shift:
            self.shifts.insert(at, shift)
            self.counts.insert(at, count_above(self.matrix, shift))
        return self.counts[at]

    def around(self, k: int) -> tuple[float, float, int, int]:
        """The closest shifts around the k-th largest eigenvalue, and their counts."""
        at = max(i for i, n in enumerate(self.counts) if n >= k)
        return self.shifts[at], self.shifts[at + 1], self.counts[at], self.counts[at + 1]


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above 0, falling, and unit eigenvectors as rows."""
    n = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if not n or scale == 0:
        return np.empty(0), np.empty((0, n))
    matrix = matrix / scale
    slices = Slices.of(matrix)
    values: list[float] = []
    vectors = np.empty((0, n))
    noise = np.random.default_rng(7)
    while len(values) < min(most, n):
        k = len(values) + 1
        low, high, below, above = slices.around(k)
        tolerance = EQUAL * max(1.0, values[0] if values else 0.0)
        while (below, above) != (k, k - 1) and high - low > tolerance:
            slices.add((low + high) / 2)
            low, high, below, above = slices.around(k)
        # An interval too narrow to be parted holds a cluster: take all of it.
        for _ in range(min(below, n) - above):
            value, vector = _iterate(slices, len(values) + 1, vectors, noise)
            values.append(value)
            vectors = np.vstack((vectors, vector))
    order = np.argsort(-np.array(values), kind="stable")
    eigenvalues, vectors = np.array(values)[order], vectors[order]
    _certify(slices, eigenvalues)
    kept = np.flatnonzero(eigenvalues > ZERO * eigenvalues[0])[:most]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])
    return eigenvalues[kept] * scale, (vectors * signs[:, None])[kept]


def _iterate(slices: Slices, k: int, found: np.ndarray, noise: np.random.Generator) -> tuple[float, np.ndarray]:
    """The k-th eigenpair, by Rayleigh quotient iteration inside its interval.

    A quotient that leaves the interval means that a neighbour was nearer: the interval
    is halved and the iteration starts again from its middle.
    """
    matrix, n = slices.matrix, len(slices.matrix)
    while True:
        low, high, _, _ = slices.around(k)
        narrow = EQUAL * max(1.0, abs(high))
        vector = noise.standard_normal(n)
        shift, value, least = (low + high) / 2, None, np.inf
        for step in range(60):
            vector = _solved(matrix, shift, vector)
            vector -= found.T @ (found @ vector)
            vector /= np.linalg.norm(vector)
            value = float(vector @ matrix @ vector)
            residual = float(np.linalg.norm(matrix @ vector - value * vector))
            inside = low - narrow <= value <= high + narrow
            if step >= 2 and not inside:
                break
            if residual >= least / 2 and residual < 1e-11:
                return value, vector  # rounding is all that is left
            least = min(least, residual)
            if step >= 2 and inside:
                shift = value
        if high - low <= narrow:
            return value, vector
        slices.add((low + high) / 2)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    n = len(matrix)
    for nudge in (0.0, 1e-15, 1e-14, 1e-13):
        try:
            solved = np.linalg.solve(matrix - (shift + nudge) * np.eye(n), vector)
        except np.linalg.LinAlgError:
            continue
        size = np.abs(solved).max()
        if np.isfinite(size) and size > 0:
            return solved / size
    raise ArithmeticError("no shift near an eigenvalue could be solved for")


def _certify(slices: Slices, values: np.ndarray) -> None:
    """Counts around every found eigenvalue must agree with its number."""
    for k, value in enumerate(values.tolist(), 1):
        near = 4 * EQUAL * max(1.0, abs(values[0]))
        first = int((values > value + 2 * near).sum()) + 1
        last = int((values >= value - 2 * near).sum())
        if slices.add(value + near) > k - 1 or slices.add(value - near) < k:
            raise ArithmeticError(f"eigenvalue {k} has another number, from {first} to {last}")


# Exact sums over the fit list


def whole_numbers(vector: Column) -> Column:
    """The vector as floor(64 * c) + 1000000, NULL if an entry has no number."""
    numbers = F.transform(vector, lambda c: c.cast("double") * F.lit(64.0))
    able = F.forall(numbers, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(numbers, lambda c: F.when(F.abs(c) < 2.0**62, F.floor(c) + 1_000_000).otherwise(F.raise_error(F.lit("an entry is beyond 2**62")).cast("long")))
    return F.when(able, whole)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int, np.ndarray]]:
    """(batch, places, length, vectors) of the vectors of one length in a batch."""
    for batch in batches:
        lists = batch.column("x")
        bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        lengths = np.diff(bounds)
        for length in np.unique(lengths).tolist():
            places = np.flatnonzero(lengths == length)
            step = max(1, BLOCK_ENTRIES // max(1, length))
            for begin in range(0, len(places), step):
                at = places[begin:begin + step]
                yield batch, at, length, flat[bounds[at][:, None] + np.arange(length)]


def _summed(fit: DataFrame, cells: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """(length, cell, total): what ``cells`` makes of blocks, summed. Whole numbers of
    any size are added by a task as Python's, and by Spark as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for _, _, length, x in _blocks(batches):
            made = cells(length, x).astype(object)
            totals[length] = totals[length] + made if length in totals else made
        for length, total in totals.items():
            columns = [pa.array([length] * len(total), pa.int32()), pa.array(np.arange(len(total))), pa.array(total.tolist(), pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["length", "cell", "part"])

    return fit.select("x").mapInArrow(run, "length int, cell long, part decimal(38,0)").groupBy("length", "cell").agg(F.sum("part").cast("decimal(38,0)").alias("total"))


def _products(x: np.ndarray) -> np.ndarray:
    """The upper triangle of the sum of outer products, exactly."""
    largest = int(np.abs(x).max(initial=0))
    kind = np.float64 if largest**2 * len(x) < 2**53 else np.int64 if largest**2 * len(x) < 2**63 else object
    x = x.astype(kind)
    made = x.T @ x
    made = made.astype(np.int64) if kind is np.float64 else made
    return made[np.triu_indices(x.shape[1])]


@dataclass
class Model:
    """What whitening needs of the fit list of vectors of one length."""

    n: int
    whole_mean: np.ndarray  # floor(S / n)
    rest: np.ndarray  # S - n * whole_mean
    components: np.ndarray  # rows over the root of their eigenvalue
    explained: np.ndarray


def _totals(rows: DataFrame, length: int | None = None) -> dict[int, list[int]]:
    found: dict[int, dict[int, int]] = {}
    for row in rows.collect():
        found.setdefault(row["length"], {})[row["cell"]] = int(row["total"])
    return {length: [cells[c] for c in range(len(cells))] for length, cells in found.items()}


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, Model], float]:
    """The model of each length of the distinct vectors ``x``, and the identity error."""
    lengths = vectors.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    if (lengths.agg(F.sum((F.col("length") + 1) * 144)).first()[0] or 0) > MOST_MODEL_BYTES:
        raise ValueError("vectors have too many lengths for their models to be handed out")
    sums = _totals(_summed(vectors, lambda length, x: np.append(_column_sums(x), len(x))))
    middle = {length: (total[-1], np.array([s // total[-1] for s in total[:-1]], np.int64), np.array([s % total[-1] for s in total[:-1]], object)) for length, total in sums.items()}
    products = _summed(vectors, lambda length, x: _products(x - middle[length][1]))
    result = pa.schema([("length", pa.int32()), ("number", pa.int32()), ("share", pa.float64()), ("component", pa.list_(pa.float64()))])

    def factor(cells: pa.Table) -> pa.Table:
        cells = cells.sort_by("cell")
        length = cells.column("length")[0].as_py()
        n, _, rest = middle[length]
        # n * n times the covariance, in whole numbers.
        upper = [n * int(v) for v in cells.column("total").to_pylist()]
        rows, columns = np.triu_indices(length)
        exact = np.array(upper, object) - rest[rows] * rest[columns]
        matrix = np.zeros((length, length))
        matrix[rows, columns] = matrix[columns, rows] = [int(v) / (n * n) for v in exact.tolist()]
        values, directions = leading_eigenpairs(matrix, components)
        trace = float(np.trace(matrix))
        made = directions / np.sqrt(values)[:, None]
        return pa.table([pa.array([length] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array(values / trace if len(values) else []), pa.array(made.tolist(), pa.list_(pa.float64()))], schema=result)

    found = products.groupBy("length").applyInArrow(factor, "length int, number int, share double, component array<double>").collect()
    models = {}
    for length, (n, whole, rest) in middle.items():
        mine = sorted((row for row in found if row["length"] == length), key=lambda row: row["number"])
        shape = (len(mine), length)
        models[length] = Model(n, whole, rest, np.array([row["component"] for row in mine], float).reshape(shape), np.array([row["share"] for row in mine], float))
    return models, _identity_error(vectors, models)


def _column_sums(x: np.ndarray) -> np.ndarray:
    safe = int(np.abs(x).max(initial=0)) * len(x) < 2**63
    return x.sum(0) if safe else x.astype(object).sum(0)


def _whitened(model: Model, x: np.ndarray) -> np.ndarray:
    centred = (x - model.whole_mean).astype(np.float64) - model.rest.astype(np.float64) / model.n
    return centred @ model.components.T


def _identity_error(vectors: DataFrame, models: dict[int, Model]) -> float:
    """The largest entry of the whitened fit list's covariance less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for _, _, length, x in _blocks(batches):
            made = _whitened(models[length], x)
            made = np.hstack((made, np.ones((len(made), 1))))
            totals[length] = totals.get(length, 0.0) + made.T @ made
        for length, total in totals.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array([length] * len(flat), pa.int32()), pa.array(np.arange(len(flat))), pa.array(flat)], ["length", "cell", "part"])

    sums = vectors.select("x").mapInArrow(run, "length int, cell long, part double").groupBy("length", "cell").agg(F.sum("part").alias("total"))
    error = 0.0
    for length, rows in itertools.groupby(sorted(map(tuple, sums.collect())), lambda row: row[0]):
        n, k = models[length].n, len(models[length].components)
        total = np.array([row[2] for row in rows]).reshape(k + 1, k + 1) / n
        mean = total[:k, k]
        error = max(error, float(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k)).max(initial=0.0)))
    return error


def _deviations(model: Model, x: np.ndarray) -> list[int]:
    """The sum over dimensions of (n * x - S)**2 of every vector, exactly."""
    centred, largest = x - model.whole_mean, 0
    largest = max(int(np.abs(centred).max(initial=0)), max(map(int, model.rest), default=0))
    kind = np.int64 if largest**2 * max(1, x.shape[1]) < 2**62 else object
    centred, rest = centred.astype(kind), model.rest.astype(kind)
    squares, mixed = (centred * centred).sum(1).tolist(), (centred @ rest).tolist()
    constant, n = sum(int(r) ** 2 for r in model.rest), model.n
    return [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, mixed)]


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row
    for each able vector and component; the deviation is a decimal of 38 digits."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col)).alias("x")).where(F.col("x").isNotNull())
    folder = new_folder(spark, "fit-list")
    # A vector with many copies is one row of each task before it is shuffled.
    rows.select("x").distinct().write.parquet(folder)
    models, error = fit(spark.read.schema("x array<long>").parquet(folder), components)
    drop_folder(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, places, length, x in _blocks(batches):
            model = models[length]
            k, m = len(model.components), len(x)
            every = np.repeat(np.arange(m), k)
            deviations = pa.array(_deviations(model, x), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(places[every])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)), deviations.take(pa.array(every)), pa.array(_whitened(model, x).ravel()),
                    pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
