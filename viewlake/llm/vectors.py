"""Operator 5: exact top-k search by no-random-access aggregation.

Each component is a list of the vectors sorted by it, and the score of a vector is the
sum of its entries in all lists, each times the query's component. Lists are read from
their best end, some way down at a time. What has been read of a vector gives a lower
and an upper bound of its score: entries not read yet lie between the value reached
and the worst value of their list. Once few vectors have an upper bound that reaches
the k-th lower bound, nobody else can qualify, and the scores of those few are settled.

Vectors and queries are dealt to blocks, and every block of queries meets every block of
vectors in a task. A vector is copied once for each block of queries, so blocks are as
large as ``BLOCK_BYTES`` allow, or as leave work for every core. Inside a task
``BLOCK_QUERIES`` queries meet ``BLOCK_VECTORS`` vectors at a time, with bounds of all of
them as matrices, and the best k of each meeting meet by query.

Edge cases: a row takes no part if its id or vector is NULL or a component is NULL, NaN
or infinite. Vectors meet vectors of their own length only. Ties go to the smaller id.
Rows with one id are each other's own and never partners; each is a candidate for
others, and rows that repeat wholly as queries are one query. With fewer candidates
than k all are returned. An empty table gives an empty table. Other columns are not
read. Scores are exact; if one could pass 64 bits, the job ends with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_VECTORS = 4096
BLOCK_QUERIES = 512
#: Bytes of vectors, and of queries, that a task may hold.
BLOCK_BYTES = 32_000_000
#: Lists are first read to this share of their length, then twice as far each time.
FIRST_DEPTH = 16


def scaled(vector: Column, scale: int = 1024) -> Column:
    """The components as floor(scale * x), NULL if one of them has no number."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    able = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(able, F.transform(numbers, lambda x: F.floor(x * F.lit(float(scale)))))


def top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best partners of every query row."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("vector"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).withColumn("width", F.size("vector"))
    size = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    counts = rows.agg(F.count("*"), F.count_if("asks"), F.max("width"), F.max(size), F.max(F.when(F.col("asks"), size))).first()
    width = max(1, counts[2] or 0)
    if width * (counts[3] or 0.0) * (counts[4] or 0.0) >= 2.0**63 or (counts[3] or 0.0) >= 2.0**62:
        raise ArithmeticError("scores of these vectors may pass 64 bits")
    most = max(1, BLOCK_BYTES // (8 * width))
    shared = -(-counts[0] // (4 * df.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, -(-counts[0] // min(max(BLOCK_VECTORS, shared), most)))
    query_blocks = max(1, -(-counts[1] // most))
    # Dealt by place in the table, not by id: rows of one id spread like any others.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    vectors = rows.select("width", "id", "vector", dealt.alias("block")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = rows.where("asks").select("width", "id", "vector").distinct()
    asked = F.pmod(F.xxhash64("id", "vector"), F.lit(query_blocks)).cast("int")
    queries = queries.withColumn("query_block", asked).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    result = pa.schema([("query_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("vec_id", pa.int64()), ("score", pa.int64())])

    def meet(table: pa.Table) -> pa.Table:
        asks = table.column("asks")
        left, right = table.filter(pc.invert(asks)), table.filter(asks)
        if not left.num_rows or not right.num_rows:
            return result.empty_table()
        ids, matrix = _matrix(left)
        query_ids, query_matrix = _matrix(right)
        found = []
        for low in range(0, len(ids), BLOCK_VECTORS):
            some, part = ids[low:low + BLOCK_VECTORS], matrix[low:low + BLOCK_VECTORS]
            for first in range(0, len(query_ids), BLOCK_QUERIES):
                asked, block = query_ids[first:first + BLOCK_QUERIES], query_matrix[first:first + BLOCK_QUERIES]
                for n, (best, scores) in enumerate(block_top_k(some, part, asked, block, k), first):
                    found += [(int(query_ids[n]), n, int(some[at]), int(score)) for at, score in zip(best, scores)]
        asking, nth, partners, scores = list(zip(*found)) or [[]] * 4
        taken = right.column("vector").combine_chunks().take(pa.array(nth, pa.int64()))
        return pa.table([pa.array(asking, pa.int64()), taken, pa.array(partners, pa.int64()), pa.array(scores, pa.int64())], schema=result)

    keys = ["width", "query_block", "block"]
    both = [side.select(*keys, "id", "vector", F.lit(asks).alias("asks")) for side, asks in ((vectors, False), (queries, True))]
    met = both[0].union(both[1]).groupBy(*keys).applyInArrow(meet, "query_id long, vector array<long>, vec_id long, score long")
    # The query's vector tells apart queries that share an id.
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    ranked = met.select("query_id", F.xxhash64("vector").alias("asked"), "vec_id", "score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    lists = table.column("vector").combine_chunks()
    width = table.column("width")[0].as_py()
    return ids, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), width)


def block_top_k(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its k best vectors in the block."""
    n, width = vectors.shape
    if not n or not len(queries):
        return [(np.empty(0, int), np.empty(0, np.int64))] * len(queries)
    exact = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(width, 1) < 2**52
    kind = np.float64 if exact else np.int64  # floats hold such whole numbers exactly, and multiply faster
    ascending = np.sort(vectors, 0).astype(kind)
    place = np.empty((n, width), np.int64)
    np.put_along_axis(place, np.argsort(vectors, 0, kind="stable"), np.arange(n)[:, None], 0)
    x, q = vectors.astype(kind), queries.astype(kind)
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    same = ids[None, :] == query_ids[:, None]
    results: list = [None] * len(queries)
    open_ = np.arange(len(queries))
    depth = max(k, n // FIRST_DEPTH)
    while len(open_):
        depth = min(depth, n)
        # Lists of positive components are read from the top, of negative ones from the bottom.
        top, bottom = place >= n - depth, place < depth
        known = up[open_] @ np.where(top, x, 0).T + down[open_] @ np.where(bottom, x, 0).T
        rest_top, rest_bottom = (~top).astype(kind).T, (~bottom).astype(kind).T
        least = known + (up[open_] * ascending[0]) @ rest_top + (down[open_] * ascending[-1]) @ rest_bottom
        most = known + (up[open_] * ascending[n - depth]) @ rest_top + (down[open_] * ascending[depth - 1]) @ rest_bottom
        still = []
        for row, query in enumerate(open_.tolist()):
            others = ~same[query]
            bounds = least[row][others]
            bar = np.partition(bounds, -k)[-k] if len(bounds) > k else -np.inf
            finalists = np.flatnonzero((most[row] >= bar) & others)
            if depth < n and len(finalists) > max(4 * k, n // 64):
                still.append(query)
                continue
            scores = vectors[finalists] @ queries[query]
            best = np.lexsort((ids[finalists], -scores))[:k]
            results[query] = (finalists[best], scores[best])
        open_ = np.array(still, int)
        depth *= 2
    return results
