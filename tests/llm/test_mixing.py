"""Mixing: SQL parity, targets by hand, reruns."""

import parity
from llm_support import SMALL, shipped  # noqa: F401
from pyspark.sql import functions as F

from viewlake.llm import mixing
from viewlake.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark):
    con = parity.connect(SMALL)
    assert parity.difference(QUERIES["op6_mixing"](spark, SMALL), con, ORACLES["op6_mixing"]) is None


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share again and again until no source is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free} if free else {}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    for sizes in ({"a": 1, "b": 1000, "c": 5, "d": 40, None: 7}, {"a": 10}, {"a": 0, "b": 9}, {"ä": 3, "z": 3, "Z": 500, "": 2}, {None: 0}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_rows_are_emitted_as_planned(spark, monkeypatch):
    rows = [(i, "w " * (i % 9), f"s{i % 5}" if i % 11 else None, i) for i in range(3000)] + [(None, None, "s1", 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    for limit in (50_000, 0):
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
        plan = mixing.plan_mix(df).cache()
        mixed = mixing.mix(df)
        assert mixed.columns == df.columns
        assert plan.count() == len(rows) and mixed.count() == plan.agg(F.sum("copies")).first()[0]
        assert plan.agg(F.max("copies")).first()[0] <= 3
        for r in plan.groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
            assert abs(r["taken"] - r["target"]) < 0.12 * r["target"]
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_rows_without_ids_come_near_the_target(spark):
    rows = [(None, f"{'w ' * 10}{i}", "a") for i in range(500)] + [(i, "w " * 20, "b") for i in range(500)]
    rows += [(None, None, "b"), (None, "", "b"), (1, "w " * 50_000, "c")]
    plan = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in plan.where("row.source <> 'c'").groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) < 0.1 * r["target"]


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
