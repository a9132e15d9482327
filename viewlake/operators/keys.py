"""Surrogate keys, keyed upserts and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Key numbering works in 16^3 buckets of the natural key's MD5.
BUCKET_DIGITS = 3


def _bucket(natural_key: Sequence[str]) -> Column:
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in natural_key))
    return F.substring(F.md5(text), 1, BUCKET_DIGITS)


def stable_keys(
    existing: DataFrame | None,
    members: DataFrame,
    natural_key: Sequence[str],
    key: str,
) -> DataFrame:
    """Key of every natural key in existing or members, one row each.

    Known members keep their key. New ones are numbered after the highest key:
    ranked inside a hash bucket, plus the number of new members in the buckets
    before it. Only the bucket totals, at most 4,096 rows, meet in one task. The
    highest existing key enters as the total of an empty first bucket.
    """
    fresh = members.select(*natural_key).dropna().distinct()
    if existing is None:
        return number_rows(fresh, natural_key, key)
    known = existing.select(*natural_key, F.col(key).cast("int").alias(key))
    fresh = fresh.join(known, list(natural_key), "left_anti")
    return known.unionByName(number_rows(fresh, natural_key, key, known))


def number_rows(
    rows: DataFrame,
    natural_key: Sequence[str],
    key: str,
    known: DataFrame | None = None,
) -> DataFrame:
    """Rows, one for each natural key, with a number as ``key``, from 1 on or from the
    highest one of ``known`` on."""
    placed = rows.withColumn("_bucket", _bucket(natural_key))
    totals = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    if known is not None:
        highest = known.select(
            F.lit("").alias("_bucket"), F.col(key).cast("long").alias("_n")
        )
        totals = totals.unionByName(highest.groupBy("_bucket").agg(F.max("_n").alias("_n")))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(*natural_key)
    number = (F.col("_offset") + F.col("_place")).cast("int").alias(key)
    return (
        placed.withColumn("_place", F.row_number().over(in_bucket))
        .join(offsets, "_bucket")
        .select(*rows.columns, number)
    )


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows, and the existing rows whose key they do not replace."""
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming).select(*existing.columns)


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: breaches of the declared grain."""
    return (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def orphans(fact: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks, with their fact rows.

    The fact is counted per key first, so the join sees one row per key.
    """
    used = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias(key))
        .agg(F.count("*").alias("fact_rows"))
    )
    return used.join(dimension.select(key), key, "left_anti")
