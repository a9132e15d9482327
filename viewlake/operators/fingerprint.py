"""Content fingerprints that ignore row order, and their comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampType

# Keeps a sum of hashes inside a long for up to four billion rows per partition
# and inside a decimal for any number.
MODULUS = 2**31


def _portable_text(rows: DataFrame, column: str) -> Column:
    """A value as text that other engines write alike.

    Each text has its length in front and NULL has none, so values cannot run into
    each other. A double is written with six places if that is all of it, else in full.
    """
    kind = rows.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, DoubleType):
        short = value.try_cast("decimal(24,6)")
        value = F.when(short.cast("double") == value, short.cast("string")).otherwise(
            value.cast("string")
        )
    elif isinstance(kind, DateType):
        value = F.date_format(value, "yyyy-MM-dd")
    text = value.cast("string")
    return F.coalesce(F.concat(F.char_length(text), F.lit(":"), text), F.lit("~"))


def _digest(rows: DataFrame, columns: Sequence[str], digest: str) -> Column:
    if digest == "xxhash64":
        # The position keeps a NULL in one column apart from a NULL in the next.
        return F.xxhash64(*(F.struct(F.lit(i), c) for i, c in enumerate(columns)))
    if digest == "md5":
        text = F.concat(*(_portable_text(rows, c) for c in columns))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    raise ValueError(f"unknown digest {digest}")


def fingerprint(
    rows: DataFrame,
    partition_by: Sequence[str],
    columns: Sequence[str] | None = None,
    digest: str = "xxhash64",
) -> DataFrame:
    """Row count, XOR and sum of the row hashes of each partition.

    ``xxhash64`` is the fast choice; ``md5`` can be recomputed by other engines.
    The sum tells apart what XOR cannot: rows that occur an even number of times.
    """
    names = sorted(columns or [c for c in rows.columns if c not in partition_by])
    hashed = rows.withColumn("_hash", _digest(rows, names, digest))
    return hashed.groupBy(*partition_by).agg(
        F.count("*").alias("rows"),
        F.bit_xor("_hash").alias("hash_xor"),
        F.sum(F.pmod("_hash", F.lit(MODULUS)).cast("decimal(20,0)"))
        .cast("decimal(30,0)")
        .alias("hash_sum"),
    )


def compare_fingerprints(
    before: DataFrame, after: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Both row counts of every partition and whether the contents are equal."""
    measures = [c for c in before.columns if c not in partition_by]
    old = before.withColumnsRenamed({m: f"_before_{m}" for m in measures})
    new = after.withColumnsRenamed({m: f"_after_{m}" for m in measures})
    same = F.lit(True)
    for m in measures:
        same = same & F.col(f"_before_{m}").eqNullSafe(F.col(f"_after_{m}"))
    return old.join(new, list(partition_by), "full_outer").select(
        *partition_by,
        F.coalesce("_before_rows", F.lit(0)).alias("rows_before"),
        F.coalesce("_after_rows", F.lit(0)).alias("rows_after"),
        same.alias("is_same"),
    )


def changed_partitions(comparison: DataFrame) -> DataFrame:
    return comparison.where(~F.col("is_same"))
