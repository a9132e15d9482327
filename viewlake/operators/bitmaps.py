"""Exact distinct counts over any range, from bitmaps that merge.

Members get dense numbers. For each day and group a bitmap per bucket of numbers says
which members occurred; the bitmaps of any days are merged by OR and their bits counted.
A bucket is 4 kB, whatever the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_bitmaps(
    rows: DataFrame, numbers: DataFrame, member: str, number: str, by: Sequence[str]
) -> DataFrame:
    """(by, bucket, members): the members that occur, by group and bucket of numbers.

    ``numbers`` has a number for every member. Rows are made distinct before they meet
    it, so a hot member is one row of each group.
    """
    seen = rows.select(*by, member).where(F.col(member).isNotNull()).distinct()
    numbered = seen.join(numbers.select(member, number), member)
    return numbered.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("members")
    )


def distinct_members(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, members): how many different members there are in each group."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias("members"))
