"""Left joins of events to the reference tables.

No side is broadcast by decree. Spark broadcasts a reference table only when
its size is under ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined
by sort and merge, where adaptive execution splits hot keys. Spark's size is an
estimate from the bytes of files, which says little of compressed columns or of rows
made from them, so a table over ``BROADCAST_ROWS`` rows is merged whatever its estimate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIQUE = "unique_key"

STRATEGIES = ("auto", "merge", "shuffle_hash")

# Rows of a reference table, some 25 MB when held, from which no join broadcasts it.
BROADCAST_ROWS = 100_000


def _join(
    events: DataFrame, reference: DataFrame, keys: Sequence[str], strategy: str
) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "auto":
        reference = merged_if_large(reference)
    if not is_declared_unique(reference, keys):
        reference = one_row_per_key(reference, keys)
    if strategy != "auto":
        reference = reference.hint(strategy)
    return events.join(reference, list(keys), "left")


def merged_if_large(table: DataFrame, rows: int | None = None) -> DataFrame:
    """The table with a hint to merge if it has more rows than may be broadcast.

    The rows are counted, in each task only until there are too many.
    """
    most = BROADCAST_ROWS if rows is None else rows
    is_large = table.limit(most + 1).count() > most
    return table.hint("merge") if is_large else table


def declare_unique(reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Note in the schema that a table has one row per key, so that a join need not
    make sure of it. For tables that were checked when they were written."""
    noted = {k: F.col(k).alias(k, metadata={UNIQUE: list(keys)}) for k in keys}
    return reference.select(*(noted.get(c, F.col(c)) for c in reference.columns))


def is_declared_unique(reference: DataFrame, keys: Sequence[str]) -> bool:
    notes = [reference.schema[k].metadata.get(UNIQUE) for k in keys]
    return all(note is not None and set(note) <= set(keys) for note in notes)


def one_row_per_key(reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of several rows for one key the greatest, so that a join multiplies no event.

    A maximum of rows is found by sorting, before the shuffle too. The rows are dealt
    out first, by all their columns, so that no task sorts what one scan task makes and
    no key gathers.
    """
    others = [c for c in reference.columns if c not in keys]
    dealt = reference.hint("rebalance", *reference.columns)
    rows = dealt.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_row"))
    return rows.select(*keys, "_row.*")


def repeated_reference(reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with several rows, the rows and how many of them differ."""
    return (
        reference.groupBy(*keys)
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct(F.struct(*reference.columns)).alias("variants"),
        )
        .where(F.col("rows") > 1)
    )


def enrich_with_metadata(
    events: DataFrame, metadata: DataFrame, strategy: str = "auto"
) -> DataFrame:
    """Add title, genre, studio, release_date and content_type."""
    return _join(events, metadata, ["content_id"], strategy)


def enrich_with_launch(
    events: DataFrame, launch: DataFrame, strategy: str = "auto"
) -> DataFrame:
    """Add the planned and actual launch date and status of content and region."""
    return _join(events, launch, ["content_id", "region"], strategy)


def unmatched_content(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Contents without metadata and how many events they have.

    Events are counted per content before the join, so the join sees one row
    per content.
    """
    per_content = events.groupBy("content_id").agg(F.count("*").alias("events"))
    return per_content.join(metadata.select("content_id"), "content_id", "left_anti")
