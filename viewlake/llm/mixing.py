"""Operator 6: mix sources to target weights.

Sizes are summed by source, the sums give each source its target and with it a rate;
every document comes floor(rate) times, plus once more where a hash of its id, taken
as a number below one, falls under the fraction of the rate.

Sizes meet by source in a partial sum before the shuffle, so a source with a third of
all rows is no hot group. The table of sources, a row each, joins back as a broadcast
if it is small, else by a join whose hot partitions adaptive execution splits.

Edge cases: a NULL text counts no words, a NULL source is a source (the last one). A
document without words is emitted by its rate like any other and adds nothing. Rows
that repeat share id and hash, so they come equally often; rows without an id are told
apart by their text. An empty table gives an
empty table. ``plan_mix`` keeps all columns of the table in a struct, so no name
clashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.scratch import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Up to so many sources their table, some 50 bytes a row, is broadcast.
BROADCAST_SOURCES = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources take the weights in turn, by code point, NULL last. Sources whose share
    would pass ``most_repeats`` times their size stop there and the excess is shared
    again by weight. With the sources in order of the level (size over weight) at which
    they stop, the level of the rest of the total rises while sources stop and falls
    after; so the level is the highest one that a source does not stop at. One row
    per source is what the windows see.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    numbered = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (at + 1).cast("int")).cast("double"))
    stop = F.col("source_size") * F.lit(float(most_repeats))
    by_stop = Window.orderBy(stop / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_stop.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    stopped = F.coalesce(F.sum(stop).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - stopped) / weight_left
    leveled = numbered.select("source", "source_size", "weight", stop.alias("stop"), level.alias("level"))
    share = F.max(F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.col("level"))).over(everything) * F.col("weight")
    return leveled.select("source", "source_size", F.least(share, F.col("stop")).alias("target"))


def unit_hash(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1 made of 52 bits of the md5 of the id, or of the text's md5
    where there is no id."""
    named = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(named), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def plan_mix(df: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, size, source_size, target, copies): how often each row of ``df`` comes."""
    source = F.col(source_col).cast("string")
    sizes = df.select(source.alias("source"), n_words(F.col(text_col)).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most_repeats)
    rows = df.select(F.struct("*").alias("row"), source.alias("source"), n_words(F.col(text_col)).alias("size"), unit_hash(F.col(id_col), F.col(text_col)).alias("at"))
    right = cut(targets.withColumnRenamed("source", "of"))
    if right.count() <= BROADCAST_SOURCES:
        right = F.broadcast(right)
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    joined = rows.join(right, rows["source"].eqNullSafe(right["of"]), "left").withColumn("rate", rate)
    copies = F.floor("rate") + F.when(F.col("at") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(df: DataFrame, **how) -> DataFrame:
    """The mixed table: rows of ``df``, each as often as its plan says."""
    planned = plan_mix(df, **how).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
