"""Data quality: run counts, category mixes, key skew, anomaly rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from viewlake.operators.validate import (
    COMPLETION_RATE_RANGE,
    WATCH_MINUTES_RANGE,
    is_valid,
)


def quality_metrics(events: DataFrame) -> DataFrame:
    """One row of counts over raw events: input, rejected, duplicate and
    output rows, NULLs, out-of-range and impossible values."""
    valid = is_valid()
    output = F.count_distinct(F.when(valid, F.col("event_id")))
    return events.agg(
        F.count("*").alias("input_rows"),
        (F.count("*") - F.count_if(valid)).alias("rejected_rows"),
        (F.count_if(valid) - output).alias("duplicate_rows"),
        output.alias("output_rows"),
        *null_counts(["event_id", "event_timestamp", "region", "completion_rate"]),
        outside("completion_rate", *COMPLETION_RATE_RANGE),
        outside("watch_minutes", *WATCH_MINUTES_RANGE),
    )


def null_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def outside(column: str, low: float, high: float) -> Column:
    return F.count_if(~F.col(column).between(low, high)).alias(f"outside_{column}")


def counted(rows: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and whatever else is asked for, while another action runs."""
    seen = Observation(name)
    return rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *(c.alias(k) for k, c in counts.items()),
    ), seen


def category_mix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every value of the given columns, from one scan."""
    pairs = F.explode(
        F.array(
            *(
                F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value"))
                for c in columns
            )
        )
    )
    counts = (
        rows.select(pairs.alias("_pair"))
        .groupBy("_pair.attribute", "_pair.value")
        .agg(F.count("*").alias("rows"))
    )
    totals = counts.groupBy("attribute").agg(F.sum("rows").alias("_total"))
    return counts.join(totals, "attribute").select(
        "attribute", "value", "rows", (F.col("rows") / F.col("_total")).alias("share")
    )


#: Parts in which the keys of one size meet their rank.
SIZE_SALTS = 16


def skew_profile(rows: DataFrame, key: str) -> DataFrame:
    """Rows, share of all rows and rank of every value of a key.

    The rank is one plus the number of keys with more rows. It is read from the
    histogram of key sizes, which has at most sqrt(2 * rows) entries, instead of
    sorting all keys in one task. Most keys may share one size, so sizes meet their
    rank under a salt.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("rows"))
    histogram = sizes.groupBy("rows").agg(F.count("*").alias("_keys"))
    larger = Window.orderBy(F.desc("rows")).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.col("rows") * F.col("_keys")).over(Window.partitionBy())
    ranks = histogram.select(
        "rows",
        (F.coalesce(F.sum("_keys").over(larger), F.lit(0)) + 1).alias("rank"),
        total.alias("_total"),
    )
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SIZE_SALTS - 1)))
    ranks = ranks.withColumn("_salt", every_salt)
    salted = sizes.withColumn(
        "_salt", F.pmod(F.xxhash64(key), F.lit(SIZE_SALTS)).cast("int")
    )
    return salted.join(ranks, ["rows", "_salt"]).select(
        key, "rows", (F.col("rows") / F.col("_total")).alias("share"), "rank"
    )


# Thresholds of the anomaly rules.
LONG_VIEW_MINUTES = 300.0
SHORT_VIEW_MINUTES = 1.0


def anomaly_flags(events: DataFrame) -> DataFrame:
    """Rule flags per event and how many fired; narrow, so it also runs on streams."""
    minutes, rate = F.col("watch_minutes"), F.col("completion_rate")
    flags = {
        "long_view": F.coalesce(minutes > LONG_VIEW_MINUTES, F.lit(False)),
        "instant_completion": F.coalesce(
            (F.col("event_type") == "complete") & (minutes < SHORT_VIEW_MINUTES),
            F.lit(False),
        ),
        "idle_skip": F.coalesce(
            (F.col("event_type") == "skip") & (rate > 0.9), F.lit(False)
        ),
    }
    score = sum((flag.cast("int") for flag in flags.values()), F.lit(0))
    return events.withColumns({**flags, "flags": score, "is_anomaly": score > 0})


def label_metrics(labelled: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Precision, recall and false-positive rate of a flag against the truth."""
    tp = F.count_if(predicted & actual)
    fp = F.count_if(predicted & ~actual)
    fn = F.count_if(~predicted & actual)
    tn = F.count_if(~predicted & ~actual)

    def rate(part: Column, whole: Column) -> Column:
        return part / F.nullif(whole, F.lit(0))

    return labelled.agg(
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        tn.alias("true_negatives"),
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(fp, fp + tn).alias("false_positive_rate"),
    )
