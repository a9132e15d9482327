"""Every registered query as a function of (spark, folder of test tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.functions import (
    derive_fields,
    exact_units,
    from_units,
    is_completed,
    normalize_timestamps,
)
from viewlake.operators import (
    bitmaps,
    dedup,
    enrich,
    keys,
    lateness,
    marts,
    quality,
    rollup,
)
from viewlake.operators import fingerprint as prints
from viewlake.operators import validate
from viewlake.operators.asof import as_of_join
from viewlake.plans import daily_run, formats, references, refresh, warehouse
from viewlake.plans.colocated import (
    Colocated,
    drop_colocated,
    join_colocated,
    write_colocated,
)
from viewlake.plans.transform import check_events, transform
from viewlake.plans.zones import Zones, side_by_side
from viewlake.session import working_folder
from viewlake.sinks import (
    latest_state,
    partition_report,
    write_dead_letter,
    write_parquet_baseline,
    write_partitioned,
)
from viewlake.sinks.compaction import compact
from viewlake.sources import land_raw, read_lake, read_partition, run_sql, testdata
from viewlake.sources.raw import read_reference_rows
from viewlake.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The week, fortnight and region of the sample questions.
WEEK = (date(2024, 1, 1), date(2024, 1, 7))
FORTNIGHT = (date(2024, 1, 10), date(2024, 1, 24))
RUN_AT = datetime(2024, 2, 1)
MIDDLE = date(2024, 1, 15)


def query(function: Query) -> Query:
    """Register under the function's name. Dates are taken in UTC, as stored."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


# Inputs shared by the queries


def clean(spark, sf_dir):
    return normalize_timestamps(testdata.viewing_events(spark, sf_dir))


def titled(spark, sf_dir):
    return enrich.enrich_with_metadata(
        clean(spark, sf_dir), testdata.content_metadata(spark, sf_dir)
    )


def checked(spark, sf_dir):
    return check_events(testdata.raw_events(spark, sf_dir))


def valid(spark, sf_dir):
    return validate.valid_rows(checked(spark, sf_dir))


def dimensions(spark, sf_dir):
    return warehouse.load_dimensions(
        spark,
        testdata.viewing_events(spark, sf_dir),
        testdata.content_metadata(spark, sf_dir),
        RUN_AT,
    )


def stored_dimensions(spark, sf_dir):
    """The dimensions, those that are computed written once and read back."""
    base, dims = working_folder(spark, "dimensions"), dimensions(spark, sf_dir)
    computed = ("dim_content", "dim_device")
    side_by_side(*(partial(dims[n].write.parquet, f"{base}/{n}") for n in computed))
    for name in computed:
        schema, _ = warehouse.TABLES[name]
        dims[name] = spark.read.schema(schema).parquet(f"{base}/{name}")
    return dims


def with_unknowns(dims):
    return {
        **dims,
        "dim_content": warehouse.with_unknown(
            dims["dim_content"], "content_key", "content_id"
        ),
        "dim_region": warehouse.with_unknown(
            dims["dim_region"], "region_key", "region_code"
        ),
        "dim_device": warehouse.with_unknown(
            dims["dim_device"], "device_key", "device_type"
        ),
    }


def with_completion(events: DataFrame) -> DataFrame:
    return events.withColumn("is_completed", is_completed())


def events_of(frame: DataFrame) -> DataFrame:
    return frame.select(*testdata.EVENT_COLUMNS, "ingest_date")


# Sources, validation, deduplication


@query
def viewing_events(spark, sf_dir):
    return testdata.viewing_events(spark, sf_dir)


@query
def content_metadata(spark, sf_dir):
    return testdata.content_metadata(spark, sf_dir)


@query
def content_launch(spark, sf_dir):
    return testdata.content_launch(spark, sf_dir)


@query
def validate_valid(spark, sf_dir):
    return events_of(valid(spark, sf_dir))


@query
def validate_rejected(spark, sf_dir):
    rejected = validate.rejected_rows(checked(spark, sf_dir))
    return rejected.select(*testdata.EVENT_COLUMNS, "ingest_date", validate.REASON)


@query
def rejection_breakdown(spark, sf_dir):
    rejected = validate.rejected_rows(checked(spark, sf_dir))
    return validate.rejection_breakdown(rejected)


@query
def dead_letter(spark, sf_dir):
    done = transform(
        testdata.raw_events(spark, sf_dir),
        testdata.content_metadata(spark, sf_dir),
        testdata.content_launch(spark, sf_dir),
    )
    return done.dead_letter.groupBy("ingest_date", validate.REASON).agg(
        F.count("*").alias("rejected_rows")
    )


@query
def dedup_unique(spark, sf_dir):
    return dedup.keep_latest(events_of(valid(spark, sf_dir)))


@query
def dedup_duplicates(spark, sf_dir):
    return dedup.superseded(events_of(valid(spark, sf_dir)))


# Transformation


@query
def normalize_events(spark, sf_dir):
    return clean(spark, sf_dir).select(
        "event_id", "event_timestamp", "event_date", "year", "month", "day"
    )


@query
def enrich_metadata(spark, sf_dir):
    return titled(spark, sf_dir).select(
        "event_id", "content_id", "title", "genre", "studio", "release_date",
        "content_type",
    )


@query
def unmatched_content(spark, sf_dir):
    return enrich.unmatched_content(
        testdata.viewing_events(spark, sf_dir),
        testdata.content_metadata(spark, sf_dir),
    )


@query
def enrich_launch(spark, sf_dir):
    joined = enrich.enrich_with_launch(
        testdata.viewing_events(spark, sf_dir), testdata.content_launch(spark, sf_dir)
    )
    return joined.select(
        "event_id", "content_id", "region", "planned_launch_date",
        "actual_launch_date", "launch_status",
    )


@query
def enrich_launch_merge(spark, sf_dir):
    """The launch join forced to sort and merge: equal rows, other strategy."""
    joined = enrich.enrich_with_launch(
        testdata.viewing_events(spark, sf_dir),
        testdata.content_launch(spark, sf_dir),
        strategy="merge",
    )
    return joined.select(
        "event_id", "content_id", "region", "planned_launch_date",
        "actual_launch_date", "launch_status",
    )


@query
def enrich_launch_colocated(spark, sf_dir):
    """The launch join over tables in the same buckets: no event is shuffled by it."""
    base = working_folder(spark, "colocated")
    number = base.rsplit("-", 1)[1]
    names = Colocated(f"events_{number}", f"launches_{number}")
    events = testdata.viewing_events(spark, sf_dir)
    launches = testdata.content_launch(spark, sf_dir)
    write_colocated(events, launches, names, base, buckets=8, salts=2)
    join_colocated(spark, names).write.parquet(f"{base}/joined")
    drop_colocated(spark, names)
    return read_lake(spark, f"{base}/joined").select(
        "event_id", "content_id", "region", "planned_launch_date",
        "actual_launch_date", "launch_status",
    )


@query
def derived_fields(spark, sf_dir):
    joined = enrich.enrich_with_launch(
        testdata.viewing_events(spark, sf_dir), testdata.content_launch(spark, sf_dir)
    )
    return derive_fields(joined).select(
        "event_id", "launch_delay_days", "watch_hours", "is_completed"
    )


@query
def daily_aggregate(spark, sf_dir):
    return rollup.aggregate_daily(with_completion(clean(spark, sf_dir)))


@query
def salted_daily_sums(spark, sf_dir):
    return rollup.salted_sums(
        clean(spark, sf_dir),
        ["content_id", "event_date"],
        {"watch_minutes": F.col("watch_minutes")},
        spread_by="event_id",
    )


@query
def end_to_end_daily(spark, sf_dir):
    """Raw events through validation, deduplication, joins and roll-up."""
    return transform(
        testdata.raw_events(spark, sf_dir),
        testdata.content_metadata(spark, sf_dir),
        testdata.content_launch(spark, sf_dir),
    ).daily


# Lake and dashboard


@query
def top_content_uk(spark, sf_dir):
    return marts.top_content(marts.filter_window(titled(spark, sf_dir), ["UK"], *WEEK))


@query
def watch_hours_uk(spark, sf_dir):
    return marts.watch_hours_by_content(
        marts.filter_window(clean(spark, sf_dir), ["UK"], *WEEK)
    )


@query
def daily_trend_by_region(spark, sf_dir):
    return marts.daily_trend(marts.filter_window(clean(spark, sf_dir), None, *WEEK))


@query
def completion_by_device(spark, sf_dir):
    return marts.completion_by_device(
        marts.filter_window(clean(spark, sf_dir), None, *WEEK)
    )


@query
def region_breakdown(spark, sf_dir):
    return marts.region_breakdown(marts.filter_window(clean(spark, sf_dir), None, *WEEK))


@query
def kpi_cards(spark, sf_dir):
    return marts.kpis(
        marts.filter_window(clean(spark, sf_dir), ["UK", "US", "DE", "JP"], *FORTNIGHT)
    )


@query
def kpi_cards_no_region(spark, sf_dir):
    """An empty region selection: one row of zero counts and NULL sums."""
    return marts.kpis(marts.filter_window(clean(spark, sf_dir), [], *FORTNIGHT))


@query
def trend_by_date(spark, sf_dir):
    return marts.trend_by_date(
        marts.filter_window(clean(spark, sf_dir), ["UK", "DE"], *FORTNIGHT)
    )


@query
def weekly_trend(spark, sf_dir):
    return marts.weekly_trend(
        marts.filter_window(clean(spark, sf_dir), ["UK", "DE"], *FORTNIGHT)
    )


@query
def device_completion_chart(spark, sf_dir):
    return marts.device_completion_chart(
        marts.filter_window(clean(spark, sf_dir), ["US", "JP"], *FORTNIGHT)
    )


@query
def top_titles(spark, sf_dir):
    return marts.top_titles(
        marts.filter_window(titled(spark, sf_dir), ["UK", "US"], *FORTNIGHT)
    )


@query
def launch_success(spark, sf_dir):
    return marts.launch_success(testdata.content_launch(spark, sf_dir))


# The same questions on the daily aggregate


def daily_lake(spark, sf_dir):
    """The daily aggregate with its exact sums, as written and read back."""
    path = f"{working_folder(spark, 'daily')}/daily_aggregate"
    events = with_completion(clean(spark, sf_dir))
    write_partitioned(rollup.aggregate_daily(events, partials=True), path, ("event_date",))
    return read_lake(spark, path)


def coarsest(spark, sf_dir, *columns):
    """The daily aggregate if it has the columns, else the events."""
    needed = ("event_date", *columns)
    return marts.coarsest(needed, daily_lake(spark, sf_dir), clean(spark, sf_dir))


@query
def kpi_cards_from_daily(spark, sf_dir):
    rows = coarsest(spark, sf_dir, "region", "content_id")
    return marts.kpis(marts.filter_window(rows, ["UK", "US", "DE", "JP"], *FORTNIGHT))


@query
def daily_trend_by_region_from_daily(spark, sf_dir):
    rows = coarsest(spark, sf_dir, "region")
    return marts.daily_trend(marts.filter_window(rows, None, *WEEK))


@query
def completion_by_device_from_daily(spark, sf_dir):
    rows = coarsest(spark, sf_dir, "device_type")
    return marts.completion_by_device(marts.filter_window(rows, None, *WEEK))


@query
def watch_hours_uk_from_daily(spark, sf_dir):
    rows = coarsest(spark, sf_dir, "region", "content_id")
    return marts.watch_hours_by_content(marts.filter_window(rows, ["UK"], *WEEK))


@query
def top_content_uk_from_daily(spark, sf_dir):
    """Titles join the days of the window, not its events."""
    rows = marts.filter_window(coarsest(spark, sf_dir, "region", "content_id"), ["UK"], *WEEK)
    titles = testdata.content_metadata(spark, sf_dir)
    return marts.top_content(enrich.enrich_with_metadata(rows, titles))


@query
def region_breakdown_from_bitmaps(spark, sf_dir):
    """Distinct contents of a week from the bitmaps of its days."""
    daily = daily_lake(spark, sf_dir)
    by = ("event_date", "region")
    numbers = keys.stable_keys(None, daily, ["content_id"], "content_number")
    path = f"{working_folder(spark, 'bitmaps')}/contents"
    made = bitmaps.member_bitmaps(daily, numbers, "content_id", "content_number", by)
    write_partitioned(made, path, ("event_date",))
    week = marts.filter_window(read_lake(spark, path), None, *WEEK)
    counts = bitmaps.distinct_members(week, ["region"])
    sums = marts.region_totals(marts.filter_window(daily, None, *WEEK))
    return sums.join(counts.withColumnRenamed("members", "unique_content"), "region")


@query
def versions_as_of(spark, sf_dir):
    """Events with the genre their content had when they happened."""
    events = testdata.viewing_events(spark, sf_dir).select(
        "event_id", "content_id", "event_timestamp"
    )
    joined = as_of_join(events, content_history(spark, sf_dir), ["content_id"], period="day")
    return joined.select("event_id", "content_id", "genre", "valid_from")


@query
def compacted_partitions(spark, sf_dir):
    """A lake of many small files after compaction: all rows, one file a partition."""
    path = f"{working_folder(spark, 'compacted')}/viewing_events"
    spread = clean(spark, sf_dir).repartition(4)
    spread.write.partitionBy("event_date", "region").parquet(path)
    compact(spark, path, ["content_id", "event_id"])
    is_one = (F.col("files") == 1).alias("is_one_file")
    return partition_report(spark, path).select("event_date", "region", "rows", is_one)


# Warehouse


def content_history(spark, sf_dir):
    """Versions of contents after a second snapshot in the middle of the events."""
    metadata = testdata.content_metadata(spark, sf_dir)
    number = F.substring_index("content_id", "-", -1).cast("int")
    second = metadata.where(number % 11 != 4).withColumn(
        "genre", F.when(number % 7 == 0, "REISSUE").otherwise(F.col("genre"))
    )
    history = warehouse.open_history(metadata.where(number % 13 != 5), date(2024, 1, 3))
    return warehouse.apply_snapshot(history, second, "content_id", MIDDLE)


@query
def dim_date(spark, sf_dir):
    """The calendar with the events of each day, days without any included."""
    per_day = clean(spark, sf_dir).groupBy("event_date").agg(F.count("*").alias("n"))
    calendar = warehouse.dim_date(spark)
    return calendar.join(
        per_day, calendar["calendar_date"] == per_day["event_date"], "left"
    ).select(*calendar.columns, F.coalesce("n", F.lit(0)).alias("events"))


@query
def dim_region(spark, sf_dir):
    """The regions with their distinct customers and events."""
    used = (
        testdata.viewing_events(spark, sf_dir)
        .groupBy("region")
        .agg(
            F.count("*").alias("events"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )
    regions = warehouse.dim_region(spark)
    return regions.join(used, regions["region_code"] == used["region"], "left").select(
        *regions.columns, "events", "customers"
    )


@query
def dim_device(spark, sf_dir):
    return dimensions(spark, sf_dir)["dim_device"]


@query
def dim_content(spark, sf_dir):
    return dimensions(spark, sf_dir)["dim_content"]


@query
def dim_content_reload(spark, sf_dir):
    """A second load after some titles changed and contents were added: known
    keys stay, new members follow, only changed rows get the new time."""
    metadata = testdata.content_metadata(spark, sf_dir)
    number = F.substring_index("content_id", "-", -1).cast("int")
    first = warehouse.dim_content(metadata.where(number % 3 != 0), RUN_AT)
    changed = metadata.withColumn(
        "title",
        F.when(number % 5 == 0, F.concat("title", F.lit(" (new)"))).otherwise(
            F.col("title")
        ),
    )
    return warehouse.dim_content(changed, datetime(2024, 2, 2), first)


@query
def scd2_content(spark, sf_dir):
    """Versions of contents after two snapshots of the metadata."""
    metadata = testdata.content_metadata(spark, sf_dir)
    number = F.substring_index("content_id", "-", -1).cast("int")
    second = metadata.where(number % 11 != 4).withColumn(
        "genre", F.when(number % 7 == 0, "REISSUE").otherwise(F.col("genre"))
    )
    history = warehouse.open_history(metadata.where(number % 13 != 5), date(2024, 1, 1))
    return warehouse.apply_snapshot(history, second, "content_id", date(2024, 2, 1))


def star(spark, sf_dir, unknown="drop"):
    """The fact and the dimensions it was keyed with."""
    dims = stored_dimensions(spark, sf_dir)
    return warehouse.fact_viewing(clean(spark, sf_dir), dims, unknown), dims


@query
def fact_viewing(spark, sf_dir):
    return star(spark, sf_dir)[0]


@query
def fact_content_launch(spark, sf_dir):
    return warehouse.fact_content_launch(
        testdata.content_launch(spark, sf_dir), stored_dimensions(spark, sf_dir)
    )


@query
def orphan_launches(spark, sf_dir):
    return warehouse.orphan_launches(
        testdata.content_launch(spark, sf_dir), dimensions(spark, sf_dir)
    )


@query
def warehouse_top(spark, sf_dir):
    return warehouse.warehouse_top(*star(spark, sf_dir))


@query
def star_read(spark, sf_dir):
    return warehouse.star_read(*star(spark, sf_dir))


@query
def views_by_calendar(spark, sf_dir):
    fact, dims = star(spark, sf_dir)
    return warehouse.views_by_calendar(
        fact, dims["dim_date"], ("year", "week", "day_of_week")
    )


@query
def grain_check(spark, sf_dir):
    """Breaches of the grain event_id in the raw events, NULL ids included."""
    return keys.repeated_keys(testdata.raw_events(spark, sf_dir), ["event_id"])


@query
def orphan_check(spark, sf_dir):
    """Fact rows of contents that the metadata lacks, by content."""
    daily = rollup.aggregate_daily(with_completion(clean(spark, sf_dir)))
    return keys.orphans(
        daily, testdata.content_metadata(spark, sf_dir), "content_id", "content_id"
    )


@query
def verify_warehouse(spark, sf_dir):
    fact, dims = star(spark, sf_dir, "keep")
    return warehouse.verify_warehouse(fact, with_unknowns(dims))


@query
def unknown_members(spark, sf_dir):
    """Views of the fact by whether the content is known: none is lost."""
    rows, _ = star(spark, sf_dir, "keep")
    return rows.groupBy((F.col("content_key") != 0).alias("known_content")).agg(
        F.count("*").alias("fact_rows"), F.sum("views").alias("views")
    )


@query
def fact_upsert(spark, sf_dir):
    """Days from the 15th on replace rows of an older fact that stopped at the 20th
    and counted only two regions."""
    dims = stored_dimensions(spark, sf_dir)
    events = clean(spark, sf_dir)
    older = events.where(
        (F.col("event_date") <= F.lit(date(2024, 1, 20)))
        & F.col("region").isin("UK", "US")
    )
    newer = events.where(F.col("event_date") >= F.lit(date(2024, 1, 15)))
    return keys.upsert(
        warehouse.fact_viewing(older, dims, "drop"),
        warehouse.fact_viewing(newer, dims, "drop"),
        warehouse.FACT_KEYS,
    )


# Incremental processing


@query
def affected_dates(spark, sf_dir):
    """Event dates that the arrivals of the last ten days touch."""
    arrivals = valid(spark, sf_dir).where(
        F.col("ingest_date") >= F.lit(date(2024, 1, 21))
    )
    return lateness.affected_dates(arrivals)


@query
def late_events(spark, sf_dir):
    rows = lateness.late_events(valid(spark, sf_dir))
    return rows.select("event_id", "event_date", "ingest_date", "lateness_days")


@query
def new_partitions(spark, sf_dir):
    """Arrival dates that a lake of on-time events up to the 20th lacks."""
    arrived = testdata.raw_events(spark, sf_dir).select("ingest_date").distinct()
    kept = clean(spark, sf_dir).where(F.col("event_date") <= F.lit(date(2024, 1, 20)))
    processed = kept.select(F.col("event_date").alias("ingest_date")).distinct()
    return lateness.new_partitions(arrived, processed)


@query
def late_window(spark, sf_dir):
    processed = clean(spark, sf_dir).select("ingest_date").distinct()
    return lateness.late_window(processed, date(2024, 1, 29))


@query
def backfill_range(spark, sf_dir):
    """A range that reaches past the data: dates without raw rows show -1."""
    return lateness.backfill_range(
        spark, testdata.raw_events(spark, sf_dir), date(2024, 1, 25), date(2024, 2, 3)
    )


@query
def fingerprint(spark, sf_dir):
    rows = events_of(testdata.viewing_events(spark, sf_dir))
    return prints.fingerprint(rows, ["ingest_date", "region"], digest="md5")


@query
def fingerprint_fast(spark, sf_dir):
    rows = events_of(testdata.viewing_events(spark, sf_dir))
    return prints.fingerprint(rows, ["ingest_date", "region"])


@query
def verify_rerun(spark, sf_dir):
    """Two runs over the same rows, the second in another order and with the
    first of January changed."""
    first = clean(spark, sf_dir)
    second = first.repartition("customer_id").withColumn(
        "watch_minutes",
        F.when(
            F.col("event_date") == F.lit(date(2024, 1, 1)), F.col("watch_minutes") + 1
        ).otherwise(F.col("watch_minutes")),
    )
    return prints.compare_fingerprints(
        prints.fingerprint(first, ["event_date"]),
        prints.fingerprint(second, ["event_date"]),
        ["event_date"],
    )


# Quality, skew, formats


@query
def quality_metrics(spark, sf_dir):
    return quality.quality_metrics(checked(spark, sf_dir))


@query
def category_mix(spark, sf_dir):
    return quality.category_mix(
        testdata.viewing_events(spark, sf_dir),
        ["device_type", "event_type", "subscription_type", "region"],
    )


@query
def skew_profile(spark, sf_dir):
    return quality.skew_profile(testdata.viewing_events(spark, sf_dir), "content_id")


@query
def skew_profile_customers(spark, sf_dir):
    return quality.skew_profile(testdata.viewing_events(spark, sf_dir), "customer_id")


@query
def written_partitions(spark, sf_dir):
    """Rows per partition of a written lake, and whether each has files; how many
    depends on its size."""
    path = f"{working_folder(spark, 'partitions')}/viewing_events"
    write_partitioned(clean(spark, sf_dir), path)
    report = partition_report(spark, path)
    has_files = (F.col("files") >= 1).alias("has_files")
    return report.select("event_date", "region", "rows", has_files)


@query
def csv_vs_parquet(spark, sf_dir):
    """The representative query on both forms of the same written rows."""
    base = working_folder(spark, "formats")
    trial = formats.write_both_forms(clean(spark, sf_dir), base)
    return formats.compare_answers(
        formats.read_forms(spark, trial), formats.watch_hours_query("UK", *WEEK)
    )


@query
def anomaly_flags(spark, sf_dir):
    flagged = quality.anomaly_flags(testdata.viewing_events(spark, sf_dir))
    return flagged.select(
        "event_id", "long_view", "instant_completion", "idle_skip", "flags", "is_anomaly"
    )


@query
def anomaly_metrics(spark, sf_dir):
    """The anomaly rules against the faults put into the raw events."""
    flagged = quality.anomaly_flags(checked(spark, sf_dir))
    return quality.label_metrics(
        flagged, F.col("is_anomaly"), F.col(validate.REASON).isNotNull()
    )


@query
def label_metrics(spark, sf_dir):
    """Low quality as the flag, toxic as the truth."""
    labels = testdata.read_table(spark, sf_dir, "labels")
    return quality.label_metrics(labels, F.col("quality") == 0, F.col("toxic") == 1)


# The same operators on the larger line items


@query
def lineitem_daily(spark, sf_dir):
    """The daily roll-up by part, flag, status and ship date."""
    items = testdata.read_table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_extendedprice").alias("watch_minutes"),
        (F.col("l_discount") * 10).alias("completion_rate"),
    )
    return rollup.aggregate_daily(
        with_completion(items),
        ("l_partkey", "l_returnflag", "l_linestatus", "ship_date"),
    )


@query
def lineitem_dedup(spark, sf_dir):
    """The latest shipped line of each order."""
    items = testdata.read_table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    return dedup.keep_latest(items, ["l_orderkey"], "l_shipdate")


@query
def lineitem_superseded(spark, sf_dir):
    """How many lines of each order an earlier ship date supersedes."""
    items = testdata.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date")
    )
    rows = dedup.superseded(items, ["l_orderkey"], "ship_date")
    return rows.groupBy("l_orderkey").agg(
        F.count("*").alias("superseded_lines"), F.max("ship_date").alias("last_shipped")
    )


@query
def lineitem_star(spark, sf_dir):
    """Line items summed per part and supplier, then joined to both and to the
    supplier's nation."""
    read = lambda name: testdata.read_table(spark, sf_dir, name)
    summed = (
        read("lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.count("*").alias("n"),
            exact_units(F.col("l_quantity")).alias("q"),
        )
    )
    return (
        summed.join(
            read("part").select("p_partkey", "p_type"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        .join(
            read("supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        )
        .join(
            read("nation").select("n_nationkey", "n_name"),
            F.col("s_nationkey") == F.col("n_nationkey"),
        )
        .groupBy("n_name", "p_type")
        .agg(F.sum("n").alias("line_items"), from_units(F.sum("q")).alias("quantity"))
    )


# Streams


def events_stream(spark, sf_dir):
    """The event table as a stream of files."""
    table = testdata.read_table(spark, sf_dir, "events")
    return live.open_files(spark, sf_dir, table.schema, files="events.parquet")


@query
def hourly_counts(spark, sf_dir):
    return live.hourly_counts(testdata.viewing_events(spark, sf_dir))


@query
def stream_hourly_counts(spark, sf_dir):
    """All hours, those still open included, as in ``hourly_counts``."""
    events = testdata.map_events(events_stream(spark, sf_dir))
    base = working_folder(spark, "stream-hours")
    return live.count_into(events, f"{base}/counts", f"{base}/state")


@query
def stream_unique_ids(spark, sf_dir):
    """Ids of a deduplicated stream; which copy came first is left open."""
    raw = testdata.map_raw_events(events_stream(spark, sf_dir))
    unique = live.dedup_stream(validate.valid_rows(check_events(raw)), "60 days")
    base = working_folder(spark, "stream-ids")
    return live.run_available(
        unique.select("event_id", "content_id"), f"{base}/out", f"{base}/state"
    )


@query
def stream_outcomes(spark, sf_dir):
    """Valid arrivals taken in as a stream in two goes, by what became of them: none is
    missing. Rows of the second go that are over two days behind the first are late."""
    base = working_folder(spark, "stream-outcomes")
    raw, columns = testdata.raw_events(spark, sf_dir), ["event_id", "event_timestamp"]
    schema = raw.select(columns).schema
    for half in (F.col("ingest_date") <= MIDDLE, F.col("ingest_date") > MIDDLE):
        arrived = validate.valid_rows(check_events(raw.where(half))).select(columns)
        arrived.write.mode("append").parquet(f"{base}/arrived")
        events = live.open_files(spark, f"{base}/arrived", schema)
        done = live.dedup_available(events, base, 2 * 86_400)
    outcomes = {"unique": done.unique, "duplicate": done.duplicates, "late": done.late}
    named = [rows.withColumn("outcome", F.lit(name)) for name, rows in outcomes.items()]
    return named[0].union(named[1]).union(named[2]).groupBy("outcome").agg(F.count("*").alias("events"))


@query
def stream_arrivals(spark, sf_dir):
    """Landed CSV files taken in as a stream, counted by outcome and arrival date."""
    base = working_folder(spark, "stream-arrivals")
    land_raw(testdata.raw_events(spark, sf_dir), f"{base}/raw")
    arrivals = live.check_arrivals(live.open_raw_events(spark, f"{base}/raw"))
    taken = live.run_available(
        arrivals, f"{base}/out", f"{base}/state", ("status", "ingest_date")
    )
    return taken.groupBy("status", "ingest_date").agg(F.count("*").alias("events"))


@query
def stream_anomalies(spark, sf_dir):
    flagged = quality.anomaly_flags(testdata.map_events(events_stream(spark, sf_dir)))
    base = working_folder(spark, "stream-anomalies")
    return live.run_available(
        flagged.where("is_anomaly").select("event_id", "flags"),
        f"{base}/out",
        f"{base}/state",
    )


# The daily run on a lake of its own


def land_reference(spark, sf_dir, zones):
    replace_reference(
        zones,
        testdata.content_metadata(spark, sf_dir),
        testdata.content_launch(spark, sf_dir),
    )


def replace_reference(zones, metadata, launch):
    for frame, path in ((metadata, zones.metadata), (launch, zones.launch)):
        frame.write.mode("overwrite").option("header", True).csv(path)


def after_two_runs(spark, sf_dir) -> Zones:
    """A lake after two runs, where late events of the second change days of the first."""
    zones = Zones(working_folder(spark, "lake"))
    land_reference(spark, sf_dir, zones)
    raw = testdata.raw_events(spark, sf_dir)
    for run, arrivals in enumerate(
        (raw.where(F.col("ingest_date") <= MIDDLE), raw.where(F.col("ingest_date") > MIDDLE))
    ):
        land_raw(arrivals, zones.raw_events)
        daily_run.run_incremental(spark, zones, f"run{run}", RUN_AT)
    return zones


@query
def incremental_daily(spark, sf_dir):
    """The daily aggregate after two runs: equal to one computation over everything."""
    return spark.read.parquet(after_two_runs(spark, sf_dir).daily).drop(*rollup.PARTIALS)


def published(spark, zones):
    return spark.read.parquet(zones.enriched).select(
        "event_id", "ingest_date", "event_date", "title", "launch_status",
        "launch_delay_days", "watch_hours",
    )


@query
def incremental_enriched(spark, sf_dir):
    """The published events after two runs, with what the joins and measures add."""
    return published(spark, after_two_runs(spark, sf_dir))


@query
def incremental_duplicates(spark, sf_dir):
    """The superseded copies after two runs, whichever run brought them."""
    set_aside = spark.read.parquet(after_two_runs(spark, sf_dir).duplicates)
    return set_aside.select(*testdata.EVENT_COLUMNS, "ingest_date")


def after_new_references(spark, sf_dir):
    """A lake whose titles change and whose missing launches arrive after its events;
    the second run has nothing but that to do."""
    zones = Zones(working_folder(spark, "restated"))
    metadata = testdata.content_metadata(spark, sf_dir)
    launch = testdata.content_launch(spark, sf_dir)
    number = F.substring_index("content_id", "-", -1).cast("int")
    old_title = F.when(number % 40 == 0, "working title").otherwise(F.col("title"))
    replace_reference(
        zones,
        metadata.withColumn("title", old_title),
        launch.where((number % 60 != 7) | (F.col("region") != "JP")),
    )
    land_raw(testdata.raw_events(spark, sf_dir), zones.raw_events)
    daily_run.run_incremental(spark, zones, "first", RUN_AT)
    replace_reference(zones, metadata, launch)
    return zones, daily_run.run_incremental(spark, zones, "second", RUN_AT)


@query
def incremental_restated(spark, sf_dir):
    """The published events after new references, equal to a load with them, and which
    of them stand on days that were rewritten."""
    zones, run = after_new_references(spark, sf_dir)
    restated = F.col("event_date").isin(run.event_dates).alias("restated")
    return published(spark, zones).select("*", restated)


@query
def reference_rejects(spark, sf_dir):
    """Reference files with broken rows: which ones are set aside, and why."""
    base = working_folder(spark, "broken-references")
    quoted = lambda c: F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"'))
    number = F.substring_index("content_id", "-", -1).cast("int")
    found = []
    for kind, rows, twice in (
        (references.METADATA, testdata.content_metadata(spark, sf_dir), "title"),
        (references.LAUNCH, testdata.content_launch(spark, sf_dir), None),
    ):
        names = kind.schema.fieldNames()
        if twice:
            again = rows.where(number % 50 == 13).withColumn(twice, F.lit(""))
            rows = rows.unionByName(again)
        else:
            status = F.when(number % 40 == 3, "postponed").otherwise(F.col("launch_status"))
            rows = rows.withColumn("launch_status", status)
        short, whole, keyless = (
            F.concat_ws(",", *map(quoted, c)) for c in (names[:2], names, names[1:])
        )
        line = F.when(number % 50 == 7, short).when(number % 50 == 9, F.concat(whole, F.lit(",x,y")))
        line = line.when(number % 50 == 11, F.concat(F.lit(","), keyless))
        path = f"{base}/{kind.name}"
        lines = rows.select(line.otherwise(whole).alias("line"))
        # Every file begins with the header; the lines are written as they are.
        plain = {"header": True, "sep": "\u0001", "quote": "\u0002"}
        lines.withColumnRenamed("line", ",".join(names)).write.options(**plain).csv(path)
        checked = read_reference_rows(spark, kind.schema, path)
        _, rejected = references.split_reference(checked, kind)
        found.append(rejected.select(F.lit(kind.name).alias("reference"), "content_id", validate.REASON))
    return found[0].union(found[1]).groupBy("reference", "content_id", validate.REASON).agg(F.count("*").alias("rows"))


@query
def warehouse_tables(spark, sf_dir):
    """The star read as SQL over the tables that two runs have published: every view is
    there, also those of contents that the metadata lacks."""
    refresh.open_warehouse(spark, after_two_runs(spark, sf_dir))
    return spark.sql(
        "SELECT title, region_name, device_type, date_key, views, watch_hours,"
        " completed_views FROM fact_viewing JOIN dim_content USING (content_key)"
        " JOIN dim_region USING (region_key) JOIN dim_device USING (device_key)"
        " JOIN dim_date USING (date_key)"
    )


@query
def run_log(spark, sf_dir):
    """What two runs say of themselves: rows checked and found valid, stages that
    succeeded, and the rows that the latest fingerprint of each day vouches for."""
    zones = after_two_runs(spark, sf_dir)
    log = spark.read.parquet(zones.runs)
    is_check = F.col("stage") == "check"
    runs = log.groupBy("run_id").agg(
        F.max(F.when(is_check, F.col("input_rows"))).alias("input_rows"),
        F.max(F.when(is_check, F.col("output_rows"))).alias("output_rows"),
        F.count_if(F.col("status") == "success").alias("stages"),
    )
    vouched = latest_state(spark, zones.fingerprints).agg(
        F.lit("latest").alias("run_id"), F.sum("rows").alias("output_rows")
    )
    return runs.unionByName(vouched, allowMissingColumns=True)


# Sinks and reads of the lake


@query
def dead_letter_written(spark, sf_dir):
    """Rejected rows written by arrival date, the first fortnight once more."""
    path = f"{working_folder(spark, 'dead-letter')}/rows"
    rejected = validate.rejected_rows(checked(spark, sf_dir))
    write_dead_letter(rejected, path)
    write_dead_letter(rejected.where(F.col("ingest_date") <= MIDDLE), path)
    kept = read_lake(spark, path)
    return kept.groupBy("ingest_date", validate.REASON).agg(F.count("*").alias("rows"))


@query
def one_partition(spark, sf_dir):
    """One day of one region of a written lake, by partition and as SQL over a view."""
    path = f"{working_folder(spark, 'one-partition')}/viewing_events"
    write_partitioned(clean(spark, sf_dir), path)
    day = read_partition(spark, path, event_date=date(2024, 1, 9), region="UK")
    return run_sql(
        spark,
        "SELECT content_id, count(*) AS events FROM {day} GROUP BY content_id",
        day=day,
    )


@query
def parquet_baseline(spark, sf_dir):
    """Events written as unpartitioned Parquet, counted by day."""
    path = f"{working_folder(spark, 'baseline')}/events"
    write_parquet_baseline(clean(spark, sf_dir), path)
    return read_lake(spark, path).groupBy("event_date").agg(F.count("*").alias("events"))
