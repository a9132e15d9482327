"""Where copies of an id may be, without reading what the ids came with.

For every arrival the index holds the 64-bit hash of its id and its ingest and event
date. Rows are dealt to folders by the hash, and a folder's rows to files of some
``ROWS_PER_TASK`` rows, each sorted by it. A run adds its arrivals to the folders they
fall in, and looks its changed ids up there: other folders are pruned, so that a run reads
as many folders as its ids fall in. A folder keeps its size while history grows, because
their number does: when arrivals would make folders hold more than ``ROWS_PER_BUCKET`` rows
on average, the index is written anew with more of them, a cost that comes once per doubling.

The index may name more dates than needed, when hashes collide or a corrected ingest
date lost rows. Who looks ids up compares the ids themselves in what the dates hold, so
this costs a read and changes no result. Adding rows again changes nothing either, but
that they count again as rows until the index is written anew.

Blooms would not help: a scan can be asked for some ten values, and a run changes many
thousands of ids.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.sinks.versions import newest_pointer, publish
from viewlake.sources.paths import drop_folder

ROWS_PER_BUCKET = 8_000_000

# Rows that one task sorts, at some 300 bytes each; a task may get a few files.
ROWS_PER_TASK = 500_000

PLACES = ("ingest_date", "event_date")
SCHEMA = "id_hash BIGINT, ingest_date DATE, event_date DATE, bucket INT"


def _hash(id_col: str) -> Column:
    return F.xxhash64(F.col(id_col)).alias("id_hash")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("id_hash"), F.lit(buckets)).cast("int")


def is_built(spark: SparkSession, base: str) -> bool:
    return newest_pointer(spark, base) is not None


def read_index(spark: SparkSession, base: str) -> DataFrame:
    state = newest_pointer(spark, base).content
    return spark.read.schema(SCHEMA).parquet(f"{base}/{state['folder']}")


def _in_buckets(index: DataFrame, touched: Collection[int], buckets: int) -> DataFrame:
    """The rows of some folders; the filter prunes the others."""
    if len(touched) == buckets:
        return index
    return index.where(F.col("bucket").isin(sorted(touched)))


def _touched(hashes: DataFrame, buckets: int) -> dict[int, int]:
    """The folders that hashes fall in and how many do, at most one number for each."""
    found = hashes.groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("rows"))
    return {row["bucket"]: row["rows"] for row in found.orderBy("bucket").collect()}


def _write(rows: DataFrame, path: str, buckets: int, mode: str, n: int, folders: int) -> None:
    """Sorted files; a folder's rows are dealt to several by other bits of their hash.

    ``n`` is how many rows there are for ``folders`` of the buckets. The number of tasks
    is given, since adaptive execution would join files by their bytes on disk, which
    are far less than what a sort holds.
    """
    slices = max(1, -(-n // (folders * ROWS_PER_TASK)))
    tasks = min(max(1, folders * slices), 2 * -(-n // ROWS_PER_TASK) + 1)
    part = F.pmod(F.shiftright("id_hash", 32), F.lit(slices)).alias("_slice")
    dealt = rows.select("id_hash", *PLACES, _bucket(buckets).alias("bucket"), part)
    unique = dealt.repartition(tasks, "bucket", "_slice").distinct()
    (
        unique.sortWithinPartitions("bucket", "_slice", "id_hash", *PLACES)
        .drop("_slice")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("bucket")
        .parquet(path)
    )


def _fresh(arrivals: DataFrame, id_col: str) -> DataFrame:
    # An id with many copies is one row of each task and date before it is dealt.
    return arrivals.select(_hash(id_col), *PLACES).distinct()


def build(arrivals: DataFrame, base: str, id_col: str = "event_id", rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Index all arrivals there are."""
    _rebuild(_fresh(arrivals, id_col), base, rows_per_bucket)


def _rebuild(rows: DataFrame, base: str, rows_per_bucket: int) -> None:
    spark = rows.sparkSession
    before = newest_pointer(spark, base)
    n = rows.count()
    buckets = 1
    while buckets * rows_per_bucket < 2 * n:
        buckets *= 2
    number = 1 if before is None else before.content["number"] + 1
    folder = f"index-{number}"
    _write(rows, f"{base}/{folder}", buckets, "static", n, buckets)
    publish(spark, base, {"number": number, "folder": folder, "buckets": buckets, "rows": n})
    if before is not None:
        drop_folder(spark, f"{base}/{before.content['folder']}")


def add(arrivals: DataFrame, base: str, id_col: str = "event_id", rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Add arrivals to the folders they fall in."""
    spark = arrivals.sparkSession
    state = newest_pointer(spark, base).content
    path, buckets = f"{base}/{state['folder']}", state["buckets"]
    fresh = _fresh(arrivals, id_col)
    touched = _touched(fresh, buckets)
    if not touched:
        return
    added = sum(touched.values())
    rows = state["rows"] + added
    if rows > buckets * rows_per_bucket:
        every = read_index(spark, base).drop("bucket").unionByName(fresh)
        _rebuild(every.distinct(), base, rows_per_bucket)
        return
    held = _in_buckets(read_index(spark, base), touched, buckets)
    # Hashes spread evenly, so a folder holds its share of what was counted.
    n = state["rows"] * len(touched) // buckets + added
    _write(held.drop("bucket").unionByName(fresh), path, buckets, "dynamic", n, len(touched))
    publish(spark, base, {**state, "rows": rows})


def places_of(ids: DataFrame, base: str, id_col: str = "event_id") -> DataFrame:
    """The (ingest_date, event_date) pairs of all arrivals that may have one of the ids."""
    spark = ids.sparkSession
    buckets = newest_pointer(spark, base).content["buckets"]
    hashes = ids.select(_hash(id_col)).distinct()
    held = _in_buckets(read_index(spark, base), _touched(hashes, buckets), buckets)
    return held.join(hashes, "id_hash", "left_semi").select(*PLACES).distinct()
