"""The index of ids: only the folders that ids fall in are read."""

from datetime import date, timedelta

from conftest import rows_of
from pyspark.sql import functions as F

from viewlake.plans import id_index
from viewlake.sinks.versions import newest_pointer

DAY = date(2024, 1, 1)


def arrivals(spark, low, high, days=5):
    rows = spark.range(low, high).select(
        F.concat(F.lit("E"), F.col("id")).alias("event_id"),
        F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("ingest_date"),
    )
    return rows.withColumn("event_date", F.date_sub("ingest_date", 1))


def ids(spark, *numbers):
    return spark.createDataFrame([(f"E{n}",) for n in numbers], "event_id string")


def scan_filters(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_places_are_found(spark, tmp_path):
    base = str(tmp_path / "index")
    id_index.build(arrivals(spark, 0, 100), base)
    id_index.add(arrivals(spark, 100, 110, days=7), base)
    id_index.add(arrivals(spark, 3, 4, days=1), base)  # E3 once more, on the first day
    found = rows_of(id_index.places_of(ids(spark, 3, 106, 5000), base))
    assert found == [
        (DAY, DAY - timedelta(1)), (DAY + timedelta(1), DAY),
        (DAY + timedelta(3), DAY + timedelta(2)),
    ]
    assert id_index.places_of(ids(spark), base).count() == 0


def test_adding_again_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "index")
    id_index.build(arrivals(spark, 0, 50), base, rows_per_bucket=10)
    before = rows_of(id_index.read_index(spark, base))
    id_index.add(arrivals(spark, 0, 50).union(arrivals(spark, 0, 50)), base)
    assert rows_of(id_index.read_index(spark, base)) == before


def test_the_number_of_folders_follows_the_rows(spark, tmp_path):
    base = str(tmp_path / "index")
    id_index.build(arrivals(spark, 0, 0), base, rows_per_bucket=100)
    sizes = []
    for step in range(6):
        id_index.add(arrivals(spark, 200 * step, 200 * step + 200), base, rows_per_bucket=100)
        content = newest_pointer(spark, base).content
        assert content["rows"] == id_index.read_index(spark, base).count() == 200 * step + 200
        assert content["rows"] <= 100 * content["buckets"]
        sizes.append(content["buckets"])
    assert sizes == sorted(sizes) and sizes[-1] >= 12
    assert rows_of(id_index.places_of(ids(spark, 777), base)) == [
        (DAY + timedelta(2), DAY + timedelta(1))
    ]


def test_untouched_folders_are_pruned_and_reads_stay_level(spark, tmp_path):
    """Ten times the history, the same ids: as many folders and bytes are read."""
    read = {}
    for n in (4_000, 40_000):
        base = str(tmp_path / f"index-{n}")
        id_index.build(arrivals(spark, 0, n), base, rows_per_bucket=500)
        buckets = newest_pointer(spark, base).content["buckets"]
        asked = ids(spark, 1, 2, 3)
        hashes = asked.select(F.xxhash64("event_id").alias("id_hash"))
        touched = id_index._touched(hashes, buckets)
        held = id_index._in_buckets(id_index.read_index(spark, base), touched, buckets)
        assert "bucket" in scan_filters(held).split("PartitionFilters: [")[1].split("]")[0]
        assert held.select("bucket").distinct().count() <= len(touched) <= 3 < buckets
        read[n] = held.count()
        assert id_index.places_of(asked, base).count() == 3
    assert read[40_000] < 2 * read[4_000]


def test_a_folder_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "ROWS_PER_TASK", 100, raising=False)
    base = str(tmp_path / "index")
    id_index.build(arrivals(spark, 0, 1_000), base, rows_per_bucket=4_000)
    id_index.add(arrivals(spark, 500, 3_000), base, rows_per_bucket=4_000)
    index = id_index.read_index(spark, base)
    files = rows_of(index.groupBy("_metadata.file_name").count(), "count")
    assert sum(n for (n,) in files) == 3_000 and len(files) >= 10
    assert max(n for (n,) in files) < 1_000
    for n in (3, 2_999):
        assert id_index.places_of(ids(spark, n), base).count() == 1


def test_many_arrivals_make_more_folders_before_they_are_written(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "index")
    id_index.build(arrivals(spark, 0, 10), base, rows_per_bucket=100)
    written = []
    write = id_index._write
    monkeypatch.setattr(id_index, "_write", lambda rows, path, buckets, *more: (
        written.append(buckets), write(rows, path, buckets, *more)))
    id_index.add(arrivals(spark, 5, 2_000), base, rows_per_bucket=100)
    assert len(written) == 1 and written[0] >= 20
    content = newest_pointer(spark, base).content
    assert content["rows"] == id_index.read_index(spark, base).count() == 2_000
