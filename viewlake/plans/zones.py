"""Where the tables of one lake are, and how a job replaces parts of them."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from viewlake.sinks.files import write_partitioned
from viewlake.sources.paths import drop_partitions, exists, one_file, partition_paths


@dataclass(frozen=True)
class Zones:
    """Paths under one base folder; ``database`` is where runs declare the warehouse."""

    base: str
    database: str | None = None

    @property
    def raw_events(self) -> str:
        return f"{self.base}/raw/viewing_events"

    @property
    def metadata(self) -> str:
        return f"{self.base}/raw/content_metadata"

    @property
    def launch(self) -> str:
        return f"{self.base}/raw/content_launch"

    @property
    def checked(self) -> str:
        """Normalized arrivals by status and ingest date; status=rejected is the
        dead letter of broken rows."""
        return f"{self.base}/checked/viewing_events"

    @property
    def duplicates(self) -> str:
        return f"{self.base}/rejected/duplicates"

    @property
    def enriched(self) -> str:
        return f"{self.base}/curated/viewing_events"

    @property
    def daily(self) -> str:
        return f"{self.base}/curated/daily_aggregate"

    @property
    def warehouse(self) -> str:
        return f"{self.base}/warehouse"

    @property
    def processed(self) -> str:
        return f"{self.base}/state/processed"

    @property
    def unfinished(self) -> str:
        """Event dates that a run is rewriting; left over if it broke off."""
        return f"{self.base}/state/unfinished"

    @property
    def id_index(self) -> str:
        """Where copies of an id may be; see ``plans.id_index``."""
        return f"{self.base}/state/id_index"

    @property
    def reach(self) -> str:
        """The event dates that arrivals of each ingest date fell on."""
        return f"{self.base}/state/reach"

    @property
    def references(self) -> str:
        """Versions of the reference tables, and a pointer to those published."""
        return f"{self.base}/state/references"

    @property
    def event_columns(self) -> str:
        """The columns that landed event files have had."""
        return f"{self.base}/state/schemas/viewing_events"

    @property
    def reference_rejects(self) -> str:
        return f"{self.base}/rejected/references"

    @property
    def fingerprints(self) -> str:
        return f"{self.base}/state/fingerprints"

    @property
    def runs(self) -> str:
        return f"{self.base}/runs"


def side_by_side(*jobs: Callable[[], object]) -> list:
    """Run jobs that do not depend on each other at the same time; returns their results.

    All of them end before an error of one is raised.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    return [job.result() for job in running]


def replace_partitions(
    rows: DataFrame, path: str, keys: Sequence[str], first: Collection[str]
) -> DataFrame:
    """Make the partitions whose first key is in ``first`` hold exactly these rows,
    and return the written table.

    A dynamic overwrite replaces the partitions that get rows and stages its
    files, so the rows may come from the same path. A partition that still has a
    file from before got no rows and is removed.
    """
    spark = rows.sparkSession
    before = {}
    for values in partition_paths(spark, path, *keys):
        if values[0] in first:
            folder = "/".join([path, *(f"{k}={v}" for k, v in zip(keys, values))])
            file = one_file(spark, folder)
            if file is not None:
                before[values] = file
    write_partitioned(rows, path, keys)
    stale = [values for values, file in before.items() if exists(spark, file)]
    drop_partitions(spark, path, tuple(keys), stale)
    return spark.read.schema(rows.schema).parquet(path)


def read_if_filled(
    spark: SparkSession, path: str, key: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """A dataset partitioned by ``key``, None while it has no partition."""
    if not partition_paths(spark, path, key):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
