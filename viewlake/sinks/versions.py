"""Versions of tables, and pointers that say which of them belong together.

A writer puts new versions next to those that are being read. Then it publishes a
pointer, a small JSON file with the next number, by one rename: a reader sees all of a
run or nothing of it. What the newest two pointers do not name may be removed, so
whoever began to read before a run still finds every file after it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viewlake.sources.paths import (
    drop_folder,
    drop_partitions,
    exists,
    numbered_files,
    partition_paths,
    publish_text,
    read_text,
)

KEPT_POINTERS = 2
_PREFIX, _SUFFIX = "pointer-", ".json"


@dataclass(frozen=True)
class Pointer:
    number: int
    content: dict


def _file(base: str, number: int) -> str:
    return f"{base}/{_PREFIX}{number:010d}{_SUFFIX}"


def kept_pointers(spark: SparkSession, base: str) -> list[Pointer]:
    """The newest pointers, the latest last."""
    numbers = numbered_files(spark, base, _PREFIX, _SUFFIX)[-KEPT_POINTERS:]
    return [Pointer(n, json.loads(read_text(spark, _file(base, n)))) for n in numbers]


def newest_pointer(spark: SparkSession, base: str) -> Pointer | None:
    numbers = numbered_files(spark, base, _PREFIX, _SUFFIX)[-1:]
    for n in numbers:
        return Pointer(n, json.loads(read_text(spark, _file(base, n))))
    return None


def publish(spark: SparkSession, base: str, content: dict) -> Pointer:
    """Make ``content`` the newest pointer and remove those no longer kept."""
    numbers = numbered_files(spark, base, _PREFIX, _SUFFIX)
    made = Pointer(max(numbers, default=0) + 1, content)
    publish_text(spark, _file(base, made.number), json.dumps(content, sort_keys=True))
    for n in numbers[: -KEPT_POINTERS + 1 or None]:
        drop_folder(spark, _file(base, n))
    return made


def newest_version(spark: SparkSession, base: str) -> int:
    """Number of the newest complete version of a table, 0 when there is none."""
    versions = [int(v) for (v,) in partition_paths(spark, base, "version")]
    done = [v for v in versions if exists(spark, f"{base}/version={v}/_SUCCESS")]
    return max(done, default=0)


def version_path(base: str, version: int) -> str:
    return f"{base}/version={version}"


def write_version(rows: DataFrame, base: str) -> int:
    """Write rows as the next version of a table and return its number."""
    version = newest_version(rows.sparkSession, base) + 1
    rows.write.mode("overwrite").parquet(version_path(base, version))
    return version


def drop_versions(spark: SparkSession, base: str, below: int, kept: set[int] = frozenset()) -> None:
    """Remove the versions below a number, but for those that are ``kept``."""
    older = [int(v) for (v,) in partition_paths(spark, base, "version")]
    stale = [(str(v),) for v in older if v < below and v not in kept]
    drop_partitions(spark, base, ("version",), stale)
