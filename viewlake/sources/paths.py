"""Partition folders of a dataset.

Only folder names are listed, never data: their number grows with the days
kept, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _glob(spark: SparkSession, pattern: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, [s.getPath() for s in fs.globStatus(path) or [] if s.isDirectory()]


def partition_paths(
    spark: SparkSession, base: str, *columns: str
) -> list[tuple[str, ...]]:
    """Values of the partition columns, in folder order, one tuple per folder."""
    _, found = _glob(spark, "/".join([base, *(f"{c}=*" for c in columns)]))
    values = []
    for path in found:
        parts: list[str] = []
        for _ in columns:
            parts.insert(0, unquote(path.getName().split("=", 1)[1]))
            path = path.getParent()
        values.append(tuple(parts))
    return sorted(values)


def partition_dates(spark: SparkSession, base: str, column: str) -> list[date]:
    """Dates of the ``column=`` folders; folders that hold no date are left out."""
    dates = []
    for (text,) in partition_paths(spark, base, column):
        try:
            dates.append(date.fromisoformat(text))
        except ValueError:
            continue
    return dates


def dates_frame(spark: SparkSession, days: Iterable[date], column: str) -> DataFrame:
    """A one-column DataFrame of dates, built from SQL literals."""
    rows = ", ".join(f"(DATE'{d.isoformat()}')" for d in days)
    if not rows:
        return spark.sql(f"SELECT CAST(NULL AS DATE) AS {column} WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS days({column})")


def drop_partitions(
    spark: SparkSession,
    base: str,
    columns: tuple[str, ...],
    stale: Iterable[tuple[str, ...]],
) -> int:
    """Delete partition folders that a rebuild left without rows.

    A dynamic overwrite replaces partitions it writes rows to; one that became
    empty keeps its old files and has to be removed by name.
    """
    dropped = 0
    for values in stale:
        fs, found = _glob(
            spark, "/".join([base, *(f"{c}={v}" for c, v in zip(columns, values))])
        )
        for path in found:
            dropped += bool(fs.delete(path, True))
    return dropped


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return bool(fs.exists(hadoop))


def one_file(spark: SparkSession, folder: str) -> str | None:
    """Some data file of a partition folder, None when it holds none."""
    fs, hadoop = _path(spark, folder)
    listed = fs.listStatusIterator(hadoop)
    while listed.hasNext():
        name = listed.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return f"{folder}/{name}"
    return None


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a working folder of a finished run."""
    fs, hadoop = _path(spark, path)
    fs.delete(hadoop, True)


def move_folder(spark: SparkSession, path: str, into: str) -> None:
    """Move a folder under another, which is made if need be."""
    fs, source = _path(spark, path)
    _, target = _path(spark, f"{into}/{source.getName()}")
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not be moved: {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as a pointer."""
    fs, hadoop = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, None if it is empty."""
    fs, hadoop = _path(spark, path)
    java = spark._jvm.java.io
    stream = fs.open(hadoop)
    try:
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that nobody sees before it is whole: it gets its name by a
    rename. A name that is taken already is refused."""
    fs, target = _path(spark, path)
    if fs.exists(target):
        raise FileExistsError(f"published already: {path}")
    _, hidden = _path(spark, f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, target):
        raise OSError(f"could not be published: {path}")


def numbered_files(spark: SparkSession, folder: str, prefix: str, suffix: str) -> list[int]:
    """Numbers of the files named ``prefix``, a number and ``suffix``, ascending."""
    fs, hadoop = _path(spark, f"{folder}/{prefix}*{suffix}")
    names = [s.getPath().getName() for s in fs.globStatus(hadoop) or []]
    return sorted(int(n[len(prefix) : -len(suffix)]) for n in names)
