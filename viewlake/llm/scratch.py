"""Shared folders, checkpoints and Arrow batches for the operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from viewlake.session import shared_folder, working_folder

#: Characters of text an operator takes at once inside a task.
SLICE_CHARS = 2_000_000


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder named by ``spark.checkpoint.dir``."""
    return working_folder(spark, purpose)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``new_folder`` named, on whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder.

    ``checkpoint`` writes through the cluster's store, so a lost executor costs
    nothing but the tasks it was running.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


_kept: dict[Hashable, Any] = {}


def keep_one(key: Hashable, make: Callable[[], Any]) -> Any:
    """What this worker has made for a key, kept from task to task.

    A worker outlives queries, so it keeps one thing only: what it was asked for last.
    The one before goes first, so two are never held at once.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str, fill: bool = True
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SLICE_CHARS`` bytes of ``text`` at most.

    A batch holds many rows of short text or a few of very long text; a single
    text is never cut. NULL texts become empty, unless they are to be left.
    """
    for batch in batches:
        at = batch.schema.get_field_index(text)
        filled = pc.fill_null(batch.column(at), "")
        if fill:
            batch = batch.set_column(at, pa.field(text, filled.type), filled)
        sizes = pc.binary_length(filled).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > SLICE_CHARS:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
