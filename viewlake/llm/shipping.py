"""Give the executors' Python workers this package."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark once per application, which sends it to every worker.

    The operators' functions are pickled by name, so that a worker keeps its caches
    from task to task; for that it must be able to import them.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, f"{PACKAGE.name}/{source.relative_to(PACKAGE)}")
    folder = Path(tempfile.mkdtemp(prefix="package-")).resolve()
    (folder / f"{PACKAGE.name}.zip").write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(folder / f"{PACKAGE.name}.zip"))
    _shipped.add(application)
