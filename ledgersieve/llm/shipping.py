"""Gets this package to the Python workers of a session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once; not needed where it is installed on the executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = Path(tempfile.mkdtemp(prefix="ledgersieve-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = folder / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(_PACKAGE.rglob("*.py")):
            target.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
