"""Makes this package importable where tasks run, on clusters that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as made:
        for path in sorted(package.rglob("*.py")):
            made.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
