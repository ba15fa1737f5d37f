"""Makes the package importable on the executors of a running session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application. Python functions of a plan are imported there by name."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="changeloom-")) / "changeloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, Path("changeloom") / f.relative_to(top))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
