"""What a session needs to run Python parts of a plan on other machines."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "casepulse_shipped"


def importable(spark: SparkSession) -> SparkSession:
    """Send this package to the session's Python workers, once, as ``spark-submit --py-files`` would."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return spark
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="casepulse-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)
    return spark
