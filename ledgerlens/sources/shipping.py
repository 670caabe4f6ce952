"""Send this package along with a session whose executors may not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Once a session: a zip of the package, handed out by Spark itself. Not needed where PYTHONPATH has the package."""
    context = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or hasattr(context, "_ledgerlens_shipped"):
        return
    path = Path(tempfile.mkdtemp(prefix="ledgerlens-")) / "ledgerlens.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((ROOT / "ledgerlens").rglob("*.py")):
            archive.write(source, source.relative_to(ROOT))
    context.addPyFile(str(path))
    context._ledgerlens_shipped = True
