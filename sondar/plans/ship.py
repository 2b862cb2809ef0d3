"""Making this package importable in the Python workers of a session."""

from __future__ import annotations

import io
import os
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from sondar.plans.lineage import put

ROOT = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to every executor, through the shared folder, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    pack = io.BytesIO()
    with zipfile.ZipFile(pack, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, os.path.join("sondar", p.relative_to(ROOT)))
    sc.addPyFile(put(spark, "sondar_src.zip", pack.getvalue()))
