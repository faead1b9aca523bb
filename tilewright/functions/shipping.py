"""Makes the package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the workers of this application, once.

    A job that was submitted with ``--py-files`` has it already; a session made
    in a notebook or a test, in any folder, gets it here.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tilewright-")) / "tilewright.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("tilewright") / p.relative_to(root))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
