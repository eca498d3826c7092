"""The package on the executors: they need not have it installed, nor share the driver's folders."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors of the session, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_kedge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="kedge-ship-")) / "kedge.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("kedge") / p.relative_to(root))
    sc.addPyFile(str(to))
    sc._kedge_shipped = True
