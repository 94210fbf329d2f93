"""Make the package importable inside tasks.

Operators with Python code in tasks need this package on every executor.  Where
the cluster does not install it, ``ship`` hands Spark a zip of the sources
(``addPyFile``), once per application.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="konform-src-")) / "konform_src.zip"     # read by the driver's file server only
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
