"""Send this package to the executors, so that Python workers can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources, a small archive, to the session's files; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    path = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="lodestone-"), "lodestone_package.zip"))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"lodestone/{p.relative_to(root)}")
    context.addPyFile(path)
    _SENT.add(context.applicationId)
