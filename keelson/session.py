"""Session settings and shipping of the package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_shipped: set[str] = set()


def session(master: str = "local[*]", app: str = "keelson", **more: str) -> SparkSession:
    """A session with the library's settings; `more` overrides them (dots as double underscores)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="keelson-", suffix=".zip")
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(name)
    _shipped.add(context.applicationId)
