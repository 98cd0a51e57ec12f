"""A session with the settings that the engine's plans expect."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(cores: int | None = None, **conf) -> SparkSession:
    """A local session; on a cluster use the cluster's own and leave this alone."""
    cores = cores or os.cpu_count() or 1
    settings = {
        "spark.sql.shuffle.partitions": str(max(8, cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quorumtext")
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the workers, once an application.

    Functions that run in Python workers are known there by their module's name; the
    driver may have found the package in a way that workers do not share.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quorumtext-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)
