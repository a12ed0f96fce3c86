"""A session with the settings that the operators expect; a cluster's own settings win over none of them."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).parent


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew handling, UTC, timestamps without a zone read as they are."""
    builder = SparkSession.builder.appName("lakemill")
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the package to all Python workers of the session, wherever they run: as an archive that Spark itself serves.

    Not needed where every machine has the package on its Python path; a session gets it once.
    """
    context = spark.sparkContext
    if not any(name.startswith(f"{PACKAGE.name}-package") for name in context._python_includes):
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{PACKAGE.name}-package", "zip", PACKAGE.parent, PACKAGE.name)
        context.addPyFile(archive)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Texts reach Python in small Arrow batches, so that workers stay small. The session's setting changes for good, as
    frames are planned later; one that is not Spark's default is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))
