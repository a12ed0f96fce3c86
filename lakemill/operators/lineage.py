"""Frames that several readers share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def settled(df: DataFrame) -> DataFrame:
    """df, written once by checkpoint, for frames that are read more than once and dear to work out.

    The folder is the one the session has set or that spark.checkpoint.dir names; a session on one machine without
    either gets a temporary one, a cluster must name one.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="lakemill-checkpoint-"))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that executors and driver both reach, beside the checkpoints; see settled()."""
    settled(spark.range(0))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"
