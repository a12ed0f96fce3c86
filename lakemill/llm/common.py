"""Small pieces shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.session import small_batches as small_batches

#: A word: anything but the blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the synthetic tables, read by Spark from wherever sf_dir points."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(col: str | Column) -> Column:
    """The words of a text: maximal runs of WORD. Null and empty texts have none."""
    return F.regexp_extract_all(text_or_empty(col), F.lit(WORD), F.lit(0))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder that spark.checkpoint.dir names.

    Only where the session names none and runs on one machine (tests, a laptop) a temporary folder is set; a cluster
    must name one. What led to df is not needed any more: the driver collects its garbage, upon which Spark removes the
    shuffle files that no frame refers to, and old checkpoints if spark.cleaner.referenceTracking.cleanCheckpoints is
    set, as lakemill.session does. Else they would stay until the driver's heap happens to fill.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="lakemill-checkpoint-"))
    done, spark = df.checkpoint(eager=True), df.sparkSession
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return done


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds: the split between learning and held-out rows."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % folds


#: Into how many parts the rows of one key are dealt when they learn what their key has decided.
SALTS = 16


def salt_of(col: str) -> Column:
    """The part that a row is dealt to, by a column in which the rows of one key differ."""
    return F.pmod(F.xxhash64(col), F.lit(SALTS))


def every_salt() -> Column:
    """All parts, for the rows that every part needs; there is one such row for a key."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
