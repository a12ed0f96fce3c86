"""Incremental refresh: batches of new rows merged into a stored state, under foreachBatch or by hand."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemill.operators.merge import coalesce_upsert


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that a state folder names, oldest first; a version is named once it is whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    done = [s.getPath() for s in fs.listStatus(hadoop)]
    names = [(p.getName(), fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))) for p in done]
    return sorted(int(n[1:]) for n, whole in names if whole and n[:1] == "v" and n[1:].isdigit())


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest whole state, or none."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/v{found[-1]}") if found else None


def refresher(path: str, keys: Sequence[str], order: str) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: the batch's latest row of each key, merged field by field into the state.

    Every batch writes a version of its own and a batch that is replayed writes the same version again, from the one
    before it, so a lost driver or executor does no harm.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark, path) if v < number]
        fields = [c for c in batch.columns if c not in keys]
        newest = batch.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("__order"), *fields)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in fields])
        state = coalesce_upsert(spark.read.parquet(f"{path}/v{before[-1]}"), newest, keys) if before else newest
        state.write.mode("overwrite").parquet(f"{path}/v{number}")

    return merge


def refresh_stream(source: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: str) -> StreamingQuery:
    """Drains a stream into the state at path."""
    return source.writeStream.foreachBatch(refresher(path, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, value: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and key; on a stream, windows close when the watermark has passed them."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def freshness(parts: DataFrame, now: F.Column, days: int) -> DataFrame:
    """(part, state) of parts(part, frozen, synced, failed): never_built, failed, stale, frozen or fresh.

    A part that is closed for good is frozen if it was built; one whose last attempt failed, or whose last sync is older
    than so many days, is not fresh.
    """
    old = F.floor((F.unix_micros(now) - F.unix_micros(F.col("synced").cast("timestamp"))) / F.lit(86_400_000_000)) > days
    state = F.when(F.col("frozen") & F.col("synced").isNotNull(), "frozen").when(F.col("synced").isNull(), "never_built").when(F.col("failed"), "failed").when(old, "stale").otherwise("fresh")
    return parts.select("part", state.alias("state"))
