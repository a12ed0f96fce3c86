"""Writing tables: sharded by a key, as JSON documents, with a manifest, and only if complete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_shards(df: DataFrame, path: str, by: str, sort: list[str]) -> None:
    """Parquet partitioned by a column, rows of a shard sorted; a shard is overwritten only where df has rows of it.

    Rows are rebalanced by the column, so that a large shard is written by several tasks and a small one by one.
    """
    writer = df.hint("rebalance", by).sortWithinPartitions(by, *sort).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Lines of compact JSON, one document each; null fields are written, as null is not absence."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(path)


def append_manifest(df: DataFrame, path: str, key: str, run: str) -> None:
    """Adds the keys that a run has written to a manifest table. A run that is repeated writes its own part anew, so its
    keys stand there once."""
    rows = df.select(F.col(key).cast("string").alias("key")).distinct().withColumn("run", F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def pending(df: DataFrame, path: str, key: str, run: str) -> DataFrame:
    """The rows whose key a run's manifest does not name yet, for a run that is resumed; all of them before it exists."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return df
    done = spark.read.schema("key string, run string").parquet(path).where(F.col("run") == run).select("key").distinct()
    return df.join(done, F.col(key).cast("string") == done["key"], "left_anti")


class Incomplete(RuntimeError):
    """Expected parts are missing, so nothing was written."""


def write_if_complete(df: DataFrame, path: str, expected: DataFrame, ingested: DataFrame, key: str) -> None:
    """Writes df unless an expected part was not ingested: not measured is not zero."""
    missing = expected.select(key).join(ingested.select(key), key, "left_anti").orderBy(key).limit(20).collect()
    if missing:
        raise Incomplete(f"not ingested: {', '.join(str(r[0]) for r in missing)}")
    df.write.mode("overwrite").parquet(path)


def markdown(df: DataFrame, title: str, rows: int = 200) -> str:
    """A small result as a Markdown table; a report shows at most so many rows and says how many there are."""
    total, shown = df.count(), df.limit(rows).collect()
    lines = [f"# {title}", "", f"{total} rows" + (f", {len(shown)} shown" if total > len(shown) else ""), "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in shown)]) + "\n"
