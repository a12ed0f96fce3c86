"""Statistics of the kind that audits report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.values import percent


def histogram(df: DataFrame, value: Column, domain: Sequence[str], name: str = "value") -> DataFrame:
    """(name, n) over a closed domain: buckets without a row are 0, null is a bucket, other values are counted as
    `other`; the domain's bound is its declaration."""
    bucket = F.when(value.isNull(), "null").when(value.isin(*domain), value).otherwise("other")
    counts = df.groupBy(bucket.alias(name)).agg(F.count("*").alias("n"))
    buckets = df.sparkSession.createDataFrame([(v,) for v in [*domain, "null", "other"]], f"{name} string")
    return buckets.join(counts, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))


def described(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """n, least, most, median, mean (two digits) of the values that are not null; all but n are null without any."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.median(value).alias("median"), F.round(F.avg(value), 2).alias("mean"),
    )


def upper_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The value of rank n div 2 from 0 in order: the upper of two middle values. Counts by value are what is ranked,
    so a key of many rows and few values stays small."""
    from pyspark.sql import Window

    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    order = Window.partitionBy(*keys).orderBy(value)
    ranked = counts.withColumn("__upto", F.sum("__n").over(order)).withColumn("__all", F.sum("__n").over(Window.partitionBy(*keys)))
    return ranked.where(F.col("__upto") > F.floor(F.col("__all") / 2)).groupBy(*keys).agg(F.min(value).alias("upper_median"), F.max("__all").alias("n"))


def fill_rates(df: DataFrame, filled: dict[str, Column]) -> DataFrame:
    """(field, n_filled, n_total, pct): one pass over the rows, then one row for each field."""
    row = df.agg(F.count("*").alias("n_total"), *[F.count_if(c).alias(f"f{i}") for i, c in enumerate(filled.values())])
    fields = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"f{i}").alias("n_filled")) for i, k in enumerate(filled)])).alias("f")
    return row.select("n_total", fields).select("f.field", "f.n_filled", "n_total", percent(F.col("f.n_filled"), F.col("n_total")).alias("pct"))


def duplicates(df: DataFrame, key: Column) -> DataFrame:
    """Keys that occur more than once, with their count; null and blank keys do not count."""
    return df.where(key.isNotNull() & (F.btrim(key.cast("string")) != "")).groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1")


def by_prefix(df: DataFrame, warning: Column, entity: str) -> DataFrame:
    """Warnings by type, the text before the first colon: occurrences and distinct entities."""
    return df.where(warning.isNotNull()).groupBy(F.btrim(F.split(warning, ":", 2)[0]).alias("type")).agg(F.count("*").alias("n"), F.countDistinct(entity).alias("n_entities"))


def with_total(df: DataFrame, key: str, aggregates: Sequence[Column], total: str = "total") -> DataFrame:
    """Aggregates by key and over all rows, where the key is named total; a null key keeps its own row, named `null`."""
    rolled = df.withColumn(key, F.coalesce(F.col(key).cast("string"), F.lit("null"))).rollup(key).agg(F.grouping(key).alias("__all"), *aggregates)
    return rolled.withColumn(key, F.when(F.col("__all") == 1, total).otherwise(F.col(key))).drop("__all")
