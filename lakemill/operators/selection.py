"""Limits, samples, shards and budgets, in a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, order: list[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """df with a running number from 0 in the order, which must be total and agree with the order of bucket.

    Rows are numbered within their bucket, and a bucket starts where those before it end; only the buckets' counts meet
    in one task. Buckets should hold about a task's worth of rows each.
    """
    rows = df.withColumn("__bucket", bucket)
    sizes = rows.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(F.asc_nulls_first("__bucket")).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("__bucket").alias("__b"), F.coalesce(before, F.lit(0)).alias("__start"))
    own = rows.withColumn("__own", F.row_number().over(Window.partitionBy("__bucket").orderBy(*order)))
    placed = own.join(starts, F.col("__bucket").eqNullSafe(F.col("__b")))
    return placed.withColumn(name, F.col("__start") + F.col("__own") - 1).drop("__bucket", "__b", "__start", "__own")


def shard(df: DataFrame, order: list[Column], bucket: Column, index: int, total: int) -> DataFrame:
    """The rows whose rank modulo total is index."""
    return ranked(df, order, bucket, "__rank").where(F.col("__rank") % total == index).drop("__rank")


def systematic(df: DataFrame, order: list[Column], bucket: Column, k: int) -> DataFrame:
    """k rows at even ranks of the order, both ends among them; one row is the last; k of at least all rows is all."""
    n = df.count()
    if k >= n:
        return df
    picks = [n - 1] if k == 1 else sorted({round(i * (n - 1) / (k - 1)) for i in range(k)})
    return ranked(df, order, bucket, "__rank").where(F.col("__rank").isin(picks)).drop("__rank")


def budgeted(candidates: DataFrame, covered: DataFrame, key: str, stale: Column, order: list[Column], limit: int) -> DataFrame:
    """At most limit candidates: those not covered yet, in order, then covered ones that are stale, in order.

    covered: (key, and what stale is about). Adds `why`, `uncovered` or `stale`.
    """
    state = covered.select(key, F.lit(True).alias("__covered"), F.coalesce(stale, F.lit(False)).alias("__stale"))
    rows = candidates.join(state, key, "left").where("__covered is null or __stale")
    rows = rows.withColumn("why", F.when(F.col("__covered").isNull(), "uncovered").otherwise("stale"))
    return rows.orderBy(F.desc("why"), *order).limit(limit).drop("__covered", "__stale")
