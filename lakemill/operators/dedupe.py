"""Deduplication with a stated order: results never depend on the order in which Spark meets rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task sorts at a time, or of which it keeps sums that may be as many.
ROWS_OF_TASK = 500_000
#: Up to so many parts a task writes each as its rows come; for more, all that it writes is first held and sorted (see
#: spark.shuffle.sort.bypassMergeThreshold).
PARTS_OF_TASK = 200


def tasks_for(df: DataFrame) -> int:
    """To how many tasks rows such as those of df, which is cheap to count, are dealt so that each gets about as many.

    Numbers that are not named are the session's, or come from adaptive execution, which merges what is small in bytes
    as written: rows that compress well are then many to a task, and their memory grows with the input. So it would in
    the tasks that deal, if there were very many parts; rows beyond PARTS_OF_TASK shares make the shares larger.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, min(PARTS_OF_TASK, -(-df.count() // ROWS_OF_TASK)))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key (null is a key) the first row in the order, which must tell all rows of a key apart."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], position: str, tasks: int | None = None) -> DataFrame:
    """Of each key the fields of the row with the greatest position, which must tell all rows of a key apart.

    As keep_one(), but an aggregation. Spark aggregates structs by sorting, so rows are dealt by key first: merged before
    the shuffle, all of a task's input would be sorted at once, and most keys have one row. Without a number
    of tasks the rows are counted for it: see tasks_for().
    """
    best = F.max_by(F.struct(*fields), position)
    return df.repartition(tasks or tasks_for(df), *keys).groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col(f"__best.{f}").alias(f) for f in fields])


def field_wise(df: DataFrame, keys: Sequence[str], fields: Sequence[str], position: Column, last: bool = False) -> DataFrame:
    """Of each key and each field the first (or last) value by position that is not null; one aggregation, no window."""
    pick = F.max_by if last else F.min_by
    # Nulls are out of the contest as their position is null.
    return df.groupBy(*keys).agg(*[pick(F.col(f), F.when(F.col(f).isNotNull(), position)).alias(f) for f in fields])


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, and that value; keys with several are never guessed."""
    found = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__high"))
    return found.where(F.col(value) == F.col("__high")).drop("__high")


def best_role(role: Column, priority: Sequence[str]) -> Column:
    """The rank of a role in a list of priority, unknown roles last."""
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), role)
    return F.when(place > 0, place).otherwise(len(priority) + 1)
