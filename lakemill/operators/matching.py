"""Joins on parts of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_containing(queries: DataFrame, names: DataFrame, query: Column, name: Column, id_col: str, run: int = 3) -> DataFrame:
    """queries with id_col, the least id of the names that contain the query; queries that no name contains are left out.

    Names are cut into their distinct runs of up to `run` signs, and a query meets only the names that hold the one of its
    own runs that fewest names have. A name is written once for each of its runs; distinct queries and distinct names
    meet, not their rows. Null and empty queries match nothing.
    """
    asked = queries.select(query.alias("__q")).where("__q <> ''").distinct()
    known = names.select(name.alias("__name"), F.col(id_col).alias("__id")).groupBy("__name").agg(F.min("__id").alias("__id"))
    runs = lambda text, n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda i: F.substring(F.col(text), i, F.lit(n)))
    held = known.select("__name", "__id", F.explode(F.array_distinct(F.flatten(F.array(*[runs("__name", n) for n in range(1, run + 1)])))).alias("__run"))
    named = held.groupBy("__run").agg(F.count("*").alias("__n"))
    rarest = asked.select("__q", F.explode(F.array_distinct(runs("__q", run))).alias("__run")).join(named, "__run").groupBy("__q").agg(F.min(F.struct("__n", "__run")).alias("r")).select("__q", F.col("r.__run").alias("__run"))
    met = rarest.join(held, "__run").where(F.contains("__name", "__q")).groupBy("__q").agg(F.min("__id").alias(id_col))
    return queries.withColumn("__q", query).join(met, "__q").drop("__q")
