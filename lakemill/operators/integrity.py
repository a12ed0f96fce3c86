"""Integrity checks, rules and gates. Every finding is a row; nothing is dropped without one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A finding wherever `broken` holds; null does not break a rule. blocking rules make a gate fail."""

    name: str
    broken: Column
    value: Column
    blocking: bool = True


def findings(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """(key, rule, value, blocking): all rules in one pass over the rows."""
    entries = F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(r.name).alias("rule"), r.value.cast("string").alias("value"), F.lit(r.blocking).alias("blocking"))) for r in rules])
    return df.select(F.col(key).alias("key"), F.explode(F.array_compact(entries)).alias("e")).select("key", "e.rule", "e.value", "e.blocking")


def references(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, position: str, declared: Column | None = None) -> DataFrame:
    """References that resolve to no row of dim: (position, key, motif, blocking).

    A missing key is `missing_key` and blocks, unless the row declares itself unresolved (`declared_unresolved`, which is
    only reported); a key without a row in dim is `orphan` and blocks.
    """
    told = F.lit(False) if declared is None else F.coalesce(declared, F.lit(False))
    keys = dim.select(F.col(dim_key).alias("__dim")).where("__dim is not null").distinct()
    rows = facts.select(F.col(position).alias("position"), F.col(key).alias("key"), told.alias("told")).join(keys, F.col("key") == F.col("__dim"), "left").where("__dim is null")
    motif = F.when(F.col("key").isNotNull(), "orphan").when(F.col("told"), "declared_unresolved").otherwise("missing_key")
    return rows.select("position", "key", motif.alias("motif")).withColumn("blocking", F.col("motif") != "declared_unresolved")


def gate(found: DataFrame, sections: Sequence[str], section: str = "rule") -> DataFrame:
    """(section, n_hard, n_soft, failed) for every section, found or not; soft findings never fail one."""
    counts = found.groupBy(F.col(section).alias("section")).agg(F.count_if("blocking").alias("n_hard"), F.count_if(~F.col("blocking")).alias("n_soft"))
    every = found.sparkSession.createDataFrame([(s,) for s in sections], "section string")
    return every.join(counts, "section", "left").fillna(0, ["n_hard", "n_soft"]).withColumn("failed", F.col("n_hard") > 0)
