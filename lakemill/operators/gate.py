"""Sections of the quality gate: each gives rows that say what was found and whether it blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def incomplete_reads(warnings: DataFrame, marker: str, threshold: int) -> DataFrame:
    """(place, endpoint, n, failed) of warnings(place, warning) that hold the marker; the endpoint stands before the
    first colon. All rows fail together, if there are more findings than the threshold."""
    hits = warnings.where(F.contains("warning", F.lit(marker)))
    counts = hits.groupBy("place", F.split_part("warning", F.lit(":"), F.lit(1)).alias("endpoint")).agg(F.count("*").alias("n"))
    # One row for each place and endpoint is left, so their sum may run in one task.
    return counts.withColumn("failed", F.sum("n").over(Window.partitionBy()) > threshold)


def low_counts(docs: DataFrame, key: str, covered: Column, least: int, least_primary: int) -> DataFrame:
    """Documents (key, n, n_primary) below a threshold; null counts are zero, as these documents have no entries."""
    zero = F.lit(0).cast("long")
    rows = docs.select(key, F.coalesce("n", zero).alias("n"), F.coalesce("n_primary", zero).alias("n_primary"))
    rows = rows.withColumns({"few": F.col("n") < least, "few_primary": covered & (F.col("n_primary") < least_primary)})
    return rows.where("few or few_primary")


def id_coverage(docs: DataFrame) -> DataFrame:
    """One row on documents (n, n_ids, failed): how many carry ids in part, wholly, failed, and whether none has any."""
    return docs.agg(
        F.count("*").alias("n_documents"), F.count_if((F.col("n_ids") > 0) & (F.col("n_ids") < F.col("n"))).alias("n_mixed"), F.count_if(F.col("n_ids") == F.col("n")).alias("n_whole"),
        F.count_if("failed").alias("n_failed"), (F.max("n_ids") == 0).alias("none_at_all"),
    )


def key_format(rows: DataFrame, part: str, ref: str, order: str, pattern: str) -> DataFrame:
    """(part, first_ref, legacy): by the first reference of each part whether its keys have the old form."""
    first = rows.groupBy(part).agg(F.min_by(ref, order).alias("first_ref"))
    return first.select(part, "first_ref", (~F.col("first_ref").rlike(pattern)).alias("legacy"))


def groups(states: DataFrame, least_members: int, least_percent: int) -> DataFrame:
    """(id, what, hard): missing and invalid groups are hard findings, few members and low coverage soft ones."""
    there = F.col("present")
    found = [
        ("missing", ~there, True), ("invalid", there & ~F.col("valid"), True), ("few_members", there & (F.col("n_members") < least_members), False),
        ("low_coverage", there & (F.col("n_expected") > 0) & (100 * F.col("n_members") < least_percent * F.col("n_expected")), False),
    ]
    entries = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("what"), F.lit(h).alias("hard"))) for n, c, h in found]))
    return states.select("id", F.explode(entries).alias("e")).select("id", "e.what", "e.hard")


def simultaneous_zero(rows: DataFrame, period: str) -> DataFrame:
    """By period: covered documents, those of them at zero, those not covered, and whether two or more covered ones are
    all at zero."""
    c, zero = F.col("covered"), F.col("n_texts") == 0
    found = rows.groupBy(period).agg(F.count_if(c).alias("n_covered"), F.count_if(c & zero).alias("n_zero"), F.count_if(~c).alias("n_outside"))
    return found.withColumn("all_zero", (F.col("n_covered") >= 2) & (F.col("n_zero") == F.col("n_covered")))


def status_histogram(files: DataFrame, statuses: str) -> DataFrame:
    """(field, status, n) of a column of maps from field to status."""
    return files.select(F.explode(statuses).alias("field", "status")).groupBy("field", "status").agg(F.count("*").alias("n"))


def verdict(found: DataFrame) -> DataFrame:
    """One row on findings (what, hard): sections with any, hard and soft findings, and whether the gate fails."""
    return found.agg(F.countDistinct("what").alias("n_sections"), F.count_if("hard").alias("n_hard"), F.count_if(~F.col("hard")).alias("n_soft"), F.coalesce(F.bool_or("hard"), F.lit(False)).alias("failed"))
