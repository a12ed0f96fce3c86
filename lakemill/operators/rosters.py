"""Who is listed, who has a document, and what a list of links stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_presence(listed: DataFrame, documents: DataFrame, key: str, label: Column, what: str = "document") -> DataFrame:
    """listed with present, whether documents has the key, and warning, which names who has none. Every listed row stays;
    a null key has no document."""
    there = documents.select(F.col(key).alias("__key")).where("__key is not null").distinct().withColumn("__there", F.lit(True))
    rows = listed.join(there, listed[key] == there["__key"], "left")
    present = F.coalesce("__there", F.lit(False))
    return rows.select(*[listed[c] for c in listed.columns], present.alias("present"), F.when(~present, F.concat(F.lit(f"no {what}: "), F.coalesce(label.cast("string"), F.lit("?")))).alias("warning"))


def expanded(links: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """links with the fields of their dimension row, as records were before they were stored once; links that lead
    nowhere are left out."""
    fields = [c for c in dim.columns if c != key]
    side = dim.select(F.col(key).alias("__key"), *fields)
    return links.join(side, links[key] == side["__key"]).select(*[links[c] for c in links.columns], *fields)


def rostered(config: DataFrame, roster: DataFrame, documents: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(grp, member, state) of each configured group: `member` with a document, `missing` without, and `recovered` for one
    whom the roster does not name any more but the previous output did, and who has a document.

    config(grp), roster(grp, member), documents(member), previous(grp, member). A group without a roster has one row with
    a null member and the state `no_roster`: that nobody was found is not that nobody is there.
    """
    named = roster.select("grp", "member").where("member is not null").distinct()
    there = documents.select("member").where("member is not null").distinct().withColumn("there", F.lit(True))
    rows = config.select("grp").distinct().join(named, "grp", "left").join(there, "member", "left")
    state = F.when(F.col("member").isNull(), "no_roster").when(F.col("there"), "member").otherwise("missing")
    found = rows.select("grp", "member", state.alias("state"))
    if previous is None:
        return found
    gone = previous.select("grp", "member").distinct().join(named, ["grp", "member"], "left_anti").join(there, "member").join(config.select("grp").distinct(), "grp", "left_semi")
    return found.unionByName(gone.select("grp", "member", F.lit("recovered").alias("state")))


def coverage(rows: DataFrame) -> DataFrame:
    """(grp, n_roster, n_found, n_recovered, covered) of rostered(): covered is the share of the roster that has a
    document, null without a roster."""
    count = lambda *states: F.count_if(F.col("state").isin(*states))
    sums = rows.groupBy("grp").agg(count("member", "missing").alias("n_roster"), count("member").alias("n_found"), count("recovered").alias("n_recovered"))
    return sums.withColumn("covered", F.round(F.try_divide(F.col("n_found").cast("double"), F.col("n_roster").cast("double")), 4))
