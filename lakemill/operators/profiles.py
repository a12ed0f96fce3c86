"""Documents put together from facts: tags with their fallbacks, groups, persons, the overview of all reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.values import rate
from lakemill.operators.intervals import enclosing, holds_strictly


def tags_with_fallback(own: DataFrame, talks: DataFrame) -> DataFrame:
    """(member, tag): own tags as they are; of members without any the themes of talks(member, theme, keyword), trimmed and
    in lower case; of members without a theme either the keywords of talks whose theme is missing.

    A theme that is blank is no theme, yet its talk does not fall back to its keyword.
    """
    clean = lambda c: F.lower(F.btrim(F.col(c)))
    mine = own.select("member", "tag").distinct()
    rest = talks.join(mine.select("member").distinct(), "member", "left_anti")
    # Both kinds of each member are gathered in one pass, so who has no theme is known without a second join.
    found = rest.groupBy("member").agg(F.collect_set(F.when(clean("theme") != "", clean("theme"))).alias("themes"), F.collect_set(F.when(F.col("theme").isNull() & (clean("keyword") != ""), clean("keyword"))).alias("keywords"))
    chosen = F.when(F.size("themes") > 0, F.col("themes")).otherwise(F.col("keywords"))
    return mine.unionByName(found.select("member", F.explode(chosen).alias("tag")))


def weighed_tags(tags: DataFrame) -> DataFrame:
    """(tag, n_members, weight): the share of the members with any tag that have this one."""
    members = tags.select("member").distinct().count()
    return tags.distinct().groupBy("tag").agg(F.count("*").alias("n_members")).withColumn("weight", rate(F.col("n_members"), F.lit(members)))


def group_documents(members: DataFrame, spans: DataFrame, votes: DataFrame) -> DataFrame:
    """One row for each group of members(member, grp), with the range of its members' spans and the means of its rows in
    cohesion(); a group without spans or ballots has none, which is not zero."""
    size = members.groupBy("grp").agg(F.count("*").alias("n_members"))
    ranges = enclosing(spans.join(members, "member"), ["grp"], "first", "last").select("grp", "first", "last", "active")
    means = votes.groupBy("grp").agg(
        F.count("*").alias("n_ballots"), F.round(F.avg("participation"), 4).alias("participation"), F.round(F.avg("coherence"), 4).alias("coherence"),
        F.count_if(~F.col("quorum")).alias("n_without_quorum"), F.min("date").alias("first_ballot"), F.max("date").alias("last_ballot"),
    )
    found = size.join(ranges, "grp", "left").join(means, "grp", "left").fillna(0, ["n_ballots", "n_without_quorum"])
    return found.withColumn("active", F.coalesce("active", F.lit(False)))


def position_at(date: Column, periods: Column, precedence: Sequence[str], otherwise: str) -> Column:
    """The position held at a date, by an array of (kind, first, last); of several the first by precedence."""
    held = F.transform(F.filter(periods, lambda p: holds_strictly(date, p["first"], p["last"])), lambda p: p["kind"])
    return reduce(lambda c, kind: c.when(F.array_contains(held, kind), kind), precedence[1:], F.when(F.array_contains(held, precedence[0]), precedence[0])).otherwise(otherwise)


def person_views(people: DataFrame, texts: DataFrame) -> DataFrame:
    """people(member, name) with figures of texts(member, theme, adopted, date): how many, the share adopted (null without
    any), the last date, and the theme most texts have, the first by name of equals."""
    themes = texts.groupBy("member", "theme").agg(F.count("*").alias("n"), F.count_if("adopted").alias("n_adopted"), F.max("date").alias("last"))
    # Themes are merged first, so a member's figures come from a few rows. The greatest count wins, then the least name.
    main = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "theme")))
    found = themes.groupBy("member").agg(F.sum("n").alias("n_texts"), F.sum("n_adopted").alias("n_adopted"), F.max("last").alias("last_seen"), F.get(main, 0)["theme"].alias("main_theme"))
    rows = people.join(found, "member", "left")
    return rows.select("member", "name", F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"), rate(F.col("n_adopted"), F.col("n_texts")).alias("adopted"), "last_seen", "main_theme")


def overview(sections: Mapping[str, tuple[DataFrame, Column, float]]) -> DataFrame:
    """(section, n, bad, percent, state, rank) of tables, what is wrong in a row of them, and the percentage that is still
    good; twice that is fair. One row for each section is ranked, the worst first."""
    parts = []
    for name, (df, bad, most) in sections.items():
        one = df.agg(F.count("*").cast("double").alias("n"), F.count_if(bad).cast("double").alias("bad"))
        parts.append(one.select(F.lit(name).alias("section"), "n", "bad", F.lit(most).alias("most")))
    rows = reduce(DataFrame.unionByName, parts)
    share = F.lit(100.0) * F.col("bad")
    state = F.when(share <= F.col("most") * F.col("n"), "good").when(share <= 2 * F.col("most") * F.col("n"), "fair").otherwise("poor")
    rank = F.rank().over(Window.orderBy(F.desc(F.col("bad") / F.col("n")), "section"))
    return rows.select("section", "n", "bad", F.round(share / F.col("n"), 2).alias("percent"), state.alias("state"), rank.cast("long").alias("rank"))
