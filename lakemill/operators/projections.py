"""Projections of raw documents onto one form: mandates, texts, interventions, questions, names, sources.

What is missing stays null: nothing is inferred from another field unless the function says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the documents: an end date that means no end, the category that carries a chamber, the role of a member.
OPEN_END, ELECTIVE, MEMBER = "9999-12-31", "mandat_electif", "membre"


def blank_to_null(c: Column) -> Column:
    return F.when(F.btrim(c) != "", c)


def labelled(value: Column, labels: Mapping[str, str]) -> Column:
    """The label of a value, null for a value without one."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), value) if labels else F.lit(None).cast("string")


def mandate(category: Column, role: Column, first: Column, last: Column, stamp: Column, chambers: Mapping[str, str]) -> dict[str, Column]:
    """A mandate's fields: the role defaults to member, it is active while it has no end, and only an elective mandate
    has a chamber, that of its own stamp."""
    end = F.when(last != OPEN_END, last)
    return {
        "category": category, "role": F.coalesce(blank_to_null(role), F.lit(MEMBER)), "first": first, "last": end, "active": end.isNull(),
        "chamber": F.when(category == ELECTIVE, F.try_element_at(F.create_map(*[F.lit(x) for kv in chambers.items() for x in kv]), F.coalesce(stamp, F.lit("")))),
    }


def intervention(session: Column, dossier: Column, subject: Column, kind: Column, answer: Column) -> dict[str, Column]:
    """An intervention's nested parts, each there only if what it refers to is; the official theme needs a session, and
    the answer is a question's own."""
    return {
        "session": F.when(session.isNotNull(), F.struct(session.alias("ref"), subject.alias("subject"))),
        "dossier": F.when(dossier.isNotNull(), F.struct(dossier.alias("ref"))),
        "theme": F.when(session.isNotNull(), subject),
        "answer": F.when(kind == "question", answer),
    }


def document_tags(themes: Column, keywords: Column) -> Column:
    """Themes, or else keywords: trimmed, lower case, each once, sorted."""
    clean = lambda a: F.filter(F.transform(a, lambda x: F.lower(F.btrim(x))), lambda x: x.isNotNull() & (x != ""))
    own = F.coalesce(clean(themes), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.when(F.size(own) > 0, own).otherwise(F.coalesce(clean(keywords), own))))


def name_of_slug(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def given_and_surname(name: Column) -> Column:
    """SURNAME Given, its leading words in capitals, as Given SURNAME in title case; other names as they are."""
    surname = F.regexp_extract(name, r"^((?:\p{Lu}[\p{Lu}'-]+ )+)", 1)
    given = F.substring(name, F.length(surname) + 1, F.length(name))
    return F.when((surname != "") & (given != ""), F.concat_ws(" ", given, F.initcap(F.btrim(surname)))).otherwise(name)


def last_of(node: Column) -> Column:
    """Of a node that holds one object or a list of them the last, as JSON; of an empty list none."""
    array = F.when(F.startswith(F.ltrim(node), F.lit("[")), F.from_json(node, "array<string>")).otherwise(F.array(node))
    return F.try_element_at(array, F.lit(-1))


def added(existing: DataFrame, more: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """existing with the rows of more whose key (null is a key) it lacks, each key once; `origin` is null for old rows
    and the source for new ones, so a source is named only where it added something."""
    match = reduce(Column.__and__, [existing[k].eqNullSafe(more[k]) for k in keys])
    fresh = more.join(existing, match, "left_anti").dropDuplicates(list(keys))
    return existing.withColumn("origin", F.lit(None).cast("string")).unionByName(fresh.withColumn("origin", F.lit(source)))


def first_answering(primary: DataFrame, other: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Of two sources the first that answers for a key, which one it was, and a warning where both did or it failed."""
    a, b = primary.alias("a"), other.alias("b")
    has = lambda x: F.col(f"{x}.{key}").isNotNull()
    warning = F.when(has("a") & has("b"), "both_answered").when(~has("a"), "first_failed")
    picked = [F.when(has("a"), F.col(f"a.{f}")).otherwise(F.col(f"b.{f}")).alias(f) for f in fields]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key), *picked, F.when(has("a"), "first").otherwise("second").alias("answered_by"), warning.alias("warning")
    )


def without_covered(old: DataFrame, official: DataFrame, member: str, label: Column, official_label: Column) -> DataFrame:
    """Old mandates less those that an official one makes redundant: same member, category and label, overlapping."""
    o, f = old.withColumn("__label", label).alias("o"), official.withColumn("__label", official_label).alias("f")
    disjoint = F.coalesce(F.col("o.first") > F.col("f.last"), F.lit(False)) | F.coalesce(F.col("o.last") < F.col("f.first"), F.lit(False))
    same = (F.col(f"o.{member}") == F.col(f"f.{member}")) & (F.col("o.category") == F.col("f.category")) & (F.col("o.__label") == F.col("f.__label"))
    return o.join(f, same & ~disjoint, "left_anti").drop("__label")


def eligibility_spans(mandates: Column, chamber: Column) -> Column:
    """Of an array of mandates the spans of elective ones in a chamber, or without a chamber: null if there is no
    elective mandate at all, which bars nobody, and empty if there is none in this chamber, which bars always."""
    elective = F.filter(mandates, lambda m: m["category"] == ELECTIVE)
    mine = F.filter(elective, lambda m: m["chamber"].isNull() | (m["chamber"] == chamber))
    return F.when(F.size(elective) > 0, F.transform(mine, lambda m: F.struct(m["first"].alias("first"), m["last"].alias("last"))))
