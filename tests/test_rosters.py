"""Rosters, presence, holders of a post, whole documents, and shown names on small rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lakemill.functions import text
from lakemill.operators import normalize, rosters, templates


def test_presence_is_told(spark):
    listed = spark.createDataFrame([("p", 1, "Ann"), ("p", 2, "Bob"), ("q", None, None), ("q", 2, "Bob")], "party string, k int, name string")
    documents = spark.createDataFrame([(2,), (2,), (None,), (9,)], "k int")
    found = rosters.with_presence(listed, documents, "k", F.col("name")).collect()
    assert sorted((r.k or 0, r.present, r.warning or "") for r in found) == [(0, False, "no document: ?"), (1, False, "no document: Ann"), (2, True, ""), (2, True, "")]


def test_rosters_recover_and_tell(spark):
    frame = lambda rows: spark.createDataFrame(rows, "grp string, member int")
    config = spark.createDataFrame([("a",), ("b",), ("a",)], "grp string")
    rows = rosters.rostered(config, frame([("a", 1), ("a", 2), ("a", 2), ("x", 3), ("a", None)]), spark.createDataFrame([(2,), (4,), (3,)], "member int"), frame([("a", 4), ("a", 5), ("a", 2), ("x", 3)]))
    assert sorted((r.grp, r.member or 0, r.state) for r in rows.collect()) == [("a", 1, "missing"), ("a", 2, "member"), ("a", 4, "recovered"), ("b", 0, "no_roster")]
    assert sorted(tuple(r) for r in rosters.coverage(rows).collect()) == [("a", 2, 1, 1, 0.5), ("b", 0, 0, 0, None)]


def test_links_to_nothing_are_left_out(spark):
    links = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "member int, id string")
    assert [tuple(r) for r in rosters.expanded(links, spark.createDataFrame([("x", 5)], "id string, v int"), "id").collect()] == [(1, "x", 5)]


def test_one_holder_or_none(spark):
    d = lambda m: date(2000, m, 1)
    memberships = spark.createDataFrame([(1, "G", d(1), d(3)), (2, "G", d(1), None), (3, "H", d(1), None), (4, "G", d(9), None)], "member int, label string, first date, last date")
    posts = spark.createDataFrame([(1, "PM", " Chief", d(2), d(2)), (2, "PM", "on mission", d(2), None), (3, "PM", "chief", d(1), None), (4, "PM", "chief", d(1), d(2)), (2, "other", "chief", d(1), None)], "member int, post string, role string, first date, last date")
    periods = spark.createDataFrame([("one", "G", d(1), d(6)), ("none", "K", d(1), None), ("late", "G", d(8), None), ("all", "H", None, None)], "period string, label string, first date, last date")
    found = {r.period: (r.holder, r.warning) for r in normalize.sole_holder(memberships, posts, periods, "PM", "chief").collect()}
    assert found == {"one": (1, "another role: 2"), "none": (None, None), "late": (None, "another role: 2"), "all": (3, None)}
    more = posts.union(spark.createDataFrame([(2, "PM", "chief", d(2), d(2))], posts.schema))
    assert {r.period: (r.holder, r.warning) for r in normalize.sole_holder(memberships, more, periods, "PM", "chief").collect()}["one"] == (None, "2 possible: 1, 2; another role: 2")


def test_chambers_of_a_career(spark):
    mandate = "array<struct<category: string, chamber: string>>"
    rows = [(1, [("mandat_electif", "Senat"), ("commission", "PE")], "AN"), (2, [("mandat_electif", "AN"), ("mandat_electif", None)], "AN"), (3, None, "moon"), (4, [("mandat_electif", "PE")], None)]
    df = spark.createDataFrame(rows, f"id int, m {mandate}, c string")
    found = templates.chambers(F.col("m"), F.col("c"))
    out = {r.id: (r.names, r.first, r.bad, r.n, r.ok) for r in df.select("id", found.names.alias("names"), found.first.alias("first"), found.unsupported.alias("bad"), found.unstamped.alias("n"), found.supported.alias("ok")).collect()}
    assert out == {1: (["AN", "Senat"], "AN", ["AN"], 0, False), 2: (["AN"], "AN", [], 1, False), 3: ([], None, [], 0, False), 4: (["PE"], "PE", [], 0, True)}


def test_tags_of_each_intervention(spark):
    df = spark.createDataFrame([([(" Energy ", ["no"]), ("", ["B", " a", None, ""]), (None, None), ("b", None)],), (None,), ([],)], "i array<struct<theme: string, keywords: array<string>>>")
    assert [r.t for r in df.select(templates.intervention_tags(F.col("i")).alias("t")).collect()] == [["a", "b", "energy"], [], []]


def test_shown_names(spark):
    df = spark.createDataFrame([("ann  mary lee", 0.125), (" x", None), ("", float("nan")), (None, float("inf"))], "n string, v double")
    found = df.select(text.short_name(F.col("n")).alias("s"), text.last_name(F.col("n")).alias("l"), text.percentage(F.col("v")).alias("p")).collect()
    assert [tuple(r) for r in found] == [("AM", "lee", "13 %"), ("X", "x", "N/D"), ("?", "?", "N/D"), ("?", "?", "N/D")]
