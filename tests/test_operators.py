"""The operators on small hand-written rows: nulls, ties, empty tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemill.functions import dates, text, values
from lakemill.operators import cohesion, dedupe, integrity, intervals, merge, selection, stats

D = dt.date


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("date", "first", "last", "loose", "strict"),
    [
        ("2020-01-05", "2020-01-01", "2020-01-05", True, True),
        ("2020-01-06", "2020-01-01", "2020-01-05", False, False),
        ("2020-01-06", "2020-01-01", None, True, True),
        (None, "2020-01-01", "2020-01-05", True, False),
        ("2020-01-06", None, None, True, False),
    ],
)
def test_interval_predicates(spark, date, first, last, loose, strict):
    c = [F.lit(x).cast("date") for x in (date, first, last)]
    assert value(spark, intervals.holds(*c)) is loose
    assert value(spark, intervals.holds_strictly(*c)) is strict


def test_no_spans_and_empty_spans_differ(spark):
    kind = "array<struct<first: date, last: date>>"
    day = F.lit("2020-01-01").cast("date")
    assert value(spark, intervals.eligible(day, F.lit(None).cast(kind))) is True
    assert value(spark, intervals.eligible(day, F.array().cast(kind))) is False
    assert value(spark, intervals.eligible(F.lit(None).cast("date"), F.array().cast(kind))) is True


def test_islands_merge_adjacent_spans_and_open_ends(spark):
    rows = [("a", D(2020, 1, 1), D(2020, 1, 31)), ("a", D(2020, 2, 1), D(2020, 2, 10)), ("a", D(2020, 3, 1), None), ("a", D(2021, 1, 1), D(2021, 2, 1)), ("a", None, D(2020, 1, 1))]
    df = spark.createDataFrame(rows, "k string, f date, l date")
    assert got(intervals.islands(df, ["k"], "f", "l")) == [("a", D(2020, 1, 1), D(2020, 2, 10), 2), ("a", D(2020, 3, 1), None, 2)]


def test_interval_join_meets_each_span_once(spark):
    points = spark.createDataFrame([(1, D(2020, 6, 1)), (2, D(2025, 1, 1)), (3, None)], "id int, d date")
    spans = spark.createDataFrame([("x", D(2019, 1, 1), None), ("y", None, D(2020, 6, 1))], "s string, f date, l date")
    met = intervals.interval_join(points, spans, "d", "f", "l", days=30)
    assert got(met.select("id", "s")) == [(1, "x"), (1, "y"), (2, "x")]
    assert got(intervals.interval_join(points.limit(0), spans, "d", "f", "l")) == []


def brute_cohesion(members, spans, votes, ballots):
    """The product of members and ballots, by loops."""
    last = {}
    for m, b, p, pos in sorted(votes, key=lambda v: v[3]):
        last[m, b] = p
    out, has = {}, {m for m, _, _ in spans}
    for b, d in ballots:
        for g in {x[1] for x in members}:
            group = [m for m, own in members if own == g]
            if not any((m, b) in last for m in group):
                continue
            able = [m for m in group if m not in has or d is None or any(s == m and (f is None or d >= f) and (e is None or d <= e) for s, f, e in spans)]
            if able:
                cells = [last.get((m, b)) or "absent" for m in able]
                out[g, b] = (len(able), *[cells.count(p) for p in ("for", "against", "abstain", "nonvoting", "excused", "absent")])
    return out


def test_cohesion_counts_silent_members(spark):
    members = [(1, "g"), (2, "g"), (3, "g"), (4, "h")]
    spans = [(1, D(2020, 1, 1), None), (2, D(2020, 1, 1), D(2020, 6, 30)), (2, D(2020, 7, 1), D(2020, 12, 31)), (2, D(2020, 6, 1), D(2020, 8, 1))]
    ballots = [(10, D(2020, 6, 30)), (11, D(2021, 1, 1)), (12, D(2019, 1, 1)), (13, None)]
    votes = [(1, 10, "for", 1), (2, 10, "against", 1), (2, 10, "for", 2), (1, 11, "abstain", 1), (2, 11, "for", 1), (1, 12, "for", 1), (4, 10, None, 1), (3, 13, "excused", 1), (3, 99, "for", 1)]
    frames = [
        spark.createDataFrame(members, "member int, grp string"), spark.createDataFrame(spans, "member int, first date, last date"),
        spark.createDataFrame(votes, "member int, ballot int, position string, pos int"), spark.createDataFrame(ballots, "ballot int, date date"),
    ]
    found = {(r.grp, r.ballot): (r.n_eligible, r.n_for, r.n_against, r.n_abstain, r.n_nonvoting, r.n_excused, r.n_absent) for r in cohesion.cohesion(*frames).collect()}
    assert found == brute_cohesion(members, spans, votes, ballots)
    first = {(r.grp, r.ballot): r for r in cohesion.cohesion(*frames).collect()}
    assert (first["g", 10].majority, first["g", 10].participation, first["g", 10].quorum) == ("for", 0.6667, True)
    assert first["h", 10].majority is None and first["h", 10].coherence_present is None


def test_dedupe_orders(spark):
    df = spark.createDataFrame([("a", None, "x", 1), ("a", 5, None, 2), ("a", 7, "y", 3), (None, 1, None, 4)], "k string, u int, v string, pos int")
    assert got(dedupe.field_wise(df, ["k"], ["u", "v"], F.col("pos"))) == [("a", 5, "x"), (None, 1, None)]
    assert got(dedupe.field_wise(df, ["k"], ["u", "v"], F.col("pos"), last=True)) == [("a", 7, "y"), (None, 1, None)]
    assert got(dedupe.keep_one(df, ["k"], [F.desc("pos")]).select("k", "u")) == [("a", 7), (None, 1)]
    names = spark.createDataFrame([("n", 1), ("n", 1), ("m", 1), ("m", 2), (None, 3)], "name string, id int")
    assert got(dedupe.unambiguous(names, "name", "id")) == [("n", 1)]


def test_merges_lose_nothing(spark):
    old = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (None, "n", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "b", 5), (2, None, 1), (2, "z", 0), (None, "m", 3)], "k int, v string, t int")
    assert got(merge.additive_union(old, new, ["k"], [F.desc("t")])) == [(1, "a", 5), (1, "a", 5), (2, None, 1), (None, "n", 1)]
    assert got(merge.upsert(old, new, ["k"], [F.desc("t")])) == [(1, "b", 5), (2, None, 1), (None, "m", 3)]
    assert got(merge.latest(old, new, ["k"], "t", [F.col("v")])) == [(1, "a", 5), (2, None, 1), (None, "m", 3)]
    one = old.distinct()
    assert got(merge.coalesce_upsert(one, spark.createDataFrame([(1, None, 9)], "k int, v string, t int"), ["k"])) == [(1, "a", 9), (None, "n", 1)]


def test_guard_and_diff(spark):
    empty, full = F.array().cast("array<int>"), F.array(F.lit(1))
    assert value(spark, merge.guarded(full, empty)) == [1]
    assert value(spark, merge.guarded(empty, full)) == [1]
    before = spark.createDataFrame([("a", 3, "x"), ("b", 1, None), ("c", 1, "q")], "f string, n int, s string")
    after = spark.createDataFrame([("a", 2, None), ("b", 4, "new"), ("d", 1, "q")], "f string, n int, s string")
    found = got(merge.compared(before, after, ["f"], ["n"], ["s"]).select("f", "field", "change", "blocking"))
    assert found == [("a", "n", "shrunk", True), ("a", "s", "lost", True), ("b", "n", "grown", False), ("b", "s", "changed", False), ("c", "*", "gone", True), ("d", "*", "added", False)]


def test_statistics_on_empty_tables(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert {r.n for r in stats.histogram(df, F.col("k"), ["a"]).collect()} == {0}
    assert got(stats.fill_rates(df, {"k": values.filled_text(F.col("k"))})) == [("k", 0, 0, 0.0)]
    some = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 10), ("b", None)], "k string, v int")
    assert got(stats.upper_median(some, ["k"], "v")) == [("a", 3, 4)]
    assert got(stats.described(some, ["k"], F.col("v"))) == [("a", 4, 1, 10, 2.5, 4.0), ("b", 0, None, None, None, None)]


def test_rules_references_and_gate(spark):
    facts = spark.createDataFrame([(1, "k"), (2, "z"), (3, None), (4, None)], "pos int, ref string").withColumn("told", F.col("pos") == 4)
    found = integrity.references(facts, spark.createDataFrame([("k",), (None,)], "id string"), "ref", "id", "pos", F.col("told"))
    assert got(found) == [(2, "z", "orphan", True), (3, None, "missing_key", True), (4, None, "declared_unresolved", False)]
    assert got(integrity.gate(found, ["orphan", "declared_unresolved", "quiet"], "motif")) == [("declared_unresolved", 0, 1, False), ("orphan", 1, 0, True), ("quiet", 0, 0, False)]


def test_ranks_and_samples(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("b"))
    order = [F.asc("b"), F.asc("id")]
    want = sorted(range(100), key=lambda i: (i % 7, i))
    assert [r.id for r in selection.ranked(df, order, F.col("b")).orderBy("rank").collect()] == want
    assert {r.id for r in selection.shard(df, order, F.col("b"), 2, 10).collect()} == {want[i] for i in range(2, 100, 10)}
    assert {r.id for r in selection.systematic(df, order, F.col("b"), 3).collect()} == {want[0], want[50], want[99]}
    assert selection.systematic(df, order, F.col("b"), 500).count() == 100


@pytest.mark.parametrize(("raw", "want"), [("2024-02-03T10:00", D(2024, 2, 3)), ("2024-02", None), ("20240203", None), (None, None), ("2024-02-31", None)])
def test_iso_date(spark, raw, want):
    assert value(spark, dates.iso_date(F.lit(raw).cast("string"))) == want


def test_text_functions(spark):
    assert value(spark, text.slug(F.lit("Éric  d'Été!"))) == "eric-d-ete"
    assert value(spark, text.without_tags(F.lit("a<br/>b <i>c</i>\n"))) == "a b c"
    assert value(spark, text.without_tags(F.lit("<p> </p>"))) is None
    assert value(spark, text.name_key(F.lit("Dupont, Éric"))) == value(spark, text.name_key(F.lit("eric dupont")))
    assert value(spark, text.word_count(F.lit(None).cast("string"))) == 0
    assert value(spark, text.initials(F.lit("Ann Mary Lee"))) == "A. M. Lee"
    assert value(spark, text.upper_head_as_surname(F.lit("DE LA CRUZ Ana Maria"))) == "Ana Maria De La Cruz"


def test_keys_and_values(spark):
    assert value(spark, values.joined_key(F.lit("17"), F.lit(""), prefix="an")) is None
    assert value(spark, values.key_part(F.lit("an:17:4"), 2, 2, "an")) == "4"
    assert value(spark, values.key_part(F.lit("xx:17:4"), 2, 2, "an")) is None
    assert value(spark, values.rate(F.lit(1), F.lit(0))) is None
    assert value(spark, values.percent(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, values.whole_number(F.lit("12x"))) is None
    assert value(spark, values.listed(F.lit('{"a":1}'))) == ['{"a":1}']
    assert value(spark, values.byte_weight(F.lit(None).cast("array<int>"))) == 0


def test_outer_interval_join_keeps_only_spans_that_hold_the_date(spark):
    points = spark.createDataFrame([(1, "2020-02-20"), (2, "2020-03-05"), (3, None)], "p int, d string").withColumn("d", F.col("d").cast("date"))
    spans = spark.createDataFrame([("a", "2020-03-01", None), ("b", "2019-01-01", "2019-12-31")], "s string, f string, l string")
    spans = spans.select("s", F.col("f").cast("date").alias("f"), F.col("l").cast("date").alias("l"))
    found = intervals.interval_join(points, spans, "d", "f", "l", how="left").collect()
    assert sorted((r.p, r.s) for r in found if r.s) == [(2, "a")] and sorted(r.p for r in found) == [1, 2, 3]
    assert [r.p for r in intervals.interval_join(points, spans, "d", "f", "l").collect()] == [2]


def test_latest_keeps_null_fields_and_null_keys(spark):
    from lakemill.operators.dedupe import latest

    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (None, 1, "b"), (None, 3, "c")], "k int, at int, v string")
    assert sorted(map(tuple, latest(rows, ["k"], ["v"], "at").collect()), key=str) == [(1, None), (None, "c")]


def test_latest_deals_rows_before_it_sorts_them(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"), F.struct("id").alias("pos"))
    found = dedupe.latest(rows, ["k"], ["v"], "pos")
    # The plan is printed from its end: what sorts or aggregates stands above the only shuffle.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning") :] and "Sort" not in plan[plan.index("Exchange hashpartitioning") :]
    assert got(found) == sorted([(k, str(max(x for x in range(100) if x % 7 == k))) for k in range(7)], key=repr)


def test_rows_of_a_task_do_not_grow_with_the_input(spark, monkeypatch):
    # More rows than a task's share, all small as written, so adaptive execution would bring them to few tasks.
    monkeypatch.setattr(dedupe, "ROWS_OF_TASK", 100)
    rows = spark.range(3000).select("id", F.lit("v").alias("v"), F.struct("id").alias("pos"))
    assert dedupe.tasks_for(rows) == 30 and dedupe.tasks_for(rows.limit(0)) == spark.sparkContext.defaultParallelism
    assert dedupe.tasks_for(spark.range(30_000)) == 200
    found = dedupe.latest(rows, ["id"], ["v"], "pos").withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(found) == 30 and sum(r["count"] for r in found) == 3000 and max(r["count"] for r in found) < 200


def test_counts_of_groups_are_kept_by_tasks_of_equal_shares(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "ROWS_OF_TASK", 100)
    members = spark.range(30).select(F.col("id").alias("member"), (F.col("id") % 3).alias("grp"))
    spans = members.select("member", F.lit(D(2020, 1, 1)).alias("first"), F.lit(None).cast("date").alias("last"))
    ballots = spark.range(100).select(F.col("id").alias("ballot"), F.lit(D(2020, 1, 2)).alias("date"))
    votes = members.crossJoin(ballots).select("member", "ballot", F.lit("for").alias("position"), F.struct("member").alias("pos"))
    settled, written = cohesion.settled, []
    monkeypatch.setattr(cohesion, "settled", lambda df: written.append(settled(df)) or written[-1])
    rows = cohesion.cohesion(members, spans, votes, ballots)
    assert rows.count() == 300 and rows.where("n_for = 10 and n_eligible = 10").count() == 300
    assert written[0].rdd.getNumPartitions() == 30


def test_votes_are_not_sorted_to_meet_members_and_ballots(spark):
    members = spark.createDataFrame([(1, "g")], "member long, grp string")
    spans = spark.createDataFrame([(1, D(2020, 1, 1), None)], "member long, first date, last date")
    votes = spark.createDataFrame([(1, 5, "for", 1), (1, 5, "against", 2), (2, 5, "for", 1), (1, 6, "for", 1)], "member long, ballot long, position string, pos long")
    ballots = spark.createDataFrame([(5, D(2020, 1, 2))], "ballot long, date date")
    last = cohesion.last_votes(members, spans, votes, ballots)
    assert last._jdf.queryExecution().executedPlan().toString().count("ShuffledHashJoin") == 2
    assert got(last) == [("g", 1, 5, D(2020, 1, 2), "against", True)]


def test_backfill_takes_null_keys(spark):
    old = spark.createDataFrame([(None, None), (1, "x"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(None, "n"), (1, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, merge.backfill(old, new, ["k"], "v", [F.asc("v")]).collect()), key=str) == [(1, "x"), (2, None), (None, "n")]


def test_containment_takes_queries_of_any_length(spark):
    from lakemill.operators.matching import first_containing

    names = spark.createDataFrame([(1, "blue ring"), (2, "red ring"), (3, None), (4, "x")], "id int, name string")
    queries = spark.createDataFrame([("r",), ("ri",), ("ring",), ("d ring",), ("none",), ("",), (None,), ("ring",)], "q string")
    found = first_containing(queries, names, F.col("q"), F.col("name"), "id").collect()
    assert sorted((r.q, r.id) for r in found) == [("d ring", 2), ("r", 1), ("ri", 1), ("ring", 1), ("ring", 1)]
