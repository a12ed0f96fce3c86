"""Group cohesion, the flagship, and what belongs to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import cohesion, intervals
from lakemill.operators.dedupe import latest
from lakemill.plans import bindings as b
from lakemill.plans.registry import query, table

_BASE = f"WITH {b.MEMBERS_SQL}, {b.BALLOTS_SQL}, {b.SPANS_SQL}, {b.VOTES_SQL}"
_COHESION = f"""{_BASE},
 has AS (SELECT DISTINCT member FROM spans),
 gb AS (SELECT DISTINCT m.grp, b.ballot, b.date FROM votes v JOIN members m USING (member) JOIN ballots b USING (ballot)),
 cells AS (SELECT gb.grp, gb.ballot, gb.date, m.member, coalesce(v.position, 'absent') AS position
   FROM gb JOIN members m USING (grp) LEFT JOIN votes v ON v.member = m.member AND v.ballot = gb.ballot
   WHERE m.member NOT IN (SELECT member FROM has)
      OR EXISTS (SELECT 1 FROM spans s WHERE s.member = m.member AND s.first <= gb.date AND (s.last IS NULL OR gb.date <= s.last))),
 n AS (SELECT grp, ballot, date, count(*) AS n_eligible, count(*) FILTER (position = 'for') AS n_for, count(*) FILTER (position = 'against') AS n_against,
   count(*) FILTER (position = 'abstain') AS n_abstain, count(*) FILTER (position = 'nonvoting') AS n_nonvoting,
   count(*) FILTER (position = 'excused') AS n_excused, count(*) FILTER (position = 'absent') AS n_absent FROM cells GROUP BY ALL),
 c AS (SELECT *, greatest(n_for, n_against, n_abstain) AS top, n_eligible - n_absent - n_excused AS present FROM n),
 cohesion AS (SELECT grp, ballot, date, n_eligible, n_for, n_against, n_abstain, n_nonvoting, n_excused, n_absent,
   CASE WHEN top = 0 THEN NULL WHEN n_for = top THEN 'for' WHEN n_against = top THEN 'against' ELSE 'abstain' END AS majority,
   round(present / n_eligible, 4) AS participation, present / n_eligible >= 0.5 AS quorum, round(top / n_eligible, 4) AS coherence,
   CASE WHEN present > 0 THEN round(top / present, 4) END AS coherence_present FROM c)"""


@query(_COHESION + " SELECT * FROM cohesion")
def cohesion_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohesion of each group on each ballot."""
    return cohesion.cohesion(b.members(spark, sf_dir), b.spans(spark, sf_dir), b.votes(spark, sf_dir), b.ballots(spark, sf_dir))


@query(
    _COHESION
    + """, eligible AS (SELECT DISTINCT grp, member, ballot FROM cells),
 mine AS (SELECT e.grp, e.member, count(*) AS n_ballots, count(*) FILTER (v.position IN ('for', 'against', 'abstain')) AS n_present,
   count(*) FILTER (v.position = c.majority) AS n_aligned
   FROM eligible e JOIN cohesion c ON c.grp = e.grp AND c.ballot = e.ballot LEFT JOIN votes v ON v.member = e.member AND v.ballot = e.ballot GROUP BY ALL),
 means AS (SELECT grp, avg(participation) AS p, avg(coherence) AS c FROM cohesion GROUP BY grp)
 SELECT m.grp, m.member, coalesce(n_ballots, 0) AS n_ballots, coalesce(n_present, 0) AS n_present, coalesce(n_aligned, 0) AS n_aligned,
   round(n_present / n_ballots, 4) AS participation, round(n_aligned / n_ballots, 4) AS coherence,
   round(round(n_present / n_ballots, 4) - p, 4) AS participation_gap, round(round(n_aligned / n_ballots, 4) - c, 4) AS coherence_gap
 FROM members m LEFT JOIN mine USING (grp, member) JOIN means USING (grp)"""
)
def member_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each member against the mean of their group."""
    return cohesion.member_gaps(b.members(spark, sf_dir), b.spans(spark, sf_dir), b.votes(spark, sf_dir), b.ballots(spark, sf_dir))


@query(
    f"""{_BASE} SELECT member, count(*) AS n_votes, count(*) FILTER (b.ballot IS NULL) AS n_unresolved, count(*) FILTER (position IS NULL) AS n_without_position
 FROM votes v LEFT JOIN ballots b USING (ballot) GROUP BY member"""
)
def unresolved_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes that resolve to no ballot are counted, not dropped."""
    last = latest(b.votes(spark, sf_dir), ["member", "ballot"], ["position"], "pos")
    known = b.ballots(spark, sf_dir).select("ballot", F.lit(True).alias("known"))
    return last.join(known, "ballot", "left").groupBy("member").agg(
        F.count("*").alias("n_votes"), F.count_if(F.col("known").isNull()).alias("n_unresolved"), F.count_if(F.col("position").isNull()).alias("n_without_position")
    )


@query(
    f"""WITH {b.SPANS_SQL} SELECT o.o_orderkey AS ballot, count(*) AS n_spans FROM orders o JOIN spans s
 ON CAST(o.o_orderdate AS DATE) >= s.first AND (s.last IS NULL OR CAST(o.o_orderdate AS DATE) <= s.last) GROUP BY ALL"""
)
def spans_holding_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many spans hold the date of each order: an interval join by bins over the distinct dates, whose
    counts go back to the orders."""
    points = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ballot"), F.col("o_orderdate").cast("date").alias("date"))
    met = intervals.interval_join(points.select("date").distinct(), b.spans(spark, sf_dir), "date", "first", "last")
    return points.join(met.groupBy("date").agg(F.count("*").alias("n_spans")), "date").select("ballot", "n_spans")


@query(
    f"""WITH {b.SPANS_SQL}, {b.MEMBERS_SQL} SELECT member, grp, min(first) AS first, CASE WHEN bool_or(last IS NULL) THEN NULL ELSE max(last) END AS last,
 bool_or(last IS NULL) AS active, count(*) AS n_spans FROM spans JOIN members USING (member) GROUP BY ALL"""
)
def member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range around each member's spans; an open end keeps the range open."""
    return intervals.enclosing(b.spans(spark, sf_dir).join(b.members(spark, sf_dir), "member"), ["member", "grp"], "first", "last")


@query(
    """WITH s AS (SELECT l_suppkey AS member, l_linenumber AS kind, CAST(l_shipdate AS DATE) AS first, CAST(l_shipdate + INTERVAL 10 DAY AS DATE) AS last FROM lineitem),
 m AS (SELECT *, max(last) OVER (PARTITION BY member, kind ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
 i AS (SELECT *, sum(CASE WHEN reach IS NULL OR first - reach > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY member, kind ORDER BY first, last ROWS UNBOUNDED PRECEDING) AS island FROM m)
 SELECT member, kind, min(first) AS first, max(last) AS last, count(*) AS n_spans FROM i GROUP BY member, kind, island"""
)
def mandate_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent or overlapping spans of one kind become one."""
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("member"), F.col("l_linenumber").alias("kind"), day.alias("first"), F.date_add(day, 10).alias("last"))
    return intervals.islands(rows, ["member", "kind"], "first", "last")


@query(
    """WITH s AS (SELECT l_suppkey AS member, l_linenumber AS kind, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem GROUP BY ALL)
 SELECT a.member, a.kind AS kind_a, b.kind AS kind_b FROM s a JOIN s b ON a.member = b.member AND a.kind < b.kind AND NOT (a.first > b.last) AND NOT (a.last < b.first)"""
)
def overlapping_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pairs of a member's spans that overlap; a member has one span of each of seven kinds."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("member"), F.col("l_linenumber").alias("kind")).agg(F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last"))
    x, y = rows.alias("x"), rows.alias("y")
    met = x.join(y, (F.col("x.member") == F.col("y.member")) & (F.col("x.kind") < F.col("y.kind")))
    met = met.where(intervals.overlap(F.col("x.first"), F.col("x.last"), F.col("y.first"), F.col("y.last")))
    return met.select("x.member", F.col("x.kind").alias("kind_a"), F.col("y.kind").alias("kind_b"))
