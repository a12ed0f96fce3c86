"""Documents and views assembled from the operators: groups, governments, persons, and what a page shows of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.functions import text as t
from lakemill.functions.values import rate
from lakemill.operators import cohesion, intervals, profiles
from lakemill.plans import bindings as b
from lakemill.plans.cohesion import _COHESION
from lakemill.plans.registry import query, table


@query(
    """WITH own AS (SELECT c_custkey AS member, lower(c_mktsegment) AS tag FROM customer WHERE c_custkey % 3 = 0),
 talks AS (SELECT o_custkey AS member, CASE WHEN o_orderkey % 2 = 0 THEN CASE o_orderstatus WHEN 'O' THEN '  ' ELSE ' Theme ' || o_orderpriority END END AS theme, ' Key ' || o_orderstatus AS keyword FROM orders WHERE o_custkey % 3 > 0),
 themes AS (SELECT DISTINCT member, lower(trim(theme)) AS tag FROM talks WHERE trim(theme) <> ''),
 words AS (SELECT DISTINCT member, lower(trim(keyword)) AS tag FROM talks WHERE theme IS NULL AND member NOT IN (SELECT member FROM themes)),
 tags AS (SELECT * FROM own UNION ALL SELECT * FROM themes UNION ALL SELECT * FROM words)
 SELECT tag, count(*) AS n_members, round(count(*) / (SELECT count(DISTINCT member) FROM tags), 4) AS weight FROM tags GROUP BY tag"""
)
def group_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member's own tags, else the themes of what they said, else the keywords; weighed over the members."""
    own = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("member"), F.lower("c_mktsegment").alias("tag"))
    theme = F.when(F.col("o_orderkey") % 2 == 0, F.when(F.col("o_orderstatus") == "O", "  ").otherwise(F.concat(F.lit(" Theme "), "o_orderpriority")))
    talks = table(spark, sf_dir, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("member"), theme.alias("theme"), F.concat(F.lit(" Key "), "o_orderstatus").alias("keyword"))
    return profiles.weighed_tags(profiles.tags_with_fallback(own, talks))


@query(
    _COHESION
    + """, own AS (SELECT grp, count(*) AS n_members FROM members GROUP BY 1), ranges AS (SELECT grp, min(first) AS first, CASE WHEN bool_or(last IS NULL) THEN NULL ELSE max(last) END AS last FROM spans JOIN members USING (member) GROUP BY 1),
 means AS (SELECT grp, count(*) AS n_ballots, round(avg(participation), 4) AS participation, round(avg(coherence), 4) AS coherence, count(*) FILTER (NOT quorum) AS n_without_quorum, min(date) AS first_ballot, max(date) AS last_ballot FROM cohesion GROUP BY 1)
 SELECT grp, n_members, first, last, first IS NOT NULL AND last IS NULL AS active, coalesce(n_ballots, 0) AS n_ballots, participation, coherence, coalesce(n_without_quorum, 0) AS n_without_quorum, first_ballot, last_ballot
 FROM own LEFT JOIN ranges USING (grp) LEFT JOIN means USING (grp)"""
)
def group_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's document: its members, the range of their spans, and its cohesion over the ballots it saw."""
    members, spans = b.members(spark, sf_dir), b.spans(spark, sf_dir)
    votes = cohesion.cohesion(members, spans, b.votes(spark, sf_dir), b.ballots(spark, sf_dir))
    return profiles.group_documents(members, spans, votes)


@query(
    """WITH p AS (SELECT s_suppkey AS member, (s_suppkey % 3) AS k FROM supplier), f AS (SELECT l_suppkey AS member, CAST(l_shipdate AS DATE) AS d FROM lineitem),
 s AS (SELECT f.member, CASE WHEN k = 0 AND d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' THEN 'govt' WHEN d BETWEEN DATE '1996-06-01' AND DATE '1998-06-30' THEN 'majority' WHEN k = 1 AND d >= DATE '2000-01-01' THEN 'opposition' ELSE 'undetermined' END AS bucket FROM f JOIN p USING (member))
 SELECT member, bucket, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY member), 4) AS share FROM s GROUP BY member, bucket"""
)
def facts_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member's dated facts split by the position held at their date; the stronger position wins."""
    day = lambda x: F.lit(x).cast("date")
    k = F.col("s_suppkey") % 3
    one = lambda kind, first, last: F.struct(F.lit(kind).alias("kind"), day(first).alias("first"), day(last).alias("last"))
    periods = F.array_compact(F.array(F.when(k == 0, one("govt", "1996-01-01", "1996-12-31")), one("majority", "1996-06-01", "1998-06-30"), F.when(k == 1, one("opposition", "2000-01-01", None))))
    held = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("member"), periods.alias("periods"))
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("member"), F.col("l_shipdate").cast("date").alias("d"))
    found = facts.join(held, "member").withColumn("bucket", profiles.position_at(F.col("d"), F.col("periods"), ["govt", "majority", "opposition"], "undetermined"))
    counts = found.groupBy("member", "bucket").agg(F.count("*").alias("n"))
    return counts.withColumn("share", rate(F.col("n"), F.sum("n").over(Window.partitionBy("member"))))


@query(
    """WITH v AS (SELECT o_custkey AS member, count(*) AS n_texts, count(*) FILTER (o_orderstatus = 'F') AS n_adopted, max(CAST(o_orderdate AS DATE)) AS last_seen FROM orders GROUP BY 1),
 k AS (SELECT o_custkey AS member, o_orderpriority AS theme, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2)
 SELECT c_custkey AS member, c_name AS name, coalesce(n_texts, 0) AS n_texts, round(n_adopted / n_texts, 4) AS adopted, last_seen, theme AS main_theme,
 CASE WHEN n_texts IS NULL THEN 'silent' WHEN n_texts >= 12 THEN 'busy' ELSE 'usual' END AS tone FROM customer LEFT JOIN v ON v.member = c_custkey LEFT JOIN k ON k.member = c_custkey AND rn = 1"""
)
def person_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a person's page shows: figures, rates that are null without a base, the main theme."""
    texts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("member"), F.col("o_orderpriority").alias("theme"), (F.col("o_orderstatus") == "F").alias("adopted"), F.col("o_orderdate").cast("date").alias("date"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"), F.col("c_name").alias("name"))
    view = profiles.person_views(people, texts)
    return view.withColumn("tone", F.when(F.col("n_texts") == 0, "silent").when(F.col("n_texts") >= 12, "busy").otherwise("usual"))


@query(
    """WITH f AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Président du groupe' WHEN 1 THEN 'Rapporteur spécial' WHEN 2 THEN 'membre' END AS role, CASE WHEN p_size % 3 > 0 THEN p_name END AS town, CASE WHEN p_size % 2 = 0 THEN p_brand END AS district FROM part)
 SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'lead' WHEN 1 THEN 'report' ELSE 'plain' END AS tone,
 CASE WHEN town IS NULL AND district IS NULL THEN NULL WHEN town IS NULL THEN '(' || district || ')' WHEN district IS NULL THEN town ELSE town || ' (' || district || ')' END AS place,
 upper(p_type[1]) || lower(p_type[2:]) AS label FROM f JOIN part USING (p_partkey)"""
)
def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A role's tone by the first pattern of its folded text, places put together from what there is, the
    end of an address as a label."""
    role = F.when(F.col("p_size") % 4 == 0, "Président du groupe").when(F.col("p_size") % 4 == 1, "Rapporteur spécial").when(F.col("p_size") % 4 == 2, "membre")
    tone = t.first_match(t.fold(F.coalesce(role, F.lit(""))), [("lead", "^president"), ("report", "rapporteur")], "plain")
    place = t.place_label(F.when(F.col("p_size") % 3 > 0, F.col("p_name")), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")))
    uri = F.concat(F.lit("http://x.example/authority/"), F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", tone.alias("tone"), place.alias("place"), t.uri_label(uri).alias("label"))


@query(
    """WITH r AS (SELECT o_custkey AS member, o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS title, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority, o_orderkey) AS rank FROM orders)
 SELECT member, o_orderkey, rank FROM r WHERE rank <= 3"""
)
def latest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's latest texts, three of each member: latest date first, then by title."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("member"), "o_orderkey", F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderpriority").alias("title"))
    rank = F.row_number().over(Window.partitionBy("member").orderBy(F.desc("d"), "title", "o_orderkey"))
    return rows.withColumn("rank", rank.cast("long")).where("rank <= 3").select("member", "o_orderkey", "rank")


@query(
    f"""WITH {b.MEMBERS_SQL}, {b.SPANS_SQL}, posts AS (SELECT l_suppkey AS member, p_type AS post, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type IN ('PROMO', 'LARGE') GROUP BY ALL),
 gov(name, first, last) AS (VALUES ('g1', DATE '1995-06-01', DATE '1996-05-31'), ('g2', DATE '1996-06-01', DATE '1998-05-31'), ('g3', DATE '1998-06-01', NULL)),
 m AS (SELECT DISTINCT g.name, m.grp, s.member FROM gov g JOIN spans s ON NOT coalesce(s.first > g.last, false) AND NOT coalesce(s.last < g.first, false) JOIN members m USING (member)),
 x AS (SELECT m.name, m.member, p.post FROM m JOIN posts p ON p.member = m.member JOIN gov g ON g.name = m.name AND NOT coalesce(p.first > g.last, false) AND NOT coalesce(p.last < g.first, false))
 SELECT m.name AS government, count(DISTINCT m.member) AS n_members, count(DISTINCT x.member) AS n_with_post, count(DISTINCT m.grp) AS n_groups FROM m LEFT JOIN x ON x.name = m.name AND x.member = m.member GROUP BY 1"""
)
def government_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A government's document: members whose spans overlap it, those of them with a post in it, their groups."""
    day = lambda x: F.lit(x).cast("date")
    dates = [("g1", "1995-06-01", "1996-05-31"), ("g2", "1996-06-01", "1998-05-31"), ("g3", "1998-06-01", None)]
    governments = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), day(f).alias("from"), day(u).alias("until")) for n, f, u in dates]))
    inside = intervals.overlap(F.col("first"), F.col("last"), F.col("g.from"), F.col("g.until"))
    organs = table(spark, sf_dir, "part").where(F.col("p_type").isin("PROMO", "LARGE")).select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("post"))
    posts = table(spark, sf_dir, "lineitem").join(organs, "l_partkey").groupBy(F.col("l_suppkey").alias("member"), "post").agg(F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last"))
    own = b.spans(spark, sf_dir).withColumn("g", governments).where(inside).select("g.name", "member").distinct().join(b.members(spark, sf_dir), "member")
    held = posts.withColumn("g", governments).where(inside).select("g.name", "member", F.lit(True).alias("has_post")).distinct()
    return own.join(held, ["name", "member"], "left").groupBy(F.col("name").alias("government")).agg(
        F.count_distinct("member").alias("n_members"), F.count_distinct(F.when(F.col("has_post"), F.col("member"))).alias("n_with_post"), F.count_distinct("grp").alias("n_groups")
    )


@query(
    """WITH r AS (SELECT 'members' AS section, count(*)::DOUBLE AS n, count(*) FILTER (c_acctbal < 0)::DOUBLE AS bad, 5.0::DOUBLE AS most FROM customer
   UNION ALL SELECT 'texts', count(*), count(*) FILTER (o_orderstatus = 'P'), 50.0 FROM orders UNION ALL SELECT 'votes', count(*), count(*) FILTER (l_orderkey % 11 = 0), 12.0 FROM lineitem
   UNION ALL SELECT 'pages', count(*), count(*) FILTER (html IS NULL), 0.0 FROM pages UNION ALL SELECT 'talks', count(*), count(*) FILTER (text = ''), 1.0 FROM conversations)
 SELECT section, n, bad, round(100.0::DOUBLE * bad / n, 2) AS percent, CASE WHEN 100.0 * bad <= most * n THEN 'good' WHEN 100.0 * bad <= 2 * most * n THEN 'fair' ELSE 'poor' END AS state, rank() OVER (ORDER BY bad / n DESC, section) AS rank FROM r"""
)
def overview_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overview of all reports: a count, what is wrong in it, a rate, a state, in order of urgency."""
    sections = {
        "members": (table(spark, sf_dir, "customer"), F.col("c_acctbal") < 0, 5.0), "texts": (table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "P", 50.0),
        "votes": (table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 11 == 0, 12.0), "pages": (table(spark, sf_dir, "pages"), F.col("html").isNull(), 0.0), "talks": (table(spark, sf_dir, "conversations"), F.col("text") == "", 1.0),
    }
    return profiles.overview(sections)
