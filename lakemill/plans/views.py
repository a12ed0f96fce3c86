"""Scalars, joins on text and display figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import text as t
from lakemill.functions.values import filled_list, first_filled, listed, size_or_null, size_or_zero, whole_number
from lakemill.operators.dedupe import keep_one
from lakemill.operators.intervals import holds_strictly
from lakemill.operators.matching import first_containing
from lakemill.plans.registry import query, table

_PLAIN = f"translate(lower({{}}), '{t.MARKED.lower()}', '{t.PLAIN.lower()}')"


@query("SELECT c_custkey, trim(regexp_replace(lower(c_name || ' & ' || c_mktsegment), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM customer")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as slugs."""
    return table(spark, sf_dir, "customer").select("c_custkey", t.slug(F.concat_ws(" & ", "c_name", "c_mktsegment")).alias("slug"))


@query(f"SELECT doc_id, sha256({_PLAIN.format('text')}) AS folded FROM documents")
def folded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower case without marks."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(t.fold(F.col("text")), 256).alias("folded"))


@query("SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS name_key FROM part")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose words may come in any order."""
    return table(spark, sf_dir, "part").select("p_partkey", t.name_key(F.col("p_name")).alias("name_key"))


@query(
    r"""WITH c AS (SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')), '') AS text FROM pages)
 SELECT page_id, length(text) AS n_chars, len(string_split(text, ' ')) AS n_words, CASE WHEN len(string_split(text, ' ')) < 200 THEN 'short' ELSE 'long' END AS format FROM c"""
)
def stripped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags stripped, words counted, a bucket by length."""
    rows = table(spark, sf_dir, "pages").select("page_id", t.without_tags(F.col("html")).alias("text"))
    n = t.word_count(F.col("text"))
    return rows.select("page_id", F.length("text").cast("long").alias("n_chars"), n.alias("n_words"), F.when(n < 200, "short").otherwise("long").alias("format"))


_THEMES = {"money": ["ring", "price"], "tools": ["widget", "bolt"], "colour": ["red", "blue"]}


@query(
    """SELECT p_partkey, CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'price') THEN 'money' WHEN contains(p_name, 'widget') OR contains(p_name, 'bolt') THEN 'tools'
 WHEN contains(p_name, 'red') OR contains(p_name, 'blue') THEN 'colour' ELSE 'other' END AS theme,
 CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 'warm_start' WHEN regexp_matches(p_name, 't$') THEN 'ends_in_t' ELSE 'debate' END AS kind FROM part"""
)
def themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first theme whose keyword occurs; the first pattern that matches."""
    kind = t.first_match(F.col("p_name"), [("warm_start", "^(red|blue)"), ("ends_in_t", "t$")], "debate")
    return table(spark, sf_dir, "part").select("p_partkey", t.first_theme(F.col("p_name"), _THEMES, "other").alias("theme"), kind.alias("kind"))


@query(
    """WITH w AS (SELECT source AS member, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> ''))) AS tag FROM documents),
 d AS (SELECT DISTINCT member, tag FROM w), n AS (SELECT count(DISTINCT source) AS n FROM documents)
 SELECT tag, count(*) AS n_members, round(count(*) / (SELECT n FROM n), 4) AS weight FROM d GROUP BY tag"""
)
def tag_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many members carry a tag, and their share; tags are the words of a member's whole texts."""
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("member"), "text")
    tags = rows.select("member", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("tag")).where("tag <> ''")
    n = rows.select("member").distinct().count()
    counts = tags.distinct().groupBy("tag").agg(F.count("*").alias("n_members"))
    return counts.select("tag", "n_members", F.round(F.col("n_members") / F.lit(n), 4).alias("weight"))


@query(
    """WITH m AS (SELECT s_nationkey AS grp, l_suppkey AS member, p_type AS label, p_brand AS fn, max(l_shipdate) >= TIMESTAMP '2001-06-01' AS active FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)
 SELECT grp, label, count(DISTINCT member) AS n_members, count(DISTINCT member) FILTER (active) AS n_active, count(DISTINCT fn) AS n_functions, count(*) AS n_entries FROM m GROUP BY grp, label"""
)
def mandate_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members and active members by group and label."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    entries = rows.groupBy(F.col("s_nationkey").alias("grp"), F.col("l_suppkey").alias("member"), F.col("p_type").alias("label"), F.col("p_brand").alias("fn")).agg((F.max("l_shipdate") >= F.lit("2001-06-01").cast("timestamp")).alias("active"))
    return entries.groupBy("grp", "label").agg(
        F.countDistinct("member").alias("n_members"), F.countDistinct(F.when(F.col("active"), F.col("member"))).alias("n_active"),
        F.countDistinct("fn").alias("n_functions"), F.count("*").alias("n_entries"),
    )


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS none FROM events")
def safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers out of text; anything else is null."""
    return table(spark, sf_dir, "events").select("event_id", whole_number(F.get_json_object("props", "$.k")).alias("k"), whole_number(F.col("event_type")).alias("none"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS a, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END, ''), source) AS chosen FROM documents")
def first_filled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that is neither null nor empty."""
    raw = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 2, F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("a"), first_filled(raw, F.col("source")).alias("chosen"))


@query(
    """WITH l AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE list_filter([c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END], lambda x: x IS NOT NULL AND c_custkey % 5 <> 0) END AS items FROM customer)
 SELECT c_custkey, coalesce(len(items), 0) AS n_or_zero, len(items) AS n_or_null, coalesce(len(items) > 0, false) AS filled FROM l"""
)
def list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, empty and filled lists are three things."""
    items = F.when(F.col("c_custkey") % 4 == 0, None).when(F.col("c_custkey") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array_compact(F.array("c_name", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")))))
    rows = table(spark, sf_dir, "customer").select("c_custkey", items.alias("items"))
    return rows.select("c_custkey", size_or_zero(F.col("items")).alias("n_or_zero"), size_or_null(F.col("items")).alias("n_or_null"), filled_list(F.col("items")).alias("filled"))


@query("SELECT event_id, 1 AS at, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events UNION ALL SELECT event_id, 2, event_id FROM events WHERE event_id % 2 = 0")
def polymorphic_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node that is one object or a list of them, as rows."""
    node = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), F.col("props"), F.lit(',{"k": '), F.col("event_id"), F.lit("}]"))).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", F.posexplode(listed(node)).alias("i", "x"))
    return rows.select("event_id", (F.col("i") + 1).alias("at"), F.get_json_object("x", "$.k").cast("long").alias("k"))


@query(
    """SELECT o_orderkey, n_name AS nation, CASE WHEN c_custkey IS NULL THEN 'unresolved' ELSE 'resolved' END AS state FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 5 <> 0 LEFT JOIN nation ON n_nationkey = c_nationkey"""
)
def dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with their dimension; unresolved ones stay."""
    known = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = table(spark, sf_dir, "orders").join(known.select("c_custkey", "n_name"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("o_orderkey", F.col("n_name").alias("nation"), F.when(F.col("c_custkey").isNull(), "unresolved").otherwise("resolved").alias("state"))


@query(
    """WITH q AS (SELECT c_custkey, left(c_mktsegment, 1 + c_custkey % 7) AS q FROM customer WHERE c_custkey % 3 = 0
   UNION ALL SELECT c_custkey, substr('blue ring widget red bolt gear steel panel', 1 + c_custkey % 30, c_custkey % 9) FROM customer WHERE c_custkey % 3 > 0)
 SELECT c_custkey, q, min(p_partkey) AS p_partkey FROM q JOIN part ON contains(lower(p_name), lower(q)) WHERE q <> '' GROUP BY ALL"""
)
def containment_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each query, of any length, the first name that contains it."""
    own = F.when(F.col("c_custkey") % 3 == 0, F.expr("left(c_mktsegment, cast(1 + c_custkey % 7 as int))"))
    cut = F.expr("substring('blue ring widget red bolt gear steel panel', cast(1 + c_custkey % 30 as int), cast(c_custkey % 9 as int))")
    queries = table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(own, cut).alias("q"))
    met = first_containing(queries, table(spark, sf_dir, "part"), F.lower("q"), F.lower("p_name"), "p_partkey")
    return met.select("c_custkey", "q", "p_partkey")


@query(
    """SELECT o_orderkey, CASE WHEN bool_or(k = 'govt') THEN 'govt' WHEN bool_or(k = 'majority') THEN 'majority' ELSE 'undetermined' END AS bucket FROM orders LEFT JOIN (
 VALUES ('govt', DATE '1996-01-01', DATE '1996-12-31'), ('majority', DATE '1996-06-01', DATE '1998-06-30'), ('majority', DATE '2000-01-01', NULL)) p(k, first, last)
 ON CAST(o_orderdate AS DATE) >= first AND (last IS NULL OR CAST(o_orderdate AS DATE) <= last) GROUP BY 1"""
)
def position_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position that holds a date, by precedence."""
    day = F.col("o_orderdate").cast("date")
    inside = lambda a, b: holds_strictly(day, F.lit(a).cast("date"), F.lit(b).cast("date"))
    major = inside("1996-06-01", "1998-06-30") | inside("2000-01-01", None)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(inside("1996-01-01", "1996-12-31"), "govt").when(major, "majority").otherwise("undetermined").alias("bucket"))


@query(
    """WITH f AS (SELECT l_suppkey AS member, l_partkey % 50 AS text, l_linenumber AS stage, l_shipdate AS d, l_returnflag AS position,
   row_number() OVER (PARTITION BY l_suppkey, l_partkey % 50 ORDER BY l_linenumber DESC, l_shipdate DESC, l_orderkey, l_partkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
 SELECT member, count(*) FILTER (position = 'A') AS n_for, count(*) FILTER (position = 'N') AS n_against, count(*) FILTER (position = 'R') AS n_abstain FROM f WHERE rn = 1 GROUP BY 1"""
)
def final_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each text the vote at its last reading, then positions counted."""
    rows = table(spark, sf_dir, "lineitem").withColumns({"member": F.col("l_suppkey"), "text": F.col("l_partkey") % 50})
    last = keep_one(rows, ["member", "text"], [F.desc("l_linenumber"), F.desc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_partkey"), F.asc("l_quantity"), F.asc("l_extendedprice")])
    return last.groupBy("member").agg(*[F.count_if(F.col("l_returnflag") == k).alias(f"n_{v}") for k, v in (("A", "for"), ("N", "against"), ("R", "abstain"))])


@query(
    """WITH n AS (SELECT o_custkey AS member, o_orderpriority AS scope, count(*) AS n FROM orders GROUP BY ALL)
 SELECT member, scope, n, CAST(round(100.0::DOUBLE * n / greatest(1, max(n) OVER (PARTITION BY member)), 0) AS BIGINT) AS bar FROM n"""
)
def scope_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by scope, scaled to the greatest of a member."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member"), F.col("o_orderpriority").alias("scope")).agg(F.count("*").alias("n"))
    top = F.greatest(F.lit(1), F.max("n").over(Window.partitionBy("member")))
    return rows.withColumn("bar", F.round(F.lit(100.0) * F.col("n") / top, 0).cast("long"))


@query("SELECT o_custkey AS member, round((DATE '2002-01-01' - CAST(min(o_orderdate) AS DATE)) / 365.25, 1) AS years FROM orders GROUP BY 1")
def tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years since the first start at a reference date."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member")).agg(F.round(F.datediff(F.lit("2002-01-01").cast("date"), F.min("o_orderdate").cast("date")) / F.lit(365.25), 1).alias("years"))


@query("SELECT regexp_extract(url, '//([^/:?#]+)', 1) AS host, count(*) AS n_pages, count(DISTINCT regexp_extract(url, '\\.(com|net|org)', 1)) AS n_zones FROM pages GROUP BY 1")
def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a URL."""
    return table(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "//([^/:?#]+)", 1).alias("host")).agg(F.count("*").alias("n_pages"), F.countDistinct(F.regexp_extract("url", r"\.(com|net|org)", 1)).alias("n_zones"))


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated facts by day and kind."""
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    """WITH p AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS w, CASE WHEN p_size % 10 > 0 THEN p_retailprice / (p_size * 100) END AS share FROM part)
 SELECT p_partkey, upper(w[1][1] || coalesce(w[2][1], '')) AS short, w[-1] AS last, CASE WHEN share IS NULL THEN 'N/D' ELSE CAST(floor(share * 100 + 0.5) AS BIGINT) || ' %' END AS share FROM p WHERE p_name <> ''
 UNION ALL SELECT p_partkey, '?', '?', CASE WHEN share IS NULL THEN 'N/D' ELSE CAST(floor(share * 100 + 0.5) AS BIGINT) || ' %' END FROM p WHERE coalesce(p_name, '') = ''"""
)
def short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initials of the first two words, the last word, and a share as per cent, of every row."""
    share = F.when(F.col("p_size") % 10 > 0, F.col("p_retailprice") / (F.col("p_size") * 100))
    return table(spark, sf_dir, "part").select("p_partkey", t.short_name(F.col("p_name")).alias("short"), t.last_name(F.col("p_name")).alias("last"), t.percentage(share).alias("share"))


@query("SELECT o_orderkey, year(o_orderdate) AS year, strftime(o_orderdate, '%d/%m/%Y') AS day, epoch_ms(o_orderdate) AS ms FROM orders")
def shown_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year, the day as it is shown, and milliseconds for sorting."""
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year(d).cast("long").alias("year"), F.date_format(d, "dd/MM/yyyy").alias("day"), F.unix_millis(d.cast("timestamp")).alias("ms"))
