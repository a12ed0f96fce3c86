"""Raw records to facts with keys, bound to the tables at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.text import first_match
from lakemill.functions.values import joined_key
from lakemill.operators import normalize
from lakemill.plans import bindings as b
from lakemill.plans.registry import query, table


@query(
    f"""WITH d AS (SELECT o_orderkey AS number, 'an:' || year(o_orderdate) || ':' || o_orderkey AS key FROM orders WHERE {b.KNOWN}),
 f AS (SELECT l_suppkey AS member, l_orderkey AS number, l_linenumber AS line, CASE WHEN l_linenumber % 3 <> 0 THEN year(l_shipdate) END AS term FROM lineitem),
 r AS (SELECT f.*, coalesce(d.key, 'an:' || term || ':' || number) AS k, d.key IS NOT NULL AS hit FROM f LEFT JOIN d USING (number))
 SELECT member, count(*) AS n_votes, count(*) FILTER (hit) AS n_indexed, count(*) FILTER (NOT hit AND k IS NOT NULL) AS n_own,
   count(*) FILTER (k IS NULL) AS n_unresolved, min(CASE WHEN k IS NULL THEN number END) AS first_unresolved, count(DISTINCT k) AS n_keys FROM r GROUP BY member"""
)
def normalized_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vote's key from the dimension, else from its own term; unresolved votes keep their record."""
    known = table(spark, sf_dir, "orders").where(b.KNOWN).select(F.col("o_orderkey").alias("number"), joined_key(F.year("o_orderdate"), F.col("o_orderkey"), prefix="an").alias("found"))
    facts = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("member"), F.col("l_orderkey").alias("number"), F.col("l_linenumber").alias("line"), F.when(F.col("l_linenumber") % 3 != 0, F.year("l_shipdate")).alias("term")
    )
    indexed = known.withColumn("hit", F.lit(True))
    rows = normalize.resolved(facts, known, ["number"], "found", joined_key(F.col("term"), F.col("number"), prefix="an"), ["member", "number", "line"])
    rows = rows.join(indexed.select("number", "hit"), "number", "left")
    hit = F.coalesce("hit", F.lit(False))
    return rows.groupBy("member").agg(
        F.count("*").alias("n_votes"), F.count_if(hit).alias("n_indexed"), F.count_if(~hit & F.col("key").isNotNull()).alias("n_own"),
        F.count_if(F.col("unresolved").isNotNull()).alias("n_unresolved"), F.min("unresolved.number").alias("first_unresolved"), F.count_distinct("key").alias("n_keys"),
    )


#: (state, substate) and what becomes of the amendment; a state alone decides where the substate is not listed.
OUTCOMES = {("F", None): "adopted", ("F", "1-URGENT"): "rejected", ("O", None): "pending", ("O", "5-LOW"): "withdrawn", ("O", "2-HIGH"): "inadmissible"}


@query(
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'rejected' WHEN o_orderstatus = 'F' THEN 'adopted'
 WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'withdrawn' WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'inadmissible' WHEN o_orderstatus = 'O' THEN 'pending' END AS outcome FROM orders"""
)
def outcome_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and substate to an outcome; unknown states give null."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), normalize.outcome(F.col("o_orderstatus"), F.col("o_orderpriority"), OUTCOMES).alias("outcome"))


@query(
    """WITH f AS (SELECT l_orderkey AS id, min_by(l_suppkey, l_linenumber * 1000000 + l_suppkey) AS author FROM lineitem GROUP BY 1),
 c AS (SELECT DISTINCT l_orderkey AS id, l_suppkey AS member FROM lineitem)
 SELECT id, author AS member, 'author' AS role FROM f UNION ALL SELECT c.id, c.member, 'cosigner' AS role FROM c JOIN f USING (id) WHERE c.member <> f.author"""
)
def signatory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for the author and one for each other distinct signatory."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min_by("l_suppkey", F.col("l_linenumber") * 1_000_000 + F.col("l_suppkey")).alias("author"), F.collect_set("l_suppkey").alias("all")
    )
    return normalize.signatories(rows, "author", "all")


PERIODS = [("first", 1, "1995-01-01", "1996-06-30"), ("second", 0, "1996-07-01", "1998-12-31"), ("third", 1, "1999-01-01", None)]
_PERIODS_SQL = ", ".join(f"('{p}', {x}, DATE '{a}', {f"DATE '{z}'" if z else 'CAST(NULL AS DATE)'})" for p, x, a, z in PERIODS)


@query(
    f"""WITH {b.SPANS_SQL}, ps(period, label, first, last) AS (VALUES {_PERIODS_SQL}),
 posts AS (SELECT l_suppkey AS member, l_linenumber AS post, CAST(min(l_shipdate) AS DATE) AS first, CAST(min(l_shipdate) + INTERVAL 400 DAY AS DATE) AS last FROM lineitem WHERE l_linenumber < 4 GROUP BY 1, 2),
 i AS (SELECT p.period, m.member, m.first AS mf, m.last AS ml, p.first AS pf, p.last AS pl FROM (SELECT *, member % 2 AS label FROM spans) m JOIN ps p
   ON m.label = p.label AND (p.last IS NULL OR m.first <= p.last) AND (m.last IS NULL OR m.last >= p.first))
 SELECT DISTINCT i.period, i.member, x.post, CASE WHEN x.post IS NOT NULL THEN x.first ELSE mf END AS first, CASE WHEN x.post IS NOT NULL THEN x.last ELSE ml END AS last
 FROM i LEFT JOIN posts x ON x.member = i.member AND (ml IS NULL OR x.first <= ml) AND x.last >= mf AND (pl IS NULL OR x.first <= pl) AND x.last >= pf"""
)
def government_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of each period with the posts that overlap membership and period."""
    periods = spark.createDataFrame(PERIODS, "period string, label bigint, first string, last string").withColumns({"first": F.col("first").cast("date"), "last": F.col("last").cast("date")})
    memberships = b.spans(spark, sf_dir).withColumn("label", F.col("member") % 2)
    rows = table(spark, sf_dir, "lineitem").where("l_linenumber < 4").groupBy(F.col("l_suppkey").alias("member"), F.col("l_linenumber").alias("post")).agg(F.min("l_shipdate").cast("date").alias("first"))
    return normalize.roster(memberships, rows.withColumn("last", F.date_add("first", 400)), periods)


@query(
    f"""WITH {b.SPANS_SQL}, ps(period, label, first, last) AS (VALUES {_PERIODS_SQL}),
 posts AS (SELECT l_suppkey AS member, l_partkey % 7 AS role, CAST(l_shipdate AS DATE) AS first, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS last FROM lineitem WHERE l_linenumber = 7 AND l_quantity >= 49),
 c AS (SELECT DISTINCT p.period, m.member, role = 0 AS counts FROM (SELECT *, member % 2 AS label FROM spans) m JOIN ps p ON m.label = p.label AND (p.last IS NULL OR m.first <= p.last) AND (m.last IS NULL OR m.last >= p.first)
   JOIN posts x ON x.member = m.member AND (m.last IS NULL OR x.first <= m.last) AND x.last >= m.first AND (p.last IS NULL OR x.first <= p.last) AND x.last >= p.first),
 g AS (SELECT period, count(*) FILTER (counts) AS n, string_agg(member::VARCHAR, ', ' ORDER BY member) FILTER (counts) AS holders, string_agg(member::VARCHAR, ', ' ORDER BY member) FILTER (NOT counts) AS others, max(CASE WHEN counts THEN member END) AS one FROM c GROUP BY 1)
 SELECT ps.period, CASE WHEN n = 1 THEN one END AS holder, nullif(concat_ws('; ', CASE WHEN n > 1 THEN n || ' possible: ' || holders END, 'another role: ' || others), '') AS warning FROM ps LEFT JOIN g USING (period)"""
)
def head_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one member who belonged to a period and held its highest post in it; none of several, which is told, as
    are those who held the post in another role."""
    periods = spark.createDataFrame(PERIODS, "period string, label bigint, first string, last string").withColumns({"first": F.col("first").cast("date"), "last": F.col("last").cast("date")})
    memberships = b.spans(spark, sf_dir).withColumn("label", F.col("member") % 2)
    rows = table(spark, sf_dir, "lineitem").where("l_linenumber = 7 and l_quantity >= 49")
    day = F.col("l_shipdate").cast("date")
    role = F.when(F.col("l_partkey") % 7 == 0, " Head ").otherwise("on mission")
    posts = rows.select(F.col("l_suppkey").alias("member"), F.lit("head").alias("post"), role.alias("role"), day.alias("first"), F.date_add(day, F.col("l_quantity").cast("int")).alias("last"))
    return normalize.sole_holder(memberships, posts, periods, "head", "head")


@query(
    """WITH a AS (SELECT l_orderkey AS id, l_returnflag || l_linestatus AS code, l_shipdate AS d, l_linenumber * 10000000 + l_partkey AS pos FROM lineitem),
 s AS (SELECT id, arg_max(CASE code WHEN 'AF' THEN 'adopted' WHEN 'RF' THEN 'rejected' ELSE 'shuttle' END, (d, -pos)) AS status FROM a WHERE code IN ('AF', 'RF', 'NF') GROUP BY 1)
 SELECT a.id, CASE WHEN bool_or(code = 'AO') THEN 'promulgated' ELSE coalesce(any_value(s.status), 'deposited') END AS status, min(d) AS deposited, max(d) AS last_act, count(*) AS n_acts
 FROM a LEFT JOIN s USING (id) GROUP BY a.id"""
)
def text_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of a text by its latest deciding act, and the act that overrides all others."""
    acts = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.concat("l_returnflag", "l_linestatus").alias("code"), F.col("l_shipdate").alias("d"), (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")).alias("pos")
    )
    return normalize.text_status(acts, "id", "code", "d", "pos", {"AF": "adopted", "RF": "rejected", "NF": "shuttle"}, "AO", "promulgated", "deposited")


@query(
    """WITH n AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i FROM nation)
 SELECT r_regionkey AS root, 0 AS depth, '0' AS path, r_name AS name FROM region
 UNION ALL SELECT n_regionkey, 1, '0.' || i, n_name FROM n
 UNION ALL SELECT n_regionkey, 2, '0.' || i || '.0', 'supplier ' || s_suppkey FROM n JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey"""
)
def act_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of nested JSON, however deep; a single child may stand without a list."""
    least = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.min("s_suppkey").alias("s"))
    leaf = F.when(F.col("s").isNotNull(), F.struct(F.concat(F.lit("supplier "), F.col("s")).alias("name")))
    nations = table(spark, sf_dir, "nation").join(least, "n_nationkey", "left").select("n_regionkey", F.struct("n_nationkey", F.col("n_name").alias("name"), leaf.alias("children")).alias("n"))
    trees = nations.groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n")).alias("children")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    trees = trees.select(F.col("r_regionkey").alias("root"), F.to_json(F.struct(F.col("r_name").alias("name"), "children")).alias("doc"))
    return normalize.tree_nodes(trees, "root", "doc")


ORDER = ["MACHINERY", "BUILDING", "AUTOMOBILE"]


@query(
    """WITH s AS (SELECT c_nationkey AS id, list(DISTINCT c_mktsegment) AS have FROM customer GROUP BY 1),
 o AS (SELECT id, have, list_filter(['MACHINERY', 'BUILDING', 'AUTOMOBILE'], lambda x: list_contains(have, x)) AS k FROM s)
 SELECT id, array_to_string(k, ',') AS chambers, k[1] AS chamber, len(k)::BIGINT AS n_known, (len(have) - len(k))::BIGINT AS n_unknown FROM o"""
)
def chamber_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known chambers in a fixed order, the first of them as the scalar, unknown ones counted."""
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("id")).agg(F.collect_set("c_mktsegment").alias("have"))
    rows = rows.withColumn("k", normalize.in_order(F.col("have"), ORDER))
    return rows.select("id", F.array_join("k", ",").alias("chambers"), F.get("k", F.lit(0)).alias("chamber"), F.size("k").cast("long").alias("n_known"), (F.size("have") - F.size("k")).cast("long").alias("n_unknown"))


@query(
    r"""WITH r AS (SELECT CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '-' || user_id WHEN 3 THEN 'PA' || user_id WHEN 4 THEN ' ' || user_id || ' ' WHEN 5 THEN '' ELSE 'x' || user_id END AS raw FROM events),
 t AS (SELECT trim(raw) AS t FROM r),
 k AS (SELECT t, CASE WHEN t IS NULL OR t = '' THEN 'absent' WHEN t = '0' THEN 'anonymous' WHEN regexp_full_match(t, '-\d+') THEN 'pseudo' WHEN regexp_full_match(t, 'PA\d+') THEN 'prefixed' WHEN regexp_full_match(t, '\d+') THEN 'completed' ELSE 'unexpected' END AS reason FROM t)
 SELECT reason, count(*) AS n, count(DISTINCT CASE reason WHEN 'prefixed' THEN t WHEN 'completed' THEN 'PA' || t END) AS n_refs FROM k GROUP BY reason"""
)
def speaker_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw speaker ids to references, every other outcome counted by its reason."""
    user, kind = F.col("user_id").cast("string"), F.col("event_id") % 7
    raw = F.when(kind == 1, "0").when(kind == 2, F.concat(F.lit("-"), user)).when(kind == 3, F.concat(F.lit("PA"), user)).when(kind == 4, F.concat(F.lit(" "), user, F.lit(" ")))
    raw = raw.when(kind == 5, "").when(kind == 6, F.concat(F.lit("x"), user))
    ref, reason = normalize.coded_ref(raw, "PA")
    return table(spark, sf_dir, "events").select(ref.alias("ref"), reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("ref").alias("n_refs"))


@query(
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'size: large' || CASE WHEN o_totalprice > 100000 THEN '' ELSE '|votes: none' END
 ELSE CASE WHEN o_totalprice > 100000 THEN 'size: large' ELSE 'size: large|votes: none' END END AS warnings FROM orders"""
)
def pruned_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings each once, without those that the data contradict."""
    rows = table(spark, sf_dir, "orders").withColumn("w", F.array(F.lit("size: large"), F.lit("votes: none"), F.lit("size: large")))
    return rows.select(F.col("o_orderkey").alias("id"), F.array_join(normalize.pruned(F.col("w"), {"votes:": F.col("o_totalprice") > 100000}), "|").alias("warnings"))


@query(
    r"""SELECT p_partkey AS id, regexp_extract(p_type, '^(\w+) (\w+)', 2) AS word, CASE WHEN p_type LIKE '%PROMO%' THEN 'first' WHEN p_type LIKE '%STANDARD%' THEN 'second' ELSE 'other' END AS reading,
 CASE WHEN length(p_name) > 12 THEN substr(p_name, 1, 12) || '…' ELSE p_name END AS title FROM part"""
)
def title_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a title by pattern, the reading's name, a shortened title."""
    short = F.when(F.length("p_name") > 12, F.concat(F.substring("p_name", 1, 12), F.lit("…"))).otherwise(F.col("p_name"))
    reading = first_match(F.col("p_type"), [("first", "PROMO"), ("second", "STANDARD")], "other")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.regexp_extract("p_type", r"^(\w+) (\w+)", 2).alias("word"), reading.alias("reading"), short.alias("title"))


@query(
    """SELECT c_mktsegment AS party, count(*) AS n_declared, count(*) FILTER (c_custkey % 10 <> 3) AS n_present, count(*) FILTER (c_custkey % 10 = 3) AS n_missing,
 min(c_custkey) AS first_id FROM customer WHERE trim(c_mktsegment) <> '' AND c_acctbal >= 0 GROUP BY 1"""
)
def party_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by party, blank parties left out, with who has a document."""
    candidates = table(spark, sf_dir, "customer").where("trim(c_mktsegment) <> '' and c_acctbal >= 0")
    documents = b.snapshots(table(spark, sf_dir, "customer"), "c_custkey")[0].select("c_custkey", F.lit(True).alias("has"))
    rows = candidates.join(documents, "c_custkey", "left")
    return rows.groupBy(F.col("c_mktsegment").alias("party")).agg(F.count("*").alias("n_declared"), F.count_if("has").alias("n_present"), F.count_if(F.col("has").isNull()).alias("n_missing"), F.min("c_custkey").alias("first_id"))


@query(
    """SELECT 'members' AS section, 'count' AS indicator, count(*)::DOUBLE AS value FROM supplier UNION ALL
 SELECT 'members', 'groups', count(DISTINCT s_nationkey)::DOUBLE FROM supplier UNION ALL SELECT 'ballots', 'count', count(*)::DOUBLE FROM orders UNION ALL
 SELECT 'ballots', 'first', epoch(CAST(min(o_orderdate) AS TIMESTAMP))::DOUBLE FROM orders UNION ALL SELECT 'votes', 'count', count(*)::DOUBLE FROM lineitem UNION ALL
 SELECT 'votes', 'median', median(l_quantity)::DOUBLE FROM lineitem"""
)
def overview_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators of several reports as one table of (section, indicator, value)."""
    parts = {
        "members": table(spark, sf_dir, "supplier").agg(F.count("*").alias("count"), F.count_distinct("s_nationkey").alias("groups")),
        "ballots": table(spark, sf_dir, "orders").agg(F.count("*").alias("count"), F.unix_timestamp(F.min("o_orderdate").cast("timestamp")).alias("first")),
        "votes": table(spark, sf_dir, "lineitem").agg(F.count("*").alias("count"), F.median("l_quantity").alias("median")),
    }
    out = None
    for section, one in parts.items():
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).cast("double").alias("value")) for c in one.columns]))
        rows = one.select(F.lit(section).alias("section"), cells.alias("x")).select("section", "x.indicator", "x.value")
        out = rows if out is None else out.union(rows)
    return out
