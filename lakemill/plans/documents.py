"""Normalised documents: raw rows of several sources brought to one form, each query with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.values import size_or_null
from lakemill.operators import intervals
from lakemill.operators import projections as p
from lakemill.operators.dedupe import keep_one
from lakemill.plans.registry import query, table

_CHAMBERS = {"FA": "AN", "FN": "SN", "OA": "PE"}
_RAW_MANDATES = """raw AS (SELECT l_orderkey, l_suppkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'mandat_electif' WHEN 1 THEN 'commission' END AS category,
   CASE l_returnflag WHEN 'A' THEN ' ' WHEN 'N' THEN 'president' END AS role, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS first, l_linestatus || l_returnflag AS stamp,
   CASE WHEN l_linestatus = 'O' THEN '9999-12-31' WHEN l_linenumber < 7 THEN CAST(CAST(l_shipdate AS DATE) + 30 AS VARCHAR) END AS last FROM lineitem)"""


def _raw_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 0, "mandat_electif").when(F.col("l_linenumber") % 3 == 1, "commission").alias("category"),
        F.when(F.col("l_returnflag") == "A", " ").when(F.col("l_returnflag") == "N", "president").alias("role"), day.cast("string").alias("first"),
        F.concat("l_linestatus", "l_returnflag").alias("stamp"), F.when(F.col("l_linestatus") == "O", p.OPEN_END).when(F.col("l_linenumber") < 7, F.date_add(day, 30).cast("string")).alias("last"),
    )


@query(
    f"""WITH {_RAW_MANDATES} SELECT l_orderkey, l_linenumber, category, coalesce(CASE WHEN trim(role) <> '' THEN role END, 'membre') AS role, first,
 CASE WHEN last <> '9999-12-31' THEN last END AS last, last IS NULL OR last = '9999-12-31' AS active,
 CASE WHEN category = 'mandat_electif' THEN CASE stamp WHEN 'FA' THEN 'AN' WHEN 'FN' THEN 'SN' WHEN 'OA' THEN 'PE' END END AS chamber FROM raw"""
)
def normalized_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mandates in one form; a far end is no end, a chamber comes from an elective mandate's own stamp."""
    rows = _raw_mandates(spark, sf_dir)
    made = p.mandate(F.col("category"), F.col("role"), F.col("first"), F.col("last"), F.col("stamp"), _CHAMBERS)
    return rows.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in made.items()])


@query(
    """WITH t AS (SELECT p_partkey, coalesce(CASE WHEN p_size % 3 > 0 THEN p_name END, p_brand) AS url, CASE p_size % 4 WHEN 0 THEN 'author' WHEN 1 THEN 'rapporteur' WHEN 3 THEN 'signatory' END AS role, p_type AS stage FROM part),
 f AS (SELECT *, coalesce(role IN ('author', 'rapporteur'), false) AS r, coalesce(stage IN ('ECONOMY', 'PROMO'), false) AS s FROM t)
 SELECT p_partkey, url, role, r AND s AS public, concat_ws(',', CASE WHEN NOT r THEN 'role' END, CASE WHEN NOT s THEN 'stage' END) AS reasons FROM f"""
)
def carried_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the first of two addresses and no inferred role; which are public, and why others are not."""
    role = F.when(F.col("p_size") % 4 == 0, "author").when(F.col("p_size") % 4 == 1, "rapporteur").when(F.col("p_size") % 4 == 3, "signatory")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.coalesce(F.when(F.col("p_size") % 3 > 0, F.col("p_name")), F.col("p_brand")).alias("url"), role.alias("role"), "p_type")
    r, s = F.coalesce(F.col("role").isin("author", "rapporteur"), F.lit(False)), F.coalesce(F.col("p_type").isin("ECONOMY", "PROMO"), F.lit(False))
    reasons = F.array_join(F.array_compact(F.array(F.when(~r, "role"), F.when(~s, "stage"))), ",")
    return rows.select("p_partkey", "url", "role", (r & s).alias("public"), reasons.alias("reasons"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 's' || user_id END AS session_ref, CASE WHEN event_id % 5 = 0 THEN 'd' || user_id END AS dossier_ref,
 CASE WHEN event_id % 3 = 0 THEN event_type END AS theme, CASE WHEN event_id % 2 = 0 THEN props END AS answer, event_id % 3 = 0 AS has_session, event_id % 5 = 0 AS has_dossier FROM events"""
)
def nested_interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interventions whose nested parts stand only where what they refer to does."""
    session, dossier = (F.when(F.col("event_id") % n == 0, F.concat(F.lit(c), "user_id")) for n, c in ((3, "s"), (5, "d")))
    kind = F.when(F.col("event_id") % 2 == 0, "question").otherwise("speech")
    made = p.intervention(session, dossier, F.col("event_type"), kind, F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in made.items()])
    return rows.select("event_id", F.col("session.ref").alias("session_ref"), F.col("dossier.ref").alias("dossier_ref"), "theme", "answer", F.col("session").isNotNull().alias("has_session"), F.col("dossier").isNotNull().alias("has_dossier"))


@query(
    """WITH d AS (SELECT c_custkey, 'person-' || lower(c_mktsegment) AS slug, CASE WHEN c_custkey % 4 > 0 THEN c_name END AS name,
   CASE c_custkey % 3 WHEN 0 THEN [' ' || c_mktsegment, lower(c_mktsegment), ''] WHEN 1 THEN [] END AS themes, [c_name, ' Zeta ', NULL] AS keywords FROM customer),
 t AS (SELECT *, coalesce(list_filter(list_transform(themes, lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x <> ''), []) AS own FROM d)
 SELECT c_custkey, coalesce(name, 'Person ' || upper(slug[8]) || slug[9:]) AS name,
 array_to_string(list_sort(list_distinct(CASE WHEN len(own) > 0 THEN own ELSE list_filter(list_transform(keywords, lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x <> '') END)), ',') AS tags,
 CASE c_custkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 0 END AS n_themes FROM t"""
)
def projected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a name made from the slug where there is none, tags from themes or else keywords,
    and lists of which missing is not empty."""
    slug = F.concat(F.lit("person-"), F.lower("c_mktsegment"))
    themes = F.when(F.col("c_custkey") % 3 == 0, F.array(F.concat(F.lit(" "), "c_mktsegment"), F.lower("c_mktsegment"), F.lit(""))).when(F.col("c_custkey") % 3 == 1, F.array().cast("array<string>"))
    keywords = F.array(F.col("c_name"), F.lit(" Zeta "), F.lit(None).cast("string"))
    name = F.coalesce(F.when(F.col("c_custkey") % 4 > 0, F.col("c_name")), p.name_of_slug(slug))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), F.array_join(p.document_tags(themes, keywords), ",").alias("tags"), size_or_null(themes).cast("int").alias("n_themes"))


@query(
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Ada Van ' || c_mktsegment[1] || lower(c_mktsegment[2:]) WHEN 1 THEN c_name ELSE c_mktsegment END AS name FROM customer"""
)
def given_names_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose surname leads in capitals, turned round; others as they are."""
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("VAN "), "c_mktsegment", F.lit(" Ada"))).when(F.col("c_custkey") % 3 == 1, F.col("c_name")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", p.given_and_surname(raw).alias("name"))


@query(
    """WITH r AS (SELECT o_custkey AS member, o_orderpriority AS grp, o_orderstatus = 'O' AS active, CASE WHEN o_orderpriority LIKE '1%' THEN 'PE' END AS chamber,
   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'O' DESC, o_orderdate DESC, o_orderkey) AS rn FROM orders) SELECT member, grp, active, chamber FROM r WHERE rn = 1"""
)
def latest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member's latest group, an active one first; elective ones are stamped with their chamber."""
    rows = table(spark, sf_dir, "orders").withColumn("active", F.col("o_orderstatus") == "O")
    best = keep_one(rows, ["o_custkey"], [F.desc("active"), F.desc("o_orderdate"), F.asc("o_orderkey")])
    return best.select(F.col("o_custkey").alias("member"), F.col("o_orderpriority").alias("grp"), "active", F.when(F.startswith("o_orderpriority", F.lit("1")), "PE").alias("chamber"))


@query(
    """WITH k AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 9 > 0 THEN o_custkey END AS member, o_orderpriority AS text FROM orders),
 e AS (SELECT member, text FROM k WHERE id % 10 <> 3), m AS (SELECT DISTINCT member, text FROM k WHERE id % 10 <> 7)
 SELECT member, text, NULL AS origin FROM e UNION ALL SELECT member, text, 'dump' FROM m WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.member IS NOT DISTINCT FROM m.member AND e.text IS NOT DISTINCT FROM m.text)"""
)
def enriched_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a second source added where their key is new; the source is named only where it added something."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 9 > 0, F.col("o_custkey")).alias("member"), F.col("o_orderpriority").alias("text"))
    old, more = rows.where("id % 10 <> 3").drop("id"), rows.where("id % 10 <> 7").drop("id")
    return p.added(old, more, ["member", "text"], "dump")


@query(
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id WHEN 1 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
 CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') || ' ; ' || event_id WHEN 1 THEN json_extract_string(props, '$.k') ELSE '' END AS analyses FROM events"""
)
def question_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node that is one object, a list or an empty list: the last one counts, all are joined."""
    node = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), "props", F.lit(',{"k": '), "event_id", F.lit("}]"))).when(F.col("event_id") % 3 == 1, F.col("props")).otherwise("[]")
    every = F.when(F.startswith(node, F.lit("[")), F.from_json(node, "array<string>")).otherwise(F.array(node))
    joined = F.array_join(F.transform(every, lambda x: F.get_json_object(x, "$.k")), " ; ")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(p.last_of(node), "$.k").cast("long").alias("k"), joined.alias("analyses"))


@query(
    f"""WITH {_RAW_MANDATES}, legacy AS (SELECT l_suppkey AS member, coalesce(category, 'other') AS category, first FROM raw WHERE l_linenumber < 6),
 official AS (SELECT l_suppkey AS member, coalesce(category, 'other') AS category, first FROM raw WHERE l_linenumber >= 6 AND l_suppkey % 2 = 0)
 SELECT member, category, first, 'official' AS origin FROM official
 UNION ALL SELECT member, category, first, 'legacy' FROM legacy l WHERE NOT EXISTS (SELECT 1 FROM official o WHERE o.member = l.member AND o.category = l.category)"""
)
def official_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official mandates in place of the legacy ones of the categories that they cover."""
    rows = _raw_mandates(spark, sf_dir).select(F.col("l_suppkey").alias("member"), F.coalesce("category", F.lit("other")).alias("category"), "first", "l_linenumber")
    official = rows.where("l_linenumber >= 6 and member % 2 = 0").select("member", "category", "first", F.lit("official").alias("origin"))
    legacy = rows.where("l_linenumber < 6").select("member", "category", "first", F.lit("legacy").alias("origin"))
    return official.unionByName(legacy.join(official.select("member", "category").distinct(), ["member", "category"], "left_anti"))


@query(
    """SELECT l_suppkey AS member, CASE p_type WHEN 'PROMO' THEN 'majority' ELSE 'opposition' END AS position, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last, count(*) AS n_mandates
 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type IN ('PROMO', 'LARGE') GROUP BY ALL"""
)
def qualified_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of a member by position: mandates joined to the organs that have one."""
    organs = table(spark, sf_dir, "part").where(F.col("p_type").isin("PROMO", "LARGE")).select("p_partkey", F.when(F.col("p_type") == "PROMO", "majority").otherwise("opposition").alias("position"))
    rows = table(spark, sf_dir, "lineitem").join(organs, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("l_suppkey").alias("member"), "position").agg(F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last"), F.count("*").alias("n_mandates"))


_POSITIONS = {"PROMO": "gouvernement", "LARGE": "majorite", "MEDIUM": "opposition", "SMALL": "minoritaire"}


@query(
    """WITH o AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'gouvernement' WHEN 'LARGE' THEN 'majorite' WHEN 'MEDIUM' THEN 'opposition' WHEN 'SMALL' THEN 'minoritaire' END AS position,
   DATE '1994-01-01' + p_size * 30 AS first, CASE WHEN p_type <> 'PROMO' THEN DATE '1994-01-01' + p_size * 30 + CAST(p_retailprice AS INTEGER) END AS last FROM part WHERE p_type IN ('PROMO', 'LARGE', 'MEDIUM', 'SMALL')),
 m AS (SELECT l_suppkey AS member, l_partkey, CAST(l_shipdate AS DATE) AS first, CASE WHEN l_quantity < 45 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) * 10 END AS last FROM lineitem),
 j AS (SELECT member, position, greatest(m.first, o.first) AS f, least(coalesce(m.last, DATE '9999-12-31'), coalesce(o.last, DATE '9999-12-31')) AS l FROM m JOIN o ON p_partkey = l_partkey AND m.first <= coalesce(o.last, DATE '9999-12-31') AND o.first <= coalesce(m.last, DATE '9999-12-31')),
 g AS (SELECT *, CASE WHEN f <= max(l) OVER (PARTITION BY member, position ORDER BY f, l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM (SELECT *, least(l, DATE '9999-12-30') AS x FROM j)),
 i AS (SELECT *, sum(fresh) OVER (PARTITION BY member, position ORDER BY f, l ROWS UNBOUNDED PRECEDING) AS island FROM g)
 SELECT member, position, min(f) AS first, nullif(max(l), DATE '9999-12-31') AS last, count(*) AS n_spans FROM i GROUP BY member, position, island"""
)
def position_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which periods a member stood for what: mandates where their organ was valid too, each pair met once, and
    what touches or overlaps made one period."""
    position = F.try_element_at(F.create_map(*[F.lit(x) for kv in _POSITIONS.items() for x in kv]), F.col("p_type"))
    start = F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size") * 30)
    # DuckDB rounds a price half to even, as rint does.
    end = F.when(F.col("p_type") != "PROMO", F.date_add(start, F.rint("p_retailprice").cast("int")))
    organs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("organ"), position.alias("position"), start.alias("first"), end.alias("last")).where("position is not null")
    day = F.col("l_shipdate").cast("date")
    mandates = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("member"), F.col("l_partkey").alias("organ"), day.alias("first"), F.when(F.col("l_quantity") < 45, F.date_add(day, F.rint("l_quantity").cast("int") * 10)).alias("last"))
    return intervals.islands(intervals.overlap_join(mandates, organs, ["organ"]), ["member", "position"], "first", "last")


@query("SELECT page_id, CASE WHEN contains(lower(url), 'blog') THEN 'url' ELSE 'name' END AS why FROM pages WHERE contains(lower(url), 'blog') OR contains(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), 'thion')")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits kept where the speaker's address or name names the candidate; mere mentions go."""
    name = F.lower(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    by_url = F.contains(F.lower("url"), F.lit("blog"))
    return table(spark, sf_dir, "pages").where(by_url | F.contains(name, F.lit("thion"))).select("page_id", F.when(by_url, "url").otherwise("name").alias("why"))


@query(
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN 'ep-' || (o_custkey % 10) ELSE CAST(o_custkey AS VARCHAR) END AS organ FROM orders)
 SELECT o_orderkey, organ, CASE WHEN starts_with(organ, 'ep-') THEN 'legislature ' || organ[4:] ELSE c_name END AS label
 FROM m LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = organ AND c_custkey % 5 > 0"""
)
def organ_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memberships with their organ's label; pseudo organs are labelled as legislatures, unknown ones stay."""
    organ = F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("ep-"), F.col("o_custkey") % 10)).otherwise(F.col("o_custkey").cast("string"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").cast("string").alias("known"), "c_name")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", organ.alias("organ")).join(known, F.col("organ") == F.col("known"), "left")
    return rows.select("o_orderkey", "organ", F.when(F.startswith("organ", F.lit("ep-")), F.concat(F.lit("legislature "), F.substring("organ", 4, 99))).otherwise(F.col("c_name")).alias("label"))


_STATUSES = {"1-URGENT": "adopted", "2-HIGH": "rejected_49_3", "3-MEDIUM": "pending"}


@query(
    """WITH d AS (SELECT o_orderkey, o_orderdate, o_orderpriority AS code, CASE o_orderpriority WHEN '1-URGENT' THEN 'adopted' WHEN '2-HIGH' THEN 'rejected_49_3' WHEN '3-MEDIUM' THEN 'pending' END AS status,
   CASE WHEN o_custkey % 4 > 0 THEN 1 + o_custkey % 2 END AS n_initiators FROM orders WHERE o_orderstatus <> 'P')
 SELECT o_orderkey, CAST(o_orderdate AS DATE) AS deposited, status, coalesce(status = 'rejected_49_3', false) AS forced, n_initiators, CASE WHEN status IS NULL THEN 'unmapped: ' || code END AS warning FROM d"""
)
def government_dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P25: the government's own dossiers with their status; an unmapped code is a warning, no initiators are not none."""
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    status = F.try_element_at(F.create_map(*[F.lit(x) for kv in _STATUSES.items() for x in kv]), F.col("o_orderpriority"))
    initiators = F.when(F.col("o_custkey") % 4 > 0, F.when(F.col("o_custkey") % 2 == 1, F.array("o_custkey", "o_orderkey")).otherwise(F.array("o_custkey")))
    return rows.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("deposited"), status.alias("status"), F.coalesce(status == "rejected_49_3", F.lit(False)).alias("forced"),
        size_or_null(initiators).cast("long").alias("n_initiators"), F.when(status.isNull(), F.concat(F.lit("unmapped: "), "o_orderpriority")).alias("warning"),
    )


@query(
    """WITH a AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 > 0), b AS (SELECT c_custkey, lower(c_name) AS c_name FROM customer WHERE c_custkey % 4 > 0)
 SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.c_name, b.c_name) AS c_name, CASE WHEN a.c_custkey IS NOT NULL THEN 'first' ELSE 'second' END AS answered_by,
 CASE WHEN a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL THEN 'both_answered' WHEN a.c_custkey IS NULL THEN 'first_failed' END AS warning FROM a FULL JOIN b ON a.c_custkey = b.c_custkey"""
)
def chambers_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chambers are asked in order; the first that answers counts, two answers or a failure are told."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return p.first_answering(rows.where("c_custkey % 3 > 0"), rows.where("c_custkey % 4 > 0").withColumn("c_name", F.lower("c_name")), "c_custkey", ["c_name"])


@query(
    """WITH m AS (SELECT l_suppkey AS member, l_linenumber = 1 AND l_suppkey % 3 > 0 AS elective, CASE l_returnflag WHEN 'A' THEN 'AN' WHEN 'N' THEN 'SN' END AS chamber, l_suppkey % 5 AS k FROM lineitem WHERE l_suppkey % 5 > 0 OR l_returnflag = 'N')
 SELECT member, CASE WHEN bool_or(elective) THEN count(*) FILTER (elective AND (chamber IS NULL OR chamber = 'AN')) END AS n_spans FROM m GROUP BY member"""
)
def mandate_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """spans of elective mandates in a chamber; none at all is null, none here is an empty list."""
    rows = table(spark, sf_dir, "lineitem").where("l_suppkey % 5 > 0 or l_returnflag = 'N'")
    one = F.struct(
        F.when((F.col("l_linenumber") == 1) & (F.col("l_suppkey") % 3 > 0), p.ELECTIVE).otherwise("commission").alias("category"),
        F.when(F.col("l_returnflag") == "A", "AN").when(F.col("l_returnflag") == "N", "SN").alias("chamber"), F.col("l_shipdate").alias("first"), F.lit(None).cast("timestamp").alias("last"),
    )
    docs = rows.groupBy(F.col("l_suppkey").alias("member")).agg(F.collect_list(one).alias("mandates"))
    return docs.select("member", size_or_null(p.eligibility_spans(F.col("mandates"), F.lit("AN"))).cast("long").alias("n_spans"))


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey % 5 = 1 AND (l_suppkey % 2 = 0 OR l_linestatus = 'O' OR CAST(l_shipdate AS DATE) >= DATE '1997-01-01')"""
)
def roster_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a group's members by acronym; in one chamber those whose end lies before a start are left out."""
    rows = table(spark, sf_dir, "lineitem").withColumns({
        "acronym": F.concat(F.lit("G"), F.col("l_suppkey") % 5), "chamber": F.when(F.col("l_suppkey") % 2 == 0, "AN").otherwise("SN"),
        "last": F.when(F.col("l_linestatus") != "O", F.col("l_shipdate").cast("date")),
    })
    inside = (F.col("chamber") != "SN") | F.col("last").isNull() | (F.col("last") >= F.lit("1997-01-01").cast("date"))
    return rows.where((F.col("acronym") == "G1") & inside).select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    """WITH g AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority) AS groups FROM orders GROUP BY 1)
 SELECT c_custkey FROM customer JOIN g ON k = c_custkey WHERE coalesce(CASE c_custkey % 3 WHEN 0 THEN 'candidat_declare' WHEN 1 THEN 'roster' END, 'candidat_declare') = 'candidat_declare' AND list_contains(groups, '1-URGENT')"""
)
def candidates_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """declared candidates, as are those without a provenance, whose groups hold the selected one."""
    groups = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set("o_orderpriority").alias("groups"))
    origin = F.when(F.col("c_custkey") % 3 == 0, "candidat_declare").when(F.col("c_custkey") % 3 == 1, "roster")
    rows = table(spark, sf_dir, "customer").where(F.coalesce(origin, F.lit("candidat_declare")) == "candidat_declare").join(groups, F.col("k") == F.col("c_custkey"))
    return rows.where(F.array_contains("groups", "1-URGENT")).select("c_custkey")


@query(
    """WITH s AS (SELECT l_suppkey AS member, l_linenumber % 3 AS category, l_partkey % 10 AS label, CAST(l_shipdate AS DATE) AS first, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS last, l_linestatus AS kind, l_orderkey FROM lineitem)
 SELECT l_orderkey, member, category, label, first FROM s o WHERE kind = 'F' AND NOT EXISTS (SELECT 1 FROM s f WHERE f.kind = 'O' AND f.member = o.member AND f.category = o.category AND f.label = o.label AND NOT (o.first > f.last) AND NOT (o.last < f.first))"""
)
def purged_mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: legacy mandates less those that an official one of the same member, category and label overlaps."""
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("member"), (F.col("l_linenumber") % 3).alias("category"), (F.col("l_partkey") % 10).alias("label"), day.alias("first"), F.date_add(day, F.col("l_quantity").cast("int")).alias("last"), "l_linestatus",
    )
    old, official = rows.where("l_linestatus = 'F'"), rows.where("l_linestatus = 'O'")
    return p.without_covered(old, official, "member", F.col("label"), F.col("label")).select("l_orderkey", "member", "category", "label", "first")


@query(
    """WITH m AS (SELECT o_custkey AS member, lower(o_orderpriority) AS country, o_orderstatus AS grp, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
 SELECT member, max(grp) FILTER (rn = 1) AS grp FROM m GROUP BY member HAVING bool_or(country IN ('1-urgent', '2-high'))"""
)
def members_of_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """members that any constituency places in the wanted countries, with their last group."""
    at = F.struct("o_orderdate", "o_orderkey")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member")).agg(F.bool_or(F.lower("o_orderpriority").isin("1-urgent", "2-high")).alias("inside"), F.max_by("o_orderstatus", at).alias("grp"))
    return rows.where("inside").select("member", "grp")


@query(
    """WITH k AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'id' || event_id WHEN 1 THEN '' END AS id, CASE event_id % 3 WHEN 0 THEN 'url' || user_id WHEN 1 THEN '' END AS url, user_id, event_type FROM events)
 SELECT event_id, coalesce(nullif(id, ''), nullif(url, ''), concat_ws('|', user_id, event_type)) AS merge_key FROM k"""
)
def merge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by a chain of fallbacks: the id, or the address, or what else tells a row; empty counts as missing."""
    from lakemill.operators.merge import fallback_key

    identity = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("id"), "event_id")).when(F.col("event_id") % 4 == 1, "")
    url = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("url"), "user_id")).when(F.col("event_id") % 3 == 1, "")
    return table(spark, sf_dir, "events").select("event_id", fallback_key([identity, url], ["user_id", "event_type"]).alias("merge_key"))


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN 'present' WHEN 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS summary FROM events"""
)
def scalar_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands at a dotted path: blank and empty are null, a filled container is only present, 0 is a value."""
    from lakemill.operators.merge import summary_at

    node = F.when(F.col("event_id") % 5 == 0, '{"a": {"b": "  "}}').when(F.col("event_id") % 5 == 1, '{"a": {"b": 0}}').when(F.col("event_id") % 5 == 2, '{"a": {"b": [1, 2]}}')
    node = node.when(F.col("event_id") % 5 == 3, '{"a": {"b": []}}').otherwise(F.concat(F.lit('{"a": {"b": '), F.get_json_object("props", "$.k"), F.lit("}}")))
    return table(spark, sf_dir, "events").select("event_id", summary_at(node, "a.b").alias("summary"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS session_date, CASE event_id % 2 WHEN 0 THEN 'doc-' || event_id END AS slug, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 1 THEN date_trunc('second', ts) END AS synced FROM events"""
)
def stems_and_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written without signs, names less their suffix, times with an offset."""
    from lakemill.functions import dates, text

    raw = F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("000"))
    stem = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("doc-"), "event_id", F.lit(".pivot")))
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 3 == 0, "+0200").when(F.col("event_id") % 3 == 1, "Z").otherwise(" soon"))
    return table(spark, sf_dir, "events").select("event_id", dates.compact_date(raw).alias("session_date"), text.stem(stem, ".pivot").alias("slug"), dates.stamped(stamp).alias("synced"))


@query(
    """SELECT l_orderkey AS member, CASE WHEN count(DISTINCT l_linenumber) = 1 + max(l_linenumber) - min(l_linenumber) THEN ['I','II','III','IV','V','VI','VII'][min(l_linenumber)] ||
 CASE WHEN max(l_linenumber) > min(l_linenumber) THEN '-' || ['I','II','III','IV','V','VI','VII'][max(l_linenumber)] ELSE '' END END AS label FROM lineitem GROUP BY 1"""
)
def coverage_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gapless run of numbers as a range in Roman numerals; null if there is a gap."""
    from lakemill.functions.text import roman

    rows = table(spark, sf_dir, "lineitem")
    found = rows.groupBy(F.col("l_orderkey").alias("member")).agg(F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"), F.countDistinct("l_linenumber").alias("n"))
    label = F.when(F.col("high") > F.col("low"), F.concat_ws("-", roman(F.col("low")), roman(F.col("high")))).otherwise(roman(F.col("low")))
    return found.select("member", F.when(F.col("n") == F.col("high") - F.col("low") + 1, label).alias("label"))


@query(
    r"""WITH s AS (SELECT page_id, regexp_extract(html, '<article>(.*)', 1, 's') AS scope, html FROM pages),
 p AS (SELECT page_id, nullif(trim(regexp_replace(regexp_extract(scope, '<h1>(.*?)</h1>', 1, 's'), '<[^>]+>', '', 'g')), '') AS speaker, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS subject FROM s)
 SELECT page_id, CASE WHEN length(speaker) < 40 THEN speaker END AS speaker, nullif(trim(subject), '') AS subject FROM p"""
)
def page_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a page the speaker, if the first name block behind an anchor is short enough, and the session's subject."""
    scope = F.regexp_extract("html", "(?s)<article>(.*)", 1)
    rows = table(spark, sf_dir, "pages").select("page_id", F.btrim(F.regexp_replace(F.regexp_extract(scope, "(?s)<h1>(.*?)</h1>", 1), "<[^>]+>", "")).alias("speaker"), F.btrim(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("subject"))
    return rows.select("page_id", F.when((F.col("speaker") != "") & (F.length("speaker") < 40), F.col("speaker")).alias("speaker"), F.when(F.col("subject") != "", F.col("subject")).alias("subject"))
