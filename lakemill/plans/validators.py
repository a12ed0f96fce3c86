"""Validators of nested documents and of the two dimensions, and the sections of the quality gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.operators import gate, pivot_rules
from lakemill.operators import validate as v
from lakemill.plans import bindings as b
from lakemill.plans.registry import query, table

#: The positions that a vote may have.
POSITIONS = ("for", "against", "abstain", "nonvoting", "excused")


# ------------------------------------------------------------------------------------------------ nested documents


def profiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(documents, entries): the scalars of each member's document and whether it has votes, and every entry of its lists
    as a row, with its place in the votes and in the mandates."""
    lines = table(spark, sf_dir, "lineitem")
    order = [*b.ORDER, "l_orderkey"]
    place = lambda *keys: F.row_number().over(Window.partitionBy("l_suppkey", *keys).orderBy(*order)) - 1
    held = F.col("l_linenumber") < 3
    rows = lines.withColumns({"__vote": place(), "__mandate": place(held)})
    entries = rows.select(
        F.col("l_suppkey").alias("id"), "__vote", F.when(held, F.col("__mandate")).alias("__mandate"),
        F.when(F.col("l_orderkey") % 13 > 0, F.concat(F.lit("an:"), F.year("l_shipdate"), F.lit(":"), "l_orderkey")).alias("ballot_id"),
        F.when(F.col("l_partkey") % 17 == 0, "maybe").otherwise(F.expr(b.POSITION)).alias("position"), (F.col("l_orderkey") % 29 == 0).alias("forced"),
        F.col("l_shipdate").alias("first"), F.when(F.col("l_linestatus") == "F", F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_linenumber") - 2).cast("int"))).alias("last"), (F.col("l_returnflag") == "A").alias("active"),
    )
    voted = lines.select(F.col("l_suppkey").alias("s_suppkey")).distinct().withColumn("votes", F.lit(True))
    docs = table(spark, sf_dir, "supplier").join(voted, "s_suppkey", "left").select(
        F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_name")).alias("name"), F.when(F.col("s_suppkey") % 5 > 0, "v1").alias("schema_version"),
        F.when(F.col("s_suppkey") % 3 == 0, "guess").otherwise("roster").alias("provenance"), "votes",
    )
    return docs, entries


def profile_findings(docs: DataFrame, entries: DataFrame) -> DataFrame:
    schema = profile_schema()
    places = {"votes": F.col("__vote"), "mandates": F.col("__mandate")}
    return v.errors(docs, "id", v.Schema(schema.name, schema.fields)).unionByName(v.entry_errors(entries, "id", schema, places))


def profile_schema() -> v.Schema:
    fields = [*v.required("name", "schema_version"), v.outside("provenance", ("roster", "candidat_declare")), v.Field("votes", "missing", F.col("votes").isNull())]
    entries = [
        v.Entry("votes", "ballot_id", "missing", lambda x: x["ballot_id"].isNull(), blocking=False),
        v.Entry("votes", "position", "outside_domain", lambda x: x["position"].isNotNull() & ~x["position"].isin(*POSITIONS)),
        v.Entry("votes", "position", "forced_has_position", lambda x: x["forced"] & x["position"].isNotNull()),
        v.Entry("mandates", "last", "before_first", lambda x: x["last"] < x["first"]),
        v.Entry("mandates", "active", "active_has_end", lambda x: x["active"] & x["last"].isNotNull()),
    ]
    return v.Schema("profile", fields, entries)


_ORDER_SQL = ", ".join([*b.ORDER, "l_orderkey"])
_PROFILES_SQL = f"""e AS (SELECT l_suppkey AS id, CASE WHEN l_partkey % 17 = 0 THEN 'maybe' ELSE {b.POSITION} END AS position, l_orderkey, l_shipdate, l_linenumber, l_linestatus, l_returnflag,
   row_number() OVER (PARTITION BY l_suppkey ORDER BY {_ORDER_SQL}) - 1 AS i, row_number() OVER (PARTITION BY l_suppkey, l_linenumber < 3 ORDER BY {_ORDER_SQL}) - 1 AS j FROM lineitem),
 m AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) + (l_linenumber - 2) AS TIMESTAMP) END AS last, l_returnflag = 'A' AS active FROM e WHERE l_linenumber < 3),
 found AS (SELECT CAST(s_suppkey AS VARCHAR) AS key, 'name' AS path, 'missing' AS rule, true AS blocking FROM supplier WHERE s_suppkey % 4 = 0
   UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'schema_version', 'missing', true FROM supplier WHERE s_suppkey % 5 = 0
   UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'provenance', 'outside_domain', true FROM supplier WHERE s_suppkey % 3 = 0
   UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'votes', 'missing', true FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)
   UNION ALL SELECT CAST(id AS VARCHAR), 'votes[' || i || '].ballot_id', 'missing', false FROM e WHERE l_orderkey % 13 = 0
   UNION ALL SELECT CAST(id AS VARCHAR), 'votes[' || i || '].position', 'outside_domain', true FROM e WHERE position = 'maybe'
   UNION ALL SELECT CAST(id AS VARCHAR), 'votes[' || i || '].position', 'forced_has_position', true FROM e WHERE l_orderkey % 29 = 0 AND position IS NOT NULL
   UNION ALL SELECT CAST(id AS VARCHAR), 'mandates[' || j || '].last', 'before_first', true FROM m WHERE last < l_shipdate
   UNION ALL SELECT CAST(id AS VARCHAR), 'mandates[' || j || '].active', 'active_has_end', true FROM m WHERE active AND last IS NOT NULL)"""


@query(f"WITH {_PROFILES_SQL} SELECT * FROM found")
def profile_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on a person's document and on each entry of its lists, told by path."""
    return profile_findings(*profiles(spark, sf_dir))


@query(
    f"""WITH {_PROFILES_SQL} SELECT CAST(s_suppkey AS VARCHAR) AS key, count(path) AS n_errors, coalesce(string_agg(path || ' ' || rule, '; ' ORDER BY path || ' ' || rule), '') AS messages, count(path) = 0 AS valid
 FROM supplier LEFT JOIN found ON key = CAST(s_suppkey AS VARCHAR) GROUP BY s_suppkey"""
)
def validation_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validator's messages of each document, those without one too."""
    docs, entries = profiles(spark, sf_dir)
    return v.by_document(docs, "id", profile_findings(docs, entries))


@query(
    """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS key, 'votes:' || l_orderkey AS path, 'unknown' AS rule, true AS blocking FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 11 <> 0)"""
)
def unknown_ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to ballots that the dimension lacks, a rule that is left out where the dimension is not given."""
    return v.unknown(table(spark, sf_dir, "lineitem"), "l_suppkey", "votes", F.col("l_orderkey"), b.ballots(spark, sf_dir), "ballot")


@query(
    """WITH d AS (SELECT CASE o_orderkey % 37 WHEN 0 THEN 'an:' || o_orderkey WHEN 1 THEN 'an:' || year(o_orderdate) || ':' || (o_orderkey - 1) ELSE 'an:' || year(o_orderdate) || ':' || o_orderkey END AS id,
   year(o_orderdate) AS legislature, o_orderkey AS number, CASE WHEN o_orderkey % 41 = 0 THEN 'lost' ELSE o_orderstatus END AS outcome, o_orderpriority AS kind, CASE WHEN o_custkey % 6 > 0 THEN o_custkey END AS text FROM orders)
 SELECT id AS key, 'id' AS path, 'malformed' AS rule, true AS blocking FROM d WHERE NOT regexp_matches(id, '^an:[0-9]+:[0-9]+$')
 UNION ALL SELECT id, 'id', 'disagrees', true FROM d WHERE regexp_matches(id, '^an:[0-9]+:[0-9]+$') AND id <> 'an:' || legislature || ':' || number
 UNION ALL SELECT id, 'outcome', 'outside_domain', true FROM d WHERE outcome NOT IN ('F', 'O', 'P') UNION ALL SELECT id, 'text', 'censure_without_text', true FROM d WHERE kind = '1-URGENT' AND text IS NULL
 UNION ALL SELECT id, 'id', 'repeated', true FROM d GROUP BY id HAVING count(*) > 1"""
)
def ballot_dimension_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ballot dimension: shape of ids, agreement with their fields, one row each, domains, linked texts."""
    number = F.when(F.col("o_orderkey") % 37 == 1, F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))
    whole = F.concat(F.lit("an:"), F.year("o_orderdate"), F.lit(":"), number)
    dim = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 37 == 0, F.concat(F.lit("an:"), "o_orderkey")).otherwise(whole).alias("id"), F.year("o_orderdate").alias("legislature"), F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderkey") % 41 == 0, "lost").otherwise(F.col("o_orderstatus")).alias("outcome"), F.col("o_orderpriority").alias("kind"), F.when(F.col("o_custkey") % 6 > 0, F.col("o_custkey")).alias("text"),
    )
    shape = "^an:[0-9]+:[0-9]+$"
    schema = v.Schema("ballots", [
        v.unlike("id", shape), v.Field("id", "disagrees", F.col("id").rlike(shape) & (F.col("id") != F.concat(F.lit("an:"), "legislature", F.lit(":"), "number"))),
        v.outside("outcome", ("F", "O", "P")), v.Field("text", "censure_without_text", (F.col("kind") == "1-URGENT") & F.col("text").isNull()),
    ])
    return v.errors(dim, "id", schema).unionByName(v.repeated(dim, "id"))


@query(
    """WITH d AS (SELECT CASE WHEN o_orderkey % 31 = 0 THEN 'x' || o_orderkey ELSE 'AMANR5L' || (14 + o_orderkey % 4) || 'N' || o_orderkey END AS id, 14 + o_custkey % 4 AS part, o_orderstatus AS outcome, CASE WHEN o_custkey % 2 = 0 THEN 'art. 40' END AS basis, o_orderkey % 8 AS n FROM orders)
 SELECT id AS key, 'id' AS path, 'malformed' AS rule, true AS blocking FROM d WHERE NOT regexp_matches(id, '^AMANR5L[0-9]+')
 UNION ALL SELECT id, 'id', 'wrong_part', true FROM d WHERE regexp_matches(id, '^AMANR5L[0-9]+') AND CAST(regexp_extract(id, '^AMANR5L([0-9]+)', 1) AS INTEGER) <> part
 UNION ALL SELECT id, 'basis', 'inadmissible_without_basis', true FROM d WHERE outcome = 'P' AND basis IS NULL UNION ALL SELECT id, 'cosigners', 'empty_list', true FROM d WHERE n = 0"""
)
def amendment_dimension_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amendment dimension and its cosigners: ids agree with the part that holds them, no empty list."""
    dim = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 31 == 0, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.concat(F.lit("AMANR5L"), 14 + F.col("o_orderkey") % 4, F.lit("N"), "o_orderkey")).alias("id"), (14 + F.col("o_custkey") % 4).alias("part"),
        F.col("o_orderstatus").alias("outcome"), F.when(F.col("o_custkey") % 2 == 0, "art. 40").alias("basis"), F.when(F.col("o_orderkey") % 8 == 0, F.array().cast("array<bigint>")).otherwise(F.array("o_custkey")).alias("cosigners"),
    )
    number = F.when(F.col("id").rlike("^AMANR5L[0-9]+"), F.regexp_extract("id", "^AMANR5L([0-9]+)", 1)).try_cast("int")
    schema = v.Schema("amendments", [
        v.unlike("id", "^AMANR5L[0-9]+"), v.Field("id", "wrong_part", number != F.col("part")),
        v.Field("basis", "inadmissible_without_basis", (F.col("outcome") == "P") & F.col("basis").isNull()), v.Field("cosigners", "empty_list", F.size("cosigners") == 0),
    ])
    return v.errors(dim, "id", schema)


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each nation: a group with its members, a portfolio and a status."""
    own = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_members"), F.collect_set("c_mktsegment").alias("segments"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    rows = table(spark, sf_dir, "nation").join(own, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 6 > 0, F.col("n_name")).alias("name"), F.when(F.col("n_nationkey") % 7 == 0, "v0").otherwise("v1").alias("schema_version"),
        F.coalesce("n_members", F.lit(0)).alias("n_members"), (F.col("n_nationkey") % 4 == 0).alias("forced"), F.when(F.col("n_nationkey") % 8 == 0, "rejected_49_3").otherwise("adopted").alias("status"),
        F.when(F.col("n_nationkey") % 3 == 0, "portfolio").alias("portfolio"), F.when(F.col("n_nationkey") % 9 > 0, F.lit("http://x.example/")).alias("url"),
        F.when(F.col("n_nationkey") % 5 == 0, F.array().cast("array<bigint>")).when(F.col("n_nationkey") % 5 == 1, F.array(F.col("n_nationkey").cast("long"))).alias("initiators"), "segments",
    )


@query(
    """WITH n AS (SELECT n_nationkey AS k, CAST(n_nationkey AS VARCHAR) AS key, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_members FROM nation)
 SELECT 'group' AS kind, key, 'name' AS path, 'missing' AS rule, true AS blocking FROM n WHERE k % 6 = 0 UNION ALL SELECT 'group', key, 'schema_version', 'outside_domain', true FROM n WHERE k % 7 = 0
 UNION ALL SELECT 'group', key, 'n_members', 'no_members', false FROM n WHERE n_members = 0
 UNION ALL SELECT 'government', key, 'forced', 'disagrees_with_status', true FROM n WHERE (k % 4 = 0) <> (k % 8 = 0) UNION ALL SELECT 'government', key, 'url', 'portfolio_without_url', true FROM n WHERE k % 3 = 0 AND k % 9 = 0
 UNION ALL SELECT 'government', key, 'initiators', 'empty_list', true FROM n WHERE k % 5 = 0
 UNION ALL SELECT 'party', key, 'name', 'missing', true FROM n WHERE k % 6 = 0 UNION ALL SELECT 'party', key, 'segments', 'missing', true FROM n WHERE n_members = 0
 UNION ALL SELECT 'initiators', key, 'initiators:' || k, 'unknown', true FROM n WHERE k % 5 = 1 AND k NOT IN (SELECT s_suppkey FROM supplier)"""
)
def group_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, government and party documents, each by its own rules; initiators must be members."""
    docs = groups(spark, sf_dir)
    schemas = [
        v.Schema("group", [*v.required("name"), v.outside("schema_version", ("v1",)), v.Field("n_members", "no_members", F.col("n_members") == 0, blocking=False)]),
        v.Schema("government", [
            v.Field("forced", "disagrees_with_status", F.col("forced") != (F.col("status") == "rejected_49_3")), v.Field("url", "portfolio_without_url", F.col("portfolio").isNotNull() & F.col("url").isNull()),
            v.Field("initiators", "empty_list", F.size("initiators") == 0),
        ]),
        v.Schema("party", v.required("name", "segments")),
    ]
    found = [v.errors(docs, "id", s).select(F.lit(s.name).alias("kind"), "key", "path", "rule", "blocking") for s in schemas]
    named = docs.select("id", F.explode("initiators").alias("who"))
    found.append(v.unknown(named, "id", "initiators", F.col("who"), table(spark, sf_dir, "supplier"), "s_suppkey").select(F.lit("initiators").alias("kind"), "key", "path", "rule", "blocking"))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


@query(
    """SELECT 'no_lang' AS what, count(*) AS n, min(doc_id) AS first FROM documents WHERE lang IS NULL OR doc_id % 10 = 1 UNION ALL SELECT 'no_source', count(*), min(doc_id) FROM documents WHERE source IS NULL OR doc_id % 7 = 2
 UNION ALL SELECT 'no_label', count(*), min(doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'label_without_document', count(*), min(doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 > 0)"""
)
def metadata_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents lack what, and whether an inventory and its documents agree, both ways."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels").select("doc_id")
    told = lambda rows, what: rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).select(F.lit(what).alias("what"), "n", "first")
    parts = [
        told(docs.where("lang is null or doc_id % 10 = 1"), "no_lang"), told(docs.where("source is null or doc_id % 7 = 2"), "no_source"),
        told(docs.join(labels.distinct(), "doc_id", "left_anti"), "no_label"), told(labels.join(docs.where("doc_id % 3 > 0").select("doc_id"), "doc_id", "left_anti"), "label_without_document"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ------------------------------------------------------------------------------------------------ sections of the gate


@query(
    """WITH w AS (SELECT 'orders' AS place, o_orderpriority || ': incomplete read at ' || o_orderstatus AS warning FROM orders WHERE o_orderkey % 7 = 0
   UNION ALL SELECT 'customers', c_mktsegment || ': incomplete read' FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'customers', c_mktsegment || ': fine' FROM customer WHERE c_custkey % 5 = 1)
 SELECT place, split_part(warning, ':', 1) AS endpoint, count(*) AS n, (SELECT count(*) FROM w WHERE contains(warning, 'incomplete read')) > 100 AS failed FROM w WHERE contains(warning, 'incomplete read') GROUP BY ALL"""
)
def gate_incomplete_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q01: warnings that tell of an incomplete read, by place and endpoint; the section fails above a threshold."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.lit("orders").alias("place"), F.concat("o_orderpriority", F.lit(": incomplete read at "), "o_orderstatus").alias("warning"))
    state = F.when(F.col("c_custkey") % 5 == 0, ": incomplete read").otherwise(": fine")
    customers = table(spark, sf_dir, "customer").where("c_custkey % 5 < 2").select(F.lit("customers").alias("place"), F.concat("c_mktsegment", state).alias("warning"))
    return gate.incomplete_reads(orders.union(customers), "incomplete read", 100)


@query(
    """WITH n AS (SELECT c_custkey, count(o_orderkey) AS n, count(o_orderkey) FILTER (o_orderstatus = 'F') AS n_primary FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 3 > 0 GROUP BY 1)
 SELECT c_custkey, n, n_primary, n < 5 AS few, c_custkey % 2 = 0 AND n_primary < 2 AS few_primary FROM n WHERE n < 5 OR (c_custkey % 2 = 0 AND n_primary < 2)"""
)
def gate_low_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q03, Q04: documents with few entries, and covered ones with few of the primary source; having none counts."""
    entries = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_primary"))
    docs = table(spark, sf_dir, "customer").select("c_custkey").join(entries, F.col("k") == F.col("c_custkey"), "left")
    return gate.low_counts(docs, "c_custkey", covered=F.col("c_custkey") % 2 == 0, least=5, least_primary=2)


@query(
    """WITH n AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderkey % 4 > 0) AS n_ids, bool_or(o_orderkey % 97 = 0) AS failed FROM orders GROUP BY 1)
 SELECT count(*) AS n_documents, count(*) FILTER (0 < n_ids AND n_ids < n) AS n_mixed, count(*) FILTER (n_ids = n) AS n_whole, count(*) FILTER (failed) AS n_failed, max(n_ids) = 0 AS none_at_all FROM n"""
)
def gate_id_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q05: whether entries carry ids: mixed documents, failed fetches, and the alarm that none does at all."""
    docs = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderkey") % 4 > 0).alias("n_ids"), F.bool_or(F.col("o_orderkey") % 97 == 0).alias("failed"))
    return gate.id_coverage(docs)


@query(
    """WITH r AS (SELECT year(o_orderdate) AS part, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'N' || o_orderkey ELSE 'AMANR5L' || o_orderkey END AS ref FROM orders)
 SELECT part, arg_min(ref, o_orderkey) AS first_ref, NOT starts_with(arg_min(ref, o_orderkey), 'AMANR5L') AS legacy FROM r GROUP BY part"""
)
def gate_key_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frozen part whose first reference has the old form of key is refused."""
    ref = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("N"), "o_orderkey")).otherwise(F.concat(F.lit("AMANR5L"), "o_orderkey"))
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("part"), "o_orderkey", ref.alias("ref"))
    return gate.key_format(rows, "part", "ref", "o_orderkey", "^AMANR5L")


_GROUP_STATES = """g AS (SELECT n_nationkey AS id, n_nationkey % 7 > 0 AS present, n_nationkey % 5 > 0 AS valid, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_expected,
   (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 3 > 0) AS n_members, CASE n_nationkey % 4 WHEN 0 THEN 0 ELSE 10 END AS n_texts, n_nationkey % 6 > 0 AS covered FROM nation)"""


def _group_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("e"), F.count_if(F.col("c_custkey") % 3 > 0).alias("m"))
    k = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").join(own, F.col("c_nationkey") == k, "left")
    zero = F.lit(0).cast("long")
    return rows.select(k.alias("id"), (k % 7 > 0).alias("present"), (k % 5 > 0).alias("valid"), F.coalesce("e", zero).alias("n_expected"), F.coalesce("m", zero).alias("n_members"), F.when(k % 4 == 0, 0).otherwise(10).alias("n_texts"), (k % 6 > 0).alias("covered"))


@query(
    f"""WITH {_GROUP_STATES} SELECT id, 'missing' AS what, true AS hard FROM g WHERE NOT present UNION ALL SELECT id, 'invalid', true FROM g WHERE present AND NOT valid
 UNION ALL SELECT id, 'few_members', false FROM g WHERE present AND n_members < 4 UNION ALL SELECT id, 'low_coverage', false FROM g WHERE present AND n_expected > 0 AND 100 * n_members < 65 * n_expected"""
)
def gate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q07: groups: missing and invalid ones are hard findings, absolute and relative coverage soft ones."""
    return gate.groups(_group_states(spark, sf_dir), least_members=4, least_percent=65)


@query(
    f"""WITH {_GROUP_STATES}, z AS (SELECT id, covered, n_texts, id % 3 AS period FROM g WHERE n_members > 0)
 SELECT period, count(*) FILTER (covered) AS n_covered, count(*) FILTER (covered AND n_texts = 0) AS n_zero, count(*) FILTER (NOT covered) AS n_outside,
 count(*) FILTER (covered) >= 2 AND bool_and(n_texts = 0) FILTER (covered) AS all_zero FROM z GROUP BY period"""
)
def gate_simultaneous_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q08: two covered documents or more of a period that all stand at zero are a hard finding; outside of what is
    covered zero is only told."""
    rows = _group_states(spark, sf_dir).where("n_members > 0").withColumn("period", F.col("id") % 3)
    return gate.simultaneous_zero(rows, "period")


@query("SELECT 'k' AS field, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) < 50 THEN 'low' ELSE 'high' END AS status, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'type', event_type, count(*) FROM events GROUP BY 2")
def gate_status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q09: how often each status stands in the maps of a status file."""
    low = F.when(F.get_json_object("props", "$.k").cast("long") < 50, "low").otherwise("high")
    files = table(spark, sf_dir, "events").select(F.create_map(F.lit("k"), low, F.lit("type"), F.col("event_type")).alias("statuses"))
    return gate.status_histogram(files, "statuses")


@query(
    f"""WITH {_GROUP_STATES}, s AS (SELECT 'missing' AS section, count(*) FILTER (NOT present) AS n, true AS hard FROM g UNION ALL SELECT 'invalid', count(*) FILTER (present AND NOT valid), true FROM g
   UNION ALL SELECT 'few_members', count(*) FILTER (present AND n_members < 4), false FROM g UNION ALL SELECT 'low_coverage', count(*) FILTER (present AND n_expected > 0 AND 100 * n_members < 65 * n_expected), false FROM g)
 SELECT count(*) FILTER (n > 0) AS n_sections, coalesce(sum(n) FILTER (hard), 0)::BIGINT AS n_hard, coalesce(sum(n) FILTER (NOT hard), 0)::BIGINT AS n_soft, bool_or(hard AND n > 0) AS failed FROM s"""
)
def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: the gate fails if any hard section has a finding; soft ones never block."""
    return gate.verdict(gate.groups(_group_states(spark, sf_dir), least_members=4, least_percent=65))


_PERSONS_SQL = """o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders),
 p AS (SELECT c_custkey AS key, c_mktsegment AS m, c_acctbal AS b, c_nationkey AS n, c_name AS name FROM customer),
 w AS (SELECT o_custkey AS key, 'votes[' || i || ']' AS path, o_orderpriority AS q, o_orderstatus AS s, 'an:' || year(o_orderdate) || ':' || o_orderkey AS ref, o_totalprice AS t FROM o)"""


@query(
    f"""WITH {_PERSONS_SQL}
 SELECT key, 'schema_version' AS path, 'version' AS rule FROM p WHERE b < 0 UNION ALL SELECT key, 'nom', 'empty' FROM p WHERE n = 3 UNION ALL SELECT key, 'chambre', 'outside_domain' FROM p WHERE m = 'BUILDING'
 UNION ALL SELECT key, 'chambre', 'disagrees' FROM p WHERE m IN ('BUILDING', 'MACHINERY') UNION ALL SELECT key, 'chambres', 'out_of_order' FROM p WHERE m = 'MACHINERY' UNION ALL SELECT key, 'tags_thematiques', 'not_a_list' FROM p WHERE n = 4
 UNION ALL SELECT key, 'sources', 'missing' FROM p WHERE n = 5 UNION ALL SELECT key, 'meta', 'not_an_object' FROM p WHERE n = 6 UNION ALL SELECT key, 'meta.warnings', 'not_a_list' FROM p WHERE n = 7 UNION ALL SELECT key, 'meta.provenance', 'outside_domain' FROM p WHERE n = 8
 UNION ALL SELECT key, path || '.position', 'outside_domain' FROM w WHERE s = 'P' UNION ALL SELECT key, path || '.scrutin_id', 'lost' FROM w WHERE q = '5-LOW' UNION ALL SELECT key, path || '.scrutin_id', 'malformed' FROM w WHERE q = '1-URGENT'
 UNION ALL SELECT key, path || '.scrutin_id', 'unknown' FROM w WHERE q NOT IN ('5-LOW', '1-URGENT') AND t <= 50000 UNION ALL SELECT key, path || '.position', 'forced_has_position' FROM w WHERE q = '2-HIGH' AND t > 300000 AND s <> 'O'"""
)
def document_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of a person's document, read as JSON of any form, once, its references resolved by one join."""
    urgent = F.when(F.col("o_orderpriority") == "5-LOW", None).when(F.col("o_orderpriority") == "1-URGENT", "x:1").otherwise(F.concat(F.lit("an:"), F.year("o_orderdate"), F.lit(":"), "o_orderkey"))
    position = F.when(F.col("o_orderstatus") == "F", "pour").when(F.col("o_orderstatus") == "P", "maybe")
    orders = table(spark, sf_dir, "orders").withColumns({"ref": urgent, "position": position})
    votes = orders.groupBy(F.col("o_custkey").alias("c")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.struct(F.col("ref").alias("scrutin_id"), "position").alias("v")))), lambda x: x["v"]).alias("votes"))
    n, m = F.col("c_nationkey"), F.col("c_mktsegment")
    version = F.when(F.col("c_acctbal") < 0, "2").otherwise("1")
    chambers = F.when(m == "MACHINERY", F.array(F.lit("Senat"), F.lit("AN"))).when(m == "BUILDING", F.array(F.lit("PE"))).otherwise(F.array(F.lit("AN")))
    meta = F.struct(F.lit("1").alias("schema_version"), F.lit("x").alias("genere_le"), F.lit("x").alias("licence_donnees"), F.when(n == 7, F.parse_json(F.lit('"x"'))).otherwise(F.parse_json(F.lit("[]"))).alias("warnings"), F.when(n == 8, "guess").otherwise("roster_groupe").alias("provenance"))
    empty = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "customer").join(votes, F.col("c") == F.col("c_custkey"), "left").select(
        F.col("c_custkey").alias("key"), version.alias("schema_version"), F.concat(F.lit("p"), "c_custkey").alias("id"), F.when(n == 3, "").otherwise(F.col("c_name")).alias("nom"), F.when(m == "BUILDING", "House").otherwise("AN").alias("chambre"), chambers.alias("chambres"),
        F.when(n == 4, F.parse_json(F.lit("{}"))).otherwise(F.parse_json(F.lit("[]"))).alias("tags_thematiques"), F.coalesce("votes", F.array().cast(votes.schema["votes"].dataType)).alias("votes"),
        *[empty.alias(c) for c in ("mandats", "textes_portes", "interventions", "amendements")], F.when(n == 6, F.parse_json(F.lit("[]"))).otherwise(F.parse_json(F.to_json(meta))).alias("meta"), empty.alias("sources"), n.alias("__n"),
    )
    # What a document is made of is few bytes, in as few tasks, and testing it is dear: it is dealt by number.
    dealt = max(4 * spark.sparkContext.defaultParallelism, table(spark, sf_dir, "customer").count() // 10_000)
    rows = rows.repartition(dealt, "key")
    parts = [c for c in rows.columns if c not in ("key", "sources", "__n")]
    # Null parts stay in the document, as null is not absence; one kind of document lacks its sources.
    text = F.when(F.col("key").isNotNull() & (F.col("__n") == 5), F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})).otherwise(F.to_json(F.struct(*parts, "sources"), {"ignoreNullFields": "false"}))
    docs = rows.where("key is not null").select("key", F.try_parse_json(text).alias("v"))
    outcome = F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_totalprice") > 300_000), pivot_rules.FORCED)
    ballots = orders.where("o_totalprice > 50000").select(F.concat(F.lit("an:"), F.year("o_orderdate"), F.lit(":"), "o_orderkey").alias("id"), outcome.alias("outcome"))
    return pivot_rules.findings(docs, "key", "v", {"votes": ballots})
