"""Audit statistics: histograms, fill rates, freshness, ranges, duplicates, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import dates
from lakemill.functions.values import byte_weight, filled_text, percent, rate
from lakemill.operators import integrity, selection, stats
from lakemill.plans.registry import query, table

_DOMAIN = ["BUILDING", "HOUSEHOLD", "MACHINERY", "UNSEEN"]
_DOMAIN_SQL = ", ".join(f"('{d}')" for d in [*_DOMAIN, "null", "other"])


@query(
    f"""WITH d(segment) AS (VALUES {_DOMAIN_SQL}), c AS (SELECT CASE WHEN c_custkey % 9 = 0 THEN 'null' WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN c_mktsegment ELSE 'other' END AS segment, count(*) AS n FROM customer GROUP BY 1)
 SELECT d.segment, coalesce(n, 0) AS n FROM d LEFT JOIN c USING (segment)"""
)
def closed_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over a closed domain with its empty buckets and null."""
    value = F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment"))
    return stats.histogram(table(spark, sf_dir, "customer"), value, _DOMAIN, "segment")


@query("SELECT l_suppkey AS member, count(l_quantity) AS n, min(l_quantity) AS least, max(l_quantity) AS most, median(l_quantity) AS median, round(avg(l_quantity), 2) AS mean FROM lineitem GROUP BY 1")
def volume_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least, most, median and mean of a group."""
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "member")
    return stats.described(rows, ["member"], F.col("l_quantity"))


@query("WITH r AS (SELECT p_brand AS brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part) SELECT brand, p_size AS upper_median, n FROM r WHERE i = n // 2")
def upper_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper of the two middle values."""
    return stats.upper_median(table(spark, sf_dir, "part").withColumnRenamed("p_brand", "brand"), ["brand"], "p_size")


@query(
    """WITH f AS (SELECT 'lang' AS field, count(*) FILTER (lang <> '') AS n_filled, count(*) AS n_total FROM documents
 UNION ALL SELECT 'text', count(*) FILTER (text <> ''), count(*) FROM documents UNION ALL SELECT 'long_text', count(*) FILTER (n_chars > 1000), count(*) FROM documents)
 SELECT field, n_filled, n_total, CASE WHEN n_total = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * n_filled / n_total, 2) END AS pct FROM f"""
)
def fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows have a field, and the percentage."""
    return stats.fill_rates(table(spark, sf_dir, "documents"), {"lang": filled_text(F.col("lang")), "text": filled_text(F.col("text")), "long_text": F.col("n_chars") > 1000})


@query(
    """WITH a AS (SELECT event_type, (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(ts)) // 86400000000 AS age FROM events)
 SELECT coalesce(event_type, 'null') AS type, count(*) AS n, min(age) AS least, max(age) AS most, median(age) AS median, round(avg(age), 2) AS mean FROM a GROUP BY 1"""
)
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The age in whole days of each kind of source at a reference date."""
    age = dates.age_days(F.col("ts"), F.lit("2024-02-01 12:00:00").cast("timestamp"))
    rows = table(spark, sf_dir, "events").select(F.coalesce("event_type", F.lit("null")).alias("type"), age.alias("age"))
    return stats.described(rows, ["type"], F.col("age"))


@query("SELECT user_id, event_type, min((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) // 86400000000) AS age FROM events GROUP BY ALL HAVING age > 3")
def stale_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose freshest source is older than a threshold."""
    age = dates.age_days(F.col("ts"), F.lit("2024-02-01").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min(age).alias("age")).where("age > 3")


@query("SELECT trim(split_part(o_orderpriority, '-', 1)) AS type, count(*) AS n, count(DISTINCT o_custkey) AS n_entities FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def warning_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings by the text before the first colon."""
    rows = table(spark, sf_dir, "orders").withColumn("warning", F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(":")))
    return stats.by_prefix(rows, F.col("warning"), "o_custkey")


@query("SELECT p_name AS key, count(*) AS n FROM part WHERE trim(p_name) <> '' GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once."""
    return stats.duplicates(table(spark, sf_dir, "part"), F.col("p_name"))


@query(
    """SELECT coalesce(o_orderpriority, 'total') AS kind, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_adopted, count(*) FILTER (o_orderstatus = 'O') AS n_rejected,
 round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS adoption FROM orders GROUP BY ROLLUP (o_orderpriority)"""
)
def amendment_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by kind of depositor and in total."""
    adopted, rejected = F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O")
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "kind")
    return stats.with_total(rows, "kind", [F.count("*").alias("n"), adopted.alias("n_adopted"), rejected.alias("n_rejected"), rate(adopted, F.count("*")).alias("adoption")])


@query(
    """SELECT coalesce(CAST(s_nationkey AS VARCHAR), 'total') AS grp, count(*) AS n_members, CAST(sum(n) AS BIGINT) AS n_votes, min(n) AS least, max(n) AS most, round(avg(n), 2) AS mean
 FROM (SELECT s_suppkey, s_nationkey, count(l_suppkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY ALL) GROUP BY ROLLUP (s_nationkey)"""
)
def cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-member sizes by group and over all."""
    sizes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("c"))
    rows = table(spark, sf_dir, "supplier").join(sizes, "s_suppkey", "left").select(F.col("s_nationkey").alias("grp"), F.coalesce("c", F.lit(0)).alias("n"))
    return stats.with_total(rows, "grp", [F.count("*").alias("n_members"), F.sum("n").alias("n_votes"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 2).alias("mean")])


@query(
    """WITH d AS (SELECT o_custkey AS entity, CASE WHEN o_orderkey % 13 = 0 THEN '2024-02' WHEN o_orderkey % 17 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders),
 p AS (SELECT entity, raw, CASE WHEN regexp_full_match(raw[1:10], '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(raw[1:10] AS DATE) END AS d FROM d)
 SELECT entity, min(d) AS first, max(d) AS last, count(*) FILTER (raw IS NOT NULL AND d IS NULL) AS n_invalid FROM p GROUP BY 1"""
)
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date range of an entity's activity; invalid dates are left out and counted."""
    raw = F.when(F.col("o_orderkey") % 13 == 0, "2024-02").when(F.col("o_orderkey") % 17 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), raw.alias("raw")).withColumn("d", dates.iso_date(F.col("raw")))
    return rows.groupBy("entity").agg(F.min("d").alias("first"), F.max("d").alias("last"), F.count_if(F.col("raw").isNotNull() & F.col("d").isNull()).alias("n_invalid"))


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'malformed' WHEN ts > TIMESTAMP '2024-01-25' THEN 'future' END AS error FROM events WHERE event_id % 7 = 0 OR ts > TIMESTAMP '2024-01-25'"""
)
def date_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps that are malformed or in the future of a reference."""
    raw = F.when(F.col("event_id") % 7 == 0, "not a date").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    rows = table(spark, sf_dir, "events").select("event_id", dates.date_error(raw, F.lit("2024-01-25").cast("timestamp")).alias("error"))
    return rows.where("error is not null")


@query(
    """SELECT n_nationkey AS grp, count(c_custkey) AS roster, count(c_custkey) FILTER (c_acctbal > 0) AS present, count(c_custkey) - count(c_custkey) FILTER (c_acctbal > 0) AS gap,
 CASE WHEN count(c_custkey) = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * count(c_custkey) FILTER (c_acctbal > 0) / count(c_custkey), 2) END AS coverage FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1"""
)
def roster_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a roster is there; an empty roster is 0 %."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    n, present = F.count("c_custkey"), F.count_if(F.col("c_acctbal") > 0)
    return rows.groupBy(F.col("n_nationkey").alias("grp")).agg(n.alias("roster"), present.alias("present"), (n - present).alias("gap"), percent(present, n).alias("coverage"))


@query(
    """SELECT p_partkey AS k, CASE WHEN p_size % 5 = 0 THEN 'undetermined' WHEN p_size > 30 THEN 'outside' WHEN p_size % 3 <> 0 AND p_size + 5 <= 30 THEN 'covered' ELSE 'partly' END AS status FROM part"""
)
def text_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a period is covered up to a bound."""
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), c)
    first, last = F.when(F.col("p_size") % 5 != 0, day(F.col("p_size"))), F.when(F.col("p_size") % 3 != 0, day(F.col("p_size") + 5))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), dates.coverage(first, last, day(F.lit(30))).alias("status"))


@query("SELECT doc_id, octet_length(encode(lang)) + 2 AS lang_bytes FROM documents WHERE lang IS NOT NULL")
def byte_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of a field as compact JSON."""
    inner = F.octet_length("lang") + 2
    rows = table(spark, sf_dir, "documents").where("lang is not null")
    whole = byte_weight(F.struct("lang"))
    return rows.select("doc_id", F.when(whole == inner + 9, inner).cast("long").alias("lang_bytes"))


_RULES = ["negative_balance", "no_segment", "odd_name"]


@query(
    """SELECT c_custkey AS key, 'negative_balance' AS rule, NULL AS value, true AS blocking FROM customer WHERE c_acctbal < 0
 UNION ALL SELECT c_custkey, 'odd_name', c_name, false FROM customer WHERE c_name LIKE '%7' UNION ALL SELECT c_custkey, 'no_segment', NULL, true FROM customer WHERE c_custkey % 50 = 0"""
)
def validation_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as data, one pass, one row for each finding."""
    return integrity.findings(table(spark, sf_dir, "customer"), "c_custkey", _customer_rules())


def _customer_rules() -> list[integrity.Rule]:
    none = F.lit(None).cast("string")
    return [
        integrity.Rule("negative_balance", F.col("c_acctbal") < 0, none),
        integrity.Rule("odd_name", F.endswith(F.col("c_name"), F.lit("7")), F.col("c_name"), blocking=False),
        integrity.Rule("no_segment", F.col("c_custkey") % 50 == 0, none),
    ]


@query(
    """WITH f AS (SELECT 'negative_balance' AS section, true AS b FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'odd_name', false FROM customer WHERE c_name LIKE '%7'
 UNION ALL SELECT 'no_segment', true FROM customer WHERE c_custkey % 50 = 0), s(section) AS (VALUES ('negative_balance'), ('no_segment'), ('odd_name'), ('silent'))
 SELECT section, count(b) FILTER (b) AS n_hard, count(b) FILTER (NOT b) AS n_soft, count(b) FILTER (b) > 0 AS failed FROM s LEFT JOIN f USING (section) GROUP BY section"""
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: hard and soft findings by section; soft ones never fail."""
    found = integrity.findings(table(spark, sf_dir, "customer"), "c_custkey", _customer_rules())
    return integrity.gate(found, [*_RULES, "silent"])


@query(
    """SELECT position, key, CASE WHEN key IS NOT NULL THEN 'orphan' WHEN told THEN 'declared_unresolved' ELSE 'missing_key' END AS motif, key IS NOT NULL OR NOT told AS blocking
 FROM (SELECT o_orderkey AS position, CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS key, o_orderkey % 2 = 0 AS told FROM orders) f
 WHERE key IS NULL OR key NOT IN (SELECT c_custkey FROM customer)"""
)
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without a row, each with its motif."""
    key = F.when(F.col("o_orderkey") % 19 == 0, None).when(F.col("o_orderkey") % 23 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    facts = table(spark, sf_dir, "orders").select(F.col("o_orderkey"), key.alias("ref"))
    return integrity.references(facts, table(spark, sf_dir, "customer"), "ref", "c_custkey", "o_orderkey", F.col("o_orderkey") % 2 == 0)


@query("SELECT doc_id, coalesce(source, '') AS root, CASE WHEN doc_id % 31 = 0 THEN NULL ELSE source END AS meta FROM documents WHERE source IS DISTINCT FROM CASE WHEN doc_id % 31 = 0 THEN NULL ELSE source END")
def version_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two places that should agree and do not; null differs from a value."""
    rows = table(spark, sf_dir, "documents").withColumn("meta", F.when(F.col("doc_id") % 31 != 0, F.col("source")))
    return rows.where(~F.col("source").eqNullSafe(F.col("meta"))).select("doc_id", F.coalesce("source", F.lit("")).alias("root"), "meta")


@query("WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS rank FROM customer) SELECT c_custkey, rank FROM r WHERE rank % 8 = 3")
def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eighth row of an order."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    ranks = selection.ranked(rows, [F.asc("c_mktsegment"), F.asc("c_custkey")], F.struct("c_mktsegment", F.floor(F.col("c_custkey") / 1000).alias("k")))
    return ranks.where("rank % 8 = 3").select("c_custkey", "rank")


@query("WITH r AS (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS rank, count(*) OVER () AS n FROM part) SELECT p_partkey, p_size FROM r WHERE rank IN (SELECT CAST(round_even(i * (n - 1) / 9.0, 0) AS BIGINT) FROM range(10) t(i))")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows at even ranks of the order of size."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return selection.systematic(rows, [F.asc("p_size"), F.asc("p_partkey")], F.col("p_size"), 10)


@query(
    """WITH s AS (SELECT c_custkey, o.k IS NULL AS uncovered, coalesce(o.last < TIMESTAMP '2000-01-01', false) AS stale FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderdate) AS last FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1) o ON k = c_custkey)
 SELECT c_custkey, CASE WHEN uncovered THEN 'uncovered' ELSE 'stale' END AS why FROM s WHERE uncovered OR stale ORDER BY why DESC, c_custkey LIMIT 1000"""
)
def budgeted_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget spent on what is not covered, then on what is stale."""
    covered = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"))
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    return selection.budgeted(rows, covered, "c_custkey", F.col("last") < F.lit("2000-01-01").cast("timestamp"), [F.asc("c_custkey")], 1000)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 12")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit in a total order."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(12)
