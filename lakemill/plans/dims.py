"""Dimensions factored out of facts, merges and differences of states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.values import joined_key, key_part
from lakemill.operators import dedupe, merge
from lakemill.plans.bindings import ORDER, snapshots
from lakemill.plans.registry import query, table

_POS = "l_orderkey, " + ", ".join(ORDER)


def _position() -> F.Column:
    return F.struct("l_orderkey", *ORDER)


@query(
    f"""WITH r AS (SELECT l_partkey AS part, l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS flag,
   CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax, row_number() OVER (ORDER BY {_POS}) AS pos FROM lineitem)
 SELECT part, arg_min(flag, pos) FILTER (flag IS NOT NULL) AS flag, arg_min(tax, pos) FILTER (tax IS NOT NULL) AS tax, arg_min(l_suppkey, pos) AS supplier FROM r GROUP BY part"""
)
def ballot_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each key, each field from the first row that has it."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_returnflag")).alias("flag"), F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax"), _position().alias("pos"))
    return dedupe.field_wise(rows, ["part"], ["flag", "tax", "supplier"], F.col("pos"))


@query(
    f"""WITH r AS (SELECT l_partkey AS part, l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS flag,
   CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax, row_number() OVER (ORDER BY {_POS}) AS pos FROM lineitem)
 SELECT part, arg_max(flag, pos) FILTER (flag IS NOT NULL) AS flag, arg_max(tax, pos) FILTER (tax IS NOT NULL) AS tax, arg_max(l_suppkey, pos) AS supplier FROM r GROUP BY part"""
)
def amendment_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ballot_dimension(), each field from the last row that has it."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_returnflag")).alias("flag"), F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax"), _position().alias("pos"))
    return dedupe.field_wise(rows, ["part"], ["flag", "tax", "supplier"], F.col("pos"), last=True)


@query(
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {_POS}) AS rn FROM lineitem)
 SELECT l_partkey AS part, l_suppkey AS supplier, l_orderkey AS first_order, l_shipdate AS shipped FROM r WHERE rn = 1"""
)
def keep_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key in a total order."""
    first = dedupe.keep_one(table(spark, sf_dir, "lineitem"), ["l_partkey"], [F.col("l_orderkey"), *[F.col(c) for c in ORDER]])
    return first.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_orderkey").alias("first_order"), F.col("l_shipdate").alias("shipped"))


@query(
    """WITH r AS (SELECT o_custkey AS customer, o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS ended,
   row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'O') DESC, o_orderdate DESC, o_orderkey) AS rn FROM orders)
 SELECT customer, o_orderkey AS current_order, o_orderdate AS since, ended FROM r WHERE rn = 1"""
)
def current_mandate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open entry first, then the latest start, then the first by key."""
    rows = table(spark, sf_dir, "orders").withColumn("open", F.col("o_orderstatus") == "O")
    best = dedupe.keep_one(rows, ["o_custkey"], [F.desc("open"), F.desc("o_orderdate"), F.asc("o_orderkey")])
    return best.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("current_order"), F.col("o_orderdate").alias("since"), F.when(~F.col("open"), F.col("o_orderdate")).alias("ended"))


@query(
    """SELECT p_name AS name, min(CASE p_type WHEN 'PROMO' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'ECONOMY' THEN 3 ELSE 4 END) AS best, min(p_size) AS first, max(p_size) AS last,
 bool_or(p_retailprice > 950) AS active FROM part GROUP BY p_name"""
)
def responsibilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By label the best role of a list of priority, earliest start, latest end, whether any is active."""
    rank = dedupe.best_role(F.col("p_type"), ["PROMO", "STANDARD", "ECONOMY"])
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min(rank).cast("int").alias("best"), F.min("p_size").alias("first"), F.max("p_size").alias("last"), F.bool_or(F.col("p_retailprice") > 950).alias("active"))


@query(
    """WITH n AS (SELECT lower(replace(p_name, ' ', '-')) AS name, p_brand FROM part),
 k AS (SELECT name, min(p_brand) AS brand FROM n GROUP BY name HAVING count(DISTINCT p_brand) = 1)
 SELECT p_partkey AS part, k.brand FROM part LEFT JOIN k ON k.name = lower(replace(p_name, ' ', '-'))"""
)
def unambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that stands for several values resolves to none."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.lower(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))).alias("name"))
    return rows.join(dedupe.unambiguous(rows, "name", "p_brand").withColumnRenamed("p_brand", "brand"), "name", "left").select(F.col("p_partkey").alias("part"), "brand")


@query(
    """WITH labels AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) END AS label, CAST(o_orderdate AS DATE) AS d FROM orders),
 a AS (SELECT k, count(DISTINCT label) AS n, min(label) AS label, min(d) AS d FROM labels GROUP BY k)
 SELECT k, CASE WHEN n = 1 AND label BETWEEN '1996' AND '2000' THEN label WHEN n = 0 THEN CASE WHEN d >= DATE '1995-01-01' AND d <= DATE '1996-06-30' THEN 'early' WHEN d >= DATE '1996-09-01' THEN 'late' END END AS resolved,
   CASE WHEN n > 1 THEN 'contradiction' WHEN n = 1 AND label NOT BETWEEN '1996' AND '2000' THEN 'unknown_label' WHEN n = 1 THEN 'collected'
        WHEN d <= DATE '1996-06-30' OR d >= DATE '1996-09-01' THEN 'calendar' ELSE 'outside' END AS origin FROM a"""
)
def label_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One known label, else the calendar, else the reason why not."""
    from lakemill.functions.dates import calendar_label

    label = F.when(F.col("o_orderkey") % 4 == 0, F.year("o_orderdate").cast("string"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), label.alias("label"), F.col("o_orderdate").cast("date").alias("d"))
    found = rows.groupBy("k").agg(F.countDistinct("label").alias("n"), F.min("label").alias("label"), F.min("d").alias("d"))
    known = F.col("label").between("1996", "2000")
    calendar = calendar_label(F.col("d"), [("early", "1995-01-01", "1996-06-30"), ("late", "1996-09-01", None)])
    return found.select(
        "k", F.when((F.col("n") == 1) & known, F.col("label")).when(F.col("n") == 0, calendar).alias("resolved"),
        F.when(F.col("n") > 1, "contradiction").when((F.col("n") == 1) & ~known, "unknown_label").when(F.col("n") == 1, "collected").when(calendar.isNotNull(), "calendar").otherwise("outside").alias("origin"),
    )


@query(
    """SELECT o_orderkey AS k, 'an:' || year(o_orderdate) || ':' || o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS part_1, CAST(o_orderkey AS VARCHAR) AS part_2,
 CAST(NULL AS VARCHAR) AS other FROM orders"""
)
def key_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys put together and taken apart; malformed keys give null."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), joined_key(F.year("o_orderdate"), F.col("o_orderkey"), prefix="an").alias("id"))
    return rows.select("k", "id", key_part(F.col("id"), 1, 2, "an").alias("part_1"), key_part(F.col("id"), 2, 2, "an").alias("part_2"), key_part(F.col("id"), 1, 3, "an").alias("other"))


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    old, new = snapshots(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), "c_custkey")
    bal = F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 1).when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    segment = F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment"))
    return old.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))), new.withColumns({"c_acctbal": bal, "c_mktsegment": segment})


_STATES = """WITH o AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 10 <> 3),
 n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
   CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 10 <> 7)"""


@query(_STATES + " SELECT * FROM o UNION ALL SELECT * FROM n WHERE c_custkey NOT IN (SELECT c_custkey FROM o)")
def merge_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All old rows, then new rows with unseen keys."""
    old, new = _states(spark, sf_dir)
    return merge.additive_union(old, new, ["c_custkey"], [F.col("c_acctbal"), F.col("c_mktsegment")])


@query(_STATES + " SELECT * FROM n UNION ALL SELECT * FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n)")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each key."""
    old, new = _states(spark, sf_dir)
    return merge.upsert(old, new, ["c_custkey"], [F.col("c_acctbal"), F.col("c_mktsegment")])


@query(_STATES + " SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def merge_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New values win, null takes nothing away."""
    old, new = _states(spark, sf_dir)
    return merge.coalesce_upsert(old, new, ["c_custkey"])


@query(_STATES + " SELECT CASE WHEN coalesce(n.c_acctbal, -1e18) > coalesce(o.c_acctbal, -1e18) OR o.c_custkey IS NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal, CASE WHEN coalesce(n.c_acctbal, -1e18) > coalesce(o.c_acctbal, -1e18) OR o.c_custkey IS NULL THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment, coalesce(n.c_custkey, o.c_custkey) AS c_custkey FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each key the row with the greatest stamp, the old one in a tie."""
    old, new = _states(spark, sf_dir)
    return merge.latest(old, new, ["c_custkey"], "c_acctbal", [F.col("c_mktsegment")])


@query(_STATES + " SELECT o.c_custkey, o.c_acctbal, coalesce(o.c_mktsegment, n.c_mktsegment) AS c_mktsegment FROM o LEFT JOIN n ON o.c_custkey = n.c_custkey")
def merge_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing field of an old row is filled from the new row of its key."""
    old, new = _states(spark, sf_dir)
    return merge.backfill(old, new, ["c_custkey"], "c_mktsegment", [F.col("c_acctbal")])


@query(
    _STATES
    + """, j AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_custkey IS NULL AS added, n.c_custkey IS NULL AS gone, o.c_acctbal AS ob, n.c_acctbal AS nb, o.c_mktsegment AS os, n.c_mktsegment AS ns FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
 SELECT c_custkey, '*' AS field, CASE WHEN gone THEN 'gone' ELSE 'added' END AS change, gone AS blocking FROM j WHERE gone OR added
 UNION ALL SELECT c_custkey, 'c_acctbal', CASE WHEN nb < ob THEN 'shrunk' ELSE 'grown' END, nb < ob FROM j WHERE NOT gone AND NOT added AND nb <> ob
 UNION ALL SELECT c_custkey, 'c_mktsegment', CASE WHEN os IS NOT NULL AND ns IS NULL THEN 'lost' ELSE 'changed' END, os IS NOT NULL AND ns IS NULL FROM j WHERE NOT gone AND NOT added AND os IS DISTINCT FROM ns"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two states and whether it blocks."""
    old, new = _states(spark, sf_dir)
    return merge.compared(old, new, ["c_custkey"], ["c_acctbal"], ["c_mktsegment"]).select("c_custkey", "field", "change", "blocking")


@query(_STATES + " SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN 'missing' WHEN o.c_custkey IS NULL THEN 'unexpected' ELSE 'both' END AS status FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def presence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys expected and found."""
    return merge.classified(*_states(spark, sf_dir), "c_custkey")


@query(
    _STATES
    + """ SELECT n.c_custkey, o.c_custkey IS NOT NULL AND o.c_acctbal IS NOT DISTINCT FROM n.c_acctbal AND o.c_mktsegment IS NOT DISTINCT FROM n.c_mktsegment AS unchanged
 FROM n LEFT JOIN o ON o.c_custkey = n.c_custkey"""
)
def stable_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose content has not changed keep their old stamp; content is compared by its fingerprint."""
    old, new = _states(spark, sf_dir)
    prints = old.select("c_custkey", merge.fingerprint("c_acctbal", "c_mktsegment").alias("was"))
    now = new.select("c_custkey", merge.fingerprint("c_acctbal", "c_mktsegment").alias("now"))
    return now.join(prints, "c_custkey", "left").select("c_custkey", F.coalesce(F.col("was") == F.col("now"), F.lit(False)).alias("unchanged"))
