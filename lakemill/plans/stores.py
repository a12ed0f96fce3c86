"""Versioned tables: snapshots compared by digests, tables that change together, buckets refreshed, members looked up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import merge
from lakemill.operators.lineage import shared_folder
from lakemill.plans.registry import query, table
from lakemill.sources.store import Conflict, Store


@query(
    """WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_custkey % 9 > 0 OR o_orderpriority <> '1-URGENT'),
 b AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_custkey % 5 = 0 AND o_orderpriority = '1-URGENT' THEN round(o_totalprice / 2, 2) ELSE o_totalprice END AS o_totalprice FROM orders),
 j AS (SELECT b.*, a.o_orderstatus AS was, a.o_totalprice AS cost, a.o_orderkey IS NULL AS added FROM b LEFT JOIN a ON a.o_orderkey = b.o_orderkey)
 SELECT o_orderkey, '*' AS field, 'added' AS change, false AS blocking FROM j WHERE added
 UNION ALL SELECT o_orderkey, 'o_totalprice', CASE WHEN o_totalprice < cost THEN 'shrunk' ELSE 'grown' END, o_totalprice < cost FROM j WHERE NOT added AND o_totalprice <> cost
 UNION ALL SELECT o_orderkey, 'o_orderstatus', CASE WHEN o_orderstatus IS NULL THEN 'lost' ELSE 'changed' END, o_orderstatus IS NULL FROM j WHERE NOT added AND o_orderstatus IS DISTINCT FROM was"""
)
def versions_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table, compared in the buckets whose digests differ; the others are not read."""
    store = Store(spark, shared_folder(spark, "store"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    shown = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = rows.where((F.col("o_custkey") % 9 > 0) | ~urgent).select(*shown)
    price = F.when((F.col("o_custkey") % 5 == 0) & urgent, F.round(F.col("o_totalprice") / 2, 2)).otherwise(F.col("o_totalprice"))
    status = F.when(~((F.col("o_custkey") % 7 == 0) & urgent), F.col("o_orderstatus"))
    first = store.commit([store.stage("orders", old, ["o_orderkey"], 256)])
    second = store.commit([store.stage("orders", rows.withColumns({"o_totalprice": price, "o_orderstatus": status}).select(*shown), ["o_orderkey"], 256)])
    before, after = store.changed("orders", first, second)
    return merge.compared(before, after, ["o_orderkey"], ["o_totalprice"], ["o_orderstatus"]).select("o_orderkey", "field", "change", "blocking")


@query(
    """SELECT 'amendments' AS part, o_orderpriority AS meta, count(*) AS n FROM orders GROUP BY ALL
 UNION ALL SELECT 'cosigners', NULL, count(DISTINCT (l_orderkey, l_suppkey)) FROM lineitem
 UNION ALL SELECT 'refused', 'amendments is not written without cosigners', 1 UNION ALL SELECT 'versions', 'false', 1"""
)
def tables_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension and its companion that become visible together with their freshness mark. A write
    without the companion is refused, and one that ends between its tables leaves the state as it was."""
    store = Store(spark, shared_folder(spark, "store"))
    amendments = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    cosigners = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").distinct()
    needs = {"amendments": ["cosigners"]}
    store.commit([store.stage("amendments", amendments, ["o_orderkey"]), store.stage("cosigners", cosigners, ["o_orderkey"])], {"frozen": False, "success": True}, needs)
    refused = ""
    staged = store.stage("amendments", amendments.limit(0), ["o_orderkey"])  # the job ends here once ...
    try:
        store.commit([staged], needs=needs)  # ... and lacks the companion the next time
    except Conflict as e:
        refused = str(e)
    rows = store.read("amendments").groupBy(F.col("o_orderpriority").alias("meta")).agg(F.count("*").alias("n")).select(F.lit("amendments").alias("part"), "meta", "n")
    pairs = store.read("cosigners").agg(F.count("*").alias("n")).select(F.lit("cosigners").alias("part"), F.lit(None).cast("string").alias("meta"), "n")
    told = spark.createDataFrame([("refused", refused, 1), ("versions", str(store.meta()["frozen"]).lower(), len(store.versions()))], "part string, meta string, n long")
    return rows.union(pairs).union(told)


@query(
    """WITH e AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_id % 3 > 0 THEN value END AS value, CASE WHEN event_type = 'error' AND user_id % 50 = 3 THEN 1 ELSE 0 END AS batch FROM events),
 b AS (SELECT batch, user_id, event_type, arg_max({'value': value, 'ts': ts}, (ts, event_id)) AS r FROM e GROUP BY ALL), x AS (SELECT * FROM b WHERE batch = 0), y AS (SELECT * FROM b WHERE batch = 1)
 SELECT coalesce(y.user_id, x.user_id) AS user_id, coalesce(y.event_type, x.event_type) AS event_type, coalesce(y.r.value, x.r.value) AS value, coalesce(y.r.ts, x.r.ts) AS ts
 FROM x FULL JOIN y ON x.user_id = y.user_id AND x.event_type = y.event_type"""
)
def refreshed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored state of which a batch rewrites its own buckets only; a batch that comes twice counts once."""
    store = Store(spark, shared_folder(spark, "store"))
    keys = ["user_id", "event_type"]
    rows = table(spark, sf_dir, "events").select(*keys, F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("value"), "ts", "event_id")
    late = (F.col("event_type") == "error") & (F.col("user_id") % 50 == 3)
    newest = lambda df: df.groupBy(*keys).agg(F.max_by(F.struct("value", "ts"), F.struct("ts", "event_id")).alias("r")).select(*keys, "r.value", "r.ts")
    store.commit([store.stage("state", newest(rows.where(~late)), keys)])
    for _ in range(2):
        store.refresh("state", newest(rows.where(late)), lambda old, batch: merge.coalesce_upsert(old, batch, keys), 1)
    return store.read("state")


@query(
    """SELECT l_suppkey AS member, l_orderkey AS ballot, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10) GROUP BY ALL"""
)
def members_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the ten richest members out of a table bucketed and sorted by member: only the files of their
    buckets are opened. Ten is the query's own number, as of a look-up."""
    store = Store(spark, shared_folder(spark, "store"))
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("member"), F.col("l_orderkey").alias("ballot"))
    store.commit([store.stage("votes", votes, ["member"], 128)])
    wanted = [r[0] for r in table(spark, sf_dir, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(10).select("s_suppkey").collect()]
    return store.lookup("votes", wanted).groupBy("member", "ballot").agg(F.count("*").alias("n"))
