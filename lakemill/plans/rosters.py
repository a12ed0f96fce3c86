"""Rosters, presence and links, bound to the tables at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import rosters
from lakemill.plans import bindings as b
from lakemill.plans.registry import query, table


@query(
    """SELECT c_mktsegment AS party, c_custkey AS candidate, o.k IS NOT NULL AS present, CASE WHEN o.k IS NULL THEN 'no document: ' || c_name END AS warning
 FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 250000) o ON k = c_custkey"""
)
def party_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared candidates of each party, whether each has a document, and a warning for each who has none."""
    documents = table(spark, sf_dir, "orders").where("o_orderstatus = 'P' and o_totalprice > 250000").select(F.col("o_custkey").alias("candidate"))
    listed = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("party"), F.col("c_custkey").alias("candidate"), "c_name")
    return rosters.with_presence(listed, documents, "candidate", F.col("c_name")).drop("c_name")


@query(
    f"""SELECT l_suppkey AS member, l_orderkey AS ballot, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS outcome, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {b.KNOWN} GROUP BY ALL"""
)
def expanded_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of members with the fields of what they link to, the inverse of storing it once; links to nothing go."""
    links = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("member"), F.col("l_orderkey").alias("ballot")).agg(F.count("*").alias("n"))
    dim = table(spark, sf_dir, "orders").where(b.KNOWN).select(F.col("o_orderkey").alias("ballot"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderstatus").alias("outcome"))
    return rosters.expanded(links, dim, "ballot")


_ROSTER = """r AS (SELECT s_nationkey AS grp, s_suppkey AS member FROM supplier WHERE s_acctbal > 0), d AS (SELECT DISTINCT l_suppkey AS member FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 1),
 v AS (SELECT s_nationkey AS grp, s_suppkey AS member FROM supplier WHERE s_acctbal < 2000),
 g AS (SELECT n_nationkey AS grp, r.member, CASE WHEN r.member IS NULL THEN 'no_roster' WHEN d.member IS NOT NULL THEN 'member' ELSE 'missing' END AS state FROM nation LEFT JOIN r ON grp = n_nationkey LEFT JOIN d ON d.member = r.member
   UNION ALL SELECT grp, member, 'recovered' FROM v WHERE member IN (SELECT member FROM d) AND member NOT IN (SELECT member FROM r))"""


def _rostered(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("grp"), F.col("s_suppkey").alias("member"), "s_acctbal")
    documents = table(spark, sf_dir, "lineitem").where("l_quantity = 50 and l_linenumber = 1").select(F.col("l_suppkey").alias("member"))
    config = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("grp"))
    return rosters.rostered(config, suppliers.where("s_acctbal > 0"), documents, suppliers.where("s_acctbal < 2000"))


@query(f"WITH {_ROSTER} SELECT * FROM g")
def group_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group's roster with who has a document, who is missing, and who is recovered from the previous output."""
    return _rostered(spark, sf_dir)


@query(
    f"""WITH {_ROSTER} SELECT grp, count(*) FILTER (state IN ('member', 'missing')) AS n_roster, count(*) FILTER (state = 'member') AS n_found, count(*) FILTER (state = 'recovered') AS n_recovered,
 round(count(*) FILTER (state = 'member') / nullif(count(*) FILTER (state IN ('member', 'missing')), 0), 4) AS covered FROM g GROUP BY grp"""
)
def group_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each group's roster is covered; null where there is no roster."""
    return rosters.coverage(_rostered(spark, sf_dir))
