"""The roles of the operators, bound to the tables at hand; each binding has its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.plans.registry import table

#: Orders outside the ballot dimension, so that votes on them stay unresolved.
KNOWN = "o_orderkey % 11 <> 0"
POSITION = """CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'excused' WHEN l_linestatus = 'O' AND l_linenumber = 6 THEN 'nonvoting'
 WHEN l_linestatus = 'O' AND l_linenumber = 5 THEN NULL WHEN l_returnflag = 'A' THEN 'for' WHEN l_returnflag = 'N' THEN 'against' ELSE 'abstain' END"""
#: An order of line items that tells them apart.
ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")

VOTES_SQL = f"""lines AS (SELECT l_suppkey AS member, l_orderkey AS ballot, {POSITION} AS position,
   row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY {", ".join(f"{c} DESC" for c in ORDER)}) AS rn FROM lineitem),
 votes AS (SELECT member, ballot, position FROM lines WHERE rn = 1)"""
MEMBERS_SQL = "members AS (SELECT s_suppkey AS member, s_nationkey AS grp FROM supplier)"
BALLOTS_SQL = f"ballots AS (SELECT o_orderkey AS ballot, CAST(o_orderdate AS DATE) AS date FROM orders WHERE {KNOWN})"
SPANS_SQL = """years AS (SELECT l_suppkey AS member, year(l_shipdate) AS y, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last
   FROM lineitem WHERE year(l_shipdate) % 2 = l_suppkey % 2 GROUP BY 1, 2),
 spans AS (SELECT member, first, CASE WHEN y = max(y) OVER (PARTITION BY member) THEN NULL ELSE last END AS last FROM years)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("member"), F.col("s_nationkey").alias("grp"))


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(KNOWN).select(F.col("o_orderkey").alias("ballot"), F.col("o_orderdate").cast("date").alias("date"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_suppkey").alias("member"), F.col("l_orderkey").alias("ballot"), F.expr(POSITION).alias("position"), F.struct(*ORDER).alias("pos"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligibility: a member's odd or even years, from first to last shipment; the latest is still open."""
    from pyspark.sql import Window

    years = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("member"), F.year("l_shipdate").alias("y")).agg(F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last"))
    last = F.max("y").over(Window.partitionBy("member"))
    return years.where("y % 2 = member % 2").select("member", "first", F.when(F.col("y") != last, F.col("last")).alias("last"))


def snapshots(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """A previous and a new state of a table: either lacks some keys."""
    return df.where(f"{key} % 10 <> 3"), df.where(f"{key} % 10 <> 7")
