"""Pages made of the tables' rows, and what is read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.plans.registry import query, table
from lakemill.sources import pages


@query(
    """SELECT c_custkey // 40 AS page, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || ' ' || c_custkey ELSE c_name END AS name, false AS guess FROM customer WHERE c_acctbal >= 0 AND c_custkey // 40 % 4 > 0
 UNION ALL SELECT c_custkey // 40, c_mktsegment || ' ' || c_custkey, true FROM customer WHERE c_custkey // 40 % 4 = 0 AND c_acctbal < 5000"""
)
def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in lists beside the headings that announce them, by link or by text, and where a page has none, the
    links to articles as guesses. A page holds forty rows."""
    page, link = F.floor(F.col("c_custkey") / 40), F.concat("c_mktsegment", F.lit(" "), "c_custkey")
    text = F.concat(F.lit("<li>"), link, F.lit(", whose text goes on<ul><li>inside</li></ul></li>"))
    named = F.concat(F.lit("<li><a href='/x'>"), "c_name", F.lit("</a> (party)</li>"))
    item = F.when(F.col("c_custkey") % 3 == 0, text).otherwise(named)
    article = F.when(F.col("c_acctbal") < 5000, F.concat(F.lit("<p><a href='/wiki/x'>"), link, F.lit("</a>"))).otherwise(F.concat(F.lit("<p><a href='/wiki/File:x'>"), link, F.lit("</a>")))
    joined = lambda c: F.array_join(F.collect_list(c), "")
    rows = table(spark, sf_dir, "customer").groupBy(page.alias("page")).agg(joined(F.when(F.col("c_acctbal") >= 0, item)).alias("wanted"), joined(F.when(F.col("c_acctbal") < 0, item)).alias("others"), joined(article).alias("articles"))
    lists = F.concat(F.lit("<div><h2>Candidats d&eacute;clar&eacute;s</h2><p>intro</p><ul>"), "wanted", F.lit("<li>ab</li></ul><h3>Sources</h3><ul>"), "others", F.lit("</ul></div>"))
    html = F.when(F.col("page") % 4 == 0, F.concat(F.lit("<h2>Candidats</h2>"), "articles")).otherwise(lists)
    return rows.select("page", F.inline(pages.listed_names(html)))


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'President' WHEN length(c_name || c_mktsegment) % 2 = 0 OR c_nationkey % 5 > 0 THEN c_name || ' ' || c_mktsegment END AS speaker,
 CASE WHEN c_nationkey % 5 = 0 THEN '/president' WHEN c_nationkey % 5 = 1 THEN NULL ELSE '/p/' || c_custkey END AS address, 'Energie,' || lower(c_mktsegment) AS keywords FROM customer"""
)
def session_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who speaks at an anchor of a session's page, or first on the page if the anchor is not there, and the page's
    keywords."""
    own = F.concat(F.lit("<div class='x perso'>"), F.when(F.col("c_nationkey") % 5 == 1, F.lit("<b>")).otherwise(F.concat(F.lit("<a href='/p/"), "c_custkey", F.lit("'>"))), "c_name", F.lit("</a></b> "), "c_mktsegment", F.lit("</div>"))
    first = F.lit("<div class=intervention id=i1><div class=perso><a href='/president'>President</a></div></div>")
    cloud = F.concat(F.lit("<p class='nuage_de_tags'>Mots cl&eacute;s : Energie, les "), F.lower("c_mktsegment"), F.lit("</p>"))
    html = F.concat(F.lit("<html>"), first, F.lit("<div class='a intervention'><p><a name='here'></a>x</p>"), own, F.lit("</div>"), cloud)
    anchor = F.when(F.col("c_nationkey") % 5 == 0, "gone").otherwise("here")
    # A table of few bytes is read by few tasks, however many pages its rows become.
    rows = table(spark, sf_dir, "customer").repartition(spark.sparkContext.defaultParallelism, "c_custkey")
    found = rows.select("c_custkey", pages.session_facts(html, anchor).alias("f"))
    return found.select("c_custkey", "f.speaker", "f.address", F.array_join("f.keywords", ",").alias("keywords"))
