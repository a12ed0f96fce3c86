"""Debates and other XML documents, written from the tables into archives and read back as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.operators import nodes
from lakemill.plans.archives import written
from lakemill.plans.registry import query, table
from lakemill.sources import archives, debates

TURNS = "t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k FROM conversations)"


def escaped(text: Column) -> Column:
    """A text as XML has it."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def element(name: str, *inner: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return table(spark, sf_dir, "conversations").withColumn("k", F.row_number().over(order) - 1)


def _report_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as a report: two turns a point, a point inside each point, speakers and inner markup; in every third
    report two speakers share what the assistant says. A conversation with a system turn has a broken copy."""
    rows = _numbered(spark, sf_dir)
    one = element("orateur", element("id", F.lit("PA"), "conv_id"), element("nom", "role"))
    both = F.concat(one, element("orateur", element("id", F.lit("PA0")), element("nom", F.lit("other"))))
    speakers = F.when((F.col("conv_id") % 3 == 0) & (F.col("role") == "assistant"), both).when(F.col("role") == "system", F.lit("")).otherwise(one)
    said = F.concat(element("italique", "role"), F.lit(" :<br/>"), escaped(F.coalesce("text", F.lit(""))))
    paragraph = element("paragraphe", element("orateurs", speakers), element("texte", said))
    points = rows.groupBy("conv_id", F.floor(F.col("k") / 2).alias("point")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", paragraph.alias("p")))), lambda x: x["p"]), "").alias("ps"), F.max(F.col("role") == "system").alias("system"))
    title = F.when(F.col("point") == 0, element("titreStruct", element("intitule", F.lit("Questions au &lt;gouvernement&gt;")))).when(F.col("point") == 1, element("titreStruct", element("intitule", F.lit(" Projet de loi no "), "conv_id"))).otherwise(F.lit(""))
    deep = F.lit("<point><titreStruct><intitule>inside</intitule></titreStruct><paragraphe><texte>deep</texte></paragraphe></point>")
    point = element("point", title, "ps", deep)
    convs = points.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("point", point.alias("x")))), lambda x: x["x"]), "").alias("points"), F.max("system").alias("system"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 365).cast("int")), "yyyyMMdd")
    meta = element("metadonnees", element("dateSeance", day, F.lit("090000000")), element("legislature", F.lit("17")), element("etat", F.lit("complet")))
    head = F.concat(F.lit('<compteRendu xmlns="http://example.org/reports">'), element("uid", F.lit("CR"), "conv_id"), meta)
    opening = F.lit("<contenu><ouvertureSeance><paragraphe><texte>opened</texte></paragraphe></ouvertureSeance>")
    whole = F.concat(head, opening, "points", F.lit("</contenu></compteRendu>"))
    texts = F.array_compact(F.array(F.struct(F.lit("").alias("kind"), whole.alias("xml")), F.when(F.col("system"), F.struct(F.lit("broken_").alias("kind"), F.concat(head, opening).alias("xml")))))
    rows = convs.select("conv_id", F.explode(texts).alias("x"))
    return rows.select(F.lit("reports_17").alias("archive"), F.concat("x.kind", "conv_id", F.lit(".xml")).alias("entry"), F.col("x.xml").alias("content"))


@query(
    rf"""WITH {TURNS}, p AS (SELECT *, replace(replace(replace(role || ' : ' || coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS said FROM t)
 SELECT 'CR' || conv_id AS uid, strftime(DATE '2024-01-01' + (conv_id % 365)::INTEGER, '%Y-%m-%d') AS date, k // 2 AS point, k % 2 AS paragraph,
 CASE k // 2 WHEN 0 THEN 'Questions au <gouvernement>' WHEN 1 THEN 'Projet de loi no ' || conv_id END AS title, CASE k // 2 WHEN 0 THEN 'question_gouvernement' WHEN 1 THEN 'loi' ELSE 'debat' END AS kind,
 CASE WHEN role = 'system' OR (conv_id % 3 = 0 AND role = 'assistant') THEN NULL ELSE 'PA' || conv_id END AS speaker,
 CASE WHEN role = 'system' OR (conv_id % 3 = 0 AND role = 'assistant') THEN NULL ELSE role END AS speaker_name, trim(regexp_replace(said, '\s+', ' ', 'g')) AS text,
 CASE WHEN len(string_split(trim(regexp_replace(said, '\s+', ' ', 'g')), ' ')) < 50 THEN 'reaction_courte' ELSE 'prise_de_parole_developpee' END AS format FROM p
 UNION ALL SELECT 'broken', NULL, count(DISTINCT conv_id), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM conversations WHERE role = 'system'"""
)
def debate_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of agenda points with their session, title and place; those of points inside points are left out,
    a paragraph of several speakers is nobody's, broken reports are counted."""
    entries = archives.zip_entries(spark, written(spark, _report_entries(spark, sf_dir), "reports"), entry_suffix=".xml")
    found, broken = debates.reports(entries.select(F.col("entry").alias("name"), F.col("content").cast("string").alias("xml")))
    rows = debates.interventions(found).select("uid", "date", F.col("point").cast("long").alias("point"), F.col("paragraph").cast("long").alias("paragraph"), "title", "kind", "speaker", "speaker_name", "text", "format")
    count = broken.agg(F.count("*").alias("point")).select(*[F.lit("broken").alias(c) if c == "uid" else F.col(c) if c == "point" else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    return rows.union(count)


@query(
    f"""WITH {TURNS}, n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1)
 SELECT conv_id, 'talk.id' AS path, '' AS places, lpad(conv_id::VARCHAR, 6, '0') AS value FROM n
 UNION ALL SELECT conv_id, 'talk.turn.role', CASE WHEN n > 1 THEN k::VARCHAR ELSE '' END, role FROM t JOIN n USING (conv_id)
 UNION ALL SELECT conv_id, 'talk.turn.words.n', CASE WHEN n > 1 THEN k::VARCHAR ELSE '' END, length(text)::VARCHAR FROM t JOIN n USING (conv_id) WHERE text <> ''
 UNION ALL SELECT conv_id, 'talk.turn.words', CASE WHEN n > 1 THEN k::VARCHAR ELSE '' END, NULL FROM t JOIN n USING (conv_id) WHERE coalesce(text, '') = ''"""
)
def xml_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML of no known schema as nested values, siblings of one name in a list, and every leaf with its path."""
    words = F.when(F.col("text") != "", element("words", element("n", F.length("text")))).otherwise("<words/>")
    turn = element("turn", element("role", F.lit(" "), "role", F.lit("\n")), words)
    rows = _numbered(spark, sf_dir).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", turn.alias("x")))), lambda x: x["x"]), "").alias("turns"))
    xml = F.concat(F.lit("<talk kind='x'>"), element("id", F.lpad(F.col("conv_id").cast("string"), 6, "0")), "turns", F.lit("</talk>"))
    return nodes.paths(rows.select("conv_id", nodes.xml_nodes(xml).alias("v")), ["conv_id"], "v")
