"""Whole documents bound to the tables at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import templates as t
from lakemill.plans.registry import query, table

_META = '"meta":{"schema_version":"1","genere_le":"2024-01-01","licence_donnees":""'
_PERIOD = '"periode":{"debut":null,"fin":null,"actif":true}'
_COUNTS = '"nb_amendements":0,"nb_adoptes":0,"nb_rejetes":0,"nb_irrecevables":0,"nb_retires_ou_tombes":0,"taux_adoption":null'
_BY_KIND = ",".join(f'"{d}":{{{_COUNTS}}}' for d in t.DEPOSITORS)
_STATUSES = ",".join(f'"{s}":0' for s in t.TEXT_STATUSES)


@query(
    f"""SELECT 'person' AS kind, s_suppkey AS key, '{{"schema_version":"1","id":"p' || s_suppkey || '","nom":"' || s_name || '","chambres":[],"chambre":null,"parti":null,"groupe":null,"identite":null,"sources":[],"mandats":[],"votes":[],"textes_portes":[],"interventions":[],"amendements":[],"tags_thematiques":[],{_META},"warnings":[],"provenance":"roster_groupe"}}}}' AS doc FROM supplier
 UNION ALL SELECT 'group', n_nationkey, '{{"schema_version":"1","type_document":"profil_groupe","groupe_id":"g' || n_nationkey || '","groupe_sigle":"' || n_name[1] || '","groupe_nom":"' || n_name || '","chambre":' || CASE WHEN n_regionkey = 0 THEN 'null' ELSE '"AN"' END || ',"legislature":"17",{_PERIOD},"historique_noms":[],"membres":[],"effectif":{{"actuel":0,"min_historique":null,"max_historique":null}},"cohesion_votes":[],"tags_thematiques_agreges":[],"mandats_agreges":[],"amendements_agreges":{{{_COUNTS},"par_type_deposant":{{{_BY_KIND}}}}},"sources":[],{_META},"profils_sources":[],"seuil_quorum":0.5,"warnings":[]}}}}' FROM nation
 UNION ALL SELECT 'government', r_regionkey, '{{"schema_version":"1","type_document":"profil_gouvernement","gouvernement_id":"v' || r_regionkey || '","nom":"' || r_name || '","premier_ministre":null,{_PERIOD},"membres":[],"textes":[],"comptages":{{"par_statut":{{{_STATUSES}}}}},"sources":[],{_META},"warnings":[]}}}}' FROM region
 UNION ALL SELECT 'party', p_partkey, '{{"schema_version":"1","type_document":"profil_parti","parti_id":"q' || p_partkey || '","parti_nom":"' || p_name || '","candidats":[],"tags_thematiques_agreges":[],"sources":[],{_META},"nb_candidats_declares":0,"nb_candidats_avec_pivot":0,"warnings":[]}}}}' FROM part"""
)
def empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which only the name is known, of all four kinds, null and empty lists as their kind has them."""
    stamp = F.lit("2024-01-01")
    named = lambda mark, key: F.concat(F.lit(mark), key)
    shown = lambda df, kind, key, doc: df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("key"), F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))
    chamber = F.when(F.col("n_regionkey") != 0, "AN")
    return (
        shown(table(spark, sf_dir, "supplier"), "person", "s_suppkey", t.empty_person(named("p", "s_suppkey"), F.col("s_name"), F.lit("roster_groupe"), stamp))
        .union(shown(table(spark, sf_dir, "nation"), "group", "n_nationkey", t.empty_group(named("g", "n_nationkey"), F.substring("n_name", 1, 1), F.col("n_name"), chamber, F.lit("17"), stamp)))
        .union(shown(table(spark, sf_dir, "region"), "government", "r_regionkey", t.empty_government(named("v", "r_regionkey"), F.col("r_name"), stamp)))
        .union(shown(table(spark, sf_dir, "part"), "party", "p_partkey", t.empty_party(named("q", "p_partkey"), F.col("p_name"), stamp)))
    )


@query(
    """WITH o AS (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus = 'F') AS n_an, count(*) FILTER (o_orderstatus = 'O') AS n_senate, count(*) FILTER (o_orderstatus = 'P') AS n_none,
   list_sort(list_distinct(list(lower(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'Theme ' || (o_custkey % 3) END)))) AS tags FROM orders GROUP BY 1),
 c AS (SELECT c_custkey, 'person-' || lower(c_mktsegment) AS slug, CASE WHEN c_nationkey % 4 > 0 THEN c_name END AS name, c_nationkey % 3 AS how, c_mktsegment AS m, c_acctbal, coalesce(n_an, 0) AS n_an, coalesce(n_senate, 0) AS n_senate, coalesce(n_none, 0) AS n_none, coalesce(tags, []) AS tags FROM customer LEFT JOIN o ON k = c_custkey),
 d AS (SELECT *, CASE WHEN n_an > 0 OR m = 'BUILDING' THEN ['AN'] ELSE [] END || CASE WHEN n_senate > 0 OR m = 'MACHINERY' THEN ['Senat'] ELSE [] END AS chambers,
   CASE WHEN n_an = 0 AND m = 'BUILDING' THEN ['AN'] ELSE [] END || CASE WHEN n_senate = 0 AND m = 'MACHINERY' THEN ['Senat'] ELSE [] END AS unsupported,
   CASE how WHEN 0 THEN 'made' WHEN 1 THEN NULL ELSE 'day' END AS synced FROM c)
 SELECT c_custkey, coalesce(name, 'Person ' || upper(slug[8]) || slug[9:]) AS name, CASE m WHEN 'MACHINERY' THEN 'second' ELSE 'main' END || '|base/' || slug || '|' || coalesce(synced, '') ||
   CASE WHEN how = 2 THEN ';assemblee_nationale|official|' || 'other' WHEN how = 0 THEN ';assemblee_nationale|official|made' ELSE '' END AS sources, c_acctbal >= 0 AS identified,
 array_to_string(chambers, '+') AS chambers, chambers[1] AS chamber, array_to_string(tags, ',') AS tags,
 array_to_string(['old'] || CASE WHEN how < 2 THEN ['never synced: main'] ELSE [] END || CASE WHEN n_none > 0 THEN ['elective mandates without chamber: ' || n_none] ELSE [] END
   || CASE WHEN len(chambers) = 0 OR len(unsupported) > 0 OR n_none > 0 THEN ['chambers not borne out: ' || array_to_string(chambers, '+') || ', of these ' || coalesce(nullif(array_to_string(unsupported, '+'), ''), 'none')] ELSE [] END, '; ') AS warnings FROM d"""
)
def full_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A person's whole document from a raw record: name, sources and when they were synced, identity, chambers
    and whether mandates bear them out, tags, and the warnings that all this gives."""
    chamber = F.when(F.col("o_orderstatus") == "F", "AN").when(F.col("o_orderstatus") == "O", "Senat")
    mandate = F.struct(F.lit("mandat_electif").alias("category"), chamber.alias("chamber"))
    said = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Theme "), F.col("o_custkey") % 3)).alias("theme"),
        F.when(F.col("o_orderstatus") == "P", F.array(F.concat(F.lit(" "), "o_orderpriority"), F.lit(""), F.lit(None).cast("string"))).otherwise(F.array(F.lit("unused"))).alias("keywords"),
    )
    own = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list(mandate).alias("mandates"), F.collect_list(said).alias("interventions"))
    how, m = F.col("c_nationkey") % 3, F.col("c_mktsegment")
    text = lambda value: F.lit(value).cast("string")
    synced = F.when(how == 1, F.create_map(F.lit("main"), text(None))).when(how == 2, F.create_map(F.lit("main"), F.lit("day"), F.lit("assemblee_nationale"), F.lit("other"))).otherwise(F.create_map().cast("map<string,string>"))
    raw = table(spark, sf_dir, "customer").join(own, F.col("k") == F.col("c_custkey"), "left").select(
        "c_custkey", F.concat(F.lit("person-"), F.lower("c_mktsegment")).alias("slug"), F.when(F.col("c_nationkey") % 4 > 0, F.col("c_name")).alias("name"), text(None).alias("party"), F.lit("roster_groupe").alias("provenance"),
        F.when(m == "BUILDING", "first").when(m == "MACHINERY", "second").alias("chamber"), F.lit("").alias("group_name"), F.lit("G").alias("group_short"), F.lit(" ").alias("source"), F.when(how != 1, "http://Assemblee-Nationale/x").alias("votes_source"),
        synced.alias("synced"), F.lit("made").alias("made_at"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("profession"), *[text(v).alias(c) for c, v in (("birth_date", None), ("birth_place", ""), ("constituency", None), ("declaration", None), ("official_url", "u"), ("licence", None))],
        "mandates", "interventions", F.array(F.lit("old")).alias("warnings"),
    )
    kept = raw.withColumn("slug", F.concat("slug", F.lit("~"), "c_custkey"))
    docs = t.person_documents(kept, {"first": "main", "second": "second"}, {"first": "AN", "second": "Senat"}, "main", "official", "assemblee-nationale", "base/")
    plain = lambda c: F.regexp_replace(c, "~[0-9]+", "")
    sources = F.array_join(F.transform("sources", lambda s: F.concat(s["type"], F.lit("|"), plain(s["url"]), F.lit("|"), F.coalesce(s["synced"], F.lit("")))), ";")
    return docs.select(
        F.regexp_extract("id", "~([0-9]+)", 1).cast("long").alias("c_custkey"), plain(F.col("name")).alias("name"), sources.alias("sources"), F.col("identity").isNotNull().alias("identified"),
        F.array_join("chambers", "+").alias("chambers"), "chamber", F.array_join("tags", ",").alias("tags"), F.array_join("warnings", "; ").alias("warnings"),
    )
