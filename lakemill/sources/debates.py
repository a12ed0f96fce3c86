"""Debates as XML reports: one row for each session and one for each paragraph that someone speaks or that says something.

A report is parsed once, into its sessions's fields and its agenda: points in order, each with a title and its own
paragraphs. Points inside points are not agenda points, so their paragraphs are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.text import first_match

#: What a title says about the kind of a debate, in order, and the fewest words of a developed speech.
KINDS = (
    ("question_gouvernement", "(?i)question.*gouvernement"),
    ("question_orale", "(?i)question.*orale"),
    ("question", "(?i)question"),
    ("motion_censure", "(?i)motion de censure"),
    ("explication_vote", "(?i)explication.*vote"),
    ("loi", "(?i)projet de loi|proposition de loi|PLFSS|PLF"),
)
NO_KIND, DEVELOPED_WORDS = "debat", 50

CORRUPT = "_corrupt"
SCHEMA = f"""uid string, seanceRef string, sessionRef string,
 metadonnees struct<dateSeance: string, legislature: string, numSeance: string, etat: string, version: string>,
 contenu struct<point: array<struct<titreStruct: struct<intitule: string>,
  paragraphe: array<struct<orateurs: struct<orateur: array<struct<id: string, nom: string, qualite: string>>>, texte: string>>>>>, {CORRUPT} string"""


def report_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(name, xml) of the reports below a folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("xml"))


def reports(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, broken) of files(name, xml): parsed as the column r, and the names of those that are no XML.

    The signs that XML must escape stay escaped in texts, as inner markup is removed from them later.
    """
    xml = F.regexp_replace(F.make_valid_utf8("xml"), "&(?=(?:lt|gt|amp);)", "&amp;")
    rows = files.select("name", F.from_xml(xml, SCHEMA, {"ignoreNamespace": "true", "columnNameOfCorruptRecord": CORRUPT, "excludeAttribute": "true"}).alias("r"))
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return rows.where(~broken), rows.where(broken).select("name")


def _collapsed(text: Column) -> Column:
    return F.nullif(F.btrim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def _value(text: Column) -> Column:
    """A field: what stands before any inner markup, trimmed; blank becomes null."""
    plain = F.substring_index(text, "<", 1)
    for sign, name in (("<", "&lt;"), (">", "&gt;"), ("&", "&amp;")):
        plain = F.replace(plain, F.lit(name), F.lit(sign))
    return F.nullif(F.regexp_replace(plain, r"(?U)^\s+|\s+$", ""), F.lit(""))


def _session() -> list[Column]:
    meta, raw = "r.metadonnees", _value(F.col("r.metadonnees.dateSeance"))
    day = F.when(F.length(raw) >= 8, F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2)))
    fields = {"uid": "r.uid", "seance_ref": "r.seanceRef", "session_ref": "r.sessionRef", "legislature": f"{meta}.legislature", "number": f"{meta}.numSeance", "state": f"{meta}.etat", "version": f"{meta}.version"}
    return [*[_value(F.col(path)).alias(name) for name, path in fields.items()], day.alias("date")]


def sessions(found: DataFrame) -> DataFrame:
    """(name, uid, seance_ref, session_ref, legislature, number, state, version, date) of reports()."""
    return found.select("name", *_session())


def interventions(found: DataFrame) -> DataFrame:
    """The paragraphs of reports() with their session: (name, session fields, point, paragraph, title, kind, speaker,
    speaker_name, function, text, format).

    point and paragraph count from 0 in the order of the report. A paragraph that names several speakers is nobody's;
    one without speaker and text is left out.
    """
    points = found.select("name", *_session(), F.posexplode("r.contenu.point").alias("point", "p"))
    fields = [c for c in points.columns if c != "p"]
    rows = points.select(*fields, _value(F.col("p.titreStruct.intitule")).alias("title"), F.posexplode("p.paragraphe").alias("paragraph", "q"))
    known = F.filter(F.transform("q.orateurs.orateur", lambda o: F.struct(_value(o["id"]).alias("id"), _value(o["nom"]).alias("nom"), _value(o["qualite"]).alias("qualite"))), lambda o: o["id"].isNotNull() | o["nom"].isNotNull())
    persons = F.array_distinct(F.transform(known, lambda o: F.struct(o["id"], o["nom"])))
    speaker = F.when(F.size(persons) == 1, known[0])
    bare = F.regexp_replace(F.regexp_replace("q.texte", r"<[^>]*\bbr\b[^>]*/?>", " "), "<[^>]+>", "")
    rows = rows.select(*fields, "title", "paragraph", speaker.alias("s"), _collapsed(bare).alias("text")).where("s is not null or text is not null")
    words = F.when(F.col("text").isNotNull(), F.size(F.split("text", " "))).otherwise(0)
    return rows.select(
        *fields, "paragraph", "title", first_match(F.coalesce("title", F.lit("")), KINDS, NO_KIND).alias("kind"), F.col("s.id").alias("speaker"), F.col("s.nom").alias("speaker_name"),
        F.col("s.qualite").alias("function"), "text", F.when(words < DEVELOPED_WORDS, "reaction_courte").otherwise("prise_de_parole_developpee").alias("format"),
    )
