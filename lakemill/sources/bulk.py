"""What the entries of bulk archives hold, as rows: ballots and their voters, amendments and their signatories, dossiers.

Entries come from archives.zip_entries(): (archive, entry, content, error). A packaging is told by the root key of the
content, never by the name of a file.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.nodes import at, is_object, listed, objects, parsed, text_at

#: Fixed values of the archives: what the ids of a chamber's own ballots begin with, and under which names a nominal
#: vote lists its voters.
OWN_BALLOT = "VTANR"
VOTERS = {"pour": ("pours", "pour"), "contre": ("contres", "contre"), "abstention": ("abstentions", "abstention"), "non_votant": ("nonVotants", "nonVotant")}

#: Fixed values of dossiers: what the documents of government and members' bills begin with, their procedure codes, acts
#: of deposit, of withdrawal and of promulgation, the codes of decisions and the status and the use of article 49.3 that
#: each means, the code that says nothing, and the statuses that a promulgation overrides (as well as none).
GOVERNMENT_DOCUMENT, MEMBER_DOCUMENT = "PRJL", "PION"
GOVERNMENT_PROCEDURES, MEMBER_PROCEDURES = ("1", "3", "4", "6", "21", "33"), ("2", "23")
DEPOSIT, WITHDRAWAL, PROMULGATION = "-DEPOT", ("AN1-RTRINI", "ANLUNI-RTRINI"), "PROM"
DECISIONS = {
    "TSORTF01": ("adopte", False),
    "TSORTF07": ("rejete", False),
    "TSORTF06": ("adopte_49_3", True),
    "TSORTF24": ("rejete_49_3", True),
    "TSORTF03": ("adopte", False),
    "TSORTF18": ("adopte_cmp", False),
    "TSORTF05": ("navette_en_cours", False),
    "TSORTF02": ("navette_en_cours", False),
    "TSORTF14": ("adopte", False),
    "TSORTF13": ("rejete", False),
}
NO_DECISION, OVERRIDDEN = "TSORTFnull", ("depose", "navette_en_cours", "rejete", "rejete_49_3")


def documents(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, broken): entries that are JSON, with their text content and the VARIANT column v, and those that cannot
    be read."""
    # As a generator's value: a condition on it stays above and does not parse a second time.
    rows = entries.select("archive", "entry", F.make_valid_utf8(F.col("content").cast("string")).alias("content"), "error", F.explode(F.array(parsed(F.col("content")))).alias("v"))
    broken = F.col("v").isNull()
    return rows.where(~broken).drop("error"), rows.where(broken).select("archive", "entry", F.coalesce("error", F.lit("no JSON")).alias("error"))


def ballots(docs: DataFrame, legislature: Column) -> tuple[DataFrame, DataFrame]:
    """(ballots, outside): an entry holds one ballot under `scrutin`, or one or several under `scrutins.scrutin`.

    ballots: (uid, number, date, title, outcome, legislature, groups), groups as VARIANT nodes. Ballots without an id or
    without groups give no row; those whose id is not the chamber's own are outside, to be counted. legislature is that
    of the archive, for ballots that do not say theirs.
    """
    one = at(F.col("v"), "scrutin")
    rows = docs.select(legislature.alias("own"), F.explode(F.when(is_object(one), F.array(one)).otherwise(objects(at(F.col("v"), "scrutins", "scrutin")))).alias("b"))
    groups = at(F.col("b"), "ventilationVotes", "organe", "groupes", "groupe")
    rows = rows.withColumns({"uid": text_at(F.col("b"), "uid"), "groups": groups}).where("uid <> ''").where(F.col("groups").isNotNull() & ~F.is_variant_null("groups"))
    text = lambda *names: text_at(F.col("b"), *names)
    found = rows.select(
        "uid", text("numero").alias("number"), text("dateScrutin").alias("date"), text("titre").alias("title"), text("sort", "libelle").alias("outcome"),
        F.coalesce(F.nullif(text("legislature"), F.lit("")), "own").alias("legislature"), objects(F.col("groups")).alias("groups"),
    )
    inside = F.startswith("uid", F.lit(OWN_BALLOT))
    return found.where(inside), found.where(~inside)


def voters(ballots: DataFrame) -> DataFrame:
    """(uid, member, position) of ballots(): every nominal vote, from the plural and the singular names of its lists."""
    rows = ballots.select("uid", F.explode("groups").alias("g")).select("uid", at(F.col("g"), "vote", "decompteNominatif").alias("d"))

    def named(position: str, name: str) -> Column:
        members = F.transform(objects(at(F.col("d"), name, "votant")), lambda x: text_at(x, "acteurRef"))
        return F.transform(F.filter(members, lambda m: m != ""), lambda m: F.struct(m.alias("member"), F.lit(position).alias("position")))

    return rows.select("uid", F.inline(F.concat(*[named(p, n) for p, names in VOTERS.items() for n in names])))


def _cosigners(signed: Column) -> Column:
    """The ids of a node's cosigners in order, each once: ids beside each other, or objects that hold one."""
    node = at(signed, "cosignataires")
    direct = F.filter(F.transform(listed(at(node, "acteurRef")), lambda x: text_at(x)), lambda r: r != "")
    nested = F.filter(F.transform(objects(at(node, "acteur")), lambda x: text_at(x, "acteurRef")), lambda r: r != "")
    return F.array_distinct(F.concat(direct, nested))


def amendments(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(amendments, unknown): an entry holds one under `amendement`, or the texts of an older legislature under
    `textesEtAmendements`, each with its amendments; other roots are unknown, to be told.

    amendments: (uid, text_ref, date, number, author, cosigners). Those without an author give no row.
    """
    has = lambda name: at(F.col("v"), name).isNotNull()
    rows = docs.withColumn("root", F.when(has("amendement"), "amendement").when(has("textesEtAmendements"), "textesEtAmendements"))
    unknown = rows.where("root is null").select("archive", "entry")
    # Both forms leave an entry together, so that it is read and parsed once.
    held = lambda modern, ref, a: F.struct(F.lit(modern).alias("modern"), ref.alias("ref"), a.alias("a"))
    modern = F.transform(F.filter(F.array(at(F.col("v"), "amendement")), is_object), lambda a: held(True, F.lit(None).cast("string"), a))
    of_text = lambda t: F.transform(objects(at(t, "amendements", "amendement")), lambda a: held(False, text_at(t, "refTexteLegislatif"), a))
    older = F.flatten(F.transform(objects(at(F.col("v"), "textesEtAmendements", "texteleg")), of_text))
    every = rows.select(F.inline(F.when(F.col("root") == "amendement", modern).when(F.col("root") == "textesEtAmendements", older)))
    a, own = F.col("a"), lambda new, old: F.when(F.col("modern"), new).otherwise(old)
    every = every.select(
        "a", own(text_at(a, "texteLegislatifRef"), F.col("ref")).alias("text_ref"), own(text_at(a, "cycleDeVie", "dateDepot"), text_at(a, "dateDepot")).alias("date"),
        own(text_at(a, "identification", "numeroLong"), F.coalesce(F.nullif(text_at(a, "numeroLong"), F.lit("")), text_at(a, "identifiant", "numero"))).alias("number"),
    )
    signed = at(F.col("a"), "signataires")
    found = every.select(text_at(F.col("a"), "uid").alias("uid"), "text_ref", "date", "number", text_at(signed, "auteur", "acteurRef").alias("author"), _cosigners(signed).alias("cosigners"))
    return found.where("author <> ''"), unknown


def newest(entries: DataFrame, rank: Column) -> DataFrame:
    """Of entries that name one document, in several archives, that of the archive of the highest rank.

    Names are enough for it, so what loses is never read; see archives.contents_of(). A name's last part without its
    suffix is the document's id.
    """
    named = entries.where("entry is not null").select("archive", "entry", F.regexp_extract("entry", r"([^/]+?)(?:\.[^./]+)?$", 1).alias("uid"), rank.alias("rank"))
    best = Window.partitionBy("uid").orderBy(F.desc("rank"), F.desc("archive"), F.desc("entry"))
    return named.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")


_ACTS = "array<struct<code: string, date: string, text: string, decision: string>>"


def acts(content: Column, *names: str) -> Column:
    """All acts of a dossier's tree, at any depth, in its order: their code, date, text and the code of their decision. The
    tree is below names in a JSON text; names in an object count in order, as VARIANT has them.

    A tree has no depth that a projection could name, so one dossier at a time is walked; what hangs below a decision's
    conclusion is no act. The text is taken as it was read: VARIANT would be written as JSON again, sign by sign.
    """

    @F.pandas_udf(_ACTS)
    def run(texts: pd.Series) -> pd.Series:
        plain = lambda v: v if isinstance(v, str) else None
        out = []
        for text in texts:
            node = json.loads(text) if text else None
            for name in names:
                node = node.get(name) if isinstance(node, dict) else None
            found, waiting = [], [node]
            while waiting:
                now = waiting.pop()
                if isinstance(now, dict):
                    end = now.get("statutConclusion")
                    found.append({"code": plain(now.get("codeActe")), "date": plain(now.get("dateActe")), "text": plain(now.get("texteAssocie")), "decision": plain(end.get("fam_code")) if isinstance(end, dict) else None})
                    waiting += [now[k] for k in sorted(now, reverse=True) if k != "statutConclusion" and isinstance(now[k], (dict, list))]
                elif isinstance(now, list):
                    waiting += reversed(now)
            out.append(found)
        return pd.Series(out)

    return run(content)


def dossiers(docs: DataFrame) -> DataFrame:
    """(uid, title, origin, chamber, deposited, last_act, initiators, legislature, n_acts, acts) of entries under
    `dossierParlementaire`.

    origin: of the document deposited first, government or member, null for other documents; without one it is told by
    the procedure. deposited is the first deposit, else the first act. chamber is that of the first deposit whose code
    names one. initiators are the actors' ids, null (not empty) if none is named.
    """
    rows = docs.select("content", at(F.col("v"), "dossierParlementaire").alias("d")).where(is_object(F.col("d")))
    rows = rows.select("d", acts(F.col("content"), "dossierParlementaire", "actesLegislatifs").alias("acts"))
    deposit = lambda a: F.coalesce(F.endswith(a["code"], F.lit(DEPOSIT)), F.lit(False))
    dated = F.filter("acts", lambda a: a["date"] != "")
    days = lambda c: F.transform(c, lambda a: F.substring(a["date"], 1, 10))
    first = F.array_min(F.transform(F.filter("acts", lambda a: deposit(a) & a["text"].isNotNull()), lambda a: F.struct(F.coalesce(a["date"], F.lit("")), a["text"].alias("text"))))["text"]
    chamber = lambda code: F.when(F.startswith(code, F.lit("AN")), "AN").when(F.startswith(code, F.lit("SN")), "Senat")
    houses = F.filter(dated, lambda a: deposit(a) & chamber(a["code"]).isNotNull())
    # The earliest date; of equal ones the first in the tree.
    earliest = F.aggregate(houses, F.lit(None).cast("struct<date: string, chamber: string>"), lambda best, a: F.when(best.isNull() | (a["date"] < best["date"]), F.struct(a["date"].alias("date"), chamber(a["code"]).alias("chamber"))).otherwise(best))
    procedure = F.coalesce(text_at(F.col("d"), "procedureParlementaire", "code"), F.try_variant_get("d", "$.procedureParlementaire.code", "string"))
    of_document = F.when(F.startswith("first", F.lit(GOVERNMENT_DOCUMENT)), "government").when(F.startswith("first", F.lit(MEMBER_DOCUMENT)), "member")
    by_procedure = F.when(F.col("procedure").isin(*GOVERNMENT_PROCEDURES), "government").when(F.col("procedure").isin(*MEMBER_PROCEDURES), "member")
    refs = F.array_distinct(F.filter(F.transform(objects(at(F.col("d"), "initiateur", "acteurs", "acteur")), lambda x: text_at(x, "acteurRef")), lambda r: r != ""))
    return rows.select("*", first.alias("first"), procedure.alias("procedure")).select(
        text_at(F.col("d"), "uid").alias("uid"), text_at(F.col("d"), "titreDossier", "titre").alias("title"),
        F.when(F.coalesce(F.col("first") != "", F.lit(False)), of_document).otherwise(by_procedure).alias("origin"), earliest["chamber"].alias("chamber"),
        F.coalesce(F.array_min(days(F.filter(dated, deposit))), F.array_min(days(dated))).alias("deposited"), F.array_max(days(dated)).alias("last_act"),
        F.when(F.size(refs) > 0, refs).alias("initiators"), text_at(F.col("d"), "legislature").alias("legislature"), F.size("acts").cast("long").alias("n_acts"), "acts",
    )


def dossier_status(acts: Column) -> tuple[Column, Column]:
    """(status, code): of the latest withdrawal, or decision of a session, by date, of equal dates the first.

    status is null where the code is not known, which the caller tells. Without any it is depose, or navette_en_cours
    once there are other acts than deposits. A promulgation overrides what it contradicts.
    """
    dated = F.filter(acts, lambda a: a["date"] != "")
    session = lambda a: F.contains(a["code"], F.lit("-DEBATS-")) & F.endswith(a["code"], F.lit("-DEC")) & (a["decision"] != "") & (a["decision"] != NO_DECISION)
    decides = F.filter(dated, lambda a: F.coalesce(a["code"].isin(*WITHDRAWAL) | session(a), F.lit(False)))
    last = F.aggregate(decides, F.lit(None).cast(_ACTS.removeprefix("array<").removesuffix(">")), lambda best, a: F.when(best.isNull() | (a["date"] > best["date"]), a).otherwise(best))
    beyond = F.exists(acts, lambda a: ~F.endswith(a["code"], F.lit(DEPOSIT)))
    known = F.try_element_at(F.create_map(*[F.lit(x) for k, v in DECISIONS.items() for x in (k, v[0])]), last["decision"])
    status = F.when(F.size(decides) == 0, F.when(beyond, "navette_en_cours").otherwise("depose")).when(last["code"].isin(*WITHDRAWAL), "retire").otherwise(known)
    ended = F.exists(acts, lambda a: F.startswith(a["code"], F.lit(PROMULGATION)))
    return F.when(F.coalesce(ended, F.lit(False)) & (status.isNull() | status.isin(*OVERRIDDEN)), "promulgue").otherwise(status), last["decision"]
