"""Whole documents: empty ones of each kind, and a person's document from a raw record.

In a document null and an empty list are two things: null is not known, an empty list is known to hold nothing. So a
template names every part, and its lists are lists of VARIANT that any entry fits.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.projections import ELECTIVE, blank_to_null, name_of_slug

#: Versions, chambers in their order, counts and kinds of amendments, and statuses of texts.
VERSION = "1"
CHAMBERS = ("AN", "Senat", "PE", "mairie")
AMENDMENT_COUNTS = ("nb_amendements", "nb_adoptes", "nb_rejetes", "nb_irrecevables", "nb_retires_ou_tombes")
DEPOSITORS = ("commission_rapporteur", "depute", "gouvernement", "inconnu")
TEXT_STATUSES = ("depose", "navette_en_cours", "adopte", "adopte_49_3", "adopte_cmp", "promulgue", "rejete", "rejete_49_3", "retire")


def _nothing() -> Column:
    return F.array().cast("array<variant>")


def _unknown(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _struct(**parts: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def _meta(stamp: Column, **more: Column) -> Column:
    return _struct(schema_version=F.lit(VERSION), genere_le=stamp, licence_donnees=F.lit(""), **more, warnings=F.array().cast("array<string>"))


def _period() -> Column:
    return _struct(debut=_unknown(), fin=_unknown(), actif=F.lit(True))


def empty_person(id_: Column, name: Column, provenance: Column, stamp: Column) -> Column:
    """A person of whom nothing is known but the name; no mandate, so no chamber."""
    lists = {c: _nothing() for c in ("sources", "mandats", "votes", "textes_portes", "interventions", "amendements")}
    return _struct(
        schema_version=F.lit(VERSION), id=id_, nom=name, chambres=F.array().cast("array<string>"), chambre=_unknown(), parti=_unknown(), groupe=_unknown(), identite=_unknown("variant"), **lists,
        tags_thematiques=F.array().cast("array<string>"), meta=_struct(schema_version=F.lit(VERSION), genere_le=stamp, licence_donnees=F.lit(""), warnings=F.array().cast("array<string>"), provenance=provenance),
    )


def empty_group(id_: Column, short: Column, name: Column, chamber: Column, legislature: Column, stamp: Column) -> Column:
    """A group without members; counts of nothing are 0, rates of nothing null."""
    counts = lambda: {**{c: F.lit(0) for c in AMENDMENT_COUNTS}, "taux_adoption": _unknown("double")}
    return _struct(
        schema_version=F.lit(VERSION), type_document=F.lit("profil_groupe"), groupe_id=id_, groupe_sigle=short, groupe_nom=name, chambre=chamber, legislature=legislature, periode=_period(), historique_noms=_nothing(), membres=_nothing(),
        effectif=_struct(actuel=F.lit(0), min_historique=_unknown("int"), max_historique=_unknown("int")), cohesion_votes=_nothing(), tags_thematiques_agreges=_nothing(), mandats_agreges=_nothing(),
        amendements_agreges=_struct(**counts(), par_type_deposant=_struct(**{d: _struct(**counts()) for d in DEPOSITORS})), sources=_nothing(), meta=_meta(stamp, profils_sources=_nothing(), seuil_quorum=F.lit(0.5)),
    )


def empty_government(id_: Column, name: Column, stamp: Column) -> Column:
    return _struct(
        schema_version=F.lit(VERSION), type_document=F.lit("profil_gouvernement"), gouvernement_id=id_, nom=name, premier_ministre=_unknown("variant"), periode=_period(), membres=_nothing(), textes=_nothing(),
        comptages=_struct(par_statut=_struct(**{s: F.lit(0) for s in TEXT_STATUSES})), sources=_nothing(), meta=_meta(stamp),
    )


def empty_party(id_: Column, name: Column, stamp: Column) -> Column:
    return _struct(
        schema_version=F.lit(VERSION), type_document=F.lit("profil_parti"), parti_id=id_, parti_nom=name, candidats=_nothing(), tags_thematiques_agreges=_nothing(), sources=_nothing(),
        meta=_meta(stamp, nb_candidats_declares=F.lit(0), nb_candidats_avec_pivot=F.lit(0)),
    )


@dataclass(frozen=True)
class Chambers:
    """names in their order, the first of them, and whether mandates bear out all of them."""

    names: Column
    first: Column
    unsupported: Column
    unstamped: Column

    @property
    def supported(self) -> Column:
        return (F.size(self.names) > 0) & (F.size(self.unsupported) == 0) & (self.unstamped == 0)


def chambers(mandates: Column, collected: Column) -> Chambers:
    """Of mandates (category, chamber): the chambers that elective ones are stamped with, and the one that the record
    came from, which is always added and never replaces what mandates say."""
    elective = F.filter(F.coalesce(mandates, F.array().cast("array<struct<category: string, chamber: string>>")), lambda m: m["category"] == ELECTIVE)
    stamped = F.filter(F.transform(elective, lambda m: m["chamber"]), lambda c: F.coalesce(c.isin(*CHAMBERS), F.lit(False)))
    order = F.array(*[F.lit(c) for c in CHAMBERS])
    names = F.filter(order, lambda c: F.array_contains(stamped, c) | F.coalesce(c == collected, F.lit(False)))
    return Chambers(names, F.try_element_at(names, F.lit(1)), F.filter(names, lambda c: ~F.array_contains(stamped, c)), F.size(elective) - F.size(stamped))


def intervention_tags(interventions: Column) -> Column:
    """Tags of interventions (theme, keywords): of each its official theme, or else its keywords; trimmed, in lower case,
    each once, sorted."""
    own = F.transform(interventions, lambda i: F.when(F.coalesce(i["theme"] != "", F.lit(False)), F.array(i["theme"])).otherwise(F.coalesce(i["keywords"], F.array().cast("array<string>"))))
    clean = F.transform(F.flatten(F.coalesce(own, F.array().cast("array<array<string>>"))), lambda t: F.lower(F.btrim(t)))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda t: F.coalesce(t != "", F.lit(False)))))


def person_documents(raw: DataFrame, types: Mapping[str, str], collected: Mapping[str, str], main: str, official: str, mark: str, base_url: str) -> DataFrame:
    """raw records as documents: (id, name, group, party, provenance, sources, identity, chambers, chamber, tags, licence,
    warnings).

    raw: slug, name, party, provenance, chamber, group_name, group_short, source, votes_source, synced (map of stamps),
    made_at, profession, birth_date, birth_place, constituency, declaration, official_url, mandates (category, chamber),
    interventions (theme, keywords), licence, warnings. A name that is missing is made from the slug. The first source
    is that of the record, synced when `main` was, which may be never; when nothing is said of it, when the record was
    made. Votes whose source names `mark` add the official source. An identity of nothing but an address is none.
    Warnings of the record stay; added are that the main source was never synced, how many elective mandates have no
    chamber, and chambers that no mandate bears out. types and collected give source type and chamber by the record's.
    """
    lookup = lambda table: F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.coalesce("chamber", F.lit("")))
    own = F.when(F.map_contains_key("synced", F.lit(main)), F.try_element_at("synced", F.lit(main))).otherwise(F.col("made_at"))
    address = F.coalesce(blank_to_null(F.col("source")), F.concat(F.lit(base_url), "slug"))
    source = lambda kind, url, stamp: F.struct(kind.alias("type"), url.alias("url"), stamp.alias("synced"))
    second = F.when(F.contains(F.lower("votes_source"), F.lit(mark)), source(F.lit("assemblee_nationale"), F.lit(official), F.coalesce(blank_to_null(F.try_element_at("synced", F.lit("assemblee_nationale"))), own)))
    facts = ("profession", "birth_date", "birth_place", "constituency", "declaration")
    known = F.exists(F.array(*[F.col(f).cast("string") for f in facts]), lambda v: F.coalesce(v != "", F.lit(False)))
    # Under a name of its own: in a lambda, a name that the projection also gives out would mean what is given out.
    rows = raw.withColumn("__collected", F.coalesce(lookup(collected), blank_to_null(F.col("chamber"))))
    found = chambers(F.col("mandates"), F.col("__collected"))
    told = F.array_compact(
        F.array(
            F.when(F.try_element_at("synced", F.lit(main)).isNull(), F.lit(f"never synced: {main}")),
            F.when(found.unstamped > 0, F.concat(F.lit("elective mandates without chamber: "), found.unstamped.cast("string"))),
            F.when(~found.supported, F.concat(F.lit("chambers not borne out: "), F.array_join(found.names, "+"), F.lit(", of these "), F.coalesce(F.nullif(F.array_join(found.unsupported, "+"), F.lit("")), F.lit("none")))),
        )
    )
    return rows.select(
        F.col("slug").alias("id"), F.coalesce(blank_to_null(F.col("name")), name_of_slug(F.col("slug"))).alias("name"), F.coalesce(blank_to_null(F.col("group_name")), blank_to_null(F.col("group_short"))).alias("group"), "party", "provenance",
        F.array_compact(F.array(source(F.coalesce(lookup(types), F.lit(main)), address, own), second)).alias("sources"),
        F.when(known, F.struct(*facts, F.coalesce(blank_to_null(F.col("official_url")), address).alias("source_url"))).alias("identity"), found.names.alias("chambers"), found.first.alias("chamber"),
        intervention_tags(F.col("interventions")).alias("tags"), F.coalesce("licence", F.lit("")).alias("licence"), F.concat(F.coalesce("warnings", F.array().cast("array<string>")), told).alias("warnings"),
    )
