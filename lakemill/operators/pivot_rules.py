"""The rules of a person's document, over JSON of any form: types, required parts, domains, and references to dimensions.

Documents are VARIANT values, so what should be a list and is none is a finding and not an error of the reader. All rules
on a document and on the entries of its lists are tested in one pass, without a shuffle. The same pass gathers the
references, each with what its rules must know, and one join resolves those to all dimensions; where a dimension is not
given, its rules are left out, and what they would tell is neither right nor wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.nodes import at, is_object, text_at

#: Fixed values of the documents: version, required parts, lists, and the values that a field may have.
VERSION = "1"
REQUIRED = ("schema_version", "id", "nom", "chambre", "sources", "mandats", "votes", "textes_portes", "interventions", "amendements", "tags_thematiques", "meta")
REQUIRED_META = ("schema_version", "genere_le", "licence_donnees", "warnings")
LISTS = ("votes", "mandats", "textes_portes", "interventions", "amendements", "tags_thematiques", "sources")
CHAMBERS = ("AN", "Senat", "PE", "mairie")
POSITIONS = ("pour", "contre", "abstention", "non_votant", "absent", "excuse")
TRIGGERS = ("droit_tirage", "demande_votee")
REPORTS = ("rapporteur_fond", "rapporteur_avis", "rapporteur_special_budget", "mission_information", "rapporteur_general")
STAGES = ("depose", "examine_commission", "inscrit_ordre_jour", "discute_seance", "adopte", "promulgue")
TEXT_ROLES = ("auteur", "rapporteur", "co-rapporteur")
SIGNATORY_ROLES = ("auteur_principal", "cosignataire")
PROVENANCES = ("candidat_declare", "roster_groupe")
FORCED = "adopte_sans_vote_49_3"

_FINDING = "array<struct<path: string, rule: string>>"


def _finding(path: Column | str, rule: Column | str) -> Column:
    made = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(made(path).alias("path"), made(rule).alias("rule"))


def _told(broken: Column, path: Column | str, rule: str) -> Column:
    """An array of one finding, or of none where the rule holds or is not known to be broken."""
    return F.when(F.coalesce(broken, F.lit(False)), F.array(_finding(path, rule))).otherwise(F.array().cast(_FINDING))


def _kind(node: Column) -> Column:
    """object, list, text, another kind, or null for JSON's null and what is missing."""
    kind = F.schema_of_variant(node)
    return F.when(kind == "VOID", None).when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "list").when(kind == "STRING", "text").otherwise(F.lower(kind))


def _outside(node: Column, domain: tuple[str, ...]) -> Column:
    """Whether something that is neither missing nor null is none of the values."""
    return _kind(node).isNotNull() & ~F.coalesce(text_at(node).isin(*domain), F.lit(False))


def _empty(node: Column) -> Column:
    """Missing, null, or what counts as nothing: an empty text, list or object, 0 and false."""
    return _kind(node).isNull() | F.to_json(node).isin('""', "[]", "{}", "0", "0.0", "false")


def _members(node: Column) -> Column:
    return F.coalesce(F.try_variant_get(node, "$", "array<variant>"), F.array().cast("array<variant>"))


def _each(name: str, rules: Callable[[Column, Column], list[Column]]) -> Column:
    """The findings of all rules on the objects of a list; rules(entry, path of the entry)."""
    entries = F.transform(_members(at(F.col("v"), name)), lambda x, i: F.when(is_object(x), F.concat(*rules(x, F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]"))))))
    return F.flatten(F.array_compact(entries))


def _chambers() -> list[Column]:
    scalar, node = at(F.col("v"), "chambre"), at(F.col("v"), "chambres")
    names = F.transform(_members(node), lambda x: F.coalesce(text_at(x), F.to_json(x)))
    known = F.array(*[F.lit(c) for c in CHAMBERS])
    unknown = F.exists(names, lambda c: ~c.isin(*CHAMBERS))
    listed = _kind(node) == "list"
    in_order = F.filter(known, lambda c: F.array_contains(names, c))
    first = F.try_element_at(names, F.lit(1))
    return [
        _told(_outside(scalar, CHAMBERS), "chambre", "outside_domain"), _told(node.isNotNull() & ~F.coalesce(listed, F.lit(False)), "chambres", "not_a_list"),
        _told(listed & unknown, "chambres", "outside_domain"), _told(listed & (F.size(F.array_distinct(names)) < F.size(names)), "chambres", "repeated"),
        _told(listed & ~unknown & (names != in_order), "chambres", "out_of_order"), _told(listed & ~F.coalesce(text_at(scalar), F.to_json(F.when(_kind(scalar).isNotNull(), scalar))).eqNullSafe(first), "chambre", "disagrees"),
    ]


def _of_document() -> Column:
    v = F.col("v")
    meta = at(v, "meta")
    # JSON's null is a node, so only what is not there has none.
    lacking = lambda node, names, before="": F.array_compact(F.array(*[F.when(at(node, k).isNull(), _finding(f"{before}{k}", "missing")) for k in names]))
    missing, parts = lacking(v, REQUIRED), lacking(meta, REQUIRED_META, "meta.")
    of_meta = F.concat(
        parts, _told(~text_at(meta, "schema_version").eqNullSafe(F.lit(VERSION)), "meta.schema_version", "version"), _told(~_kind(at(meta, "warnings")).eqNullSafe(F.lit("list")), "meta.warnings", "not_a_list"),
        _told(_outside(at(meta, "provenance"), PROVENANCES), "meta.provenance", "outside_domain"),
    )
    return F.concat(
        missing, _told(~text_at(v, "schema_version").eqNullSafe(F.lit(VERSION)), "schema_version", "version"), _told(_empty(at(v, "id")), "id", "empty"), _told(_empty(at(v, "nom")), "nom", "empty"), *_chambers(),
        _told(_kind(at(v, "identite")) != "object", "identite", "not_an_object"), *[_told(_kind(at(v, k)) != "list", k, "not_a_list") for k in LISTS],
        F.when(is_object(meta), of_meta).otherwise(F.array(_finding("meta", "not_an_object"))),
    )


def _split(key: Column) -> Column:
    """Whether a ballot's key is an:legislature:number."""
    return F.coalesce(key.rlike("^an:[^:]+:[^:]+$"), F.lit(False))


def _of_entries() -> list[Column]:
    def mandate(x: Column, path: Column) -> list[Column]:
        unsourced = _kind(at(x, "position_dans_hemicycle")).isNotNull() & _empty(at(x, "source_url"))
        field = lambda n: F.concat(path, F.lit(f".{n}"))
        return [
            _told(unsourced, field("position_dans_hemicycle"), "without_source"), _told(_outside(at(x, "mode_declenchement"), TRIGGERS), field("mode_declenchement"), "outside_domain"),
            _told(_outside(at(x, "chambre"), CHAMBERS), field("chambre"), "outside_domain"),
        ]

    def kept(x: Column, path: Column, key: str, record: str, formed: Column) -> list[Column]:
        none = _kind(at(x, key)).isNull()
        return [_told(none & ~is_object(at(x, record)), F.concat(path, F.lit(f".{key}")), "lost"), _told(~none & ~formed, F.concat(path, F.lit(f".{key}")), "malformed")]

    def vote(x: Column, path: Column) -> list[Column]:
        return [*kept(x, path, "scrutin_id", "scrutin_non_resolu", _split(text_at(x, "scrutin_id"))), _told(_outside(at(x, "position"), POSITIONS), F.concat(path, F.lit(".position")), "outside_domain")]

    def text(x: Column, path: Column) -> list[Column]:
        domains = {"role": TEXT_ROLES, "type_rapport": REPORTS, "stade_procedural": STAGES}
        return [_told(_outside(at(x, n), d), F.concat(path, F.lit(f".{n}")), "outside_domain") for n, d in domains.items()]

    def amendment(x: Column, path: Column) -> list[Column]:
        formed = F.coalesce(text_at(x, "amendement_id").rlike("^an:.+"), F.lit(False))
        return [_told(_outside(at(x, "role_signataire"), SIGNATORY_ROLES), F.concat(path, F.lit(".role_signataire")), "outside_domain"), *kept(x, path, "amendement_id", "amendement_non_resolu", formed)]

    def intervention(x: Column, path: Column) -> list[Column]:
        return [_told(_kind(at(x, "theme_officiel")) != "text", F.concat(path, F.lit(".theme_officiel")), "not_a_text"), *[_told(_kind(at(x, n)) != "object", F.concat(path, F.lit(f".{n}")), "not_an_object") for n in ("seance", "dossier", "source")]]

    return [_each("mandats", mandate), _each("votes", vote), _each("textes_portes", text), _each("amendements", amendment), _each("interventions", intervention)]


#: Of each list whose entries refer to a dimension: the reference, its shape, and what its rules must know.
REFERENCES = {"votes": ("scrutin_id", "^an:[^:]+:[^:]+$", "position"), "amendements": ("amendement_id", "^an:.+", "role_signataire")}

_TOLD = "array<struct<path: string, rule: string, dim: string, ref: string, held: string>>"


def _references(dimensions: Iterable[str]) -> Column:
    """All well-formed references of a document to these dimensions: dim says to which, held is what the entry holds, as
    the position of a vote."""

    def gathered(name: str, field: str, shape: str, held: str) -> Column:
        found = F.transform(_members(at(F.col("v"), name)), lambda x, i: F.struct(F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]")).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(name).alias("dim"), text_at(x, field).alias("ref"), text_at(x, held).alias("held")))
        return F.filter(found, lambda r: F.coalesce(r["ref"].rlike(shape), F.lit(False)))

    return F.concat(*[gathered(n, *REFERENCES[n]) for n in dimensions])


def findings(docs: DataFrame, key: str, node: str, dimensions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(key, path, rule) for every broken rule of documents (key, node), node as VARIANT.

    dimensions: `votes` as (id, outcome) of ballots, `amendements` as (id). What is no object has one finding. An entry
    of a list that is no object is left out, as no rule speaks of it. A document is read once.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(node).alias("v"))
    object_ = is_object(F.col("v"))
    whole = F.when(object_, F.concat(_of_document(), *_of_entries())).otherwise(F.array(_finding("", "not_an_object")))
    if not dimensions:
        return rows.select("key", F.inline(whole))
    none = F.lit(None).cast("string")
    told = F.transform(whole, lambda f: F.struct(f["path"].alias("path"), f["rule"].alias("rule"), none.alias("dim"), none.alias("ref"), none.alias("held")))
    found = rows.select("key", F.inline(F.concat(told, F.when(object_, _references(dimensions)).otherwise(F.array().cast(_TOLD)))))
    known = [d.select(F.lit(n).alias("of"), F.col("id").alias("known"), (F.col("outcome") if "outcome" in d.columns else none).alias("decided")) for n, d in dimensions.items()]
    known = reduce(DataFrame.union, known).where("known is not null").distinct()
    # Findings have no reference; so that they do not meet in one task, each joins by what it tells, and meets nothing.
    found = found.withColumns({"asked": F.coalesce("ref", F.concat_ws(" ", F.col("key").cast("string"), "path")), "among": F.coalesce("dim", F.lit(""))})
    met = found.join(known, (F.col("asked") == F.col("known")) & (F.col("among") == F.col("of")), "left")
    field = F.create_map(*[F.lit(x) for n in dimensions for x in (n, f".{REFERENCES[n][0]}")])
    forced = (F.col("dim") == "votes") & (F.col("decided") == FORCED) & F.col("held").isNotNull()
    every = F.array(
        F.when(F.col("rule").isNotNull(), _finding(F.col("path"), F.col("rule"))), F.when(F.col("ref").isNotNull() & F.col("known").isNull(), _finding(F.concat("path", field[F.col("dim")]), "unknown")),
        F.when(forced, _finding(F.concat("path", F.lit(".position")), "forced_has_position")),
    )
    return met.select("key", F.inline(F.array_compact(every)))
