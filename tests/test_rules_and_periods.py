"""Every rule of a person's document with a row that breaks it, and interval joins against brute force."""

from __future__ import annotations

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakemill.operators import pivot_rules
from lakemill.operators.intervals import islands, overlap_join

GOOD = {
    "schema_version": "1", "id": "a", "nom": "A", "chambre": "AN", "chambres": ["AN", "PE"], "identite": {"x": 1}, "sources": [], "tags_thematiques": [],
    "mandats": [{"position_dans_hemicycle": "majorite", "source_url": "u", "mode_declenchement": "droit_tirage", "chambre": "PE"}, {"position_dans_hemicycle": None}, "text"],
    "votes": [{"scrutin_id": "an:17:1", "position": "pour"}, {"scrutin_id": None, "scrutin_non_resolu": {"n": 1}, "position": None}, {"scrutin_id": "an:17:2"}],
    "textes_portes": [{"role": "auteur", "type_rapport": "rapporteur_fond", "stade_procedural": "depose"}], "amendements": [{"amendement_id": "an:X", "role_signataire": "cosignataire"}, {"amendement_non_resolu": {}}],
    "interventions": [{"theme_officiel": "t", "seance": {}, "dossier": None, "source": {}}, {}], "meta": {"schema_version": "1", "genere_le": "x", "licence_donnees": "x", "warnings": [], "provenance": "roster_groupe"},
}


def changed(**parts):
    return {k: v for k, v in (GOOD | parts).items() if v != "DROP"}


def meta(**parts):
    return changed(meta={k: v for k, v in (GOOD["meta"] | parts).items() if v != "DROP"})


BREAKING = [
    ([], ("", "not_an_object")), (changed(sources="DROP"), ("sources", "missing")), (changed(schema_version="2"), ("schema_version", "version")), (changed(id=""), ("id", "empty")), (changed(nom=None), ("nom", "empty")),
    (changed(chambre="X", chambres="DROP"), ("chambre", "outside_domain")), (changed(chambres="AN"), ("chambres", "not_a_list")), (changed(chambres=None), ("chambres", "not_a_list")), (changed(chambres=["AN", "X"]), ("chambres", "outside_domain")),
    (changed(chambres=["AN", "AN"]), [("chambres", "repeated"), ("chambres", "out_of_order")]), (changed(chambre="PE", chambres=["PE", "AN"]), ("chambres", "out_of_order")), (changed(chambre=None), ("chambre", "disagrees")), (changed(identite="x"), ("identite", "not_an_object")),
    (changed(tags_thematiques={}), ("tags_thematiques", "not_a_list")), (changed(votes="x"), ("votes", "not_a_list")), (changed(mandats=[{"position_dans_hemicycle": "x", "source_url": ""}]), ("mandats[0].position_dans_hemicycle", "without_source")),
    (changed(mandats=[{}, {"mode_declenchement": "x"}]), ("mandats[1].mode_declenchement", "outside_domain")), (changed(mandats=[{"chambre": 1}]), ("mandats[0].chambre", "outside_domain")), (changed(votes=[{}]), ("votes[0].scrutin_id", "lost")),
    (changed(votes=[{"scrutin_id": "an:17"}]), ("votes[0].scrutin_id", "malformed")), (changed(votes=[{"scrutin_id": 5}]), ("votes[0].scrutin_id", "malformed")), (changed(votes=[{"scrutin_id": "an:17:1", "position": "x"}]), ("votes[0].position", "outside_domain")),
    (changed(votes=[{"scrutin_id": "an:9:9"}]), ("votes[0].scrutin_id", "unknown")), (changed(votes=[{"scrutin_id": "an:17:2", "position": "pour"}]), ("votes[0].position", "forced_has_position")), (changed(textes_portes=[{"role": "x"}]), ("textes_portes[0].role", "outside_domain")),
    (changed(textes_portes=[{"type_rapport": "x"}]), ("textes_portes[0].type_rapport", "outside_domain")), (changed(textes_portes=[{"stade_procedural": "x"}]), ("textes_portes[0].stade_procedural", "outside_domain")),
    (changed(amendements=[{"amendement_id": "an:X", "role_signataire": "x"}]), ("amendements[0].role_signataire", "outside_domain")), (changed(amendements=[{}]), ("amendements[0].amendement_id", "lost")), (changed(amendements=[{"amendement_id": "an:"}]), ("amendements[0].amendement_id", "malformed")),
    (changed(amendements=[{"amendement_id": "an:Y"}]), ("amendements[0].amendement_id", "unknown")), (changed(interventions=[{"theme_officiel": 1}]), ("interventions[0].theme_officiel", "not_a_text")), (changed(interventions=[{"seance": []}]), ("interventions[0].seance", "not_an_object")),
    (changed(interventions=[{"dossier": "x"}]), ("interventions[0].dossier", "not_an_object")), (changed(interventions=[{"source": 1}]), ("interventions[0].source", "not_an_object")), (changed(meta=None), ("meta", "not_an_object")), (changed(meta=[]), ("meta", "not_an_object")),
    (meta(genere_le="DROP"), ("meta.genere_le", "missing")), (meta(schema_version="0"), ("meta.schema_version", "version")), (meta(warnings=None), ("meta.warnings", "not_a_list")), (meta(provenance="x"), ("meta.provenance", "outside_domain")),
]


def test_every_rule(spark):
    docs = [GOOD, changed(chambres="DROP"), *[d for d, _ in BREAKING]]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "key int, x string").select("key", F.parse_json("x").alias("v"))
    ballots = spark.createDataFrame([("an:17:1", "adopte"), ("an:17:2", pivot_rules.FORCED), (None, "x")], "id string, outcome string")
    dims = {"votes": ballots, "amendements": spark.createDataFrame([("an:X",)], "id string")}
    expected = {(i + 2, *f) for i, (_, told) in enumerate(BREAKING) for f in (told if isinstance(told, list) else [told])}
    assert {(r.key, r.path, r.rule) for r in pivot_rules.findings(rows, "key", "v", dims).collect()} == expected
    # Without the dimensions nothing is told of references.
    alone = {(r.key, r.path, r.rule) for r in pivot_rules.findings(rows, "key", "v").collect()}
    assert alone == {e for e in expected if e[2] not in ("unknown", "forced_has_position")}
    assert pivot_rules.findings(rows.limit(0), "key", "v", dims).isEmpty()


def test_a_document_is_read_once_and_documents_are_dealt_to_all_tasks(spark):
    from lakemill.plans.validators import document_findings

    rows = spark.range(3).select("id", F.parse_json(F.lit("{}")).alias("v"))
    ballots = spark.createDataFrame([("an:17:1", "x")], "id string, outcome string")
    plan = pivot_rules.findings(rows, "id", "v", {"votes": ballots})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    sf_dir = "/root/testdata/sf0.001"
    plan = document_findings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert f"{4 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("days", [1, 30, 366, 5000])
def test_overlaps_against_all_pairs(spark, days):
    """One key has most of the intervals; open ends, single days, ends before starts and repeats are among them."""
    rng = random.Random(days)
    day = lambda: date(2000, 1, 1) + timedelta(rng.randrange(900))
    bound = lambda: rng.choice([None, *[day()] * 4])
    span = lambda: (f, None if f is None or rng.random() < 0.2 else f + timedelta(rng.choice([0, 1, 20, 400, -3]))) if (f := bound()) or rng.random() < 0.7 else (None, day())
    a = [(rng.choice([1, 1, 1, 2, None]), i, *span()) for i in range(80)]
    b = [(rng.choice([1, 1, 1, 2, 3, None]), i, *span()) for i in range(60)]
    b += b[:3]
    lo, hi = date.min, date.max
    want = []
    for k, x, f, e in a:
        for q, y, g, h in b:
            if k is not None and k == q and (f or lo) <= (e or hi) and (g or lo) <= (h or hi) and (f or lo) <= (h or hi) and (g or lo) <= (e or hi):
                first, last = max(f or lo, g or lo), min(e or hi, h or hi)
                want.append((k, x, y, None if first == lo else first, None if last == hi else last))
    found = overlap_join(spark.createDataFrame(a, "k int, x int, first date, last date"), spark.createDataFrame(b, "k int, y int, first date, last date"), ["k"], days=days)
    assert found.columns == ["k", "x", "y", "first", "last"]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))


def test_common_days_become_periods(spark):
    a = spark.createDataFrame([("m", 1, date(2000, 1, 1), date(2000, 3, 1)), ("m", 1, date(2000, 3, 2), None)], "member string, k int, first date, last date")
    b = spark.createDataFrame([(1, "p", date(2000, 2, 1), date(2000, 2, 20)), (1, "p", date(2000, 2, 21), date(2001, 1, 1))], "k int, position string, first date, last date")
    found = islands(overlap_join(a, b, ["k"]), ["member", "position"], "first", "last").collect()
    assert [tuple(r) for r in found] == [("m", "p", date(2000, 2, 1), date(2001, 1, 1), 3)]
