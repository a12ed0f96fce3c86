"""Toxicity against plain versions: the lexicon, the machine's marks, factors that labels teach, odd tables."""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from lakemill.llm import toxicity

PLAIN = "alpha beta gamma delta epsilon zeta theta iota kappa lambda sigma omega".split()


def labelled(spark, rows):
    return spark.createDataFrame([(t, y) for t, y in rows], "text string, toxic int")


def brute_lexicon(rows, margin=2.0, ratio=3.0, least=3):
    """The same choice by loops: words and beginnings, log-likelihood against chance, share among toxic texts."""
    k, n, forms = {}, {}, {}
    for text, toxic in rows:
        held = {w for w in re.findall(r"[^\W_]+(?:'[^\W_]+)?", text.lower()) if len(w) > 1}
        starts = {w[:m] + "*" for w in held for m in range(5, min(len(w), 12) + 1)}
        for w in held | starts:
            n[w] = n.get(w, 0) + 1
            k[w] = k.get(w, 0) + toxic
        if toxic:
            for w in held:
                for m in range(5, min(len(w), 12) + 1):
                    forms.setdefault(w[:m] + "*", set()).add(w)
    size, bad = len(rows), sum(y for _, y in rows)
    share, distinct, found = bad / size, sum(v > 0 for v in k.values()), {}
    for w, a in k.items():
        if a < least or w.endswith("*") and len(forms[w]) < 2:
            continue
        part = lambda x, p: x * math.log(x / (n[w] * p)) if x else 0.0  # noqa: B023, E731
        odds = math.log((a + 0.5) / (bad + 1)) - math.log((n[w] - a + 0.5) / (size - bad + 1))
        if odds > math.log(ratio) and part(a, share) + part(n[w] - a, 1 - share) > math.log(distinct + 1) + margin:
            found[w] = odds
    middle = float(np.median(list(found.values()))) if found else 1.0
    return {w: o / middle for w, o in found.items()}


def texts(seed, size=400):
    """One in eight is toxic: an insult, a form of an insult's stem, sometimes an apostrophe."""
    rng, rows = random.Random(seed), []
    for i in range(size):
        words = [rng.choice(PLAIN) for _ in range(30)]
        if toxic := i % 8 == 0:
            words.insert(rng.randrange(30), rng.choice(["zonk", "frib", "ol'mug"]))
            words.insert(rng.randrange(30), "glarpo" + "".join(rng.choice("abcdefghij") for _ in range(3)))
        rows.append((" ".join(words) + rng.choice([".", " 'quoted' end", ""]), int(toxic)))
    return rows


def test_lexicon_is_the_brute_one(spark):
    rows = [*texts(1), ("", 0), ("zonk zonk ZONK", 1), ("'zonk'", 1)]
    found, want = toxicity.lexicon(labelled(spark, rows)), brute_lexicon(rows)
    assert found.keys() == want.keys() and {"zonk", "frib", "ol'mug", "glarpo*"} <= want.keys()
    assert all(abs(found[w] - want[w]) < 1e-9 for w in want)


def test_scores_are_the_machines_own(spark):
    rows = texts(2)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels)
    machine = grammar.machine()
    for r in toxicity.score(docs, grammar).collect():
        weight, clauses = grammar.weigh(rows[r.doc_id][0], machine)
        assert abs(r.weight - weight) < 1e-9 and r.clauses == clauses
        assert abs(r.score - float(grammar.probability(np.array(weight)))) < 1e-9 and r.predicted == int(r.score >= 0.7)
        assert r.predicted == rows[r.doc_id][1]


def test_unseen_forms_and_quoted_words_are_found(spark):
    rows = texts(3)
    grammar = toxicity.Grammar(toxicity.lexicon(labelled(spark, rows)))
    machine = grammar.machine()
    for text in ("a glarpoxyz b", "so 'zonk' he", "ol'mug"):
        assert grammar.weigh(text, machine)[0] > 0, text
    assert grammar.weigh("glar zon ol mug", machine) == (0.0, 0)


def test_labels_teach_what_a_negation_is_worth(spark):
    """Texts that only deny an insult are clean: their factor falls, and the verdict follows the grammar alone."""
    rng, rows = random.Random(4), []
    for i in range(900):
        words = [rng.choice(PLAIN) for _ in range(20)]
        words[10:10] = ["zonk"] if i % 3 == 0 else ["not", "a", "zonk"] if i % 9 == 1 else ["not", "a", "lambda"]
        rows.append((" ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels)
    assert grammar.factors[toxicity.NEGATED] < 0.35
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, grammar).collect()}
    assert all(found[i] == y for i, (_, y) in enumerate(rows))
    # Without the machine the denied ones are taken for insults.
    grammar.factors = dict.fromkeys(grammar.factors, 1.0)
    flat = {r.doc_id: r.predicted for r in toxicity.score(docs, grammar).collect()}
    assert sum(flat[i] != y for i, (_, y) in enumerate(rows)) == 100


def test_marks():
    g = toxicity.Grammar({"zonk": 1.0})
    m = g.machine()
    T, N, R, H = toxicity.TARGETED, toxicity.NEGATED, toxicity.REPORTED, toxicity.THREATENED
    for text, marks in [
        ("zonk", 0), ("you zonk", T), ("zonk you", T), ("not a zonk", N), ("you are not a zonk", T | N), ("he said a zonk", T | R), ("they wrote, long after all that, zonk", R),
        ("I will kill you", H), ("I will not kill you", H | N), ("she said she will kill them", H | R), ("not one two three four zonk", 0),
    ]:
        found, clauses = g.features(text, m)
        assert clauses == 1 and found[marks] == 1.0 and found.sum() == 1.0, text


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "zonk"), (None, None), (2, "zonk"), (2, "zonk")], "doc_id long, text string").withColumns({"toxic": F.lit("x"), "features": F.lit(1), "__id": F.lit(0)})
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (9, 1)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    grammar = toxicity.fit(docs, labels)
    assert grammar.weights == {}
    grammar.weights = {"zonk": 9.0}
    assert sorted((str(r.doc_id), r.predicted) for r in toxicity.score(docs, grammar).collect()) == [("1", 0), ("1", 0), ("2", 1), ("2", 1), ("None", 0), ("None", 1)]
    found = toxicity.learned_and_scored(docs.limit(0), labels.limit(0))
    assert found.count() == 0 and found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
