"""Toxicity by a weighted finite-state grammar over clauses.

Words are first mapped to symbols: insult and threat words, targets (who is spoken to), negations, verbs of reporting.
Small transducers then rewrite a clause's symbols and mark what is matched, each knowing one thing only: a negation
reaches what soon follows it, reported speech its clause, a target the insult near it; a threat without a target is
none. They are composed into one machine, whose steps multiply the marks. What a mark is worth is learned together with
the curve that turns the weight of a text's matches into a probability: a factor near 1 if the labels know no
difference between, say, denied insults and others, near 0 if texts that only deny insults are clean.

Insults are learned as whole words and as beginnings of words, since languages that inflect and compound have them in
many rare forms: those that labelled toxic texts hold so much more often than others that chance does not explain it,
given how many were looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import cut, fold, small_batches

#: The closed classes of the grammar in English, German, French and Spanish.
TARGETS = "you your yours yourself u he him she her they them du dich dir dein ihr euch sie er tu te toi vous il elle ils tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not no never nor without isn't aren't don't nicht kein keine nie ohne pas ne jamais sans nunca sin jamás".split()
REPORTS = "said says say wrote writes quoted called calls claimed according sagte sagt schrieb nannte dit disait écrit selon dijo dice escribió llamó según".split()
THREATS = (
    "kill kills killed killing murder murders murdered murdering hurt hurts hurting destroy destroys destroyed destroying attack attacks attacked attacking "
    "shoot shoots shot shooting stab stabs stabbed stabbing burn burns burned burnt burning "
    "töten töte tötest tötet getötet umbringen umgebracht schlagen schlage schlägst schlägt geschlagen "
    "tuer tue tues tuez tuent tuerai tuerons frapper frappe frappes frappez frapperai brûler brûle brûles brûlez brûlerai "
    "matar mato matas mata matan mataré mataremos golpear golpeo golpeas golpea golpearé quemar quemo quemas quema quemaré"
).split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END = "ITYNRO."
#: What targeted() puts out besides: a threat that waits for its target, a target that releases one, that makes the insult
#: before it stronger, that does both.
HELD, RELEASED, BOOST, BOTH = "HLBX"
#: Marks on a match. They multiply as sets: a match has all marks that the machines on its way gave it.
TARGETED, NEGATED, REPORTED, THREATENED, MARKS = 1, 2, 4, 8, 16
#: A word, for learning as for scoring: letters and digits, with one apostrophe between them.
_WORD, _TOKEN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)?", re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n]")
#: Beginnings of words that are looked at, in letters.
SHORTEST, LONGEST = 5, 12


@dataclass(frozen=True)
class Transducer:
    """step(state, symbol) gives the next state, the symbol put out and the marks on the match that it is part of."""

    start: object
    step: Callable[[object, str], tuple[object, str, int]]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that runs b over what a puts out; marks multiply. Steps that were taken once are remembered."""
    known: dict[tuple[object, str], tuple[object, str, int]] = {}

    def step(state: tuple[object, object], symbol: str) -> tuple[object, str, int]:
        found = known.get((state, symbol))
        if found is None:
            p, middle, u = a.step(state[0], symbol)
            q, out, v = b.step(state[1], middle)
            found = known[state, symbol] = ((p, q), out, u | v)
        return found

    return Transducer((a.start, b.start), step)


def negation(reach: int = 3) -> Transducer:
    """Marks insults and threats within reach of a negation; a threat that waits for its target is marked where it stood."""

    def step(state: tuple[int, bool], symbol: str) -> tuple[tuple[int, bool], str, int]:
        left, held = state
        denied = held if symbol in (RELEASED, BOTH) else left > 0 and symbol in (INSULT, THREAT)
        held = left > 0 if symbol == HELD else held
        return (reach if symbol == NEGATION else 0 if symbol == END else max(0, left - 1), held), symbol, NEGATED * denied

    return Transducer((0, False), step)


def reported() -> Transducer:
    """Marks what follows a verb of reporting in its clause."""

    def step(on: bool, symbol: str) -> tuple[bool, str, int]:
        return (on or symbol == REPORT) and symbol != END, symbol, REPORTED * (on and symbol in (INSULT, THREAT, RELEASED, BOTH))

    return Transducer(False, step)


def targeted(reach: int = 4, after: int = 3) -> Transducer:
    """Marks an insult near a target; a threat without a target near it is no threat.

    The target stands up to reach symbols before in the clause, or up to `after` symbols behind: then the threat is held
    and the target releases it, and an insult is marked late (BOOST). A threat that begins its clause has no one who
    utters it and is not held.
    """

    def step(state: tuple[int, int, int, bool], symbol: str) -> tuple[tuple[int, int, int, bool], str, int]:
        left, held, insulted, begun = state
        if symbol == END:
            return (0, 0, 0, False), END, 0
        near, out = left > 0, symbol
        if symbol == TARGET:
            out = BOTH if held and insulted else RELEASED if held else BOOST if insulted else TARGET
            return (reach, 0, 0, True), out, THREATENED * bool(held)
        held, insulted = max(0, held - 1), max(0, insulted - 1)
        if symbol == THREAT and not near:
            out = HELD if begun else OTHER
            held = after if begun else held
        elif symbol == INSULT:
            insulted = 0 if near else after
        return (max(0, left - 1), held, insulted, True), out, TARGETED * (near and symbol == INSULT) | THREATENED * (out == THREAT)

    return Transducer((0, 0, 0, False), step)


@dataclass
class Grammar:
    """weights: by insult its weight; a key that ends in * is the beginning of words. factors: by mark what it multiplies
    a match's weight with. slope and offset: of the logistic curve over log(1 + weight of a text)."""

    weights: dict[str, float]
    factors: dict[int, float] = field(default_factory=lambda: {TARGETED: 1.5, NEGATED: 0.5, REPORTED: 0.6, THREATENED: 1.0})
    slope: float = 4.0
    offset: float = -4.0
    closed: dict[str, str] = field(default_factory=lambda: {w: s for ws, s in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT), ([".", "!", "?", ";", ":", "\n"], END)) for w in ws})
    known: dict[str, tuple[str, float]] = field(default_factory=dict, repr=False)

    def machine(self) -> Transducer:
        return reduce(compose, (targeted(), negation(), reported()))

    def symbol(self, word: str) -> tuple[str, float]:
        """The symbol of a word, and its weight if it is an insult: that of the word itself, else of its longest known
        beginning. A bounded number of words is remembered."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 200_000:
                self.known.clear()
            keys = [word, *[word[:n] + "*" for n in range(min(len(word), LONGEST), SHORTEST - 1, -1)]]
            weight = next((self.weights[k] for k in keys if k in self.weights), None)
            found = self.known[word] = (self.closed.get(word, OTHER), 0.0) if weight is None else (INSULT, weight)
        return found

    def features(self, text: str, machine: Transducer) -> tuple[np.ndarray, int]:
        """By set of marks the weight of a text's matches that have just these marks, and how many clauses matched."""
        out, clauses = np.zeros(MARKS), 0
        symbols = [self.known.get(t) or self.symbol(t) for t in _TOKEN.findall(text.lower())]
        if not any(s == INSULT or s == THREAT for s, _ in symbols):
            return out, 0
        state, own, last = machine.start, [], 0
        for symbol, weight in [*symbols, (END, 0.0)]:
            state, put, marks = machine.step(state, symbol)
            if put == INSULT:
                last = len(own)
                own.append([marks, weight])
            elif put in (THREAT, RELEASED, BOTH):
                own.append([marks, 1.0])
            if put in (BOOST, BOTH) and own:
                own[last][0] |= TARGETED
            if put == END and own:
                for found, w in own:
                    out[found] += w
                clauses, own = clauses + 1, []
        return out, clauses

    def worth(self) -> np.ndarray:
        """By set of marks the product of its factors."""
        return np.array([np.prod([f for m, f in self.factors.items() if s & m]) for s in range(MARKS)])

    def weigh(self, text: str, machine: Transducer) -> tuple[float, int]:
        """The total weight of a text's matched clauses, and how many clauses matched."""
        found, clauses = self.features(text, machine)
        return float(found @ self.worth()), clauses

    def probability(self, weight: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(weight) + self.offset, -30, 30)))


def featured(grammar: Grammar, docs: DataFrame, text_col: str = "text") -> Column:
    """struct<features: array<double>, weight: double, clauses: long> of docs' whole texts; null and empty texts weigh 0."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    @F.pandas_udf("features array<double>, weight double, clauses long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        machine, worth = own.machine(), own.worth()
        for batch in batches:
            found = [own.features(x or "", machine) for x in batch]
            yield pd.DataFrame({"features": [f for f, _ in found], "weight": [float(f @ worth) for f, _ in found], "clauses": [n for _, n in found]})

    return run(F.make_valid_utf8(F.col(text_col)))


def insults_in(text: Column) -> Column:
    """The distinct words of a text of two letters or more, and their beginnings, marked by *."""
    found = F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)), lambda w: F.length(w) > 1))
    return F.array_distinct(F.flatten(F.transform(found, lambda w: F.concat(F.array(w), beginnings(w)))))


def beginnings(word: Column) -> Column:
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length(word), F.lit(LONGEST)))
    none = F.array().cast("array<string>")
    return F.when(F.length(word) < SHORTEST, none).otherwise(F.transform(lengths, lambda n: F.concat(F.left(word, n), F.lit("*"))))


def lexicon(rows: DataFrame, margin: float = 2.0, ratio: float = 3.0, least: int = 3, small: int = 200_000) -> dict[str, float]:
    """Insults of rows(text, toxic) with their weights: words, and beginnings that two words or more share.

    A word counts once for a text. It is taken if at least `least` toxic texts hold it, its log-likelihood ratio against
    chance is above the logarithm of the number of distinct words and beginnings plus a margin, and its share among
    toxic texts is ratio times that among others. Weights are 1 for the word of the median ratio and follow the
    logarithm of the ratio. Their number is bounded by the rows: each needs about (log of the distinct words) / (log of
    the share of toxic texts) toxic texts for itself. Those that toxic texts hold are joined by broadcast if they are no more than `small`.
    """
    sizes = rows.agg(F.sum(F.col("toxic").cast("double")).alias("toxic"), F.count("*").alias("all")).first()
    if not sizes["all"] or not sizes["toxic"] or sizes["toxic"] == sizes["all"]:
        return {}
    r = sizes["toxic"] / sizes["all"]
    each = rows.select("toxic", F.explode(insults_in(F.col("text"))).alias("word"))
    bad = each.where("toxic = 1").groupBy("word").agg(F.count("*").alias("k"))
    bad = cut(bad)
    shared = bad.where("word not like '%*'").select(F.explode(beginnings(F.col("word"))).alias("word")).groupBy("word").count().where("count > 1")
    able = bad.where(F.col("k") >= least)
    able = cut(able.where("word not like '%*'").union(able.join(shared.select("word"), "word", "left_semi")))
    distinct, candidates = bad.count(), able.count()
    counts = each.join(F.broadcast(able) if candidates <= small else able, "word").groupBy("word").agg(F.first("k").cast("double").alias("k"), F.count("*").cast("double").alias("n"))
    k, n = F.col("k"), F.col("n")
    part = lambda x, p: F.when(x > 0, x * F.log(x / (n * p))).otherwise(0.0)
    odds = F.log((k + 0.5) / (sizes["toxic"] + 1)) - F.log((n - k + 0.5) / (sizes["all"] - sizes["toxic"] + 1))
    scored = counts.select("word", (part(k, r) + part(n - k, 1 - r)).alias("sure"), odds.alias("odds")).where(F.col("odds") > float(np.log(ratio)))
    found = scored.where(F.col("sure") > float(np.log(distinct + 1)) + margin).orderBy("word").collect()
    middle = float(np.median([x["odds"] for x in found])) if found else 1.0
    return {x["word"]: x["odds"] / middle for x in found}


def calibrated(grammar: Grammar, features: np.ndarray, toxic: np.ndarray, steps: int = 400, trust: float = 1.0) -> Grammar:
    """The grammar with factors, slope and offset that fit the labels, by gradient steps on the log-likelihood.

    The logarithms of the factors, the slope and the offset are held back by a weak prior around where they start, so
    what the labels say nothing about stays as the grammar has it.
    """
    marks = sorted(grammar.factors)
    has = np.array([[bool(s & m) for m in marks] for s in range(MARKS)], float)
    start = np.array([*[np.log(grammar.factors[m]) for m in marks], grammar.slope, grammar.offset])
    precision = np.array([*[trust] * len(marks), 0.5, 0.5])
    p, first, second = start.copy(), np.zeros(len(start)), np.zeros(len(start))
    for t in range(1, steps + 1):
        worth = np.exp(has @ p[:-2])
        weight = features @ worth
        x = np.log1p(weight)
        wrong = 1 / (1 + np.exp(-np.clip(p[-2] * x + p[-1], -30, 30))) - toxic
        own = (features * worth) @ has * (p[-2] * wrong / (1 + weight))[:, None]
        g = np.array([*own.sum(0), (wrong * x).sum(), wrong.sum()]) + precision * (p - start)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        p = p - 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    factors = {m: float(np.exp(v)) for m, v in zip(marks, p, strict=False)}
    return Grammar(grammar.weights, factors, float(max(p[-2], 0.1)), float(p[-1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 20_000) -> Grammar:
    """A grammar learned from a sample of about sample_rows labelled rows, drawn by hash of the id.

    Rows without a label, id or text are not used. Without labels of both kinds the grammar has no insult words. The
    drawn ids are few by their bound, so they are broadcast and texts are read once and not shuffled; the drawn rows are
    written, and all that is learned is learned from them.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    n = marked.count()
    draw = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit("toxicity")), F.lit(1_000_000_007)) / 1_000_000_007
    drawn = marked.where(draw < min(1.0, sample_rows / max(n, 1)))
    rows = docs.select(F.col(id_col).alias("__id"), F.make_valid_utf8(F.col(text_col)).alias("text")).where("text is not null")
    rows = cut(rows.join(F.broadcast(drawn), "__id").select("text", "toxic"))
    grammar = Grammar(lexicon(rows))
    # Where no label speaks of threats, a threat weighs what the heaviest insult does at a target.
    grammar.factors[THREATENED] = grammar.factors[TARGETED] * max(grammar.weights.values(), default=1.0)
    learned = rows.select(featured(grammar, rows)["features"].alias("features"), "toxic").groupBy("features", "toxic").count().orderBy("features", "toxic").collect()
    if grammar.weights and learned:
        times = np.repeat(np.arange(len(learned)), [r["count"] for r in learned])
        grammar = calibrated(grammar, np.array([r["features"] for r in learned])[times], np.array([r["toxic"] for r in learned], float)[times])
    return grammar


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, weight, clauses), one row for each row of docs, from whole texts.

    Null and empty texts weigh nothing and get the score of any text without a match. Ids are carried through, also
    null and repeated ones; an empty table gives an empty result; other columns of docs are not read.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), featured(grammar, docs, text_col).alias("w")).select("doc_id", "w.weight", "w.clauses")
    curve = 1 / (1 + F.exp(-(F.lit(grammar.slope) * F.log1p("weight") + F.lit(grammar.offset))))
    return found.select("doc_id", curve.alias("score"), "weight", "clauses").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learned_and_scored(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """score() of all docs by a grammar learned from the labels outside the held-out fold; adds held_out."""
    grammar = fit(docs, labels.where(fold("doc_id", folds) != held))
    return score(docs, grammar).select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", "predicted", "weight", "clauses")
