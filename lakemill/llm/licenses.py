"""Licence scans: a trained paragraph classifier whose predictions templates confirm, applied by SQL functions only.

The classifier is a multinomial logistic regression over the word one-, two- and three-grams of licence notices. It is
fit in numpy on the driver, on variants of the notices below (words left out, set among others, two in a row), which is
all its training data. Some notices of each family are kept out of a first fit: on their variants its temperature is
calibrated, and the probability below which a family is not believed; the final fit takes them in. Class `unknown` is talk of licences that fits no
family, class `none` is other prose; the classifier, not a list of key words, decides what is talk of licences at all.

A text's paragraphs end at blank lines. In each, every line and the groups of up to three lines that begin with it are
classified, so a notice is found as well if it is wrapped. Every notice has two content words or more, and so has every
group of lines that is looked up; a word for licences, copyright or permission counts as two. Applied, the classifier is a table from gram to class weights inside
one projection.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import text_or_empty

#: Notices by which licence families are declared, as their publishers word them. Every third notice of a
#: family, counted from the second, is kept for calibration.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": ("licensed under the gnu affero general public license version 3", "under the terms of the gnu affero general public license as published by the free software foundation", "spdx-license-identifier agpl-3.0"),
    "apache": ("licensed under the apache license version 2.0", "released under the apache license", "you may not use this file except in compliance with the license", "you may obtain a copy of the license at http www.apache.org licenses license-2.0", "spdx-license-identifier apache-2.0"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "licensed under the bsd license",
        "use of this source code is governed by a bsd-style license that can be found in the license file", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "released under the 3-clause bsd license", "spdx-license-identifier bsd-3-clause",
    ),
    "cc-by": ("this work is licensed under a creative commons attribution 4.0 international license", "licensed under cc by 4.0", "available under the creative commons attribution license"),
    "cc-by-nc": ("this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "licensed under cc by-nc 4.0", "creative commons attribution noncommercial license"),
    "cc-by-sa": ("this work is licensed under a creative commons attribution-sharealike 4.0 international license", "licensed under cc by-sa 4.0", "creative commons attribution sharealike license"),
    "cc0": ("dedicated to the public domain under cc0 1.0", "this is free and unencumbered software released into the public domain", "to the extent possible under law the author has waived all copyright and related rights"),
    "gpl": (
        "this work is licensed under the gnu general public license version 3", "released under the gnu gpl", "under the terms of the gnu general public license as published by the free software foundation",
        "you should have received a copy of the gnu general public license along with this program", "spdx-license-identifier gpl-3.0",
    ),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "licensed under the isc license", "spdx-license-identifier isc"),
    "lgpl": ("licensed under the gnu lesser general public license version 3", "under the terms of the gnu lesser general public license as published by the free software foundation", "spdx-license-identifier lgpl-3.0"),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "licensed under the mit license",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "released under the mit license", "available under the terms of the mit license", "spdx-license-identifier mit",
    ),
    "mpl": ("subject to the terms of the mozilla public license version 2.0", "licensed under the mozilla public license", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0"),
    "proprietary": ("all rights reserved no part of this publication may be reproduced", "proprietary and confidential", "unauthorized copying of this file is strictly prohibited"),
}
#: Talk of licences that names no family, for the class `unknown`.
UNKNOWN = (
    "licensed under the terms of the agreement", "see the license for details", "used with the permission of the author", "a driving license is required",
    "the licence was revoked by the court", "copyright belongs to its owner", "no warranty is given", "released under a custom license", "a public license of some kind",
    "the software is distributed under other terms", "ask for permission before you copy this", "the publisher holds the copyright", "they lost their license last year", "an unlicensed copy was found",
)
#: Other prose that shares words with notices, for the class `none`.
NONE = (
    "they work at home in general", "use the file on the table", "any person may come in", "the software was late again", "all parts of the list are included", "copy the text by hand and read it",
    "free the birds", "a large portion of the public was present", "the source of the river", "the purpose of this document is plain", "forms are available at the door", "you can find one at the shop",
    "the commons met in the domain of the king", "an international conference on version control", "the conditions were met with related notice", "no part of the program was reproduced", "provided that it rains", "the foundation published a report in march",
    "possible under the circumstances", "each author received two copies", "creative people share alike", "it was distributed to all members without charge", "the extent of the law is not known",
)
FUNCTION_WORDS = frozenset("a an and any all are as at be been by can for found from has have if in is it its may must no not of on one or or other shall should that the their they this to under was were with without you your".split())
LINES = 3
_TALK = re.compile("licen|copyright|permi|warranty|rights|redistribut")
_WORD = r"[^a-z0-9.+-]+"


def tokens(paragraph: str) -> list[str]:
    return [w for w in (x.strip(".-+") for x in re.split(_WORD, paragraph.lower())) if w]


def grams(words: list[str], most: int = 3) -> list[str]:
    return sorted({" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)})


def content_words() -> list[str]:
    """The words of notices and of talk about licences that are no function words; every notice has two or more."""
    talk = {w for t in UNKNOWN for w in tokens(t) if _TALK.search(w)}
    return sorted({w for ts in TEMPLATES.values() for t in ts for w in tokens(t)} - FUNCTION_WORDS | talk)


@dataclass
class Classifier:
    """weights: by gram one weight for each class; bias: of each class. The last two classes are `none` and `unknown`."""

    classes: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    threshold: float

    def probabilities(self, paragraph: str) -> np.ndarray:
        z = np.array(self.bias) + sum((np.array(self.weights[g]) for g in grams(tokens(paragraph)) if g in self.weights), np.zeros(len(self.bias)))
        z = z / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def _kept_out(k: int) -> bool:
    return k % 3 == 1


def _variants(rng: np.random.Generator, each: int, part: str) -> tuple[list[list[str]], list[int]]:
    """Token rows and classes: variants of the notices that are kept for calibration, of the others, or of all."""
    names = [*sorted(TEMPLATES), "none", "unknown"]
    filler = sorted({w for t in (*UNKNOWN, *NONE) for w in t.split()} | set("work text document author page published please note here file".split()))
    x, y = [], []
    for k, name in enumerate(names):
        sources = {"none": NONE, "unknown": UNKNOWN}.get(name) or TEMPLATES[name]
        sources = [tokens(t) for i, t in enumerate(sources) if part == "all" or _kept_out(i) == (part == "kept")]
        for i in range(each * (len(sources) if name in TEMPLATES else 4)):
            words = [*sources[i % len(sources)], *(sources[rng.integers(len(sources))] if rng.random() < 0.2 else [])]
            kept = [w for w in words if rng.random() > 0.1] or words
            around = lambda: [filler[i] for i in rng.integers(len(filler), size=rng.integers(0, 8))]
            x.append([*around(), *kept, *around()] if name != "unknown" or rng.random() < 0.7 else kept)
            y.append(k)
    # A single content word of a notice is too little to tell the family, and a few of them far apart in other prose say
    # nothing of licences unless the word is one for them.
    heads = content_words()
    plain = [w for w in heads if not _TALK.search(w)]
    for _ in range(0 if part == "kept" else 4 * each):
        x.append([heads[rng.integers(len(heads))]])
        y.append(len(names) - 1)
        words = [filler[i] for i in rng.integers(len(filler), size=rng.integers(5, 14))]
        words = [w for w in words if not _TALK.search(w)]
        for _ in range(rng.integers(1, 5)):
            words.insert(rng.integers(len(words) + 1), plain[rng.integers(len(plain))])
        x.append(words)
        y.append(len(names) - 2)
    return x, y


def _matrix(rows: list[list[str]], number: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(rows), len(number)), np.float32)
    for i, words in enumerate(rows):
        out[i, [number[g] for g in grams(words) if g in number]] = 1
    return out


def _descent(a: np.ndarray, y: list[int], classes: int, epochs: int, rate: float, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of the logistic regression, by gradient descent."""
    hot, rate, decay = np.eye(classes, dtype=np.float32)[y], np.float32(rate), np.float32(decay)
    w, b = np.zeros((a.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    for _ in range(epochs):
        z = a @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= rate * (a.T @ (p - hot) / np.float32(len(y)) + decay * w)
        b -= rate * (p - hot).mean(axis=0)
    return w, b


def fit(each: int = 40, epochs: int = 300, rate: float = 4.0, decay: float = 1e-4, seed: int = 3) -> Classifier:
    """Fit on the notices that are not kept out, calibrate on variants of those that are, then fit on all with that
    temperature and threshold; the same parameters give the same classifier."""
    rng, classes = np.random.default_rng(seed), [*sorted(TEMPLATES), "none", "unknown"]
    notices = [*TEMPLATES.values(), UNKNOWN, NONE]
    number = {g: i for i, g in enumerate(sorted({g for ts in notices for t in ts for g in grams(tokens(t))} | set(content_words())))}
    x, y = _variants(rng, each, "others")
    w, b = _descent(_matrix(x, number), y, len(classes), epochs, rate, decay)
    x, y = _variants(rng, each, "kept")
    z, y = _matrix(x, number) @ w + b, np.array(y)

    def loss(t: float) -> float:
        q = z / t
        q = q - q.max(axis=1, keepdims=True)
        return float(-(q - np.log(np.exp(q).sum(axis=1, keepdims=True)))[np.arange(len(y)), y].mean())

    temperature = min(np.linspace(0.3, 3, 28), key=loss)
    p = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    p /= p.sum(axis=1, keepdims=True)
    # The probability below which a family is not believed: what 19 of 20 right predictions of families reach, on notices
    # that the fit has not seen.
    right = (p.argmax(axis=1) == y) & (y < len(classes) - 2)
    threshold = float(np.quantile(p.max(axis=1)[right], 0.05)) if right.any() else 0.5
    x, y = _variants(rng, each, "all")
    w, b = _descent(_matrix(x, number), y, len(classes), epochs, rate, decay)
    return Classifier(classes, {g: [round(float(v), 6) for v in w[i]] for g, i in number.items()}, [round(float(v), 6) for v in b], float(temperature), threshold)


def _sql_grams(words: Column, most: int = 3) -> Column:
    def runs(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, each).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(n) for n in range(1, most + 1)]))


def _lookup(weights: dict[str, list[float]], parts: int = 512) -> tuple[Column, Column]:
    """The weights as an array of small maps, dealt by checksum, since a map is searched from its front; and their number."""
    dealt: list[dict[str, list[float]]] = [{} for _ in range(parts)]
    for g, w in weights.items():
        dealt[crc32(g.encode()) % parts][g] = w
    return _constant(dealt, "array<map<string,array<double>>>"), F.lit(parts)


def _constant(value: object, kind: str) -> Column:
    """A constant, written as one string, which the optimizer reads once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(docs: DataFrame, classifier: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text", confirm: float = 0.5, also: float = 0.9) -> DataFrame:
    """(doc_id, n_paragraphs, findings), one row for each row of docs, over all lines of the whole text.

    findings is array<struct<line, family, probability, predicted, overlap, text, lines, others>>: what speaks of
    licences, by its first line and number of lines, with its family, the calibrated probability of the likeliest class
    (predicted) and the best template overlap. Of the families whose probability reaches the threshold that one is named
    whose template is there most, if at least `confirm` of its grams are; else, or if no family is likeliest, `unknown`. Of the groups that begin with a line that one counts that names a family with the most template overlap, the
    shortest of equals, and else the line alone; a line inside a named group is no finding of its own unless it names another family. others are further
    families of which a whole template (`also` of its grams) is there. Null and empty texts have no findings; ids are
    carried through, also null and repeated ones; an empty table gives an empty result; other columns of docs are not
    read.
    """
    c = classifier or fit()
    families = len(c.classes) - 2
    table, parts = _lookup(c.weights)
    words = lambda x: F.regexp_extract_all(F.lower(x), F.lit(r"[a-z0-9](?:[a-z0-9.+-]*[a-z0-9])?"), F.lit(0))  # noqa: E731  as tokens()
    content = _constant(content_words(), "array<string>")
    lines = F.transform(F.split(text_or_empty(text_col), "\n"), lambda x, i: F.struct((i + 1).alias("line"), x.alias("text"), words(x).alias("words")))
    rows = docs.select(F.col(id_col).alias("doc_id"), lines.alias("lines"))
    rows = rows.select("doc_id", F.transform("lines", lambda x: F.struct(x["line"].alias("line"), x["text"].alias("text"), x["words"].alias("words"), F.array_intersect(x["words"], content).alias("content"))).alias("lines"))
    said = lambda x: F.size(x["content"]) + F.size(F.filter(x["content"], lambda w: w.rlike(_TALK.pattern)))
    rows = rows.select("doc_id", F.transform("lines", lambda x: F.struct(x["line"].alias("line"), x["text"].alias("text"), x["words"].alias("words"), said(x).alias("said"))).alias("lines"))
    rows = rows.select("doc_id", "lines", F.filter("lines", lambda x: x["said"] > 0).alias("starts"))
    names = F.array(*[F.lit(n) for n in c.classes])
    start = F.array(*[F.lit(v) for v in c.bias])

    def windows(x: Column) -> Column:
        """The groups of lines that begin with x and do not pass a blank line."""
        inside = lambda n: (x["line"] + n - 1 <= F.size("lines")) & F.forall(F.slice("lines", x["line"], n), lambda y: F.btrim(y["text"]) != "")
        enough = lambda n: F.aggregate(F.slice("lines", x["line"], n), F.lit(0), lambda a, y: a + y["said"]) >= 2
        lengths = F.filter(F.array(*[F.lit(n) for n in range(1, LINES + 1)]), lambda n: inside(n) & enough(n))
        return F.transform(lengths, lambda n: F.struct(x["line"].alias("line"), n.alias("lines"), F.slice("lines", x["line"], n).alias("of")))

    def found(x: Column) -> Column:
        return F.struct(x["line"].alias("line"), x["lines"].alias("lines"), F.array_join(F.transform(x["of"], lambda y: y["text"]), "\n").alias("text"), F.flatten(F.transform(x["of"], lambda y: y["words"])).alias("words"))

    def gathered(x: Column) -> Column:
        return F.struct(x["line"].alias("line"), x["lines"].alias("lines"), x["text"].alias("text"), _sql_grams(x["words"]).alias("grams"))

    def logits(x: Column) -> Column:
        hits = F.filter(F.transform(x["grams"], lambda g: F.try_element_at(F.element_at(table, (F.crc32(g) % parts + 1).cast("int")), g)), lambda w: w.isNotNull())
        z = F.transform(F.aggregate(hits, start, lambda a, w: F.zip_with(a, w, lambda u, v: u + v)), lambda v: v / c.temperature)
        return F.struct(x["line"].alias("line"), x["lines"].alias("lines"), x["text"].alias("text"), x["grams"].alias("grams"), z.alias("z"))

    def overlap(there: Column, name: str) -> Column:
        wanted = [grams(tokens(t)) for t in TEMPLATES[name]]
        return F.greatest(F.lit(0.0), *[F.size(F.array_intersect(there, _constant(p, "array<string>"))) / float(len(p)) for p in wanted])

    def decide(x: Column) -> Column:
        top = F.array_max(x["z"])
        return F.struct(
            x["line"].alias("line"), x["lines"].alias("lines"), x["text"].alias("text"), F.array_position(x["z"], top).cast("int").alias("best"),
            (1 / F.aggregate(x["z"], F.lit(0.0), lambda a, z: a + F.exp(z - top))).alias("probability"),
            F.array(*[overlap(x["grams"], n) for n in c.classes[:families]], F.lit(0.0), F.lit(0.0)).alias("overlaps"), x["z"].alias("z"), top.alias("top"),
        )

    def name(x: Column) -> Column:
        predicted = F.element_at(names, x["best"])
        # Of the families that are believed, the one whose template is there most; the likelier one of equals.
        rank = F.zip_with(F.slice(x["overlaps"], 1, families), F.slice(x["z"], 1, families), lambda o, z: F.when(F.exp(z - x["top"]) * x["probability"] >= c.threshold, F.struct(o.alias("o"), z.alias("z"))))
        rank = F.transform(rank, lambda r, i: F.when(r.isNotNull(), F.struct(r["o"].alias("o"), r["z"].alias("z"), i.alias("i"))))
        first = F.array_max(rank)
        shared, family = F.coalesce(first["o"], F.lit(0.0)), F.element_at(names, first["i"] + 1)
        sure = F.coalesce((x["best"] <= families) & (shared >= confirm), F.lit(False))
        whole = F.filter(F.zip_with(names, x["overlaps"], lambda n, o: F.when(o >= also, n)), lambda n: n.isNotNull() & (n != family))
        return F.struct(
            x["line"].alias("line"), F.when(sure, family).otherwise("unknown").alias("family"), x["probability"].alias("probability"),
            predicted.alias("predicted"), shared.alias("overlap"), x["text"].alias("text"), x["lines"].alias("lines"), F.when(sure, whole).otherwise(F.array().cast("array<string>")).alias("others"),
        )

    step = lambda f: F.transform("starts", lambda x: F.transform(x, f))
    rows = rows.select("doc_id", F.transform("starts", windows).alias("starts"))
    for f in (found, gathered, logits, decide, name):
        rows = rows.select("doc_id", step(f).alias("starts"))
    sure = lambda x: x["family"] != "unknown"
    fullest = lambda x: F.array_max(F.transform(F.filter(x, sure), lambda y: F.struct(y["overlap"].alias("overlap"), (-y["lines"]).alias("short"), y.alias("y"))))["y"]
    best = F.transform("starts", lambda x: F.coalesce(fullest(x), F.get(x, F.lit(0))))
    rows = rows.select("doc_id", F.filter(best, lambda x: x.isNotNull() & ((x["lines"] == 1) | sure(x)) & (x["predicted"] != "none")).alias("f"))

    def inside(x: Column, i: Column) -> Column:
        """Whether a named group that begins one or two lines before holds x, and x says nothing else."""
        held = [(F.get("f", i - k)["family"] != "unknown") & (F.get("f", i - k)["line"] + F.get("f", i - k)["lines"] > x["line"]) & (~sure(x) | (x["family"] == F.get("f", i - k)["family"])) for k in range(1, LINES)]
        return F.coalesce(held[0], F.lit(False)) | F.coalesce(held[1], F.lit(False))

    rows = rows.select("doc_id", F.filter("f", lambda x, i: ~inside(x, i)).alias("findings"))
    return rows.select("doc_id", F.size("findings").cast("long").alias("n_paragraphs"), "findings")
