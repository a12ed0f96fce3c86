"""Licence scans: the projection against the numpy classifier over a whole table, wrapped and mixed notices, calibration."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import licenses

SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def classifier():
    return licenses.fit()


def brute(c, text, confirm=0.5, also=0.9):
    """Findings of one text by loops: (line, family, predicted, lines, text, others), with probability and overlap."""
    lines, content = (text or "").split("\n"), set(licenses.content_words())
    best = []
    for i, line in enumerate(lines):
        if not content & set(licenses.tokens(line)):
            continue
        options = []
        for n in range(1, licenses.LINES + 1):
            group = lines[i : i + n]
            if len(group) < n or not all(x.strip(" ") for x in group):
                continue
            words = [w for x in group for w in licenses.tokens(x)]
            said = [w for x in group for w in content & set(licenses.tokens(x))]
            if len(said) + sum(bool(licenses._TALK.search(w)) for w in said) < 2:
                continue
            there, z = set(licenses.grams(words)), np.array(c.bias)
            for g in there & c.weights.keys():
                z = z + np.array(c.weights[g])
            p = np.exp(z / c.temperature - (z / c.temperature).max())
            p /= p.sum()
            predicted = c.classes[int(p.argmax())]
            shared = {f: max(len(there & set(g)) / len(g) for g in map(licenses.grams, map(licenses.tokens, ts))) for f, ts in licenses.TEMPLATES.items()}
            most, _, family = max(((shared[f], q, f) for f, q in zip(c.classes, p, strict=True) if f in shared and q >= c.threshold), default=(0.0, 0, None))
            sure = predicted in shared and most >= confirm
            others = sorted(f for f, v in shared.items() if v >= also and f != family) if sure else []
            options.append((i + 1, family if sure else "unknown", predicted, n, "\n".join(group), others, float(p.max()), most))
        if options:
            best.append(max((o for o in options if o[1] != "unknown"), key=lambda o: (o[7], -o[3]), default=options[0]))
    best = [b for b in best if b[2] != "none" and (b[3] == 1 or b[1] != "unknown")]
    held = lambda k, b: any(k - d >= 0 and best[k - d][1] != "unknown" and best[k - d][0] + best[k - d][3] > b[0] and b[1] in ("unknown", best[k - d][1]) for d in (1, 2))
    return [b for k, b in enumerate(best) if not held(k, b)]


def scanned(spark, c, rows):
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"line": F.lit(1), "words": F.lit("clash")}), c)
    return {r.doc_id: r.findings for r in found.collect()}


def agree(found, want):
    assert [(f.line, f.family, f.predicted, f.lines, f.text, sorted(f.others)) for f in found] == [w[:6] for w in want]
    assert all(abs(f.probability - w[6]) < 1e-9 and abs(f.overlap - w[7]) < 1e-9 for f, w in zip(found, want, strict=True))


@pytest.mark.skipif(not os.path.exists(SF), reason="the synthetic tables are not here")
def test_the_whole_table_against_the_numpy_classifier(spark, classifier):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SF).select("doc_id", "text").collect()]
    found = scanned(spark, classifier, rows)
    assert len(found) == len(rows) and any(found.values())
    for i, text in rows:
        agree(found[i], brute(classifier, text))


def test_wrapped_notices(spark, classifier):
    texts = {
        "bsd": "Redistribution and use in source and binary forms,\nwith or without modification, are permitted\nprovided that the following conditions are met:",
        "cc-by-sa": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
        "mit": "Copyright (c) 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files",
        "apache": "Licensed under the Apache\nLicense, Version 2.0",
        "gpl": "it under the terms of the GNU General\nPublic License as published by the Free\nSoftware Foundation",
    }
    found = scanned(spark, classifier, [(i, "plain\n\n" + t + "\n\nplain") for i, t in enumerate(texts.values())])
    for i, (family, text) in enumerate(texts.items()):
        assert {f.family for f in found[i]} - {"unknown"} == {family}, text
        agree(found[i], brute(classifier, "plain\n\n" + text + "\n\nplain"))


def test_one_line_that_names_two(spark, classifier):
    text = "Released under the MIT License, or licensed under the Apache License, Version 2.0."
    found = scanned(spark, classifier, [(1, text)])[1]
    assert {f.family for f in found} | {o for f in found for o in f.others} == {"mit", "apache"}


def test_other_prose_is_no_finding(spark, classifier):
    rows = [(i, t) for i, t in enumerate(["They work at the general office.", "The public source of the river is free.", "Any person may copy the list.", None, "", "\n\n \n"])]
    assert [f for f in scanned(spark, classifier, rows).values() if f] == []


def test_every_notice_passes_the_lookup_filter():
    content = set(licenses.content_words())
    assert all(len(content & set(licenses.tokens(t))) >= 2 for ts in licenses.TEMPLATES.values() for t in ts)


def test_families_of_kept_out_notices_are_told(classifier):
    """The calibrated unknown: notices that a fit has not seen are named rightly or not at all, mostly rightly."""
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts]
    told = [(f, classifier.classes[int(classifier.probabilities("note: " + t + " today").argmax())]) for f, t in notices]
    assert sum(f == p for f, p in told) >= 0.95 * len(told)
    assert 0 < classifier.threshold < 1


def test_odd_tables(spark, classifier):
    rows = [(None, "Released under the MIT License."), (None, None), (3, "Released under the MIT License."), (3, "Released under the MIT License."), (4, "license " * 50_000)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), classifier).collect()
    assert sorted((str(r.doc_id), r.n_paragraphs) for r in found) == [("3", 1), ("3", 1), ("4", 1), ("None", 0), ("None", 1)]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"), classifier).count() == 0
