"""Fill-in-middle: marks against a plain scan, outputs against patterns, exact restoring, odd tables."""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemill.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by patterns."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x08\x0e\x1f!aé日😀\x00\x7f ", max_size=40), max_size=12))
def test_marks_are_those_of_a_plain_scan(texts):
    raw = [t.encode() for t in texts]
    sizes = np.array([len(b) for b in raw], np.int64)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    ends, points = fim.unit_ends(np.frombuffer(b"".join(raw), np.uint8), starts, stops)
    assert (ends.rank(stops) - ends.rank(starts)).tolist() == [len(UNIT.findall(t)) for t in texts]
    assert (points.rank(stops) - points.rank(starts)).tolist() == [len(t) for t in texts]
    for t, start in zip(texts, starts.tolist(), strict=True):
        lengths = np.cumsum([len(u.encode()) for u in UNIT.findall(t)])
        k = ends.rank(np.array([start]))[0] + np.arange(1, len(lengths) + 1)
        assert (ends.select(k) + 1 - start).tolist() == lengths.tolist()


def test_outputs_and_restored_texts(spark):
    texts = [
        "", None, " ", "one", " one", "one ", "a b c d e f g h", "tabs\tand\nlines \r\n\x0b\x0c end \n", "no <P> here", "half <P", "<S", "<M>", "> a <", "é 日本 語 😀 x", "nul\x00 \x00 b",
        "long " * 40_000, "x" * 300_000, " \n" * 1000, "a b c d",
    ]
    rows = [(i * 31 + k, t) for k in range(8) for i, t in enumerate(texts)] + [(None, "null id a b c"), (2**62 + 1, "large id a b c"), (5, "same a b"), (5, "same a b"), (5, "other a b c")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, form string, h1 int").repartition(5)
    found = fim.transform(df).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=key) == sorted(((i, *plain(i, t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.back) for r in found), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert all(sha256(r.back.encode()).hexdigest() == r.text_sha256 for r in found)


def test_bytes_that_are_not_utf8_stay(spark):
    df = spark.range(60).selectExpr("id AS doc_id", "cast(x'61FF2062E9200A63' AS string) AS text")
    found = fim.transform(df)
    assert found.where("n <> 3").isEmpty()
    out = found.select("form", F.col("output").cast("binary").alias("output")).collect()
    assert all(sorted(bytes(r.output).replace(b"<P>", b"").replace(b"<S>", b"").replace(b"<M>", b"")) == sorted(b"a\xff b\xe9 \nc") for r in out)


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).isEmpty()
