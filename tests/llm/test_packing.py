"""Packing: best fit against a plain search, every id in one place, the library's ids, odd tables."""

from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from lakemill.llm import packing, queries
from test_llm_queries import SF

FILE = Path(queries.TOKENIZER)
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="the public vocabulary is not here")


@pytest.fixture(scope="module")
def json():
    return FILE.read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def library(json):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def checked(rows, expected, window=4096):
    """That rows hold each document of expected [(doc_id, ids)] once, cut without gaps, in sequences without gaps.
    The share of padding."""
    documents, places = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert sum(len(x) for _, x in expected) == sum(r.length for r in rows) and set(documents) == {i for i, _ in expected}
    for doc_id, ids in expected:
        at = 0
        for r in sorted(documents[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc32(np.array(ids[at : at + r.length], "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return 1 - sum(r.length for r in rows) / (window * len(places))


def test_best_fit_is_the_tightest_window():
    draw = random.Random(5)
    for window in (1, 7, 64, 4096):
        lengths = sorted((draw.randint(1, window) for _ in range(400)), reverse=True)
        found, offsets = packing.best_fit(lengths, window)
        left: list[int] = []
        for length, at, offset in zip(lengths, found, offsets, strict=True):
            fits = [c for c in left if c >= length]
            if at == len(left):
                assert not fits and offset == 0
                left.append(window)
            else:
                assert left[at] == min(fits) and offset == window - left[at]
            left[at] -= length


def test_words_give_the_librarys_ids(json, library):
    texts = [
        "", " ", "Hello  WORLD\n\tit's they'll 12345 £$%", "naïve café ́x Σίσυφος ΟΔΟΣ", "a<|endoftext|>b <|startoftext|> c", "x y z\u0085w",
        "日本語の文章 한국어 हिन्दी العربية", "word " * 3000, "q" * 5000, "İstanbul İ.x ΟΔΟΣ. a.b,c;d ab's.t don't! x.́ ŉ. ǅ!? ß:,", "e.̸ ;̸", "wor.d... .w ab,'s", "가 ̣̇", " lead and trail \r\n", "😀👍🏽 🇩🇪",
    ]
    words = packing.Words(json)
    for _ in range(2):
        ids, bounds = words.ids(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [library(t)[:-1] for t in texts]
    ids, bounds = words.ids(pa.array(texts).slice(2, 3))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [library(t)[:-1] for t in texts[2:5]]


def test_a_worker_forgets(json, library, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 50)
    words = packing.Words(json)
    for k in range(20):
        text = " ".join(f"word{k * 7 + j}" for j in range(15))
        assert words.ids(pa.array([text]))[0].tolist() == library(text)[:-1]
        assert len(words.young) <= 50 and len(words.old) <= 100


@pytest.mark.skipif(not Path(SF).is_dir(), reason="the synthetic tables are not here")
def test_op12_over_a_whole_table(spark, library):
    docs = [(r.doc_id, library(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert checked(queries.op12_packing(spark, SF).collect(), docs) < 0.02


def test_odd_rows_and_long_texts(spark, json, library):
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "Some text.", 5: "word " * 4095, 6: "word " * 4096, 7: "word " * 4094}
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, block string, draw int").repartition(3)
    rows = packing.pack(df, json).collect()
    checked(rows, [(i, library(t)) for i, t in texts.items()])
    assert sorted(r.length for r in rows if r.doc_id == 6) == [1, 4096] and [r.length for r in rows if r.doc_id in (5, 1)] in ([4096, 1], [1, 4096])


def test_repeated_rows_and_null_ids(spark, json, library):
    """Rows that repeat an id are documents of their own; ids beyond a double's digits stay exact beside null ones."""
    texts = [(None, "a b"), (None, "a b"), (2**60 + 1, "c"), *[(9, "copy of one text " * 40)] * 300]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), json, window=256, windows=2).collect()
    assert len(rows) == 303 and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 2**60 + 1 for r in rows) == 1
    assert sum(r.length for r in rows) == sum(len(library(t)) for _, t in texts)
    assert len({r.sequence_id >> 24 for r in rows}) > 20  # dealt over many blocks
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:], strict=False))


def test_empty_table_and_bad_bytes(spark, json, library):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), json).isEmpty()
    bad = spark.sql("SELECT 1 AS doc_id, cast(x'6120FF62' AS string) AS text")
    checked(packing.pack(bad, json).collect(), [(1, library("a �b"))])


def test_sequences_hold_the_ids(spark, json, library):
    texts = {i: f"text number {i} " * (i % 40) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    packed = packing.pack(df, json, window=128, windows=8, keep_ids=True)
    rows = packing.sequences(packed).collect()
    assert all(len(r.ids) == sum(r.lengths) <= 128 for r in rows)
    found = defaultdict(dict)
    starts = {(r.sequence_id, r.offset): r for r in packed.collect()}
    for r in rows:
        at = 0
        for n in r.lengths:
            piece = starts[r.sequence_id, at]
            found[piece.doc_id][piece.start] = r.ids[at : at + n]
            at += n
    assert {i: sum((x for _, x in sorted(p.items())), []) for i, p in found.items()} == {i: library(t) for i, t in texts.items()}
