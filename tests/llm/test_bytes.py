"""Bytes that are no UTF-8, and the byte network against a plain convolution."""

from __future__ import annotations

import os

import numpy as np
import pytest

from lakemill.llm import exact_dedup, html_extract, language_id, near_dedup, pieces, queries, toxicity

BAD = "SELECT {id} AS doc_id, {id} AS page_id, 'http://a.b/c' AS url, cast(x'{text}' AS string) AS text"


def rows(spark, *texts):
    frame = None
    for i, text in enumerate(texts):
        one = spark.sql(BAD.format(id=f"{i}L", text=text.hex().upper()))
        frame = one if frame is None else frame.union(one)
    return frame


def test_op8_tells_texts_apart_by_their_bytes(spark):
    """Two bad bytes, the sign that replaces them, and two rows that are equal."""
    df = rows(spark, b"ab\xffc", b"ab\xfec", "ab�c".encode(), b"ab\xffc", b"\xed\xa0\x80")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect()}
    assert found == {0: (3, 2, False), 1: (1, 1, True), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}
    # So it is when a digest is in doubt and names are longer.
    weak = exact_dedup.exact_groups(df, name=lambda c: exact_dedup.F.unhex(exact_dedup.F.lit("00")))
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in weak.collect()} == found


def test_a_bad_text_does_not_end_a_job(spark):
    df = rows(spark, b"five words stand here \xff now", "five words stand here � now".encode(), b"other \xc3", b"")
    near = {r.doc_id: r.component_id for r in near_dedup.near_groups(df).collect()}
    assert near == {0: 0, 1: 0, 2: 2, 3: 3}
    net = language_id.train(["some words"] * 4 + ["andere woerter"] * 4, ["en"] * 4 + ["de"] * 4, epochs=1)
    assert language_id.predict(df, net).count() == 4
    grammar = toxicity.fit(df, spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int"))
    assert toxicity.score(df, grammar).count() == 4
    assert html_extract.extract(df.withColumnRenamed("text", "html")).count() == 4


@pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="the vocabulary file is not here")
def test_bad_bytes_as_pieces(spark):
    model = queries.piece_model(spark)
    found = {r.doc_id: r.decoded for r in pieces.decode(pieces.encode(rows(spark, b"a\xffb", b"ok"), model), model).collect()}
    assert found == {0: "a�b", 1: "ok"}


def test_the_last_stage_takes_odd_tables(spark):
    """Nulls, empty and long texts, repeats, an empty table and columns with the operator's own names."""
    if not os.path.exists(queries.PIECE_MODEL):
        pytest.skip("the vocabulary file is not here")
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, n_ids string"
    odd = [(1, None, None, None, None, "x", "y"), (None, "", "en", None, 0, None, None), (2, "word " * 50_000, None, "s", 1, None, None), (2, "a", None, "s", 1, None, None), (2, "a", None, "s", 1, None, None)]
    found = p.STAGES[-1][1](spark, spark.createDataFrame(odd, schema), "")
    assert sorted((r.n_ids if r.n_ids is not None else -1) for r in found.collect())[:2] == [-1, 0] and found.count() == 5
    assert p.STAGES[-1][1](spark, spark.createDataFrame([], schema), "").isEmpty()


def test_the_network_is_a_convolution():
    """The look-up tables give what filters slid over embedded bytes give."""
    rng = np.random.default_rng(3)
    net = language_id.train(["abc def ghi " * 20, "xyz éàü " * 20] * 5, ["a", "b"] * 5, epochs=2, window=32)
    x = rng.integers(0, 256, (50, net.window), dtype=np.uint8)
    pooled = []
    for k, f in net.filters.items():
        slid = np.stack([sum(net.embed[x[:, at + j]] @ f[j] for j in range(k)) for at in range(net.window - k + 1)])
        pooled.append(slid.max(axis=0) + net.biases[k])
    z = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.dense + net.dense_bias
    plain = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    assert np.allclose(net.log_probabilities(x, net.tables()), plain, atol=2e-3)


def test_spans_of_a_whole_text_are_learned_from(spark, monkeypatch):
    """Every span can be drawn; rows that repeat count once; the draw stays bounded."""
    seen = []
    monkeypatch.setattr(language_id, "train", lambda texts, langs, **_: seen.append(texts))
    text = "".join(chr(97 + i % 26) for i in range(95))
    df = spark.createDataFrame([(None, text, "en")] * 50 + [(7, "zz", "de")], "doc_id long, text string, lang string")
    language_id.fit(df, span=10, spans_per_label=10**6)
    assert sorted(seen[0]) == sorted([text[k : k + 10] for k in range(0, 95, 10)] + ["zz"])
    language_id.fit(df, span=10, spans_per_label=50)
    assert len(seen[1]) <= 11
