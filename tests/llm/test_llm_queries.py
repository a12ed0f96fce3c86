"""Every opN query and the pipeline over whole small tables: against SQL, brute force, the public library, held-out labels."""

from __future__ import annotations

import html
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from lakemill.llm import language_id, near_dedup, pieces, queries
from test_llm_operators import brute_components, brute_targets, docs, prose, split

SF, LARGER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the synthetic tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    df = queries.queries()[name](spark, SF)
    assert set(names) == set(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cursor.fetchall())


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_op3_on_held_out_documents(spark, documents):
    found = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    assert len(found) == len(documents) and all(r.held_out == (held(i, 4) == 2) for i, r in found.items())
    own = [d for d in documents if found[d["doc_id"]].held_out and d["lang"] and re.search(r"[^\W\d_]", d["text"] or "")]
    assert own and sum(found[d["doc_id"]].lang_pred == d["lang"] for d in own) >= 0.95 * len(own)
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", d["text"] or "")) for d in documents for r in [found[d["doc_id"]]])


def article(page):
    """The article of the table's pages, by patterns."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    blocks = [" ".join(html.unescape(re.sub("<br>", "\n", re.sub("</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_op5_gives_every_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op5_html_extract(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_op6_meets_its_targets(spark, documents):
    found = queries.op6_source_mixing(spark, SF).collect()
    sizes, taken = {}, {}
    own = {d["doc_id"]: (len(split(d["text"])), d["source"]) for d in documents}
    for r in found:
        size, source = own[r.doc_id]
        assert r.size == size and r.taken in (0, size, 2 * size)
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + r.taken
    want = brute_targets(sizes)
    for r in found:
        source = own[r.doc_id][1]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 * max(1, want[source])
    # Sources hold ten documents here; the miss is no more than a document.
    most = {s: max(n for n, t in own.values() if t == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="the synthetic tables are not here")
def test_op7_on_held_out_documents(spark):
    """The smallest table has too few labels to learn from, so the next one is taken."""
    found = queries.op7_toxicity(spark, LARGER).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (held(r.doc_id, 3) == 1) for r in found)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    clean = [r for r in found if r.held_out and labels.get(r.doc_id) == 0]
    toxic = [r for r in found if r.held_out and labels.get(r.doc_id) == 1]
    assert np.mean([r.score for r in toxic]) > 5 * np.mean([r.score for r in clean])
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_op9_against_all_pairs(spark, documents):
    ordered = sorted(documents, key=lambda d: d["doc_id"])
    ids = [d["doc_id"] for d in ordered]
    want, sizes = brute_components([d["text"] for d in ordered], 4)
    found = {r.doc_id: r for r in queries.op9_near_dedup(spark, SF).collect()}
    assert [found[i].component_id for i in ids] == [ids[w] for w in want] and [found[i].n_shingles for i in ids] == sizes
    assert all(found[i].kept == (found[i].component_id == i) for i in ids)


@pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="the vocabulary file is not here")
def test_op10_against_the_library(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    found = {r.doc_id: r for r in queries.op10_sentencepiece(spark, SF).collect()}
    assert len(found) == len(documents) and all(r.round_trip for r in found.values())
    for d in documents:
        assert found[d["doc_id"]].ids == (None if d["text"] is None else library.encode(d["text"]))


@pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="the vocabulary file is not here")
def test_pipeline_against_a_plain_version(spark, documents):
    """Stage by stage: what each keeps of what the one before it kept."""
    import sentencepiece

    import corpus_pipeline as p

    frames, now = [], spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in p.STAGES:
        now = stage(spark, now, SF)
        frames.append([r.asDict() for r in now.collect()])
        if len(frames) < len(p.STAGES):
            assert now.columns == list(documents[0])
    by_id = {d["doc_id"]: d for d in documents}
    letters = {i for i, d in by_id.items() if re.search(r"[^\W\d_]", d["text"] or "")}
    assert {d["doc_id"] for d in frames[0]} == letters
    last = {}
    for i in sorted(letters):
        last[by_id[i]["text"]] = i
    assert sorted(d["doc_id"] for d in frames[1]) == sorted(last.values())
    ids = sorted(last.values())
    components, _ = brute_components([by_id[i]["text"] for i in ids], 5)
    assert sorted(d["doc_id"] for d in frames[2]) == sorted({ids[c] for c in components})
    sizes = {}
    for d in frames[2]:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(split(d["text"]))
    want, taken, copies = brute_targets(sizes), {}, {}
    for d in frames[3]:
        assert d == by_id[d["doc_id"]]
        copies[d["doc_id"]] = copies.get(d["doc_id"], 0) + 1
        taken[d["source"]] = taken.get(d["source"], 0) + len(split(d["text"]))
    longest = max(len(split(d["text"])) for d in frames[2])
    assert max(copies.values()) <= 2 and all(abs(taken.get(s, 0) - want[s]) <= longest for s in sizes)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    assert len(frames[4]) == len(frames[3]) and all(d["ids"] == library.encode(d["text"]) and d["n_ids"] == len(d["ids"]) for d in frames[4])


def test_stages_take_odd_tables(spark):
    """Nulls in all columns, empty and long texts, repeated rows and an empty table pass every stage."""
    import corpus_pipeline as p

    rows = [(1, None, None, None, None), (None, "some words here", None, None, 3), (None, None, "en", "s", 1), (2, "", "en", "s", 0), (3, "word " * 50_000, "en", "s", 9), (4, "some words here", "de", None, 1), (4, "some words here", "de", None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in p.STAGES[:-1]:
            found = stage(spark, table, SF)
            assert found.columns == table.columns and found.count() <= 2 * table.count(), name


def test_near_groups_of_a_shared_template(spark):
    """1,000 texts of an 86-word template and 14 own words (0.75 alike), 150 of them with a copy of 0.85: nothing else is linked."""
    import random

    rng = random.Random(9)
    template, texts, pairs = [f"t{i}" for i in range(86)], [], []
    own = [[f"o{i}x{k}" for k in range(14)] for i in range(1000)]
    texts = [template + w for w in own]
    for j in rng.sample(range(1000), 150):
        pairs.append((j, len(texts)))
        texts.append(template + own[j][:6] + [f"p{j}x{k}" for k in range(8)])
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(spark, [" ".join(t) for t in texts])).collect()}
    linked = sum(found[a] == found[b] for a, b in pairs)
    assert linked >= 0.95 * len(pairs) and len(set(found.values())) == len(texts) - linked


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 199, 200, 201, 257])
def test_windows_hold_every_byte(n):
    data = bytes(i % 251 for i in range(n))
    w, share = language_id.windows(data, 100), language_id.window_weights(n, 100)
    assert len(w) == len(share) and bytes(w[-1]).rstrip(b" ")[-100:] == data[-100:].rstrip(b" ")
    assert n <= 100 or abs(share.sum() * 100 - n) < 1e-9
    seen = set()
    for k in range(len(w)):
        at = min(k * 100, max(0, n - 100))
        seen |= set(range(at, at + 100))
    assert set(range(n)) <= seen


def test_too_many_labels_are_an_error(spark):
    df = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 3"):
        language_id.fit(df, most_labels=3)


def test_normaliser_rules_and_generations():
    from test_llm_operators import small_model

    model = small_model(2)
    model.rules = {"dd": "d", "ddd": "b", "é": "a"}
    t = pieces.Transducer(model)
    assert t.normalise("ddd dd é") == pieces.BLANK + "b" + pieces.BLANK + "d" + pieces.BLANK + "a"
    model.rules = {"é": "a"}
    assert pieces.Transducer(model).normalise("é é") == pieces.BLANK + "a" + pieces.BLANK + "a"
    plain, small = pieces.Transducer(small_model(2)), pieces.Transducer(small_model(2), remember=3)
    import random

    rng = random.Random(1)
    for _ in range(200):
        text = prose(rng, 6)
        assert small.encode(text) == plain.encode(text) and len(small.words) <= 3 and len(small.older) <= 3
