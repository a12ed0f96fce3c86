"""The exact part of near-duplicate detection: no pair at the limit is lost, and few are tried."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_llm_operators import brute_components, docs, near_texts

from lakemill.llm import near_dedup


def template_texts(n, planted, kept, seed=11):
    """n texts of an 86-word template and 14 own words, 0.75 alike, and copies of some that keep so many of the own words."""
    rng = random.Random(seed)
    template, own, pairs = [f"t{i}" for i in range(86)], [[f"o{i}x{k}" for k in range(14)] for i in range(n)], []
    texts = [template + w for w in own]
    for j in rng.sample(range(n), planted):
        pairs.append((j, len(texts)))
        texts.append(template + own[j][:kept] + [f"p{j}x{k}" for k in range(14 - kept)])
    return [" ".join(t) for t in texts], pairs


def test_no_pair_at_the_limit_is_lost(spark):
    """Pairs of 0.81 among documents that are all 0.75 alike."""
    texts, pairs = template_texts(1000, 300, 4)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(spark, texts)).collect()}
    assert [p for p in pairs if found[p[0]] != found[p[1]]] == []
    assert len(set(found.values())) == len(texts) - len(pairs)


def test_few_pairs_of_a_large_group_are_tried(spark, monkeypatch):
    """Documents that share most of their words but are no copies are told apart before their sets move."""
    tried, plain = [], near_dedup.confirmed

    def counted(pairs, *more):
        tried.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(near_dedup, "confirmed", counted)
    texts, pairs = template_texts(600, 20, 10)
    found = near_dedup.near_groups(docs(spark, texts)).select("component_id").distinct().count()
    assert found == len(texts) - len(pairs) and sum(tried) < 2 * len(texts)


@pytest.mark.parametrize("many, block", [(1 << 40, 512), (0, 7)])
def test_lists_in_one_and_in_blocks(spark, monkeypatch, many, block):
    """With hardly any links beforehand, lists alone find all of them, whether or not they are compared in blocks."""
    monkeypatch.setattr(near_dedup, "MANY_PAIRS", many)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts()
    want, _ = brute_components(texts, 4)
    rows = docs(spark, texts).withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 5, "0"))
    found = {int(r.doc_id): int(r.component_id) for r in near_dedup.near_groups(rows, width=4, trees=1, depth=1, bits=0).collect()}
    assert [found[i] for i in range(len(texts))] == want


def test_the_order_of_shingles_changes_no_link(spark, monkeypatch):
    """Common shingles come last for speed; without any that are known, the links are the same."""
    texts = near_texts()
    want, _ = brute_components(texts, 5)
    monkeypatch.setattr(near_dedup, "ORDER_DOCS", 0)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(spark, texts), trees=1, depth=1, bits=0).collect()}
    assert [found[i] for i in range(len(texts))] == want


def long_texts(n=14, words=2600, seed=5):
    """n long texts of their own words, in each of which one passage of 200 words stands, and a copy of the first that is near."""
    rng = random.Random(seed)
    passage = [f"s{k}" for k in range(200)]
    texts = [[f"d{i}w{rng.randrange(10**6)}" for _ in range(words)] for i in range(n)]
    texts = [t[: i * 50] + passage + t[i * 50 :] for i, t in enumerate(texts)]
    texts.append([w if k > 100 else f"e{k}" for k, w in enumerate(texts[0])])
    return [" ".join(t) for t in texts]


def test_long_texts_that_share_a_passage_do_not_move(spark, monkeypatch):
    """Sets that fill the bitmap of the lists are told apart by their broad ones, before they move for the confirmation."""
    tried, plain = [], near_dedup.confirmed

    def counted(pairs, *more):
        tried.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(near_dedup, "confirmed", counted)
    monkeypatch.setattr(near_dedup, "ORDER_DOCS", 0)
    found = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(spark, long_texts()), trees=1, depth=1, bits=0).collect()}
    assert [i for i in range(15) if found[i] != i] == [14] and found[14] == 0
    assert sum(tried) <= 1


def test_broad_bitmaps_of_two_lengths(spark):
    """Of sets on both sides of a power of two the longer bitmap is folded; a pair at the limit stays, an unlike one goes."""
    words = [f"w{k}" for k in range(2500)]
    texts = [" ".join(words), " ".join(words[:2010]), " ".join(f"v{k}" for k in range(2010))]
    wide = near_dedup.with_paths(docs(spark, texts).select(F.col("doc_id").alias("id"), "text"), 5, 1, 1).cache()
    assert [len(r.broad) for r in wide.orderBy("id").collect()] == [64, 32, 32]
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    assert [tuple(r) for r in near_dedup.narrowed(pairs, wide, 80).collect()] == [(0, 1)]


def test_pairs_in_many_turns(spark, monkeypatch):
    """What moves at once is bounded; all turns together confirm what one would."""
    words = [f"w{k}" for k in range(100)]
    texts = docs(spark, [" ".join(words[i * 8 :]) for i in range(5)]).select(F.col("doc_id").alias("id"), "text")
    wide = near_dedup.with_paths(texts, 5, 1, 1).cache()
    pairs = spark.createDataFrame([(i, j) for i in range(5) for j in range(i + 1, 5)], "a long, b long")
    turns, plain = [], near_dedup._confirmed
    monkeypatch.setattr(near_dedup, "_confirmed", lambda *args: turns.append(1) or plain(*args))
    monkeypatch.setattr(near_dedup, "MOVED", 700)
    monkeypatch.setattr(near_dedup, "MOVED_SHARE", 0)
    found = {tuple(r) for r in near_dedup.confirmed(pairs, wide, wide, texts, 5, 80).collect()}
    sizes = [96 - 8 * i for i in range(5)]
    assert found == {(i, j) for i in range(5) for j in range(i + 1, 5) if 100 * sizes[j] >= 80 * sizes[i]}
    assert len(turns) == 3


def test_rows_without_words_alone(spark):
    """A task whose texts have no words has no prefix to give."""
    found = near_dedup.near_groups(docs(spark, ["", " \n", "\t"])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]
