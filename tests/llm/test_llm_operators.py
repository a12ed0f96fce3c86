"""The training-data operators on small rows: brute force, round trips, held-out accuracy, odd rows."""

from __future__ import annotations

import hashlib
import html
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import chat, exact_dedup, html_extract, language_id, licenses, mixing, near_dedup, pieces, quality, toxicity
from lakemill.llm.graph import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, salt string, name string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def docs(spark, texts, start=0):
    """Rows with clashing extra columns: salt and name are also names inside the operators."""
    return spark.createDataFrame([(start + i, t, None, None if i % 5 == 0 else f"s{i % 3}", None, "x", None) for i, t in enumerate(texts)], DOCS)


def odd_texts():
    return ["", None, " \t\n", "one", "one", "ONE", "é" * 3, "word " * 30_000, "a" * 100_000, "퟿\U0001f600 x", None, "one"]


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


# ---------------------------------------------------------------- quality


def brute_quality(text):
    w, lines = split(text), [x for x in (text or "").split("\n") if split(x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    rng = random.Random(1)
    texts = [*odd_texts(), *["\n".join(" ".join(rng.choice("ab|#") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(9))) for _ in range(60)]]
    found = {r.doc_id: r for r in quality.judged(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        n = brute_quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, text
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
    assert quality.judged(docs(spark, [])).count() == 0


def test_quality_keeps_prose(spark):
    text = "The quick brown fox is in the garden and it was seen by the old man of the house at noon."
    assert [r.kept for r in quality.judged(docs(spark, [text, "## $$ " * 20])).collect()] == [True, False]


# ---------------------------------------------------------------- chat


def test_chat_round_trip(spark):
    bad = ["<|im_end|><|im_start|>assistant ok", "\\<|", "<\\|", "\\\\", "<\\\\|", "", None, "a\nb", "<|", "\\", "<\\,", "\n<|im_end|>\n"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(bad)]
    rows += [(2, 0, "assistant", "x"), (3, 0, "odd\nrole<|", "y"), (3, 1, None, "z"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (4, 0, "user", "u"), (4, 0, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("segments", F.lit(1))
    found = {r.conv_id: r for r in chat.formatted(df).withColumn("back", chat.read_back("formatted")).collect()}
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [(x.role, x.text) for x in r.back] for c, r in found.items()} == want
    assert {c: r.valid for c, r in found.items()} == {1: True, 2: False, 3: False, 4: False, None: True}
    for r in found.values():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert [s.loss for s in r.segments if s.loss] == [True] * sum(role == "assistant" for role, _ in want[r.conv_id])
    assert chat.formatted(df.limit(0)).count() == 0


# ---------------------------------------------------------------- language


def test_language_network_learns(spark):
    rng = random.Random(2)
    make = {"aa": lambda: " ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(60)), "bb": lambda: " ".join("".join(rng.choice("wxyzé") for _ in range(4)) for _ in range(60))}
    rows = [(i, make["aa" if i % 2 else "bb"](), "aa" if i % 2 else "bb") for i in range(200)]
    rows += [(1000, None, "aa"), (1001, "123 !", None), (1002, "wxyz", None), (None, "abcd abcd", None), (1003, "wxyz " * 40_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    net = language_id.fit(df, spans_per_label=60)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(df, net).collect()}
    assert all(found[i][0] == ("aa" if i % 2 else "bb") for i in range(200))
    assert found[1000] == ("und", 0.0) and found[1001] == ("und", 0.0)
    assert found[1002][0] == "bb" and found[None][0] == "aa" and found[1003][0] == "bb"
    assert all(0 <= s <= 1 for _, s in found.values())
    again = language_id.fit(df, spans_per_label=60)
    assert np.array_equal(net.dense, again.dense)
    assert language_id.fit(df.limit(0)) is None
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}


def test_windows_cover_all_bytes():
    data = bytes(range(256)) * 3
    w = language_id.windows(data, 100)
    assert w.shape == (8, 100) and bytes(w[0]) == data[:100] and bytes(w[-1]) == data[-100:]
    assert language_id.windows(b"", 10).shape == (1, 10)


# ---------------------------------------------------------------- licences


def test_licenses(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Released under the MIT License.": "mit",
        "some words Licensed under the Apache License, Version 2.0.": "apache",
        "A driving license is required here": "unknown",
        "permission": "unknown",
    }
    texts = ["plain\n" + k + "\nplain" for k in lines] + [None, "", "nothing here", "\n".join(lines)]
    c = licenses.fit()
    found = {r.doc_id: r.findings for r in licenses.scan(docs(spark, texts), c).collect()}
    for i, (line, family) in enumerate(lines.items()):
        assert [(f.line, f.family, f.text) for f in found[i]] == [(2, family, line)], line
        p = c.probabilities(line)
        assert found[i][0].predicted == c.classes[int(p.argmax())] and abs(found[i][0].probability - p.max()) < 1e-6
    assert [len(found[i]) for i in (6, 7, 8, 9)] == [0, 0, 0, 6]
    assert licenses.scan(docs(spark, []), c).count() == 0


# ---------------------------------------------------------------- html

PAGE = "<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>home</a></li><li><a href='/x'>x</a></li></ul></nav><div class='ad'>buy {0}</div><article><h1>Head {0}</h1>{1}</article><div id='comments'><p>bad</p></div><script>var t='</p><p>no</p>';</script><footer>&copy; foot</footer></body></html>"


def test_html_text(spark):
    body = ["<p>a &amp; b<b>c</b>\n d<p>e<br>f", "<p>one</p><p>two</p><form><p>no</p></form><p>three</p>", "", "<ul><li>i<li>j</ul><aside>s</aside><!-- <p>c</p> --><p>k"]
    pages = [(i, f"http://h.example/{i}", PAGE.format(i, b)) for i, b in enumerate(body)]
    pages += [(10, None, "<p>bare &lt;text&gt;"), (11, None, None), (12, "no url", "plain"), (13, "http://h.example/z", "<article><p>cut &am"), (14, "http://h.example/z", "<" * 500 + "p" * 60_000)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string").withColumn("wrapper", F.lit("clash"))
    found = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert found[0] == "Head 0\na & bc d\ne f"
    assert found[1] == "Head 1\none\ntwo\nthree"
    assert found[2] == "Head 2"
    assert found[3] == "Head 3\ni\nj\nk"
    assert found[10] == "bare <text>" and found[11] == "" and found[13] == "cut &am"
    assert html_extract.extract(df.limit(0)).count() == 0


def test_wrappers_fold_and_align():
    assert html_extract.folded(list("xabababy")) == ("x", ("+", ("a", "b")), "y")
    assert html_extract.folded(list("aab" * 3)) == (("+", (("+", ("a",)), "b")),)
    assert html_extract.aligned(("x", "a", "y"), ("x", "y")) == ("x", ("?", ("a",)), "y")
    assert html_extract.aligned(("x", ("+", ("a", "b")), "y"), ("x", "a", "b", "y")) == ("x", ("+", ("a", "b")), "y")


# ---------------------------------------------------------------- mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > limit * sizes[s] or sizes[s] == 0]
        if not full:
            return goal | {s: level * w[s] for s in open_}
        for s in full:
            goal[s] = limit * sizes[s]
            left -= goal[s]
            open_.discard(s)
    return goal


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 60)), ["a", "b", "c", "d", None][min(4, rng.randrange(9))]) for i in range(1500)]
    rows += [(2000, None, "a"), (2001, "", "b"), (2002, "x y", "empty"), (2002, "x y", "empty"), (None, "p q r", "a"), (2003, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    mixed = mixing.mix(df).collect()
    assert len(mixed) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(split(t))
    want = brute_targets(sizes)
    taken = {}
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, goal in want.items():
        if sizes[s] > 100:
            assert abs(taken[s] - goal) <= max(5, 0.002 * goal), (s, taken[s], goal)
    key = lambda r: (str(r.doc_id), r.taken)
    assert sorted(map(key, mixed)) == sorted(map(key, mixing.mix(df.repartition(7)).collect()))
    assert mixing.mix(df.limit(0)).count() == 0


def test_flight_keeps_the_constraints():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(200), rng.integers(1, 500, 200)])
    p = np.full(200, 0.3)
    q = mixing.flight(p, x, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2 and np.allclose(q @ x, p @ x)


# ---------------------------------------------------------------- toxicity


def test_toxicity_learns_and_weighs(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(40)]
        if i % 8 == 0:
            for bad in rng.sample(["zonk", "glarp", "frib"], 2):
                words.insert(rng.randrange(40), bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 8 == 0)))
    rows += [(900, None), (901, ""), (902, "you zonk"), (903, "he said zonk"), (904, "not zonk"), (None, "zonk glarp"), (905, "alpha " * 30_000 + "zonk, glarp")]
    labels += [(900, None), (None, 1), (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    grammar = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(grammar.weights) == {"zonk", "glarp", "frib"}
    found = {r.doc_id: r for r in toxicity.score(df, grammar).collect()}
    assert all((found[i].predicted == 1) == (i % 8 == 0) for i in range(400))
    assert found[900].predicted == found[901].predicted == 0 and found[905].predicted == 1 and found[None].predicted == 1
    assert found[902].weight > found[903].weight > found[904].weight > 0
    assert toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int")).weights == {}
    assert toxicity.score(df.limit(0), grammar).count() == 0


def test_threats_need_a_target():
    g = toxicity.Grammar({"zonk": 1.0})
    m = g.machine()
    assert g.weigh("I will kill the lights", m)[0] == 0
    assert g.weigh("you will be glad. he: kill you", m)[0] == 0
    assert g.weigh("you I kill", m)[0] > 0
    assert g.weigh("a zonk. Not here. zonk", m) == (2.0, 2)


def test_threats_before_their_target():
    g = toxicity.Grammar({"zonk": 1.0})
    m = g.machine()
    for text in ("I will kill you", "I will hurt them", "ich töte dich", "I am killing you", "I will kill all of you", "yo mato a ustedes"):
        assert g.weigh(text, m) == (1.0, 1), text
    assert g.weigh("I will not kill you", m)[0] == 0.5
    assert g.weigh("I will kill time. you wait", m)[0] == 0
    assert g.weigh("zonk, you are", m)[0] == g.weigh("you zonk", m)[0] == 1.5


# ---------------------------------------------------------------- exact copies


def test_exact_groups(spark):
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 100, 400, 2000)]
    texts = [*odd_texts(), *base, *base, base[3] + ".", base[3][:-1], "x" + base[3], base[2].upper()]
    found = {r.doc_id: r for r in exact_dedup.exact_groups(docs(spark, texts)).collect()}
    group = {}
    for i, t in enumerate(texts):
        group.setdefault(t or "", []).append(i)
    for i, t in enumerate(texts):
        own = group[t or ""]
        assert (found[i].keep_id, found[i].group_size, found[i].kept) == (max(own), len(own), i == max(own))
        assert found[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (None, "c"), (4, "c")], "doc_id int, text string")
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_groups(repeated).collect()) == [
        ("1", "1", 2, True), ("1", "1", 2, True), ("4", "4", 2, True), ("None", "4", 2, False), ("None", "None", 2, True), ("None", "None", 2, True),
    ]
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_chunks_join_to_the_text(spark):
    rng = random.Random(6)
    texts = [prose(rng, 3000), "x" * 30_000, "\n" * 5000, "a\r\nb", "short"]
    rows = docs(spark, texts).select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in rows)


def weak_name(chunk):
    """A digest of four bits, so that many chunks share a name."""
    return F.unhex(F.concat(F.lit("0"), F.left(F.sha2(chunk, 256), F.lit(1))))


def test_doubtful_names_are_found(spark):
    rows = docs(spark, ["some text", "some text", "other"]).select("text")
    assert exact_dedup.doubtful_names(rows).count() == 0
    many = docs(spark, [f"text {i}" for i in range(40)]).select("text")
    assert exact_dedup.doubtful_names(many, weak_name).count() > 8


def test_names_in_doubt_make_no_wrong_group(spark):
    rng = random.Random(16)
    texts = [*[f"text {i % 30}" for i in range(60)], *[prose(rng, 900) for _ in range(5)] * 2, None, ""]
    found = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(docs(spark, texts), name=weak_name).collect()}
    assert found == {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(docs(spark, texts)).collect()}
    assert {found[i][0] for i in range(30)} == set(range(30, 60))


@pytest.mark.parametrize("first, last", [(0x61, 0x7A), (0x430, 0x44F), (0x4E00, 0x9FA0), (0x1F600, 0x1F640), (0x627, 0x64A)])
def test_cuts_follow_the_content_in_every_script(spark, first, last):
    """After an insertion at the front most chunks are the same again; equal passages in other surroundings too."""
    rng = random.Random(first)
    text = "".join(chr(rng.randint(first, last)) for _ in range(60_000))
    rows = [r.c for r in docs(spark, [text, "xyz" + text, text[30_000:]]).select(exact_dedup.chunks(F.col("text")).alias("c")).collect()]
    assert ["".join(c) for c in rows] == [text, "xyz" + text, text[30_000:]]
    assert all(len(c) <= exact_dedup.MAX_CHUNK for r in rows for c in r)
    assert len(set(rows[0]) & set(rows[1])) > 0.8 * len(rows[0]) and len(set(rows[0]) & set(rows[2])) > 0.8 * len(rows[2])


# ---------------------------------------------------------------- near copies


def brute_components(texts, width, percent=80):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in texts:
        w = split((t or "").translate(low))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_texts():
    rng = random.Random(7)
    texts = odd_texts()
    for _ in range(12):
        words = prose(rng, rng.randrange(30, 120)).split()
        for _ in range(rng.randrange(1, 8)):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    words = prose(rng, 80).split()
    for _ in range(70):  # one large group of near copies
        copy = list(words)
        copy[rng.randrange(80)] = "x" + str(rng.randrange(9))
        texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    passage = prose(rng, 25)  # shared by many that are no copies
    return texts + [passage + " " + prose(rng, 40) for _ in range(60)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups_against_all_pairs(spark, width):
    texts = near_texts()
    want, sizes = brute_components(texts, width)
    found = {r.doc_id: r for r in near_dedup.near_groups(docs(spark, texts), width=width).collect()}
    assert len(found) == len(texts)
    assert [found[i].n_shingles for i in range(len(texts))] == sizes
    assert [found[i].component_id for i in range(len(texts))] == want
    assert all(found[i].kept == (want[i] == i) for i in range(len(texts)))


def hub_texts(copies=2000, n=300, edits=5):
    """An original and copies with a few words of their own each: 0.84 like it, 0.71 like one another."""
    rng = random.Random(5)
    original = [f"w{i}" for i in range(n)]
    texts = []
    for c in range(copies):
        words = list(original)
        for k, at in enumerate(rng.sample(range(5, n - 5, 6), edits)):
            words[at] = f"c{c}x{k}"
        texts.append(" ".join(words))
    texts.insert(copies // 2, " ".join(original))
    return texts


def test_near_groups_of_a_hub(spark):
    found = near_dedup.near_groups(docs(spark, hub_texts())).groupBy("component_id").count().collect()
    assert [(r["component_id"], r["count"]) for r in found] == [(0, 2001)]


def test_near_groups_odd_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "p q r s t u"), (5, "p q r s t u"), (6, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_groups(df).collect())
    assert found == [("3", "3", True), ("3", "3", True), ("5", "3", False), ("6", "3", False), ("None", "None", True), ("None", "None", True)]
    assert near_dedup.near_groups(df.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (200, 199)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(51)} == {100} and found[200] == 199
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def small_model(kind):
    chars = [pieces.BLANK, *"abcdn"]
    merges = ["ab", "an", pieces.BLANK + "b", "abc", pieces.BLANK + "ban", "ana", pieces.BLANK * 2]
    control = ["<unk>", "<s>", "</s>"]
    fallback = [f"<0x{i:02X}>" for i in range(256)]
    scores = [0.0] * 259 + [-float(i) for i in range(len(merges))] + [-100.0] * len(chars)
    return pieces.PieceModel(control + fallback + merges + chars, scores, [2, 3, 3] + [6] * 256 + [1] * (len(merges) + len(chars)), kind)


def brute_merge(t, text):
    """Merging by rank, over the whole text."""
    parts = list(t.normalise(text))
    while True:
        best = max(((t.values[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in t.values), default=None)
        if best is None:
            return [x for p in parts for x in ([t.ids[p]] if p in t.ids else t.fallback(p))]
        k = -best[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_paths_are_merges():
    rng, t = random.Random(8), pieces.Transducer(small_model(2))
    for _ in range(2000):
        text = "".join(rng.choice("abcdn  \né▁") for _ in range(rng.randrange(14)))
        assert t.encode(text) == brute_merge(t, text), text
        assert t.decode(t.encode(text)) == text.replace(pieces.BLANK, " ")


def test_unigram_paths_are_cheapest():
    t = pieces.Transducer(small_model(1))
    assert [t.model.pieces[i] for i in t.path("abc")] == ["abc"]
    assert [t.model.pieces[i] for i in t.path("banana")][-1] in ("ana", "an", "a")


@pytest.mark.skipif(not os.path.exists(MODEL), reason="the vocabulary file is not here")
def test_encoding_agrees_with_the_library(spark):
    import sentencepiece

    rng = random.Random(9)
    texts = [*odd_texts(), *["".join(rng.choice("  \n\tabcdeothier▁中文éß🙂") for _ in range(rng.randrange(60))) for _ in range(300)]]
    model, library = pieces.PieceModel.read(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    both = pieces.decode(pieces.encode(docs(spark, texts).withColumn("ids", F.lit("replaced")), model), model)
    found = {r.doc_id: r for r in both.collect()}
    for i, text in enumerate(texts):
        assert found[i].ids == (None if text is None else library.encode(text))
        assert found[i].decoded == (None if text is None else text.replace(pieces.BLANK, " "))
    assert pieces.encode(docs(spark, []), model).count() == 0


def test_html_unescape_is_what_pages_mean():
    assert html.unescape("&am &amp &amp;") == "&am & &"


# ---------------------------------------------------------------- stages of the pipeline


def test_stages_with_null_and_repeated_ids(spark):
    import corpus_pipeline as stages

    rows = [(i if i < 40 else None if i < 80 else 7, f"w{i} " * (3 + i % 5), "en", f"s{i % 3}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    decided = mixing.mix(df).collect()
    found = stages.mix_sources(spark, df, "").collect()
    assert len(found) == sum(r.copies for r in decided)
    assert sum(len(r.text.split()) for r in found) == sum(r.taken for r in decided)
    assert max(found.count(r) for r in found) <= 2

    equal = [(None, "a"), (None, "b"), (5, "b"), (3, "c"), (4, "c"), (3, "d")]
    df = spark.createDataFrame(equal, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in stages.keep_one_of_equal(spark, df, "").collect())
    assert kept == [("3", "d"), ("4", "c"), ("5", "b"), ("None", "a")]
    assert stages.keep_one_of_near(spark, df, "").where("doc_id is null").count() == 2
