"""Near-duplicate detection: an exact set similarity join on word shingles, behind a chosen-path join that does most of it.

Each document is the set of its distinct word shingles. In every one of several independent trees a document walks
down a path: at each level it is sent to the child that the tree's minwise token at that level names. A node compares
its documents with heads, the smallest id in a small node, one drawn anew and the one in its middle in a large one, and
large nodes branch again. These links join most copies, a hub and its thousands of edited copies among them, without
comparing the copies with one another; they need not find all, as what follows is exact.

All shingles have one order, common ones last. Of two sets A and B, B no larger, that have a similarity of t or more, the
first common shingle in this order is among the first |B| - 2t / (1 + t) |B| + 1 of B and the first |A| - t |A| + 1 of A:
before it stand only shingles that the other lacks. So documents meet in the lists of their first shingles, and every
pair of a list that the links so far leave apart is tried, unless sizes, places in the list's order or bitmaps show that
it cannot reach the limit. A bitmap holds the parity of how many shingles fall on each bit, so two differ in at most as
many bits as the sets differ in shingles. No pair is lost, and no list or partner is capped. Documents of one template
whose own parts set them further apart than the limit have their own shingles first, and do not meet.

Long sets fill such a bitmap, so pairs of them are tried again on bitmaps that grow with the sets, and only then move.

Candidates are confirmed on the full sets. What is quadratic is a list of many documents that no head links: it is
compared block against block, in bounded memory and by all tasks, by bitmaps. What moves at once, of lists, bitmaps and
sets, is a share of all sets; what is more goes in further turns, none of it is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import cut, every_salt, salt_of, small_batches
from lakemill.llm.graph import components

SEED = 20_240_611


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible pattern."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Powers of an odd base, for the hash of a word by its bytes; longer words go on in steps of this length.
_STEP = 4096
_POWERS = np.cumprod(np.full(_STEP, 0x5851F42D4C957F2D, np.uint64), dtype=np.uint64)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text, from whole texts; A-Z count as a-z.

    A text of fewer words than the width has its whole word sequence as its only shingle, one without words has none.
    """
    raw = [("" if t is None else t).encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(b) + 1 for b in raw])
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    upper = (data >= 65) & (data <= 90)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return [np.empty(0, np.uint64) for _ in raw]
    size = stop - start
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(start, size) + inside
    value = (data[at] + np.uint8(32) * upper[at]).astype(np.uint64) + np.uint64(1)
    value = value * _POWERS[inside % _STEP] + (inside // _STEP).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    word = _mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))
    count = np.diff(np.concatenate(([0], np.searchsorted(start, ends))))
    first = np.cumsum(count) - count
    factor = _mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    joined = np.zeros(max(0, len(word) - width + 1), np.uint64)
    for k in range(width if len(joined) else 0):
        joined += word[k : len(word) - width + 1 + k] * factor[k]
    joined = _mix(joined)
    out = []
    for a, n in zip(first.tolist(), count.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(joined[a : a + n - width + 1]))
        elif n:
            out.append(_mix(np.array([(word[a : a + n] * factor[:n]).sum() ^ np.uint64(n)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _pieces(batches: Iterator[pd.DataFrame], most: int = 1 << 21) -> Iterator[pd.DataFrame]:
    """The batches in parts of about so many characters, for bounded memory; a text is never split."""
    for batch in batches:
        size = batch["text"].str.len().fillna(0).to_numpy().cumsum() // most
        for _, part in batch.groupby(size, sort=False):
            yield part


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def with_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles): the set of each row of docs(id, text), as array<long>."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _pieces(batches):
            yield pd.DataFrame({"id": part["id"], "shingles": [_signed(x) for x in shingle_sets(part["text"].tolist(), width)]})

    return docs.mapInPandas(run, f"id {docs.schema['id'].dataType.simpleString()}, shingles array<bigint>")


#: Bits of a set's bitmap. A set of more shingles has a broad one beside it, of as many bits as it has shingles or more.
PARITY = 1024


def _parity(x: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of a set; that of half as many bits is its first half XOR its second."""
    return _signed(np.packbits((np.bincount((x >> np.uint64(32)) % np.uint64(bits), minlength=bits) & 1).astype(np.uint8)).view(np.uint64))


def with_paths(docs: DataFrame, width: int, trees: int, depth: int) -> DataFrame:
    """(id, n_shingles, digest, sketch, tokens, parity, broad, short) of docs(id, text).

    digest names the set, sketch holds a bit of each of 64 minwise tokens, tokens the minwise token for each tree and
    level (tree by tree), parity the bitmap of the set, broad the one of a set of more than PARITY shingles, short the
    distinct lower halves of the shingles, as arrays of 32-bit numbers.
    """
    draws = max(64, trees * depth)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd = _mix(np.arange(SEED, SEED + draws, dtype=np.uint64)) | np.uint64(1)
        bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for part in _pieces(batches):
            digest, sketch, tokens, sizes, parity, broad, short = [], [], [], [], [], [], []
            for x in shingle_sets(part["text"].tolist(), width):
                least = np.full(draws, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(x), 2048):  # what fits the cache
                    np.minimum(least, (odd[:, None] * x[None, at : at + 2048]).min(axis=1), out=least)
                least = _mix(least)
                sizes.append(len(x))
                parity.append(_parity(x, PARITY))
                broad.append(_parity(x, 1 << (len(x) - 1).bit_length()) if len(x) > PARITY else None)
                short.append(np.unique(x.astype(np.uint32)).view(np.int32))
                digest.append(blake2b(x.tobytes(), digest_size=16).digest())
                sketch.append((bit[(least[:64] & np.uint64(1)) == 1]).sum(dtype=np.uint64))
                tokens.append((least[: trees * depth] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pd.DataFrame({"id": part["id"], "n_shingles": sizes, "digest": digest, "sketch": _signed(np.array(sketch, np.uint64)), "tokens": tokens, "parity": parity, "broad": pd.Series(broad, dtype=object), "short": short})

    return docs.mapInPandas(run, f"id {docs.schema['id'].dataType.simpleString()}, n_shingles bigint, digest binary, sketch bigint, tokens array<int>, parity array<bigint>, broad array<bigint>, short array<int>")


def _alike(a: Column, b: Column, most: int) -> Column:
    """Whether two sketches differ in few enough bits. Pairs of 0.8 differ in 6 of 64 on average, unlike ones in 32."""
    return F.bit_count(a.bitwiseXOR(b)) <= most


def candidates(classes: DataFrame, trees: int, depth: int, small: int, bits: int) -> DataFrame:
    """The pairs (member, head) of documents with the heads of their nodes.

    classes: (id, sketch, tokens), one row for each distinct set.
    """
    token = lambda level: F.element_at("tokens", F.col("tree") * depth + level + 1)
    walkers = classes.select("id", "sketch", "tokens", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    walkers = walkers.select("id", "sketch", "tree", F.xxhash64("tree", token(0)).alias("node"))
    stars = []
    for level in range(depth):
        # A node's rows are merged before the shuffle; what a node tells its rows is dealt by salt.
        told = cut(_with_heads(walkers, small))
        stars.append(_star(told, bits))
        large = told.where(F.col("members") > small)
        if large.isEmpty():
            break
        stars.append(cut(_star(_with_middles(large, classes), bits).distinct()))
        if level + 1 < depth:
            walkers = large.select("id", "sketch", "tree", "node").join(classes.select("id", "tokens"), "id")
            walkers = walkers.select("id", "sketch", "tree", F.xxhash64("node", token(level + 1)).alias("node"))
    none = classes.select(F.col("id").alias("member"), F.col("id").alias("head")).limit(0)
    return reduce(DataFrame.union, stars, none).distinct()


def _star(told: DataFrame, bits: int) -> DataFrame:
    """The pairs (member, head) of each row of told(id, sketch, head) and its head, if their sketches are alike."""
    met = told.where(F.col("id") != F.col("head.id")).where(_alike(F.col("sketch"), F.col("head.sketch"), bits))
    return met.select(F.col("id").alias("member"), F.col("head.id").alias("head"))


def _contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect the same documents as links(member, head): one for each member, and one for each head
    that it shares with its smallest. A member has at most two heads for each level of each tree."""
    rows = links.groupBy("member").agg(F.collect_set("head").alias("heads"))
    least = F.array_min("heads")
    pairs = F.concat(F.array(F.struct(F.col("member").alias("a"), least.alias("b"))), F.transform(F.filter("heads", lambda h: h > least), lambda h: F.struct(h.alias("a"), least.alias("b"))))
    return rows.select(F.inline(pairs)).distinct()


def _possible(n: Column, m: Column, x: Column, y: Column, percent: int) -> Column:
    """Whether sets of n and m shingles and of the bitmaps x and y may reach the limit: they differ in no fewer shingles
    than the bitmaps differ in bits, and may differ in (100 - percent) / (100 + percent) of their sizes' sum. Exact: a
    pair that reaches the limit always may."""
    apart = reduce(Column.__add__, [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(PARITY // 64)])
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs, named by their first two columns, whose bitmaps in classes(id, n_shingles, parity) let them be near."""
    a, b = pairs.columns[:2]
    side = lambda own, n: classes.select(F.col("id").alias(own), F.col("n_shingles").alias(f"__n{n}"), F.col("parity").alias(f"__{n}"))
    met = pairs.join(side(a, "p"), a).join(side(b, "q"), b)
    return met.where(_possible(F.col("__np"), F.col("__nq"), F.col("__p"), F.col("__q"), percent)).select(*pairs.columns).distinct()


#: From about how many documents the order of shingles is learned, and how many shingles it names at most. Any order is
#: exact; this one keeps lists short.
ORDER_DOCS, ORDER_SHINGLES = 8192, 100_000


def common_shingles(texts: DataFrame, n: int, width: int) -> np.ndarray:
    """The shingles that three or more of some drawn documents hold, the rarest first; texts(id, text) has n rows."""
    drawn = texts.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(max(n, 1))) < ORDER_DOCS)
    held = with_sets(drawn, width).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    most = held.where("n > 2").orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).select("shingle")
    return most.toPandas()["shingle"].to_numpy(np.int64)[::-1].view(np.uint64)


def with_prefixes(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """(id, n, prefix) of docs(id, text): how many shingles its set has and the first of them, n - percent / 100 * n + 1,
    in the order of all: by their values, and those that are common after these, in the order of common."""
    place = np.argsort(common)
    known = common[place]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _pieces(batches):
            ids, sizes, prefixes = [], [], []
            for own, x in zip(part["id"], shingle_sets(part["text"].tolist(), width), strict=True):
                if n := len(x):
                    at = np.minimum(np.searchsorted(known, x), max(0, len(known) - 1))
                    late = known[at] == x if len(known) else np.zeros(n, bool)
                    ordered = np.concatenate((x[~late], common[np.sort(place[at[late]])]))
                    ids.append(own)
                    sizes.append(n)
                    prefixes.append(_signed(ordered[: n + (-percent * n) // 100 + 1]))
            yield pd.DataFrame({"id": pd.Series(ids, dtype=part["id"].dtype), "n": np.array(sizes, np.int32), "prefix": pd.Series(prefixes, dtype=object)})

    return docs.mapInPandas(run, f"id {docs.schema['id'].dataType.simpleString()}, n int, prefix array<bigint>")


#: In how many turns documents are dealt to the lists, so that only such a part of all prefixes is on disk at once.
TURNS = 4
#: Rows of lists that meet at once, if they are more than a share of all shingles.
LIST_ROWS, LIST_SHARE = 1 << 19, 1 / 128


def _list_pairs(prefixes: DataFrame, placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, x, y) that meet in the lists of prefixes(id, n, prefix), as _pairs() gives them.

    Lists hold (node, id, component, n, pos, early) and name documents of more than one component of placed(id,
    component), with members, main and rest as in _mixed. early: whether the shingle is among the document's first
    n - 2 * percent / (100 + percent) * n + 1, as the smaller document of a near pair has it. Lists are made, met and
    forgotten turn by turn, large ones in more turns.
    """
    held = cut(prefixes.join(placed, "id").select("id", "component", "n", "prefix"))
    most = max(LIST_ROWS, LIST_SHARE * (classes.agg(F.sum("n_shingles")).first()[0] or 0))
    own, met = Window.partitionBy("node"), []
    for turn in range(TURNS):
        rows = held.select("id", "component", "n", F.posexplode("prefix").alias("pos", "node")).where(F.pmod("node", F.lit(TURNS)) == turn)
        rows = rows.withColumn("early", (100 + percent) * F.col("pos") <= (100 - percent) * F.col("n"))
        seen = rows.withColumns({"least": F.min("component").over(own), "most": F.max("component").over(own), "some": F.max("early").over(own)})
        seen = cut(seen.where("least < most and some").select("node", "id", "component", "n", "pos", "early"))
        lists = cut(_mixed(seen))
        del seen
        # A row of a large list goes to as many blocks as the others have.
        copies = _blocks("rest") + F.when(F.col("component") != F.col("main"), _blocks("members")).otherwise(0)
        moved = lists.agg(F.sum(F.when(_many(), copies).otherwise(1))).first()[0] or 0
        parts = max(1, ceil(moved / most))
        for part in range(parts):
            met.append(cut(_pairs(lists.where(F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(parts)) == part), classes, percent)))
        del lists
    return cut(reduce(DataFrame.union, met).distinct())


def _mixed(rows: DataFrame) -> DataFrame:
    """rows(node, ...) of nodes that hold more than one component, with members, the size of the node, main, its largest
    component, and rest, how many rows are of others."""
    parts = rows.groupBy("node", "component").agg(F.count("*").alias("n_own"))
    shape = parts.groupBy("node").agg(F.sum("n_own").alias("members"), F.max(F.struct("n_own", "component")).alias("main")).where("main.n_own < members")
    # Nodes are many and most of them small, so what is told is not dealt by salt; adaptive execution splits a hot one.
    return rows.join(shape.select("node", "members", F.col("main.component").alias("main"), (F.col("members") - F.col("main.n_own")).alias("rest")), "node")


#: Lists with more pairs to try than this are compared block against block, and how many documents a block has.
MANY_PAIRS, BLOCK = 4096, 512


def _many() -> Column:
    return F.col("rest") * F.col("members") > MANY_PAIRS


def _blocks(of: str) -> Column:
    return F.ceil(F.col(of) / BLOCK).cast("long")


def _pairs(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, x, y) of lists whose components x and y differ and that may reach the limit: those of small lists
    and those of large ones. Only documents outside a list's main component look for partners."""
    told = lists.join(classes.select("id", "parity"), "id")
    many = _many()
    row = F.struct("id", "component", "n", "pos", "early", "parity")
    groups = told.where(~many).groupBy("node").agg(F.collect_list(row).alias("m"), F.first("main").alias("main"))
    asks = groups.select("m", "main", F.explode(F.filter("m", lambda p: p["component"] != F.col("main"))).alias("p"))
    p = F.col("p")
    other = lambda q: (q["component"] != p["component"]) & ((q["component"] == F.col("main")) | (q["id"] > p["id"]))
    # The smaller set has the shingle early. If it is their first common one, what follows it must hold all they share.
    early = lambda q: F.when(p["n"] < q["n"], p["early"]).when(p["n"] > q["n"], q["early"]).otherwise(p["early"] & q["early"])
    after = lambda q: (100 + percent) * F.least(p["n"] - p["pos"], q["n"] - q["pos"]) >= percent * (p["n"] + q["n"])
    met = asks.select("p", F.explode(F.filter("m", lambda q: other(q) & early(q) & after(q) & _possible(p["n"], q["n"], p["parity"], q["parity"], percent))).alias("q"))
    few = met.select(p["id"].alias("p"), F.col("q.id").alias("q"), p["component"].alias("pc"), F.col("q.component").alias("qc"))
    # Askers meet all members, block by block.
    large = told.where(many)
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), _blocks(of) - 1))
    part = lambda of: F.pmod(F.xxhash64("id"), _blocks(of))
    inside = (F.col("component") == F.col("main")).alias("inside")
    kept = ["node", "id", "component", "n", "pos", "early", "parity", inside]
    askers = large.where(~inside).select(*kept, F.lit(True).alias("asks"), part("rest").alias("i"), every("members").alias("j"))
    others = large.select(*kept, F.lit(False).alias("asks"), every("rest").alias("i"), part("members").alias("j"))

    def compared(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy()
        p, q = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        bits = lambda t: t["parity"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(t), -1)
        col = lambda t, c: t[c].to_numpy()
        left, right, most = [], [], 100 + percent
        mine, n, pos, early = bits(q), col(q, "n").astype(np.int64), col(q, "pos"), col(q, "early")
        comp, own, inner = col(q, "component"), col(q, "id"), col(q, "inside")
        for k, (c, d, m, at, first, x) in enumerate(zip(col(p, "component"), col(p, "id"), col(p, "n").tolist(), col(p, "pos").tolist(), col(p, "early"), bits(p), strict=True)):
            may = (comp != c) & (inner | (own > d)) & np.where(n > m, first, np.where(n < m, early, early & first))
            may &= (most * np.minimum(n - pos, m - at) >= percent * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            found = np.flatnonzero(may)
            found = found[most * np.bitwise_count(mine[found] ^ x).sum(axis=1, dtype=np.int64) <= (100 - percent) * (n[found] + m)]
            left.append(np.full(len(found), k))
            right.append(found)
        a, b = (p.take(pa.array(np.concatenate([*left, np.empty(0, int)]).astype(np.int64))), q.take(pa.array(np.concatenate([*right, np.empty(0, int)]).astype(np.int64))))
        return pa.table({"p": a["id"], "q": b["id"], "pc": a["component"], "qc": b["component"]})

    kind = classes.schema["id"].dataType.simpleString()
    blocked = askers.union(others).groupBy("node", "i", "j").applyInArrow(compared, f"p {kind}, q {kind}, pc {kind}, qc {kind}")
    turned = F.col("p") < F.col("q")
    pick = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    return few.union(blocked).select(pick("p", "q").alias("a"), pick("q", "p").alias("b"), pick("pc", "qc").alias("x"), pick("qc", "pc").alias("y")).distinct()


def _with_middles(large: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of large nodes (node, id, sketch), with the document as head that agrees best with the others.

    The original of thousands of edited copies has the sketch bits that most members have, as each copy keeps most of
    what it says; but some copies have them all too. So each of 16 parts of a node names its nearest document to these
    bits, and the one of them that shares the most tokens with the others becomes the head.
    """
    # Two bits are counted in one sum, 32 places apart.
    pair = F.lit(0x1_0000_0001).cast("long")
    counts = large.groupBy("node").agg(F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned("sketch", i).bitwiseAND(pair)).alias(f"bits{i}") for i in range(32)])
    array = F.array(*[F.col(f"bits{i}") for i in range(32)])
    most = lambda low: F.aggregate(F.reverse(F.transform(array, lambda v: F.when(2 * (v.bitwiseAND(F.lit(0xFFFF_FFFF).cast("long")) if low else F.shiftrightunsigned(v, 32)) > F.col("n"), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))), F.lit(0).cast("long"), lambda a, v: a * 2 + v)
    middles = counts.select("node", F.shiftleft(most(False), 32).bitwiseOR(most(True)).alias("middle"), every_salt())
    rows = large.select("node", "id", "sketch", salt_of("id").alias("salt"))
    far = F.bit_count(F.col("sketch").bitwiseXOR(F.col("middle")))
    nearest = F.min(F.struct(far.alias("far"), F.xxhash64("id", "node").alias("draw"), "id", "sketch")).alias("c")
    named = rows.join(middles, ["node", "salt"]).groupBy("node", F.pmod(F.xxhash64("node", "id"), F.lit(16)).alias("part")).agg(nearest)
    named = named.select("node", "c.id", "c.sketch").join(classes.select("id", "tokens"), "id")
    shared = lambda x, y: F.size(F.filter(F.zip_with(x["tokens"], y["tokens"], lambda a, b: a == b), lambda same: same))
    score = lambda x: F.aggregate("c", F.lit(0), lambda sum_, y: sum_ + shared(x, y)).alias("score")
    best = F.array_max(F.transform("c", lambda x: F.struct(score(x), x["id"].alias("id"), x["sketch"].alias("sketch"))))
    heads = named.groupBy("node").agg(F.collect_list(F.struct("id", "sketch", "tokens")).alias("c")).select("node", best.alias("head"))
    return rows.join(heads.select("node", "head", every_salt()), ["node", "salt"]).select("id", "sketch", "head")


def _with_heads(walkers: DataFrame, small: int) -> DataFrame:
    """walkers of nodes of two or more, with the node's head and number of members.

    The head is the smallest id in a small node, and a document drawn by hash in a large one, where the heads of many
    nodes together connect what one of them would leave apart.
    """
    drawn = F.struct(F.xxhash64("node", "id").alias("draw"), "id", "sketch")
    heads = walkers.groupBy("node").agg(F.min(F.struct("id", "sketch")).alias("least"), F.min(drawn).alias("drawn"), F.count("*").alias("members"))
    head = F.when(F.col("members") <= small, F.col("least")).otherwise(F.struct(F.col("drawn.id").alias("id"), F.col("drawn.sketch").alias("sketch"))).alias("head")
    heads = heads.where("members > 1").select("node", head, "members", every_salt())
    return walkers.withColumn("salt", salt_of("id")).join(heads, ["node", "salt"]).select("id", "sketch", "tree", "node", "head", "members")


#: Ids that are broadcast to find their sets and texts; more are joined by shuffle.
BROADCAST_IDS = 200_000
#: Shingles that move at once for pairs, if they are more than a share of all.
MOVED, MOVED_SHARE = 1 << 24, 1 / 2


def _dealt(pairs: DataFrame, classes: DataFrame, bytes_: float, ids: int | None = None) -> list[DataFrame]:
    """The pairs in as many parts as keep what moves for one, so many bytes for a shingle, within 4 bytes for each of
    MOVED shingles or their share, and the ids that one names within ids."""
    a, b = pairs.columns[:2]
    side = lambda own: classes.select(F.col("id").alias(own), F.col("n_shingles").alias(f"__n_{own}"))
    n, moved = pairs.join(side(a), a).join(side(b), b).agg(F.count("*"), F.sum(F.col(f"__n_{a}") + F.col(f"__n_{b}"))).first()
    most = max(MOVED, MOVED_SHARE * (classes.agg(F.sum("n_shingles")).first()[0] or 0))
    parts = max(1, ceil((moved or 0) * bytes_ / 4 / most), ceil(2 * n / ids) if ids else 1)
    return [pairs.where(F.pmod(F.xxhash64(F.lit(SEED), a, b), F.lit(parts)) == part) for part in range(parts)]


def narrowed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs, named by their first two columns, but for those whose broad bitmaps in classes(id, n_shingles, broad)
    differ in too many bits. Exact, as _possible is: of two the longer bitmap is folded to the bits of the other."""
    a, b = pairs.columns[:2]
    side = lambda own, n: classes.where("broad is not null").select(F.col("id").alias(own), F.col("n_shingles").alias(f"__n{n}"), F.col("broad").alias(f"__{n}"))
    n = F.least(F.size("__p"), F.size("__q"))
    xor = lambda x, y: x.bitwiseXOR(y)
    folded = lambda c: F.when(F.size(c) > n, F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, n + 1, n), xor)).otherwise(F.col(c))
    apart = F.aggregate(F.zip_with(folded("__p"), folded("__q"), lambda x, y: F.bit_count(xor(x, y))), F.lit(0), lambda sum_, bits: sum_ + bits)
    may = (F.greatest(F.size("__p"), F.size("__q")) > 2 * n) | ((100 + percent) * apart <= (100 - percent) * (F.col("__np") + F.col("__nq")))
    told = lambda part: part.join(side(a, "p"), a, "left").join(side(b, "q"), b, "left").where(F.col("__p").isNull() | F.col("__q").isNull() | may)
    # A bitmap has one or two bits for each shingle, and that of one side moves with the pair.
    return reduce(DataFrame.union, [cut(told(part).select(*pairs.columns).distinct()) for part in _dealt(pairs, classes, 1 / 8)])


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union. The first two columns of pairs name
    the documents of classes(id, n_shingles), sets(id, digest, n_shingles, short) and docs(id, text). They are dealt to
    as many turns as they need, and what moves for one is gone before the next."""
    return reduce(DataFrame.union, [cut(_confirmed(part, sets, docs, width, percent)) for part in _dealt(pairs, classes, 4, BROADCAST_IDS)])


def _confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One turn of confirmed().

    Halves of shingles decide where they must be right: they may agree where shingles do not about n * m / 2 ** 32
    times, so a pair that is nearer to the limit than four times that and four more is decided on whole shingles. Of a
    pair of short texts that is each; they are few bytes.
    """
    a, b = pairs.columns[:2]
    # Only the sets that pairs name move for the two joins, each once, however often rows repeat it.
    named = cut(pairs.select(F.explode(F.array(a, b)).alias("id")).distinct())
    named = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    sets = cut(sets.join(named, "id", "left_semi").dropDuplicates(["id", "digest"]))
    side = lambda own, n: sets.select(F.col("id").alias(own), F.col("short").alias(f"__{n}"), F.col("n_shingles").alias(f"__n{n}"))
    both = F.size(F.array_intersect("__p", "__q"))
    above = 100 * both - percent * (F.col("__np") + F.col("__nq") - both)
    doubt = (100 + percent) * (4 + F.floor(F.col("__np") * F.col("__nq") / F.lit(1 << 30)))
    told = pairs.join(side(a, "p"), a).join(side(b, "q"), b).select(*pairs.columns, above.alias("__above"), doubt.alias("__doubt"))
    told = cut(told.where("__above >= -__doubt").select(*pairs.columns, (F.col("__above") >= F.col("__doubt")).alias("__sure")).distinct())
    del sets
    open_ = told.where(~F.col("__sure")).select(*pairs.columns)
    ids = cut(open_.select(F.explode(F.array(a, b)).alias("id")).distinct())
    few = ids.count()
    ids = F.broadcast(ids) if few <= BROADCAST_IDS else ids
    whole = cut(with_sets(docs.join(ids, "id", "left_semi"), width)) if few else None
    sure = told.where("__sure").select(*pairs.columns)
    if whole is None:
        return sure
    left, right = whole.select(F.col("id").alias(a), F.col("shingles").alias("__p")), whole.select(F.col("id").alias(b), F.col("shingles").alias("__q"))
    exact = open_.join(left, a).join(right, b).where(100 * both >= percent * (F.size("__p") + F.size("__q") - both)).select(*pairs.columns)
    return sure.union(exact).distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, trees: int = 10, depth: int = 3, small: int = 16, bits: int = 22
) -> DataFrame:
    """Groups of near copies: (doc_id, n_shingles, component_id, kept), one row for each row of docs.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets, which is confirmed on the full
    sets; component_id is the smallest id that links reach, kept marks the document of that id. Equal sets are linked
    without a comparison. Null and empty texts, and texts of nothing but white space, have no shingles and are linked
    with nothing. Rows with a null id take part in nothing: their component is null and they are kept. Rows that
    repeat an id are one document that has all of their sets. Bytes that are not valid UTF-8 count as U+FFFD. Other
    columns of docs, whatever their names, are not read. Pairs inside one component are only compared as far as its
    connection needs.

    trees, depth, small and bits decide how much the heads link beforehand, never what is linked in the end. small: most
    documents of a node that does not branch. bits: in how many of 64 sketch bits a document and a head may differ.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.make_valid_utf8(F.col(text_col)).alias("text"))
    wide = cut(with_paths(texts, width, trees, depth))
    # One class for each distinct set, named by its smallest id; a class of thousands of copies walks once.
    worded = wide.where("id is not null and n_shingles > 0")
    classes = worded.groupBy("digest").agg(F.min(F.struct("id", "n_shingles", "sketch", "tokens", "parity", "broad")).alias("head"), F.count("*").alias("copies"))
    classes = cut(classes.select("digest", "copies", "head.*"))
    # Written once: what pairs need of the short sets is read from here.
    sets = worded.select("id", "digest", "n_shingles", "short")
    rows = cut(wide.select("id", "n_shingles", "digest"))
    del wide, worded
    texts = texts.where("id is not null")
    common = common_shingles(texts, rows.count(), width)
    stars = cut(possible(candidates(classes, trees, depth, small, bits), classes, percent))
    first = components(_contracted(confirmed(stars, classes, sets, texts, width, percent))).withColumnRenamed("node", "id")
    del stars
    # Exactly, but only between documents that the links so far leave apart.
    apart = classes.join(first, "id", "left").select("id", F.coalesce("component", "id").alias("component")).distinct()
    pairs = narrowed(_list_pairs(with_prefixes(texts, width, percent, common), apart, classes, percent), classes, percent)
    links = confirmed(pairs, classes, sets, texts, width, percent)
    # These join whole components, so the second run is over components.
    second = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    placed = classes.join(first, "id", "left").select("digest", "id", "copies", F.coalesce("component", "id").alias("component"))
    placed = placed.join(second, "component", "left").select("digest", "id", "copies", F.coalesce("whole", "component").alias("component_id"))
    # Only classes that say something to their rows are dealt out; any other row is its own component.
    told = placed.where("copies > 1 or component_id < id").select("digest", "component_id", every_salt())
    found = rows.withColumn("salt", salt_of("id")).join(told, ["digest", "salt"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.when(F.col("id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
