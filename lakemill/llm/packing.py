"""Packing tokenized documents into sequences of one length, by best-fit decreasing.

A document becomes its token ids and an end id. Documents longer than a window are first cut into full windows; what is
left of them, and all shorter ones, are dealt by hash into blocks of about 256 windows. In a block the longest piece
comes first, and each goes to the open window that it fills best, which a segment tree over remaining capacities finds
in some steps. Blocks are packed independently, so no task sees more than its block, and only the numbers of a piece
are moved, unless its ids are asked for.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import cut, small_batches

#: A batch of texts is taken in parts of about so many bytes.
PART_BYTES = 1 << 22

#: The most words that a worker remembers, in each of two generations, and the longest of them.
MEMORY, WORD_CHARS = 1 << 18, 48

#: Words of letters alone are encoded so many at a time.
TOGETHER = 1000

#: A sign that ends a sentence or a part of it, after a letter: a tokenizer that separates letters from other signs
#: begins a word there. Not after a dotted capital I, whose lower case is two signs, the second no letter.
AFTER_LETTER = r"([A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?])"


class Words:
    """Token ids of texts by a tokenizer of the `tokenizers` library, word by word.

    Words are what ASCII white space separates, and signs at their end. That is exact for tokenizers that drop white
    space before their merges, and neither join nor look across it, nor from a letter to such a sign. Words are encoded
    once and remembered. Those of letters alone are encoded together, if the model marks the last token of each word;
    where the marks are not as many as the words, each is encoded by itself.
    """

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.young, self.old = Tokenizer.from_str(content), {}, {}
        suffix, vocabulary = json.loads(content)["model"].get("end_of_word_suffix"), self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def new(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, as 32-bit numbers."""
        plain = [w for w in words if w.isalpha()] if self.last.any() else []
        found: dict[str, bytes] = {}
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            (ids,) = self._ids([" ".join(some)])
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                raw, places = ids.tobytes(), [0, *(4 * ends).tolist()]
                found |= {w: raw[a:b] for w, a, b in zip(some, places, places[1:], strict=False)}
        alone = [w for w in words if w not in found]
        return found | dict(zip(alone, (x.tobytes() for x in self._ids(alone)), strict=True))

    def encoded(self, words: list[str]) -> list[bytes]:
        found = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            older = {words[i]: ids for i in missing if (ids := self.old.get(words[i])) is not None}
            fresh = older | self.new([words[i] for i in missing if words[i] not in older])
            for i in missing:
                found[i] = fresh[words[i]]
            self.young |= {w: ids for w, ids in fresh.items() if len(w) <= WORD_CHARS}
            if len(self.young) > MEMORY:
                self.old, self.young = self.young, {}
        return found

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, one after the other, and where each text's begin and end."""
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, AFTER_LETTER, r"\1 \2"))
        words = lists.flatten().dictionary_encode()
        found = self.encoded(words.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = size[word]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat((np.cumsum(size) - size)[word] - (ends - n), n)
        bounds = np.concatenate(([0], ends))[lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()]
        return flat[at], bounds


@lru_cache(maxsize=2)
def _words(content: str) -> Words:
    """Kept in a worker, which serves many tasks."""
    return Words(content)


def parts(batch: pa.RecordBatch, text: str = "text", most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about so many bytes of text; a text is never split."""
    size = np.cumsum(pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)) // most
    edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def joined(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about so many bytes of text, from smaller ones and larger ones."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in parts(batch, text, most):
            held.append(part)
            size += pc.sum(pc.binary_length(part[text])).as_py() or 0
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """The pieces of docs(doc_id, text): (doc_id, start, length, ids_crc32, doc_tokens, and ids if they are kept).

    A document longer than a window gives full windows and what is left, any other is one piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        for part in joined(batches):
            ids, bounds = words.ids(part["text"])
            rows, starts, kept = [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), window):
                    piece = own[start : start + window]
                    rows.append(i)
                    starts.append((start, len(piece), crc32(piece.tobytes()), len(own)))
                    if keep_ids:
                        kept.append(piece.astype(np.int64))
            numbers = np.array(starts, np.int64).reshape(-1, 4)
            columns = [part["doc_id"].take(pa.array(rows, pa.int64())), *[pa.array(numbers[:, k]) for k in range(4)]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.list_(pa.int64()))] if keep_ids else []), names + (["ids"] if keep_ids else []))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<long>" if keep_ids else "")
    return docs.mapInArrow(run, schema)


class OpenWindows:
    """Open windows by what they have left: a segment tree over capacities tells which of them any window has."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.windows: dict[int, list[int]] = defaultdict(list)

    def _mark(self, capacity: int, some: int) -> None:
        i = capacity + self.leaves
        self.some[i] = some
        while i > 1:
            i >>= 1
            either = self.some[2 * i] | self.some[2 * i + 1]
            if self.some[i] == either:
                return
            self.some[i] = either

    def add(self, capacity: int, window: int) -> None:
        if capacity:
            if not self.windows[capacity]:
                self._mark(capacity, 1)
            self.windows[capacity].append(window)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out a window with the least capacity that holds the length: (capacity, window), None if there is none."""
        i = length + self.leaves
        if not self.some[i]:
            # Up until something stands to the right, then down to its leftmost leaf.
            while i > 1 and (i & 1 or not self.some[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.some[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        window = self.windows[capacity].pop()
        if not self.windows[capacity]:
            self._mark(capacity, 0)
        return capacity, window


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece, with lengths in descending order, none above the window."""
    open_, found, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        best = open_.tightest(length)
        if best is None:
            best, used = (window, used), used + 1
        capacity, at = best
        found.append(at)
        offsets.append(window - capacity)
        open_.add(capacity - length, at)
    return found, offsets


def _packed(window: int) -> Callable[[pa.Table], pa.Table]:
    """A block's pieces with their sequence and place."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [("length", "descending"), ("draw", "ascending")]))
        found, offsets = best_fit(rows["length"].to_pylist(), window)
        number = pa.array((rows["block"][0].as_py() << 24) + np.array(found, np.int64))
        return rows.drop_columns(["block", "draw"]).append_column("sequence_id", number).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2, windows: int = 256, keep_ids: bool = False
) -> DataFrame:
    """Where each piece of each document goes: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    tokenizer is the content of a tokenizer's JSON file; see Words for which are suitable. start is the piece's place
    in its document, offset in its sequence; both are gapless. Null and empty texts are documents of the end id alone.
    Bytes that are not valid UTF-8 count as U+FFFD. Null and repeated ids, and repeated rows, are documents of their
    own. An empty table gives no pieces. Other columns of docs, whatever their names, are not read. keep_ids adds the
    pieces' ids, which then move with them. windows is the size of a block; a block's last windows are not full.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    found = cut(pieces(own, tokenizer, window, end_id, keep_ids))
    blocks = max(1, (found.agg(F.sum("length")).first()[0] or 0) // (window * windows))
    # Rows that agree in everything are told apart by their place in the checkpoint, so that they spread over blocks.
    draw = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    dealt = found.withColumn("draw", draw).withColumn("block", F.pmod("draw", F.lit(blocks)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return dealt.groupBy("block").applyInArrow(_packed(window), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of pack(keep_ids=True): (sequence_id, ids, lengths, doc_ids), pieces in order, not padded."""
    piece = F.struct("offset", "doc_id", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"), F.col("p.doc_id").alias("doc_ids"))
