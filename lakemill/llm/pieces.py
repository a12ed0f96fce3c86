"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model's normaliser, pieces and byte fallback are compiled into one transducer from characters to piece ids. A text is
composed with it position by position, and the shortest path in the tropical semiring (least total cost, sums along a
path) is its encoding. For unigram models a piece costs its negative log-probability. For BPE models a second
transducer is composed, whose states are the pieces: it lets piece b follow piece a at cost 0 if merging their
characters by rank gives just a and b again, and at infinite cost otherwise. Exactly one path through a text has a
finite cost then, and it is the one that the merges make. With two costs only, 0 and infinity, the shortest path is
whatever path is finite: it is searched depth first, longest pieces first, rather than by relaxing all positions, which
is done for unigram models. Whether b may follow a is worked out by merging a and b, when the pair is first met.

The normaliser is a rewriting transducer: at each place the longest of its left sides is replaced by its right side.
Files whose normaliser is not the identity are refused, as their tables are not read here; rules can be given instead.

Pieces never cross from a word into the blank that follows it, so the path is found word by word, and each worker
remembers the words it has met: those of late, and those of the generation before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import small_batches

BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protobuf message: number, and an int or the bytes."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if kind == 2 else ((8 if kind == 1 else 4), i)
            value, i = data[i : i + size], i + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file holds that encoding needs. kind is 1 for unigram models and 2 for BPE."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int = 2
    dummy_prefix: bool = True
    trim: bool = False
    escape: bool = True
    normaliser: str = "identity"
    rules: dict[str, str] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        """The model in a file that the driver reads; tasks get it by broadcast, its size is that of the vocabulary."""
        model = cls([], [], [])
        with open(path, "rb") as f:
            data = f.read()
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                model.pieces.append(own.get(1, b"").decode("utf-8"))
                model.scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
                model.types.append(own.get(3, _NORMAL))
            elif number == 2:
                model.kind = dict(_fields(value)).get(3, 1)
            elif number == 3:
                own = dict(_fields(value))
                model.normaliser = own.get(1, b"identity").decode()
                model.dummy_prefix, model.trim, model.escape = bool(own.get(3, 1)), bool(own.get(4, 1)), bool(own.get(5, 1))
        if model.kind not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        if model.normaliser != "identity":
            raise ValueError(f"the normaliser {model.normaliser} is not supported")
        return model


@dataclass
class Transducer:
    """A compiled model. words, older and follows are what a worker remembers: two generations of at most `remember`
    words of at most 64 characters each, and about as many pairs of pieces."""

    model: PieceModel
    remember: int = 200_000
    words: dict[str, tuple[int, ...]] = field(default_factory=dict)
    older: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        m = self.model
        self.ids = {p: i for i, p in enumerate(m.pieces) if m.types[i] in (_NORMAL, _USER)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(m.pieces) if m.types[i] == _BYTE}
        self.unknown = next((i for i, t in enumerate(m.types) if t == _UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        self.values = {p: m.scores[i] for p, i in self.ids.items()}
        self.follows: dict[str, dict[str, bool]] = {}
        self.held = 0
        # The normaliser's rules, the longest left side first; the escape of blanks is the last of them.
        rules = dict(m.rules) | ({} if not m.escape or " " in m.rules else {" ": BLANK})
        self.rules = {a: b.replace(" ", BLANK) if m.escape else b for a, b in rules.items() if a}
        self.single = str.maketrans(self.rules) if all(len(a) == 1 for a in self.rules) else None
        self.rewrite = re.compile("|".join(re.escape(a) for a in sorted(self.rules, key=len, reverse=True)) or r"(?!)")
        # The first transducer: a trie of characters, with the piece at "" where one ends. A BPE piece that merging
        # does not make from its own characters is on no path.
        self.trie: dict = {}
        for p in self.ids:
            if m.kind == 1 or len(p) == 1 or self.merged(p) == [p]:
                state = self.trie
                for c in p:
                    state = state.setdefault(c, {})
                state[""] = p
        crossing = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.split = re.compile("(?s).+" if crossing else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.raw = [bytes([int(p[3:5], 16)]) if t == _BYTE else b"" if t in (_CONTROL, _UNUSED) else p.replace(BLANK, " ").encode() for p, t in zip(m.pieces, m.types, strict=True)]

    def normalise(self, text: str) -> str:
        m = self.model
        if m.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if m.dummy_prefix and text:
            text = " " + text
        if self.single is not None:
            return text.translate(self.single) if len(self.rules) > 1 else text.replace(" ", BLANK) if m.escape else text
        return self.rewrite.sub(lambda x: self.rules[x[0]], text)

    def merged(self, text: str) -> list[str]:
        """What merging by rank makes of a short string: the best-scored neighbours first, the leftmost of equals."""
        parts, value, none = list(text), self.values.get, float("-inf")
        pairs = [value(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = value(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = value(parts[k] + parts[k + 1], none)
        return parts

    def may_follow(self, a: str, b: str) -> bool:
        """The weight of the second transducer: whether piece b keeps apart from the piece a before it."""
        return self.merged(a + b) == [a, b]

    def bpe_path(self, word: str) -> tuple[int, ...]:
        """The ids on the one path of finite cost through one word, found depth first with the longest pieces first.

        A prefix of the word has just one such path, so a position from which the end was not reached is left for good.
        """
        n, ids, follows, trie = len(word), self.ids, self.follows, self.trie
        path: list[str] = []
        choices: list[list[str] | None] = [None] * n
        left = [False] * (n + 1)
        i, before = 0, ""
        while i < n:
            choice = choices[i]
            if choice is None:
                choice = choices[i] = []
                state = trie
                for c in word[i : i + self.longest]:
                    state = state.get(c)
                    if state is None:
                        break
                    if "" in state:
                        choice.append(state[""])
                if not choice:  # no piece has this character, so nothing merges across it
                    choice.append(word[i])
            allowed = follows.get(before)
            if allowed is None:
                allowed = follows[before] = {}
            while choice:
                piece = choice.pop()
                if left[i + len(piece)]:
                    continue
                if before:
                    free = allowed.get(piece)
                    if free is None:
                        free = piece not in ids or self.may_follow(before, piece)
                        self.held += 1
                        allowed[piece] = free
                    if not free:
                        continue
                path.append(piece)
                i += len(piece)
                before = piece if piece in ids else ""
                break
            else:
                left[i] = True
                i -= len(path.pop())
                before = path[-1] if path and path[-1] in ids else ""
        if self.held > self.remember:
            self.held, self.follows = 0, {}
        return tuple([x for p in path for x in ((ids[p],) if p in ids else self.fallback(p))])

    def fallback(self, character: str) -> list[int]:
        """A character without a piece: its bytes, or the unknown piece."""
        return [self.bytes[x] for x in character.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def path(self, word: str) -> tuple[int, ...]:
        """The ids on the shortest path through one word."""
        if self.model.kind == 2:
            return self.bpe_path(word)
        n, ids, scores, floor = len(word), self.ids, self.model.scores, min(self.model.scores) - 10
        cost, begin = [0.0, *[float("inf")] * n], [0] * (n + 1)
        for i in range(n):
            state = self.trie
            for j in range(i, n):
                state = state.get(word[j])
                if state is None:
                    break
                if (piece := state.get("")) is not None and cost[i] - scores[ids[piece]] < cost[j + 1]:
                    cost[j + 1], begin[j + 1] = cost[i] - scores[ids[piece]], i
            if word[i] not in ids and cost[i] - floor < cost[i + 1]:
                cost[i + 1], begin[i + 1] = cost[i] - floor, i
        out: list[int] = []
        while n:
            piece = word[begin[n] : n]
            out.extend([ids[piece]] if piece in ids else reversed(self.fallback(piece)))
            n = begin[n]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        words, extend = self.words, out.extend
        for word in self.split.findall(self.normalise(text)):
            ids = words.get(word)
            if ids is None:
                ids = self.older.get(word) or self.path(word)
                if len(word) <= 64:
                    if len(words) >= self.remember:
                        self.older, self.words = words, {}
                        words = self.words
                    words[word] = ids
            extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


class _Shared:
    def __init__(self, df: DataFrame, model: PieceModel) -> None:
        small_batches(df.sparkSession)
        self.model = df.sparkSession.sparkContext.broadcast(model)
        self.id = sha256("\n".join(model.pieces).encode()).hexdigest()

    @property
    def value(self) -> PieceModel:
        return self.model.value


_compiled: dict[str, Transducer] = {}


def _transducer(shared: _Shared) -> Transducer:
    """The worker's own transducer, kept with what it remembers for the tasks that follow."""
    if shared.id not in _compiled:
        _compiled.clear()
        _compiled[shared.id] = Transducer(shared.value)
    return _compiled[shared.id]


def encode(docs: DataFrame, model: PieceModel, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the piece ids of each whole text as array<int>; a null text has null ids, an empty one no ids.

    All columns stay; one that is already named like ids_col is replaced. Rows are independent of each other, so nulls,
    ties and repeats in other columns do not matter. Blanks and the sign U+2581 become the same pieces, as the model
    has it; decode() gives blanks for both.
    """
    shared = _Shared(docs, model)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _transducer(shared)
        for texts in batches:
            yield pd.Series([None if x is None else np.array(t.encode(x), np.int32) for x in texts], dtype=object)

    return docs.withColumn(ids_col, run(F.make_valid_utf8(F.col(text_col))))


def decode(docs: DataFrame, model: PieceModel, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """docs with the text that piece ids stand for; null ids give null. Ids outside the vocabulary are an error."""
    shared = _Shared(docs, model)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _transducer(shared)
        for ids in batches:
            yield pd.Series([None if x is None else t.decode(x) for x in ids], dtype=object)

    return docs.withColumn(text_col, run(F.col(ids_col)))
