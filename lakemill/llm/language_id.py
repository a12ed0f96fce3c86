"""Language identification by a byte convolutional network that is trained in numpy.

A window of fixed length is embedded byte by byte, convolved with filters of several widths, max-pooled over its length
and classified by a softmax. Convolution over embedded bytes is a sum of one table row for each tap, so prediction looks
rows up: neighbouring taps are merged into tables over byte pairs. A text is cut into windows that cover all of it, and
the windows' log-probabilities are averaged, each with the weight of the bytes that no window before it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import fold, small_batches, text_or_empty


@dataclass
class ByteNetwork:
    """embed: (256, d); filters: by width a (width, d, n) array; bias of the n filters each; dense: (sum of n, labels)."""

    labels: list[str]
    window: int
    embed: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> dict[int, list[tuple[int, int, np.ndarray]]]:
        """By width the lookups that make up the convolution: (first tap, number of taps, table over those taps' bytes)."""
        out: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for width, w in self.filters.items():
            tap = [(self.embed @ w[k]).astype(np.float32) for k in range(width)]
            for k in range(0, width, 2):
                pair = k + 1 < width
                table = (tap[k][:, None, :] + tap[k + 1][None, :, :]).reshape(65536, -1) if pair else tap[k]
                out.setdefault(width, []).append((k, 1 + pair, np.ascontiguousarray(table)))
        return out

    def pooled(self, x: np.ndarray, tables: dict[int, list[tuple[int, int, np.ndarray]]]) -> np.ndarray:
        """The pooled, rectified features of windows x (n, window) of bytes."""
        pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        single = x.astype(np.int32)
        features = []
        for width, parts in tables.items():
            span, total = x.shape[1] - width + 1, None
            for k, taps, table in parts:
                rows = table[(pairs if taps == 2 else single)[:, k : k + span]]
                total = rows if total is None else np.add(total, rows, out=total)
            features.append(np.maximum(total.max(axis=1) + self.biases[width], 0))
        return np.concatenate(features, axis=1)

    def log_probabilities(self, x: np.ndarray, tables: dict[int, list[tuple[int, int, np.ndarray]]]) -> np.ndarray:
        z = self.pooled(x, tables) @ self.dense + self.dense_bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows(data: bytes, size: int) -> np.ndarray:
    """Windows of one length that cover data, (n, size); the last one ends where data does, a short text is padded by blanks."""
    if len(data) <= size:
        return np.frombuffer(data.ljust(size, b" "), np.uint8)[None, :]
    starts = np.minimum(np.arange(0, len(data), size), len(data) - size)
    return np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), size)[starts]


def window_weights(bytes_: int, size: int) -> np.ndarray:
    """By window the share of it that no window before it holds; the blanks that pad a short text count as held."""
    n = max(1, -(-bytes_ // size))
    out = np.ones(n)
    out[-1] = (bytes_ - (n - 1) * size) / size if n > 1 else 1.0
    return out


def train(texts: list[str], langs: list[str], window: int = 128, dim: int = 6, widths: tuple[int, ...] = (2, 3, 4), filters: int = 8, epochs: int = 6, rate: float = 0.01, batch: int = 64, seed: int = 7) -> ByteNetwork:
    """Fit a network by Adam on labelled windows; the same rows in the same order give the same network."""
    rng, labels = np.random.default_rng(seed), sorted(set(langs))
    x, y = [], []
    for text, lang in zip(texts, langs, strict=True):
        w = windows(text.encode("utf-8", "replace"), window)
        x.append(w)
        y += [labels.index(lang)] * len(w)
    x, y = np.concatenate(x), np.array(y)
    weight = (len(y) / len(labels) / np.bincount(y, minlength=len(labels)))[y]
    p = {"e": rng.normal(0, 0.5, (256, dim)), "d": rng.normal(0, 0.3, (len(widths) * filters, len(labels))), "c": np.zeros(len(labels))}
    for k in widths:
        p[f"f{k}"], p[f"b{k}"] = rng.normal(0, (2 / (k * dim)) ** 0.5, (k, dim, filters)), np.zeros(filters)
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(epochs):
        for ids in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            b, n, g = x[ids], np.arange(len(ids)), {k: np.zeros_like(a) for k, a in p.items()}
            e, pooled, where = p["e"][b], [], {}
            for k in widths:
                span = window - k + 1
                conv = sum(e[:, j : j + span] @ p[f"f{k}"][j] for j in range(k))
                where[k] = conv.argmax(axis=1)
                pooled.append(np.take_along_axis(conv, where[k][:, None, :], 1)[:, 0] + p[f"b{k}"])
            h = np.maximum(np.concatenate(pooled, 1), 0)
            z = h @ p["d"] + p["c"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[n, y[ids]] -= 1
            z *= weight[ids][:, None] / len(ids)
            g["d"], g["c"] = h.T @ z, z.sum(0)
            back = (z @ p["d"].T) * (h > 0)
            for i, k in enumerate(widths):
                part = back[:, i * filters : (i + 1) * filters]
                g[f"b{k}"] = part.sum(0)
                for j in range(k):
                    byte = b[n[:, None], where[k] + j]
                    g[f"f{k}"][j] = np.einsum("nfd,nf->df", p["e"][byte], part)
                    np.add.at(g["e"], byte, np.einsum("nf,df->nfd", part, p[f"f{k}"][j]))
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return ByteNetwork(labels, window, p["e"], {k: p[f"f{k}"] for k in widths}, {k: p[f"b{k}"].astype(np.float32) for k in widths}, p["d"].astype(np.float32), p["c"].astype(np.float32))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", spans_per_label: int = 300, span: int = 1024, most_labels: int = 1000, **training: object) -> ByteNetwork | None:
    """A network learned from a bounded sample of labelled texts: about spans_per_label spans of each label.

    Whole texts are dealt into spans of so many characters, the last one shorter, and spans are drawn by hash, so every
    part of every text may be learned from. Rows without a label, or whose text has no letter, are not used; with no
    usable row there is no network. Rows that repeat id and text count once. A column of more than most_labels values is
    no column of languages and an error, so what reaches the driver is bounded.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & text_or_empty(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.make_valid_utf8(text_col).alias("text"), F.col(lang_col).alias("lang"))
    spans = F.ceil(F.length("text") / span)
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.sum(spans)).limit(most_labels + 1).collect()}
    if len(counts) > most_labels:
        raise ValueError(f"{lang_col} has more than {most_labels} values")
    if not counts:
        return None
    share = F.create_map(*[F.lit(y) for k, n in sorted(counts.items()) for y in (k, min(1.0, spans_per_label / n))])[F.col("lang")]
    named = rows.select("text", "lang", share.alias("share"), F.xxhash64("id", "text").alias("row"), spans.alias("spans"))
    draw = lambda k: F.pmod(F.xxhash64("row", k, F.lit("draw")), F.lit(1_000_000_007)) / 1_000_000_007
    drawn = named.select("row", "text", "lang", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("spans") - 1), lambda k: draw(k) < F.col("share"))).alias("k"))
    drawn = drawn.select("row", "k", F.substring(F.col("text"), (F.col("k") * span + 1).cast("int"), F.lit(span)).alias("text"), "lang").distinct()
    learned = sorted((r["row"], r["k"], r["text"], r["lang"]) for r in drawn.collect())
    return train([r[2] for r in learned], [r[3] for r in learned], **training) if learned else None


def predicted(network: ByteNetwork | None, docs: DataFrame, text_col: str = "text", part: int = 512) -> Column:
    """The prediction for docs' text as struct<lang_pred: string, score: double>, from every window of the whole text.

    Null texts and texts without a letter are `und` with score 0, as are all texts if there is no network. Bytes that are
    not valid UTF-8 count as U+FFFD. A long text
    is scored in parts of so many windows, so memory is bounded.
    """
    text = F.when(text_or_empty(text_col).rlike(r"\p{L}"), F.make_valid_utf8(F.col(text_col)))
    if network is None:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = shared.value
        tables, names = net.tables(), np.array(net.labels, object)
        for batch in batches:
            total, held = np.zeros((len(batch), len(net.labels))), np.zeros(len(batch))
            blocks, rows, weights, waiting = [], [], [], 0
            for i, text in enumerate([*batch, None]):
                data = text.encode("utf-8", "replace") if text is not None else b""
                found = windows(data, net.window) if text is not None else None
                share = window_weights(len(data), net.window)
                for k in range(0, len(found) if text is not None else 0, part):
                    blocks.append(found[k : k + part])
                    weights.append(share[k : k + part])
                    rows.append(np.full(len(blocks[-1]), i))
                    waiting += len(blocks[-1])
                if blocks and (waiting >= part or i == len(batch)):
                    x, at, w = np.concatenate(blocks), np.concatenate(rows), np.concatenate(weights)
                    for k in range(0, len(at), part):
                        np.add.at(total, at[k : k + part], net.log_probabilities(x[k : k + part], tables) * w[k : k + part, None])
                    np.add.at(held, at, w)
                    blocks, rows, weights, waiting = [], [], [], 0
            mean = np.exp(total / np.where(held > 0, held, 1)[:, None])
            mean /= mean.sum(axis=1, keepdims=True)
            yield pd.DataFrame({"lang_pred": np.where(held > 0, names[mean.argmax(axis=1)], "und"), "score": np.where(held > 0, mean.max(axis=1), 0.0)})

    return run(text)


def predict(docs: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row for each row of docs; see predicted().

    Only the id and the text of docs are read; null and repeated ids are carried through, an empty table gives an empty
    result.
    """
    return docs.select(F.col(id_col).alias("doc_id"), predicted(network, docs, text_col).alias("p")).select("doc_id", "p.lang_pred", "p.score")


def learned_and_predicted(docs: DataFrame, folds: int = 4, held: int = 2, **fitting: object) -> DataFrame:
    """predict() of all docs by a network fit on those outside the held-out fold; adds held_out."""
    network = fit(docs.where(fold("doc_id", folds) != held), **fitting)
    return predict(docs, network).select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
