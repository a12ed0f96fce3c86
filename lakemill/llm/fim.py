"""Fill-in-middle transformation, cut at unit ends that are found eight bytes at a time.

A text is units of a word and the white space before it; white space at the end is a unit of its own. The bytes of a
whole batch are viewed as 64-bit words. Arithmetic on a word marks each of its bytes that ends a unit, its bits are
counted, and the running count tells which word holds the k-th end; the place within that word is resolved on its
eight bytes. Code points are counted the same way. No text is decoded or copied but for its output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import small_batches
from lakemill.llm.packing import parts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)


def _below(words: np.ndarray, limit: int) -> np.ndarray:
    """The high bit of each byte, none of them above 127, that is less than the limit."""
    return ~(words + _ONES * np.uint64(128 - limit)) & _HIGH


def blanks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a blank or one of the ASCII controls 9 to 13."""
    low = words & _LOW
    blank = _below(low ^ (_ONES * np.uint64(0x20)), 1)
    return (blank | (_below(low, 14) & ~_below(low, 9))) & ~words


class Marks:
    """Marked bytes of a buffer: how many come before a byte (rank), and where the k-th is (select)."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.before = words, np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The number of marked bytes before each place."""
        word, inside = at >> 3, (at & 7).astype(np.uint64) * np.uint64(8)
        own = self.words[np.minimum(word, len(self.words) - 1)] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[word] + np.bitwise_count(own)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th marked byte, k from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left = k - self.before[word]
        counts = np.cumsum(self.words[word].astype("<u8").view(np.uint8).reshape(-1, 8) >> 7, axis=1)
        return word * 8 + (counts < left[:, None]).sum(axis=1)


def unit_ends(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[Marks, Marks]:
    """(ends of units, first bytes of code points) in the texts data[start:stop], which follow each other."""
    padded = np.zeros(-(-(len(data) + 1) // 8) * 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8").astype(np.uint64, copy=False)
    blank = blanks(words)
    after = (blank >> np.uint64(8)) | (np.append(blank[1:], np.uint64(0)) << np.uint64(56))
    ends = ~blank & _HIGH & after
    # What follows a text's last byte is another text: that byte ends a unit, be it a blank or not.
    last = stops[stops > starts] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) * np.uint64(8)))
    return Marks(ends), Marks(~(words & ~(words << np.uint64(1))) & _HIGH)


def _cuts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of each text: its start, both cuts and its end in the buffer, its units, the code points before and between the cuts."""
    texts = batch["text"]
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_binary(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts, stops = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    ends, points = unit_ends(data, starts, stops)
    base = ends.rank(starts)
    n = ends.rank(stops) - base
    one, two = (batch[h].to_numpy() % (n + 1) for h in ("h1", "h2"))
    places = []
    for k in (np.minimum(one, two), np.maximum(one, two)):
        at = starts.copy()
        some = k > 0
        at[some] = ends.select((base + k)[some]) + 1
        places.append(at)
    a, b = places
    chars = [points.rank(x) for x in (starts, a, b)]
    return data, starts, a, b, stops, n, chars[1] - chars[0], chars[2] - chars[1]


def draws(id_col: str, seed: int) -> list[Column]:
    """h1 to h4: the first four groups of eight hex digits of the digest of seed and id; a null id has no digits."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(name, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """The documents for training: (doc_id, n, form, output, prefix_chars, middle_chars, text_sha256), a row for each of docs.

    n counts units. Of rate in a hundred documents, prefix, middle and suffix are cut at unit ends and marked; spm_rate
    in a hundred of these have the suffix first. All others, texts that hold a mark, and null and empty texts (which
    count as empty) are plain: output is the text and the counts of code points are null. Draws follow from the id
    alone, so rows that repeat an id are cut in the same way. Bytes that are not valid UTF-8 stay as they are; as code
    points count all bytes but continuation bytes. An empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(id_col, seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (F.pmod(h3, F.lit(100)) >= rate)
    form = F.when(plain, "plain").when(F.pmod(h4, F.lit(100)) < spm_rate, "spm").otherwise("psm").alias("form")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("text"), F.sha2(text, 256).alias("text_sha256"), form, h1, h2)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                data, starts, a, b, stops, n, prefix, middle = _cuts(part)
                raw, forms, out = data.tobytes(), part["form"].to_pylist(), []
                for kind, i, j, k, e in zip(forms, starts.tolist(), a.tolist(), b.tolist(), stops.tolist(), strict=True):
                    if kind == "plain":
                        out.append(raw[i:e])
                    elif kind == "psm":
                        out.append(b"".join((p, raw[i:j], s, raw[k:e], m, raw[j:k])))
                    else:
                        out.append(b"".join((s, raw[k:e], p, raw[i:j], m, raw[j:k])))
                no = np.array([f == "plain" for f in forms], bool)
                columns = [part["doc_id"], pa.array(n), part["form"], pa.array(out, pa.binary()), pa.array(prefix, mask=no), pa.array(middle, mask=no), part["text_sha256"]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars", "text_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, n long, form string, output binary, prefix_chars long, middle_chars long, text_sha256 string")
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Neither text nor cut texts hold a mark, so the first of each is the one set."""
    marks = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

    def split(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        at, then = F.locate(second, output), F.locate(third, output)
        own = len(first) + 1
        return F.substring(output, F.lit(own), at - own), F.substring(output, at + len(second), then - at - len(second)), F.substring(output, then + len(third), F.length(output))

    prefix, suffix, middle = split(*marks["psm"])
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = split(*marks["spm"])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
