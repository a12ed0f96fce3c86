"""Mixing sources to target weights by the cube method of balanced sampling.

Each source has a target in words. Documents are taken a whole number of times; what remains of the target is a
fractional inclusion probability, the same for all documents of the source. The cube method moves these probabilities
along the null space of the balancing constraints (number of documents, number of words) until they reach 0 or 1. It
runs in blocks of bounded size: a block leaves at most as many open documents as there are constraints, the open ones
of all blocks meet in the next, far fewer blocks, and only the few that the last block of a source leaves open are
landed by the choice that misses the constraints least.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import SALTS, cut, every_salt, words


#: Of the draws; the same documents are taken in every run.
SEED = 11


#: What tells a row from all others: its id, its words, the draw, and its running number among rows that agree in these.
KEY = ("doc_id", "size", "draw", "twin")


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, prefix: str = "") -> DataFrame:
    """docs with the columns of KEY but the id, under prefixed names. Rows that no column of these tells apart have one
    id, draw and size, and any numbering of them gives the same mix."""
    size, draw = f"{prefix}size", f"{prefix}draw"
    rows = docs.withColumns({size: F.size(words(text_col)).cast("long"), draw: F.xxhash64(id_col, text_col, F.lit(seed))})
    return rows.withColumn(f"{prefix}twin", F.row_number().over(Window.partitionBy(draw, id_col, size).orderBy(source_col)))


def same_row(a: DataFrame, b: DataFrame, id_col: str = "doc_id", prefix: str = "") -> Column:
    """Whether a row of a, numbered with a prefix, is the row of b. A hash alone would join rows that collide."""
    return a[id_col].eqNullSafe(b["doc_id"]) & (a[f"{prefix}size"] == b["size"]) & (a[f"{prefix}draw"] == b["draw"]) & (a[f"{prefix}twin"] == b["twin"])


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) of sizes(source, size); n_docs counts documents with words.

    Sources in code point order, null last, get the weights in turn. Their targets share `share` times all words by
    weight; no target passes limit times its source's words, and what is above is shared out again by weight: with
    sources in order of words per weight, those before a cut are at their limit and the rest share what is left.
    The window runs over the table of sources, which has one row for each.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("ratio", limit * F.col("source_size") / F.col("weight"))
    order, every = Window.orderBy("ratio", F.col("source").asc_nulls_last()), Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("source_size").over(every) * share
    left = whole - F.coalesce(F.sum(limit * F.col("source_size")).over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weights_left).withColumn("at", F.row_number().over(order))
    # The level at the first source whose ratio is above it holds for that source and all after it.
    level = F.min_by("level", F.when(F.col("ratio") > F.col("level"), F.col("at"))).over(every)
    target = F.least(limit * F.col("source_size"), F.coalesce(level * F.col("weight"), limit * F.col("source_size")))
    return per.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move p along the null space of the two constraints x (n, 2), the first of them ones, until at most two entries
    are strictly between 0 and 1."""
    p, tiny = p.copy(), 1e-9
    waiting = np.flatnonzero((p > tiny) & (p < 1 - tiny))[::-1].tolist()
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            return p
        a, b, c = x[active, 1]
        u = np.array([b - c, c - a, a - b])  # orthogonal to ones and to the sizes
        if not u.any():
            u[:2] = 1, -1
        u /= np.abs(u).max()
        q = p[active]
        moved = u != 0
        up = np.min(np.where(u > 0, 1 - q, q)[moved] / np.abs(u[moved]))
        down = np.min(np.where(u > 0, q, 1 - q)[moved] / np.abs(u[moved]))
        q = q + (up if rng.random() * (up + down) < down else -down) * u
        q[q < tiny], q[q > 1 - tiny] = 0.0, 1.0
        p[active] = q
        active = [i for i, v in zip(active, q.tolist(), strict=True) if 0 < v < 1]


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Round the few open entries by the choice whose totals are nearest to the constraints, words before documents."""
    left = np.flatnonzero((p > 0) & (p < 1))
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    miss = np.abs(choices @ x[left] - p[left] @ x[left])
    p = p.copy()
    p[left] = choices[np.lexsort((miss[:, 0], miss[:, 1]))[0]]
    return p


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 128, seed: int = SEED, keyed: bool = False, **targeting: object) -> DataFrame:
    """How often each document is taken: (doc_id, source, size, source_size, target, copies, taken), a row for each of docs.

    size is the number of words, taken = size * copies. Documents without words, null and empty texts among them, are
    never taken. A source whose target is a whole multiple of its words takes all documents equally often. Null
    sources are one source, the last; null ids and repeated rows are documents like any other, and rows that agree in
    id and text are told apart by their running number among themselves. Reruns give the same result: blocks, order
    and draws follow from hashes of id and text. Texts are not moved, only their sizes. keyed adds
    draw and twin, which make up KEY with id and size; see numbered().
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    sizes = own.select("doc_id", "source", F.size(words("text")).cast("long").alias("size"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("draw"))
    sizes = cut(sizes.withColumn("twin", F.row_number().over(Window.partitionBy("draw", "doc_id", "size").orderBy("source"))))
    goal = cut(targets(sizes, **targeting))
    # Sources are few, yet nothing bounds their number: a join with hot sources dealt by salt, no broadcast hint.
    key = F.struct("source", F.pmod("draw", F.lit(SALTS)).alias("salt"))
    dealt = goal.select("source", "source_size", "n_docs", "target", every_salt()).select(F.struct("source", "salt").alias("key"), "source_size", "n_docs", "target")
    rows = sizes.withColumn("key", key).join(dealt, "key")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12).cast("long")
    rows = rows.select(
        "doc_id", "source", "size", "source_size", "target", "draw", "twin", whole.alias("whole"),
        F.greatest(F.lit(0.0), ratio - whole).alias("p"), F.ceil(F.col("n_docs") / block).alias("blocks"),
    )
    rows = cut(rows)
    open_, decided = rows.where("size > 0 and p > 0").select("source", *KEY, "p", "blocks"), []
    left = goal.agg(F.ceil(F.max("n_docs") / block)).first()[0] or 0
    while left:
        part = F.pmod(F.xxhash64("draw", F.lit(len(decided))), "blocks").alias("part")
        flown = open_.withColumn("part", part).groupBy("source", "part").applyInPandas(_decide(block, seed), open_.schema)
        decided.append(cut(flown))
        open_, left = decided[-1].where("p > 0 and p < 1"), -(-2 * left // block) if left > 1 else 0
    rounded = [d.where("p = 0 or p = 1").select(*KEY, F.col("p").cast("long").alias("extra")) for d in decided]
    found = rows.withColumn("extra", F.lit(0).cast("long"))
    if rounded:
        extra = reduce(DataFrame.union, rounded)
        found = rows.join(extra, same_row(rows, extra), "left").select(*[rows[c] for c in rows.columns], extra["extra"])
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(0).cast("long")
    return found.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), *(["draw", "twin"] if keyed else []))


def _decide(block: int, seed: int, landed: int = 10) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The flight of one block; in the block that is its source's only one, `landed` documents of
    evenly spread ranks of size wait for landing, so that their totals come near to anything in between."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = int(rows["blocks"].iloc[0])
        rows = rows.sort_values(["size", "draw", "twin"] if blocks == 1 else ["draw", "size", "twin"], ascending=False, kind="stable")
        x = np.column_stack([np.ones(len(rows)), rows["size"].to_numpy(float)])
        rng, p = np.random.default_rng([seed, len(rows), int(rows["size"].sum())]), rows["p"].to_numpy(float).copy()
        flown = np.ones(len(p), bool)
        if blocks == 1:
            flown[np.linspace(0, len(p) - 1, landed + 1).astype(int)[1:]] = False
        p[flown] = flight(p[flown], x[flown], rng)
        p = landing(p, x) if blocks == 1 else p
        return rows[["source", *KEY]].assign(p=p, blocks=-(-2 * blocks // block))

    return run
