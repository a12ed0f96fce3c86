"""Merkle manifests of a dataset, by checkpoint and recompute.

Every row is a leaf, the rows of a group are one tree in the order of their ids, and the roots of all groups are the
leaves of a last tree. Eight consecutive nodes become their parent; only every third level is stored. A proof takes a
leaf's siblings from the aligned subtree of at most 512 stored nodes that it stands in: the levels between are made
again from the stored ones, give their siblings, and are forgotten. So a manifest keeps one digest for 512 rows beside
the leaves, and a proof reads one subtree for each stored layer.

A tree's order needs no window over a group: rows are range-partitioned by group and id, numbered within their
partition, and a table of one row for each partition and group says how many came before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.llm.common import cut

#: Children of a node, as a power of two, and the levels from one stored layer to the next.
BITS, STEP = 3, 3
ARITY, SUBTREE = 1 << BITS, BITS * STEP

#: The name of the last tree, and what precedes the value of a group in the name of its own; a null group has the mark alone.
TOP, NULL_TREE, TREE = "*", "-", "="

#: The most rows of the table of partitions that are broadcast; with more, the join shuffles.
BROADCAST_ROWS = 50_000


def digest(*columns: Column) -> Column:
    """The lowercase hex SHA-256 of the columns' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*columns), 256)


def field(value: Column) -> Column:
    """A value as a leaf holds it: "-" for null, else its length in bytes, a colon, and itself; so no two rows agree in
    all bytes but not in all fields. Texts that are not valid UTF-8 count with the bytes that they have."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


@dataclass(frozen=True)
class Tree:
    """Trees of one kind: stored layers of (tree, idx, digest, height, ...), the leaves first, then every third level.

    height is how many levels the tree has above its leaves. Layer j holds the trees with more than 3 * (j - 1) levels.
    """

    layers: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest): the one node that is left of each tree."""
        return reduce(DataFrame.union, [layer.where(_top_layer() == j).select("tree", "digest") for j, layer in enumerate(self.layers)])


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups, and the tree over their roots."""

    groups: Tree
    top: Tree


def _top_layer() -> Column:
    """The stored layer that has a tree's root alone."""
    return F.ceil(F.col("height") / STEP).cast("int")


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows(tree, ...) with idx, the place in the tree by the given order, and height.

    Rows that agree in tree and order are interchangeable; they are told apart by their place in the checkpoint, so a
    third of all rows that repeat one id spread over partitions too.
    """
    fixed = cut(rows).withColumn("tie", F.monotonically_increasing_id())
    ordered = fixed.repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie").drop("tie")
    placed = cut(ordered.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = F.sum("n").over(own)
    height = reduce(Column.__add__, [(size > F.lit(1 << BITS * k)).cast("int") for k in range(63 // BITS)])
    parts = cut(parts.select("tree", "part", (before - F.col("first")).alias("shift"), height.alias("height")))
    parts = F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts
    found = placed.join(parts, ["tree", "part"]).withColumn("idx", F.col("place") + F.col("shift"))
    return found.select("tree", "idx", "digest", "height", *[c for c in rows.columns if c not in ("tree", "digest")])


def subtree_levels(nodes: list[str], height: int) -> list[list[str]]:
    """The levels of an aligned subtree from the given nodes upwards; a run of fewer than eight, even of one, is a parent too."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([sha256("".join(below[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(below), ARITY)])
    return levels


def _ordered(rows: pa.Table, layer: int) -> tuple[pa.Table, list[list[str]]]:
    """A subtree's rows in order, and all its levels."""
    rows = rows.take(pc.sort_indices(rows["idx"]))
    height = max(0, min(STEP, rows["height"][0].as_py() - STEP * layer))
    return rows, subtree_levels(rows["digest"].to_pylist(), height)


def _parents(layer: int) -> Callable[[pa.Table], pa.Table]:
    """The root of each subtree of a stored layer, as a node of the next."""

    def run(rows: pa.Table) -> pa.Table:
        rows, levels = _ordered(rows, layer)
        (node,) = levels[-1]
        return pa.table({"tree": rows["tree"][:1], "idx": [rows["idx"][0].as_py() >> SUBTREE], "digest": [node], "height": rows["height"][:1]})

    return run


def grown(leaves: DataFrame, order: list[str]) -> Tree:
    """The trees over leaves(tree, digest, order columns and any others), whose rows keep all their columns."""
    layers = [cut(_numbered(leaves, order))]
    highest = layers[0].agg(F.max("height")).first()[0] or 0
    schema = layers[0].select("tree", "idx", "digest", "height").schema
    while STEP * (len(layers) - 1) < highest:
        at = len(layers) - 1
        below = layers[at].where(F.col("height") > STEP * at).select("tree", "idx", "digest", "height")
        layers.append(cut(below.groupBy("tree", F.shiftright("idx", SUBTREE)).applyInArrow(_parents(at), schema)))
    return Tree(layers)


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", **carried: Column) -> Manifest:
    """The manifest of docs: a leaf of the given fields for each row, a tree for each value of group_col, null first.

    Leaves ascend by id, a null id first; rows that repeat an id follow each other by their leaf. Null and empty fields
    are told apart. A group of one row has that leaf as its root; an empty table has no trees, and no root. carried are
    further columns of docs, computed in the same pass over the texts, that stay with the leaves. Only digests, ids and
    groups leave the first stage, however long a text is. Other columns of docs are not read.
    """
    named = F.coalesce(F.concat(F.lit(TREE), F.col(group_col).cast("string")), F.lit(NULL_TREE)).alias("tree")
    rows = docs.select(named, F.col(id_col).alias("doc_id"), leaf(*[F.col(c) for c in fields]).alias("digest"), *[c.alias(k) for k, c in carried.items()])
    groups = grown(rows, ["doc_id", "digest"])
    # "-" comes before "=", and names with one mark are in the order of the bytes of what they name.
    roots = groups.roots().select(F.lit(TOP).alias("tree"), "digest", F.col("tree").alias("group"))
    return Manifest(groups, grown(roots, ["group"]))


_PROOF = "lefts array<string>, rights array<string>, tops array<string>"


def _siblings(layer: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each stored node of a subtree its siblings, level by level, followed by those of the subtree's own root."""

    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, levels = _ordered(rows, layer)
        lefts, rights = above["up_lefts"][0].as_py(), above["up_rights"][0].as_py()
        # Texts beside each node of a level, made once for all leaves below it.
        sides = [[("".join(level[i & -ARITY : i]), "".join(level[i + 1 : (i & -ARITY) + ARITY])) for i in range(len(level))] for level in levels[:-1]]
        own = [[side[i >> BITS * k] for k, side in enumerate(sides)] for i in range(rows.num_rows)]
        texts = pa.list_(pa.string())
        out = rows.append_column("lefts", pa.array([[x[0] for x in o] + lefts for o in own], texts))
        out = out.append_column("rights", pa.array([[x[1] for x in o] + rights for o in own], texts))
        return out.append_column("tops", pa.array([above["up_tops"][0].as_py()] * rows.num_rows, texts))

    return run


def _extended(tree: Tree, roots: DataFrame) -> DataFrame:
    """The leaves of all trees with their proofs; roots(tree, lefts, rights, tops) are the proofs of the trees' roots.

    lefts and rights are the digests beside the node on its way up, as hex text, an entry for each level.
    """
    above = None
    for j in reversed(range(len(tree.layers))):
        layer = tree.layers[j]
        ending = layer.where(_top_layer() == j).select("tree").join(roots, "tree").withColumn("idx", F.lit(0).cast("long"))
        tails = ending.select("tree", "idx", "lefts", "rights", "tops")
        if above is not None:
            tails = tails.unionByName(above.select("tree", "idx", "lefts", "rights", "tops"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layer.schema)
        rows = layer.groupBy("tree", F.shiftright("idx", SUBTREE))
        # New names, as the tails may come from the layer itself.
        tails = tails.select(*[F.col(c).alias(f"up_{c}") for c in tails.columns])
        above = rows.cogroup(tails.groupBy("up_tree", "up_idx")).applyInArrow(_siblings(j), f"{schema}, {_PROOF}")
    return above


def proofs(made: Manifest) -> DataFrame:
    """A row for each leaf: (doc_id, group, leaf, lefts, rights, subroot, root) and the carried columns.

    Folding the leaf with lefts and rights, level by level, gives the root; see folded().
    """
    none = F.array().cast("array<string>")
    base = made.top.roots().select("tree", none.alias("lefts"), none.alias("rights"), F.array("digest").alias("tops"))
    upper = _extended(made.top, base)
    roots = cut(upper.select(F.col("group").alias("tree"), "lefts", "rights", F.concat(F.array("digest"), "tops").alias("tops")))
    found = _extended(made.groups, roots)
    group = F.when(F.col("tree") != NULL_TREE, F.substring("tree", 2, 1 << 30)).alias("group")
    others = [c for c in found.columns if c not in ("tree", "idx", "digest", "height", "doc_id", "lefts", "rights", "tops")]
    return found.select("doc_id", group, F.col("digest").alias("leaf"), "lefts", "rights", F.col("tops")[0].alias("subroot"), F.col("tops")[1].alias("root"), *others)


def folded(leaf: Column, lefts: str = "lefts", rights: str = "rights") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(F.arrays_zip(F.col(lefts).alias("l"), F.col(rights).alias("r")), leaf, lambda node, x: digest(x["l"], node, x["r"]))


def proof_digest(lefts: str = "lefts", rights: str = "rights") -> Column:
    """The digest of all siblings of a proof, in order."""
    return F.sha2(F.array_join(F.flatten(F.zip_with(lefts, rights, lambda a, b: F.array(a, b))), ""), 256)


def save(made: Manifest, path: str) -> None:
    """Write the stored layers of a manifest as Parquet: {path}/groups/0, 1, ... and {path}/top/0, 1, ..."""
    for name, tree in (("groups", made.groups), ("top", made.top)):
        for j, layer in enumerate(tree.layers):
            layer.write.mode("overwrite").parquet(f"{path}/{name}/{j}")


def load(spark: SparkSession, path: str) -> Manifest:
    """A manifest as save() wrote it; proofs are made from it without the rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def tree(name: str) -> Tree:
        n = 0
        while files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/{n}")):
            n += 1
        return Tree([spark.read.parquet(f"{path}/{name}/{j}") for j in range(n)])

    return Manifest(tree("groups"), tree("top"))
