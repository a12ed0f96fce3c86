"""Manifests against a plain tree in Python, proofs, stored layers, odd tables."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lakemill.llm import merkle

SCHEMA = "doc_id long, lang string, text string, digest string, tree string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climbed(nodes):
    """The levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out += [x for j, x in enumerate(level) if j // 8 == i // 8 and j != i]
        i //= 8
    return out


def brute(rows):
    """{leaf: (subroot, root, siblings)} of (doc_id, lang, text) rows without repeated leaves."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    levels = {g: climbed([x[-1] for x in sorted(trees[g])]) for g in order}
    top = climbed([levels[g][-1][0] for g in order])
    found = {}
    for j, g in enumerate(order):
        for i, x in enumerate(levels[g][0]):
            found[x] = (levels[g][-1][0], top[-1][0], siblings(levels[g], i) + siblings(top, j))
    return found


def proved(made):
    rows = merkle.proofs(made).withColumns({"proof": merkle.proof_digest(), "folded": merkle.folded(F.col("leaf"))}).collect()
    assert all(r.folded == r.root for r in rows)
    return {r.leaf: (r.subroot, r.root, r.proof) for r in rows}, rows


def made(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns({"digest": F.lit(1), "tree": F.lit(2), "idx": F.lit(3), "height": F.lit(4), "place": F.lit(5)})
    return merkle.manifest(df.repartition(3), ["doc_id", "lang", "text"])


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 9}, {"en": 513, "é": 2, "": 64, None: 1}, {f"l{i}": 1 for i in range(70)}], ids=str)
def test_manifest_is_the_plain_tree(spark, sizes):
    rows = [(k * 7919 % 10_007, g, f"text {g} {k}" if k % 5 else None) for g, n in sizes.items() for k in range(n)]
    expected = {x: (s, r, h(*p)) for x, (s, r, p) in brute(rows).items()}
    found, out = proved(made(spark, rows))
    assert found == expected and len(out) == len(rows)
    assert {(r.doc_id, r.group) for r in out} == {r[:2] for r in rows}


def test_subtrees_above_the_first_stored_layer(spark):
    """More than 512 * 8 leaves: two stored layers above the leaves."""
    rows = [(k, "en", None) for k in range(4200)]
    m = made(spark, rows)
    assert [layer.count() for layer in m.groups.layers] == [4200, 9, 1]
    assert proved(m)[0] == {x: (s, r, h(*p)) for x, (s, r, p) in brute(rows).items()}


def test_a_changed_leaf_does_not_lead_to_the_root(spark):
    rows = merkle.proofs(made(spark, [(k, "en", f"t{k}") for k in range(30)]))
    assert rows.where(merkle.folded(F.sha2(F.lit("other"), 256)) == F.col("root")).isEmpty()


def test_odd_rows(spark):
    """Null and repeated ids, rows that repeat, null groups beside empty ones, large ids beside null ones."""
    rows = [(None, None, "x"), (None, None, None), (1, "", "a"), (1, "", "b"), (1, "", "a"), (1, "", "a"), (2**62 + 1, None, "big"), (3, None, "-"), (3, "-", "y" * 200_000)]
    found, out = proved(made(spark, rows))
    assert len(out) == len(rows) and sum(r.doc_id == 2**62 + 1 for r in out) == 1
    assert len({r.root for r in out}) == 1 and len({r.subroot for r in out}) == 3
    same = [r for r in out if r.leaf == leaf((1, "", "a"))]
    assert len(same) == 3
    # Rows with a null id come first.
    nulls = sorted(leaf((None, None, x)) for x in ("x", None))
    assert made(spark, rows).groups.layers[0].where("tree = '-'").orderBy("idx").limit(2).toPandas()["digest"].tolist() == nulls


def test_empty_table(spark):
    assert merkle.proofs(made(spark, [])).isEmpty()


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("SELECT 1L AS doc_id, 'en' AS lang, cast(x'61FF62' AS string) AS text UNION ALL SELECT 2L, 'en', cast(x'61FE62' AS string)")
    found = merkle.proofs(merkle.manifest(df, ["text"])).collect()
    assert {r.leaf for r in found} == {sha256(b"3:a" + b + b"b").hexdigest() for b in (b"\xff", b"\xfe")}


def test_proofs_from_stored_layers(spark, tmp_path):
    m = made(spark, [(k, "en" if k % 3 else "de", f"t{k}") for k in range(600)])
    merkle.save(m, str(tmp_path / "manifest"))
    assert proved(merkle.load(spark, str(tmp_path / "manifest")))[0] == proved(m)[0]
