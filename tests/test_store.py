"""The versioned store: what becomes visible, what is rewritten, what is read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakemill.operators.merge import coalesce_upsert
from lakemill.sources.store import Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def rows(spark, n, start=0):
    return spark.range(start, start + n).select("id", F.concat(F.lit("v"), "id").alias("v"))


def folders(path):
    return {p for p in path.glob("store/data/*/*/bucket=*")}


def test_tables_become_visible_together(spark, store, tmp_path):
    assert store.versions() == [] and store.table("a") is None
    with pytest.raises(KeyError):
        store.read("a")
    first = store.commit([store.stage("a", rows(spark, 20), ["id"], 4), store.stage("b", rows(spark, 5), ["id"], 4)], {"built": "x"})
    staged = store.stage("a", rows(spark, 3), ["id"], 4)
    with pytest.raises(Exception, match="lost"):  # a job that ends between two tables
        store.stage("b", rows(spark, 3).withColumn("v", F.raise_error("lost")), ["id"], 4)
    assert (store.read("a").count(), store.read("b").count()) == (20, 5)
    second = store.commit([staged])
    assert (store.read("a").count(), store.read("b").count(), store.read("a", first).count()) == (3, 5, 20)
    assert store.meta() == {"built": "x"} and store.versions() == [first, second]


def test_a_second_writer_and_a_missing_companion(spark, store):
    base = store.commit([store.stage("a", rows(spark, 3), ["id"])])
    one, two = (store.stage("a", rows(spark, n), ["id"]) for n in (1, 2))
    store.commit([one], after=base)
    with pytest.raises(Conflict, match="came after"):
        store.commit([two], after=base)
    with pytest.raises(Conflict, match="without b"):
        store.commit([two], needs={"a": ["b"]})
    assert store.read("a").count() == 1


def test_a_draft_is_no_version(spark, store, tmp_path):
    store.commit([store.stage("a", rows(spark, 3), ["id"])])
    (tmp_path / "store" / "versions" / "2.json.abc.draft").write_text("{")
    assert store.versions() == [1] and store.read("a").count() == 3


def test_a_batch_rewrites_its_buckets(spark, store, tmp_path):
    store.commit([store.stage("a", rows(spark, 1000), ["id"], 64)])
    before = folders(tmp_path)
    batch = spark.createDataFrame([(7, "new"), (7000, "more"), (8, None)], "id long, v string")
    merge = lambda old, new: coalesce_upsert(old, new, ["id"])
    version = store.refresh("a", batch, merge, 0)
    assert len(folders(tmp_path) - before) <= 3
    assert store.refresh("a", batch, merge, 0) == version  # the batch comes again
    found = {r.id: r.v for r in store.read("a").collect()}
    assert len(found) == 1001 and (found[7], found[7000], found[8], found[9]) == ("new", "more", "v8", "v9")


def test_versions_are_compared_by_digests(spark, store):
    plain = rows(spark, 2000)
    a = store.commit([store.stage("t", plain, ["id"], 600)])
    b = store.commit([store.stage("t", plain.withColumn("v", F.when(F.col("id") == 11, "other").otherwise(F.col("v"))).repartition(3), ["id"], 600)])
    assert len(store.differing("t", a, b)) == 1 and store.differing("t", a, a) == []
    old, new = store.changed("t", a, b)
    assert old.count() < 20 and len(old.inputFiles()) <= 2
    assert [(r.id, r.v) for r in new.exceptAll(old).collect()] == [(11, "other")]
    # Rows that repeat count, a bucket that empties differs.
    c = store.commit([store.stage("t", plain.where("id <> 11").union(plain.where("id = 12")), ["id"], 600)])
    x, y = store.changed("t", a, c)
    assert sorted((r.id, r.v) for r in x.exceptAll(y).collect()) == [(11, "v11")] and [r.id for r in y.exceptAll(x).collect()] == [12]


def test_unchanged_buckets_keep_their_folder(spark, store):
    a = store.commit([store.stage("t", rows(spark, 100), ["id"], 16)])
    b = store.commit([store.stage("t", rows(spark, 100).repartition(5), ["id"], 16)])
    assert store.table("t", a).places == store.table("t", b).places


def test_a_look_up_reads_its_files(spark, store):
    store.commit([store.stage("t", rows(spark, 5000), ["id"], 200)])
    found = store.lookup("t", [1, 2, 3, 99_999])
    assert sorted(r.id for r in found.collect()) == [1, 2, 3]
    assert len(found.inputFiles()) <= 4 and len(store.read("t").inputFiles()) >= 190
    assert "PushedFilters: [In(id, [1,2,3,99999])]" in found._jdf.queryExecution().toString().replace(", ", ",").replace("In(id,[", "In(id, [")


def test_empty_tables_nulls_and_repeats(spark, store):
    odd = spark.createDataFrame([(None, "x"), (None, "x"), (1, None), (1, None)], "id long, v string")
    a = store.commit([store.stage("t", odd, ["id"], 8)])
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, odd.collect()))
    b = store.commit([store.stage("t", odd.limit(0), ["id"], 8)])
    assert store.read("t").isEmpty() and store.differing("t", a, b) == sorted(store.table("t", a).places)
    assert store.refresh("t", odd, lambda old, new: old.unionByName(new), 3) == b + 1 and store.read("t").count() == 4


def test_tidying(spark, store, tmp_path):
    for n in (100, 101, 102):
        store.commit([store.stage("t", rows(spark, n), ["id"], 8)])
    before = len(folders(tmp_path))
    assert store.tidy(keep=1) > 0
    assert store.versions() == [3] and store.read("t").count() == 102
    assert len(folders(tmp_path)) == 8 < before
