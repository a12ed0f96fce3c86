from __future__ import annotations

import gzip
import json
import lzma
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.sources import documents as d
from lakemill.sources import sinks
from lakemill.streaming import incremental

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("votes", T.ArrayType(T.StructType([T.StructField("n", T.IntegerType())])))])


def test_json_folder_reports_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text('{"id": "a",\n "votes": [{"n": 1}, {"n": 2}]}')
    (tmp_path / "sub" / "b.json").write_text('{"id": "b", "votes": []}')
    (tmp_path / "bad.json").write_text('{"id": ')
    (tmp_path / ".hidden.json").write_text("{}")
    good, bad = d.json_documents(spark, str(tmp_path), SCHEMA)
    assert {r.id: len(r.votes) for r in good.collect()} == {"a": 2, "b": 0}
    assert [r.file for r in bad.collect()] == ["bad.json"]


def test_lines(spark, tmp_path):
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write('{"id": "a"}\nbroken\n{"id": "b"}\n')
    assert {r.id for r in d.json_lines(spark, str(tmp_path / "x.json.gz"), SCHEMA).collect()} == {"a", "b"}
    with lzma.open(tmp_path / "y.xz", "wt") as f:
        f.write('{"id": 1}\nbroken\n{"id": 2}\n')
    assert [json.loads(r.line)["id"] for r in d.lzma_lines(spark, str(tmp_path / "y.xz")).collect()] == [1, 2]


def test_archives(spark, tmp_path):
    for leg, ballots in ((15, {"scrutin": {"uid": "V1", "n": 1}}), (16, {"scrutins": {"scrutin": [{"uid": "V1", "n": 2}, {"uid": "V2", "n": 3}]}})):
        with zipfile.ZipFile(tmp_path / f"{leg}.zip", "w") as z:
            z.writestr("x/V1.json", json.dumps(ballots))
            z.writestr("readme.txt", "no")
    (tmp_path / "99.zip").write_bytes(b"no archive")
    entries = d.zip_entries(spark, str(tmp_path))
    assert entries.where("entry is null").count() == 1
    assert d.ballots(entries.where("entry is not null")).count() == 3
    newest = d.newest_entries(entries, F.regexp_extract("archive", r"(\d+)\.zip", 1))
    assert [(r.uid, r.archive[-6:]) for r in newest.collect()] == [("V1", "16.zip")]


def test_xml_finds_nested_paragraphs(spark, tmp_path):
    p = "<paragraphe><orateurs><orateur><id>{0}</id><nom>N{0}</nom></orateur></orateurs><texte>t{0}</texte></paragraphe>"
    (tmp_path / "a.xml").write_text(f"<c><point>{p.format(1)}<point>{p.format(2)}</point></point></c>")
    rows = d.interventions(spark, str(tmp_path / "a.xml")).collect()
    assert {(r.speaker, r.text) for r in rows} == {("1", "t1"), ("2", "t2")}


def test_html_lists(spark):
    page = '<h2>Other</h2><ul><li>No One</li></ul><h3>Candidats déclarés</h3><ul><li><a href="/x">Ann Lee</a>, mayor</li><li>Bob Ray (left)</li><li>[1]</li><li>Ann Lee</li></ul>'
    df = spark.createDataFrame([(page,), (None,)], "html string")
    assert [r.names for r in d.listed_names(df).collect()] == [["Ann Lee", "Bob Ray", "[1]"], []]


def test_file_names(spark, tmp_path):
    for n in ("a.pivot.json", "b.json", "c.pivot.json"):
        (tmp_path / n).write_text("{}")
    assert sorted(r.name for r in d.file_names(spark, str(tmp_path), ".pivot.json").collect()) == ["a", "c"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None), (2, "y", "b")], "id int, leg string, v string")
    sinks.write_shards(df, str(tmp_path / "s"), "leg", ["id"])
    sinks.write_shards(df.where("leg = 'x'").withColumn("v", F.lit("new")), str(tmp_path / "s"), "leg", ["id"])
    assert sorted((r.leg, r.v) for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [("x", "new"), ("y", "b")]
    sinks.write_documents(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).where(F.contains("value", F.lit('"v":null'))).count() == 1
    with pytest.raises(sinks.Incomplete, match="3"):
        sinks.write_if_complete(df, str(tmp_path / "k"), spark.createDataFrame([(1,), (3,)], "id int"), df, "id")
    assert not (tmp_path / "k").exists()
    sinks.append_manifest(df, str(tmp_path / "m"), "id", "r1")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    assert "2 rows, 1 shown" in sinks.markdown(df, "t", rows=1)


def test_incremental_refresh_and_replay(spark, tmp_path):
    merge = incremental.refresher(str(tmp_path / "state"), ["k"], "t")
    make = lambda rows: spark.createDataFrame(rows, "k int, t int, v string")
    merge(make([(1, 1, "a"), (1, 2, "b"), (2, 1, "x")]), 0)
    for _ in range(2):
        merge(make([(1, 3, None), (3, 1, "n")]), 1)
    assert sorted(tuple(r) for r in incremental.current(spark, str(tmp_path / "state")).collect()) == [(1, 3, "b"), (2, 1, "x"), (3, 1, "n")]


def test_stream_drains_into_state(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, t int, v string").write.parquet(src)
    stream = spark.readStream.schema("k int, t int, v string").parquet(src)
    incremental.refresh_stream(stream, str(tmp_path / "state"), str(tmp_path / "cp"), ["k"], "t").awaitTermination(60)
    assert incremental.current(spark, str(tmp_path / "state")).count() == 2


def test_freshness_states(spark):
    rows = [("a", True, "2020-01-01", False), ("b", False, None, False), ("c", False, "2024-01-30", True), ("d", False, "2024-01-01", False), ("e", False, "2024-01-30", False)]
    df = spark.createDataFrame(rows, "part string, frozen boolean, synced string, failed boolean").withColumn("synced", F.col("synced").cast("timestamp"))
    found = incremental.freshness(df, F.lit("2024-02-01").cast("timestamp"), 10)
    assert {r.part: r.state for r in found.collect()} == {"a": "frozen", "b": "never_built", "c": "failed", "d": "stale", "e": "fresh"}


def test_files_of_documents_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(60):
        folder = tmp_path / f"n{i % 3}" / f"m{i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i} é.pivot.json").write_text(f'{{"id": {i}}}')
        (folder / f".{i}.pivot.json").write_text("{}")
        (folder / f"{i}.txt").write_text("{}")
    (tmp_path / "_staging").mkdir()
    (tmp_path / "_staging" / "x.pivot.json").write_text("{}")
    (tmp_path / "list.pivot.json").write_text("[1]")
    monkeypatch.setattr(d, "FILES_OF_TASK", 10)
    good, bad = d.document_files(spark, str(tmp_path), "*.pivot.json")
    assert sorted(r.file for r in good.collect()) == sorted(f"{i} é.pivot.json" for i in range(60))
    assert [tuple(r) for r in bad.collect()] == [("list.pivot.json", "no object")]
    assert not good.inputFiles() and good.groupBy(F.spark_partition_id()).count().count() > 4
