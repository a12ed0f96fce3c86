"""Archives and xz streams shared by tasks, bulk documents, debates and nodes of unknown form, on small hand-made files."""

from __future__ import annotations

import json
import lzma
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemill.operators import nodes
from lakemill.sources import archives as a
from lakemill.sources import bulk, debates


def zipped(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries.items():
            z.writestr(name, content if isinstance(content, str) else json.dumps(content))


def test_entries_are_shared_by_tasks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    zipped(tmp_path / "a.zip", {f"x/{i}.json": f"{i} " * 500 for i in range(50)} | {"readme.txt": "no"})
    zipped(tmp_path / "sub" / "b.zip", {"y.json": "b"})
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "_hidden.zip").write_bytes(b"no archive")
    found = a.zip_entries(spark, str(tmp_path), partition_bytes="500")
    assert found.rdd.getNumPartitions() > 10
    rows = found.collect()
    assert sorted(r.entry for r in rows if r.entry) == sorted([f"x/{i}.json" for i in range(50)] + ["y.json"])
    assert {bytes(r.content).decode() for r in rows if r.entry} == {f"{i} " * 500 for i in range(50)} | {"b"}
    assert [r.archive.rsplit("/", 1)[1] for r in rows if r.error] == ["bad.zip"]
    assert a.zip_entries(spark, str(tmp_path), entry_prefix="x/1").where("error is null").count() == 11


def test_a_damaged_entry_does_not_end_the_rest(spark, tmp_path):
    zipped(tmp_path / "a.zip", {f"{i}.json": "abcdefgh" * 100 for i in range(3)})
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[raw.index(b"1.json") + 8] ^= 0xFF
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    rows = {r.entry: r for r in a.zip_entries(spark, str(tmp_path)).collect()}
    assert rows["1.json"].content is None and rows["1.json"].error
    assert rows["0.json"].error is None and rows["2.json"].error is None


def test_contents_of_what_a_query_keeps(spark, tmp_path):
    for leg in (15, 16):
        zipped(tmp_path / f"{leg}.zip", {f"x/{i}.json": f"{leg}/{i}" for i in range(leg, 20)})
    names = a.zip_entries(spark, str(tmp_path), names_only="true")
    assert names.where("content is not null").isEmpty()
    best = bulk.newest(names, F.regexp_extract("archive", r"(\d+)\.zip", 1).cast("int"))
    rows = a.contents_of(best, str(tmp_path)).collect()
    assert sorted(bytes(r.content).decode() for r in rows) == sorted([f"16/{i}" for i in range(16, 20)] + ["15/15"])


def test_archives_written_by_all_tasks(spark, tmp_path):
    a.register(spark)
    rows = spark.range(300).select(F.concat(F.lit("leg/"), F.col("id") % 2).alias("archive"), F.concat("id", F.lit(".json")).alias("entry"), F.encode(F.repeat("id", 50), "UTF-8").alias("content"))
    path = f"file://{tmp_path}/z"
    for _ in range(2):  # the second time in place of the first
        rows.repartition(3).sortWithinPartitions("archive").write.format("lakemill_zip").mode("overwrite").save(path)
    names = [p.name for p in (tmp_path / "z").iterdir()]
    assert len(names) == 6 and all(n.startswith(("leg_0-", "leg_1-")) and n.endswith(".zip") for n in names)
    back = a.zip_entries(spark, path).select("entry", "content")
    assert back.exceptAll(rows.select("entry", "content")).isEmpty() and back.count() == 300


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    a.register(spark)
    rows = spark.range(10).select(F.lit("x").alias("archive"), F.when(F.col("id") < 9, F.concat("id", F.lit(".json"))).otherwise(F.raise_error("no")).alias("entry"), F.lit(b"x").alias("content"))
    with pytest.raises(Exception, match="no"):
        rows.write.format("lakemill_zip").mode("append").save(str(tmp_path / "z"))
    assert not (tmp_path / "z").exists() or list((tmp_path / "z").iterdir()) == []


def test_lines_across_blocks_and_streams(spark, tmp_path):
    draw = random.Random(3)
    data = b"".join(b"%d %s\n" % (i, b"q" * draw.randrange(300)) for i in range(800)) + b"no line end"
    with (tmp_path / "a.xz").open("wb") as f:
        at = 0
        while at < len(data):
            size = draw.choice([1, 10, 900, 4000])
            f.write(lzma.compress(data[at : at + size]) + bytes(draw.choice([0, 4])))
            at += size
    (tmp_path / "b.xz").write_bytes(lzma.compress(data, format=lzma.FORMAT_ALONE))
    expected = sorted(x.decode() for x in data.split(b"\n"))
    for size in ("1", "600", "100000000"):
        rows = a.xz_lines(spark, str(tmp_path), partition_bytes=size)
        for name in ("a.xz", "b.xz"):
            assert sorted(r.line for r in rows.where(F.endswith("file", F.lit(name))).collect()) == expected
    assert a.xz_lines(spark, str(tmp_path), partition_bytes="600").rdd.getNumPartitions() > 10
    assert a.xz_lines(spark, str(tmp_path / "a.xz")).count() == 801


def test_xz_written_by_all_tasks(spark, tmp_path):
    a.register(spark)
    rows = spark.range(2000).select(F.concat(F.lit("line é "), "id").alias("line"))
    rows.repartition(3).write.format("lakemill_xz").option("block_bytes", 1000).mode("append").save(str(tmp_path / "x"))
    back = a.xz_lines(spark, str(tmp_path / "x"), partition_bytes="300")
    assert back.count() == 2000 and back.select("line").exceptAll(rows).isEmpty()
    assert sum(len(lzma.open(p, "rt").readlines()) for p in (tmp_path / "x").iterdir()) == 2000


def entries(spark, *contents):
    return spark.createDataFrame([("16.zip", f"{i}.json", c if isinstance(c, str) else json.dumps(c), None) for i, c in enumerate(contents)], "archive string, entry string, content string, error string")


def ballot(uid, groups, **more):
    return {"uid": uid, "numero": "1", "ventilationVotes": {"organe": {"groupes": {"groupe": groups}}}} | more


def test_ballots_of_both_packagings(spark):
    one = {"vote": {"decompteNominatif": {"pours": {"votant": [{"acteurRef": "PA1"}, {"acteurRef": ""}, "x"]}, "contre": {"votant": {"acteurRef": "PA2"}}, "abstentions": None, "nonVotant": {"votant": [{"acteurRef": "PA3"}]}}}}
    docs, broken = bulk.documents(
        entries(spark, {"scrutin": ballot("VTANR1", one, legislature="17")}, {"scrutins": {"scrutin": [ballot("VTANR2", [one, "x"]), ballot("VTANR3", None), ballot("", one), "x"]}}, {"scrutins": {"scrutin": ballot("VTCGR4", one)}}, {"other": 1}, "[", "[1]")
    )
    assert [r.entry for r in broken.collect()] == ["4.json"]
    inside, outside = bulk.ballots(docs, F.lit("16"))
    assert {(r.uid, r.legislature) for r in inside.collect()} == {("VTANR1", "17"), ("VTANR2", "16")} and [r.uid for r in outside.collect()] == ["VTCGR4"]
    assert sorted(tuple(r) for r in bulk.voters(inside).where("uid = 'VTANR2'").collect()) == [("VTANR2", "PA1", "pour"), ("VTANR2", "PA2", "contre"), ("VTANR2", "PA3", "non_votant")]


def test_amendments_by_root_key(spark):
    signed = lambda author, **more: {"signataires": {"auteur": {"acteurRef": author}, "cosignataires": more}}
    older = {"texteleg": {"refTexteLegislatif": "T", "amendements": {"amendement": [{"uid": "B", "identifiant": {"numero": "7"}, "dateDepot": "2014-01-01"} | signed("PA1", acteurRef="PA2"), {"uid": "C", "numeroLong": "7 (Rect)"} | signed("PA1")]}}}
    docs, _ = bulk.documents(
        entries(spark, {"amendement": {"uid": "A", "identification": {"numeroLong": "1"}} | signed("PA1", acteurRef=["PA2", "PA2"], acteur=[{"acteurRef": "PA3"}, {}])}, {"amendement": {"uid": "D"}}, {"textesEtAmendements": older}, {"x": 1}, {"amendement": None})
    )
    found, unknown = bulk.amendments(docs)
    rows = {r.uid: r for r in found.collect()}
    assert set(rows) == {"A", "B", "C"} and rows["A"].cosigners == ["PA2", "PA3"] and (rows["B"].number, rows["C"].number, rows["B"].text_ref) == ("7", "7 (Rect)", "T")
    assert [r.entry for r in unknown.collect()] == ["3.json"]


def test_dossiers(spark):
    acts = {"acteLegislatif": [{"codeActe": "SN1-DEPOT", "dateActe": "2020-02-01T00:00", "texteAssocie": "PRJL2"}, {"codeActe": "AN1-DEPOT", "dateActe": "2020-01-01", "texteAssocie": "PION1", "actesLegislatifs": {"acteLegislatif": {"codeActe": "AN1-DEBATS-DEC", "dateActe": "2020-03-01", "statutConclusion": {"fam_code": "TSORTF01", "codeActe": "X-DEPOT", "dateActe": "1900-01-01"}}}}]}
    docs, _ = bulk.documents(
        entries(
            spark, {"dossierParlementaire": {"uid": "1", "actesLegislatifs": acts, "initiateur": {"acteurs": {"acteur": {"acteurRef": "PA1"}}}}},
            {"dossierParlementaire": {"uid": "2", "procedureParlementaire": {"code": 1}, "initiateur": {"acteurs": {"acteur": []}}}}, {"dossierParlementaire": {"uid": "3", "procedureParlementaire": {"code": "99"}, "actesLegislatifs": {"a": {"codeActe": "PROM-PUB"}}}}, {"dossierParlementaire": "x"},
        )
    )
    status, code = bulk.dossier_status(F.col("acts"))
    rows = {r.uid: r for r in bulk.dossiers(docs).withColumns({"status": status, "code": code}).collect()}
    first = rows["1"]
    assert (first.origin, first.deposited, first.last_act, first.chamber, first.initiators, first.status, first.code) == ("member", "2020-01-01", "2020-03-01", "AN", ["PA1"], "adopte", "TSORTF01")
    assert (rows["2"].origin, rows["2"].initiators, rows["2"].status, rows["2"].deposited) == ("government", None, "depose", None)
    assert (rows["3"].origin, rows["3"].status) == (None, "promulgue")


def test_debates(spark):
    p = lambda speakers, text: f"<paragraphe><orateurs>{speakers}</orateurs><texte>{text}</texte></paragraphe>"
    one, two = "<orateur><id>1</id><nom>N</nom><qualite>president</qualite></orateur>", "<orateur><id>2</id></orateur>"
    xml = (
        '<c:compteRendu xmlns:c="u"><c:uid>U</c:uid><c:metadonnees><c:dateSeance>20240102</c:dateSeance></c:metadonnees><c:contenu><c:point>'
        + (p(one, "a &lt;b&gt; <c:br/>\u00a0 <i>x</i>") + p(one + one, "same") + p(one + two, "both") + p("", " ") + p(two, "") + "<point>" + p(one, "deep") + "</point>").replace("<", "<c:").replace("<c:/", "</c:").replace("<c:c:", "<c:")
        + "</c:point></c:contenu></c:compteRendu>"
    )
    files = spark.createDataFrame([("a", xml), ("b", "<compteRendu><uid>"), ("c", None)], "name string, xml string")
    found, broken = debates.reports(files)
    assert sorted(r.name for r in broken.collect()) == ["b", "c"]
    assert [(r.uid, r.date, r.state) for r in debates.sessions(found).collect()] == [("U", "2024-01-02", None)]
    rows = debates.interventions(found).orderBy("paragraph").collect()
    assert [(r.paragraph, r.speaker, r.text) for r in rows] == [(0, "1", "a &lt;b&gt; x"), (1, "1", "same"), (2, None, "both"), (4, "2", None)]
    assert rows[0].function == "president" and rows[0].kind == "debat" and rows[0].format == "reaction_courte"


def test_nodes(spark):
    xml = ["<a k='1'><b> 007 </b><b/><c>t<d>x</d></c></a>", "<a", None, "<a>" * 3 + "</a>" * 3, "<a> x </a>"]
    df = spark.createDataFrame(list(enumerate(xml)), "id int, x string").select("id", nodes.xml_nodes(F.col("x")).alias("v"))
    assert [r.j and json.loads(r.j) for r in df.orderBy("id").select(F.to_json("v").alias("j")).collect()] == [{"a": {"b": ["007", None], "c": {"d": "x"}}}, None, None, {"a": {"a": {"a": None}}}, {"a": "x"}]
    found = sorted(tuple(r) for r in nodes.paths(df, ["id"], "v").collect() if r.id in (0, 4))
    assert found == [(0, "a.b", "0", "007"), (0, "a.b", "1", None), (0, "a.c.d", "", "x"), (4, "a", "", "x")]


def test_end_record_of_a_large_archive(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(66_000):
            z.writestr(f"{i}", b"")
    with pa.OSFile(str(tmp_path / "a.zip")) as f:
        assert a.count_of_entries(f, f.size()) == 66_000


def test_files_that_are_written_have_bounded_directories(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(a, "FILE_ENTRIES", 10)
    monkeypatch.setattr(a, "OPEN_ARCHIVES", 2)
    folder = str(tmp_path / "out")
    writer = a.ZipWriter({"path": folder}, False)
    rows = [(f"a{i % 3}", f"{i}.json", f"[{i}]".encode()) for i in range(90)]
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist([dict(zip(("archive", "entry", "content"), r, strict=True)) for r in rows])]))])
    files = [zipfile.ZipFile(f) for f in (tmp_path / "out").glob("*.zip")]
    assert max(len(f.namelist()) for f in files) <= 10
    found = a.zip_entries(spark, folder).select(F.regexp_extract("archive", r"/(a\d)-", 1), "entry", "content").collect()
    assert sorted((r[0], r[1], bytes(r[2])) for r in found) == sorted(rows)


def test_contents_are_read_by_several_tasks(spark, tmp_path):
    zipped(tmp_path / "1.zip", {f"{i}.json": f"[{i}]" for i in range(200)})
    found = a.contents_of(a.zip_entries(spark, str(tmp_path), names_only="true"), str(tmp_path))
    counts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 200 and len(counts) > 1


def test_entries_are_written_and_read_without_a_stream_for_each(tmp_path, monkeypatch):
    rows = [("é/ü.json", "é".encode()), ("b.json", b""), ("c.json", random.Random(1).randbytes(3_000_000))]
    opens = []
    own = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, *args, **more: opens.append(args) or own(self, *args, **more))
    writer = a.ZipWriter({"path": str(tmp_path / "out")}, False)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist([{"archive": "x", "entry": n, "content": c} for n, c in rows])]))])
    (file,) = (tmp_path / "out").glob("*.zip")
    with zipfile.ZipFile(file) as z:
        assert [a.entry_of(z, n) for n, _ in rows] == [(n, c, None) for n, c in rows] and not opens
        assert z.testzip() is None and z.namelist() == [n for n, _ in rows]
    # What is not plainly deflated is left to zipfile.
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("stored.json", b"s")
    with zipfile.ZipFile(tmp_path / "s.zip") as z:
        assert a.plain_content(z, z.infolist()[0]) is None and a.entry_of(z, "stored.json") == ("stored.json", b"s", None)
    # A damaged content is never taken for whole.
    raw = bytearray(file.read_bytes())
    raw[raw.index(b"c.json") + 100] ^= 0xFF
    file.write_bytes(bytes(raw))
    with zipfile.ZipFile(file) as z:
        assert a.entry_of(z, "c.json")[1] is None and a.entry_of(z, "c.json")[2]


def test_an_entry_is_parsed_once(spark):
    entries = spark.createDataFrame([("a", "1.json", b'{"x": 1}', None), ("a", "2.json", b"{", None), ("a", "3.json", None, "cut")], "archive string, entry string, content binary, error string")
    docs, broken = bulk.documents(entries)
    assert [(r[0], r[1]) for r in docs.select("entry", F.try_variant_get("v", "$.x", "long")).collect()] == [("1.json", 1)]
    assert sorted((r.entry, r.error) for r in broken.collect()) == [("2.json", "no JSON"), ("3.json", "cut")]
    assert docs.select("v")._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_amendments_of_both_forms_are_read_together(spark):
    entries = spark.createDataFrame([("a", "1.json", b'{"amendement": {"uid": "1", "signataires": {"auteur": {"acteurRef": "PA1"}}}}', None)], "archive string, entry string, content binary, error string")
    found, _ = bulk.amendments(bulk.documents(entries)[0])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [(r.uid, r.text_ref, r.author) for r in found.collect()] == [("1", None, "PA1")]
