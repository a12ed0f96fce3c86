"""Reading documents: JSON in folders, archives and compressed lines, XML debates, HTML lists.

Everything is read by Spark's own readers, so any store that Spark reaches will do. A file that cannot be read becomes
a finding, never a silent gap.
"""

from __future__ import annotations

import io
import json
import lzma
import zipfile
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.operators.lineage import settled
from lakemill.operators.nodes import at, is_object, listed, parsed
from lakemill.sources import archives

CORRUPT = "_corrupt"


def json_documents(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable) of one JSON document for each file below path; names that begin with a dot are skipped.

    documents has the schema and `file`; unreadable has `file` and `raw`. Files may be gzip or zstandard compressed, as
    far as their suffix says so.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    files = files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col("value").alias("raw")).where(~F.startswith("file", F.lit(".")))
    rows = files.withColumn("d", F.from_json("raw", full, {"columnNameOfCorruptRecord": CORRUPT}))
    broken = F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()
    return rows.where(~broken).select(*[f"d.{f.name}" for f in schema.fields], "file"), rows.where(broken).select("file", "raw")


#: How many files a task reads.
FILES_OF_TASK = 5000


def listed_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path) of the files below a folder whose names match the pattern (*, ? and [ ]), or of the file itself; names of
    files and folders that begin with "_" or "." are skipped.

    Tasks list the folders, a level at a time, so that no process holds all names, as the driver does where Spark lists.
    """
    archives.register(spark)
    tasks = spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = archives.opened(path)
        for batch in batches:
            for folder in batch["folder"].to_pylist():
                own = system.get_file_info(root if folder is None else folder)
                found = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(own.path))
                rows = [(f.path, f.type == fs.FileType.Directory) for f in found if f is own or f.base_name[0] not in "_."]
                rows = [r for r in rows if r[1] or fnmatchcase(r[0].rsplit("/", 1)[-1], pattern)]
                for k in range(0, len(rows), 10_000):
                    names, folders = zip(*rows[k : k + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(folders, pa.bool_())], ["path", "is_folder"])

    level, found = spark.range(1).select(F.lit(None).cast("string").alias("folder")), []
    while True:
        seen = settled(level.mapInArrow(run, "path string, is_folder boolean"))
        found.append(seen.where(~F.col("is_folder")).select("path"))
        level = seen.where("is_folder").select(F.col("path").alias("folder"))
        if level.isEmpty():
            return reduce(DataFrame.union, found)
        level = level.repartition(tasks, "folder")


def document_files(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable) of files below a folder, whatever form the documents have: (file, v) with v as VARIANT, and
    (file, reason) of files that are no JSON or no object. Names are matched and skipped as by listed_files()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = archives.opened(path)

        def read() -> Iterator[tuple]:
            for batch in batches:
                for name in batch["path"].to_pylist():
                    with system.open_input_stream(name) as f:
                        yield name.rsplit("/", 1)[-1], f.read()

        yield from archives.batches(read(), pa.schema([("file", pa.string()), ("content", pa.binary())]))

    names = listed_files(spark, path, pattern)
    # The number of tasks is told, as names have few bytes and adaptive execution would deal them to one.
    parts = max(spark.sparkContext.defaultParallelism, -(-names.count() // FILES_OF_TASK))
    files = names.repartition(parts, "path").mapInArrow(run, "file string, content binary")
    rows = files.select("file", parsed(F.col("content")).alias("v"))
    good = is_object(F.col("v"))
    return rows.where(good), rows.where(~good).select("file", F.when(F.col("v").isNull(), "no JSON").otherwise("no object").alias("reason"))


def routed(docs: DataFrame) -> DataFrame:
    """docs(file, v) with form: `pivot` for a document with a version and an id, `raw` for one with a slug, else null,
    for the caller to tell."""
    said = lambda name: F.coalesce(F.to_json(at(F.col("v"), name)) != "null", F.lit(False))
    return docs.withColumn("form", F.when(said("schema_version") & said("id"), "pivot").when(said("slug"), "raw"))


def entries_of(docs: DataFrame, name: str) -> DataFrame:
    """(file, entry) of the objects in a list of each document, also of the list in an envelope; other entries go."""
    return docs.select("file", F.explode(F.filter(listed(at(F.col("v"), name)), is_object)).alias("entry"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of JSON, plain or compressed (gz, zst); broken lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def broken_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, raw) of the lines that json_lines() leaves out, as findings."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.text(path).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col("value").alias("raw")).where("trim(raw) <> ''")
    d = F.from_json("raw", full, {"columnNameOfCorruptRecord": CORRUPT})
    return rows.withColumn("d", d).where(F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()).select("file", "raw")


def lzma_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of lines in LZMA streams, decompressed as a stream; lines that are no JSON are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                held = []
                with lzma.open(io.BytesIO(content), "rt", encoding="utf-8", errors="replace") as lines:
                    for line in lines:
                        try:
                            json.loads(line)
                        except ValueError:
                            continue
                        held.append(line.rstrip("\n"))
                        if len(held) == 1000:
                            yield pd.DataFrame({"file": name, "line": held})
                            held = []
                if held:
                    yield pd.DataFrame({"file": name, "line": held})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, line string")


def zip_entries(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """(archive, entry, content) of the entries of ZIP archives; an archive that cannot be opened has entry null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for entry in archive.namelist():
                            if entry.endswith(suffix):
                                yield pd.DataFrame({"archive": [name], "entry": [entry], "content": [archive.read(entry).decode("utf-8", "replace")]})
                except zipfile.BadZipFile:
                    yield pd.DataFrame({"archive": [name], "entry": [None], "content": [None]}).astype(object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, entry string, content string")


def newest_entries(entries: DataFrame, rank: F.Column) -> DataFrame:
    """Of entries with the same name the one from the archive of the highest rank; others are not parsed at all."""
    uid = F.regexp_extract("entry", r"([^/]+?)(?:\.[^./]+)?$", 1)
    order = Window.partitionBy("uid").orderBy(rank.desc(), F.desc("archive"))
    return entries.where("entry is not null").withColumn("uid", uid).withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def ballots(entries: DataFrame) -> DataFrame:
    """One row for each ballot of entries(content), whether an entry holds one or a list of them; (entry, ballot)."""
    one, many = F.get_json_object("content", "$.scrutin"), F.get_json_object("content", "$.scrutins.scrutin")
    node = F.coalesce(many, one)
    array = F.when(F.startswith(node, F.lit("[")), F.from_json(node, "array<string>")).otherwise(F.array(node))
    return entries.where(node.isNotNull()).select("entry", F.explode(array).alias("ballot"))


def interventions(spark: SparkSession, path: str, row_tag: str = "paragraphe") -> DataFrame:
    """(speaker, name, text) of an XML debate's paragraphs, at any depth."""
    schema = "_id string, orateurs struct<orateur: struct<id: string, nom: string>>, texte string"
    rows = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(schema).load(path)
    return rows.select(F.col("orateurs.orateur.id").alias("speaker"), F.col("orateurs.orateur.nom").alias("name"), "texte").withColumnRenamed("texte", "text")


class _Lists(HTMLParser):
    """Items of lists below headings that match; the first link's text, else the text up to a comma or bracket."""

    def __init__(self, wanted: tuple[str, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.wanted, self.names = wanted, []
        self.heading = self.item = self.link = None
        self.on = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("h2", "h3", "h4"):
            self.heading = ""
        elif tag == "li" and self.on:
            self.item, self.link = "", None
        elif tag == "a" and self.item is not None and self.link is None:
            self.link = ""

    def handle_endtag(self, tag: str) -> None:
        if tag in ("h2", "h3", "h4") and self.heading is not None:
            self.on, self.heading = any(w in self.heading.lower() for w in self.wanted), None
        elif tag == "a" and self.link:
            self.link = (self.link,)
        elif tag == "li" and self.item is not None:
            link = self.link[0].strip() if isinstance(self.link, tuple) else ""
            name = link if len(link) > 3 and not link.startswith("[") else self.item.split(",")[0].split("(")[0].strip()
            if name and name not in self.names:
                self.names.append(name)
            self.item = None

    def handle_data(self, data: str) -> None:
        if self.heading is not None:
            self.heading += data
        if self.item is not None:
            self.item += data
        if isinstance(self.link, str):
            self.link += data


#: Words of the headings below which declared candidates are listed.
HEADING_WORDS = ("candidat", "déclaré", "pressenti", "en lice")


def listed_names(pages: DataFrame, html_col: str = "html", wanted: tuple[str, ...] = HEADING_WORDS) -> DataFrame:
    """pages with `names`, the names in lists below matching headings, in order, each once."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            parser = _Lists(wanted)
            parser.feed(page or "")
            out.append(parser.names)
        return pd.Series(out)

    return pages.withColumn("names", run(F.col(html_col)))


def file_names(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(name) of the files below path, without the suffix; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return rows.select(name.alias("name")).where(F.endswith("name", F.lit(suffix))).select(F.expr(f"left(name, length(name) - {len(suffix)})").alias("name"))
