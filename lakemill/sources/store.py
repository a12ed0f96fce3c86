"""A store of keyed tables whose versions become visible at once, share what did not change, and are compared by digests.

A table is dealt into buckets by a hash of its key. A version names, for each bucket, the folder that holds it and the
digest of its rows; a folder is never written twice. The names stand in pages of 256 buckets, which are themselves named
by their digest, and one small file for each version lists the pages of all tables:

    {path}/data/{table}/{job}/bucket={k}/...   {path}/pages/{digest}.json   {path}/versions/{n}.json

Tables are staged first, by Spark jobs. A commit then writes the version's file under another name and renames it, which
either happens or does not; so several tables change together, and a job that fails in between changes nothing. A batch
rewrites the buckets of its keys only. Two versions differ in the buckets whose digests differ, and no others are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from hashlib import sha256
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

PAGE = 256


class Conflict(RuntimeError):
    """Another commit came first, or a commit lacks a table that it needs."""


@dataclass
class Table:
    """A table of a version: its key, number of buckets, schema, and (folder, digest, rows) of each bucket with rows."""

    keys: list[str]
    buckets: int
    schema: StructType
    places: dict[int, tuple[str, str, int]] = field(default_factory=dict)
    #: Of a staged table: the buckets that it holds all rows of, None for all.
    only: list[int] | None = None


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _row_sums(columns: Sequence[str]) -> list[Column]:
    """Sums of the eight words of each row's SHA-256: a digest of a set of rows in which repeats count and order does not."""
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    return [F.sum(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")).alias(f"w{k}") for k in range(8)]


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ files

    def _at(self, name: str) -> Any:
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def _get(self, name: str) -> Any:
        stream = self.files.open(self._at(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, name: str, value: Any) -> bool:
        """Writes a file that is not there yet, whole or not at all; false if it is there."""
        target, draft = self._at(name), self._at(f"{name}.{uuid4().hex}.draft")
        if self.files.exists(target):
            return False
        stream = self.files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        done = self.files.rename(draft, target)
        if not done:
            self.files.delete(draft, False)
        return done

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and n[:-5].isdigit())

    def _version(self, number: int | None = None) -> dict[str, Any] | None:
        found = self.versions()
        number = found[-1] if number is None and found else number
        return None if number is None else self._get(f"versions/{number}.json")

    def meta(self, version: int | None = None) -> dict[str, Any]:
        """What a version says about itself, as a batch's number or when a table was last built."""
        return (self._version(version) or {}).get("meta", {})

    def table(self, name: str, version: int | None = None, pages: Sequence[int] | None = None) -> Table | None:
        """A table of a version, the latest if none is named; with pages, only their buckets."""
        entry = (self._version(version) or {}).get("tables", {}).get(name)
        if entry is None:
            return None
        places: dict[int, tuple[str, str, int]] = {}
        for page, digest in entry["pages"].items():
            if pages is None or int(page) in pages:
                places |= {int(k): tuple(v) for k, v in self._get(f"pages/{digest}.json").items()}
        return Table(entry["keys"], entry["buckets"], StructType.fromJson(entry["schema"]), places)

    # ------------------------------------------------------------ reading

    def _rows(self, table: Table, buckets: Sequence[int]) -> DataFrame:
        folders = [f"{self.path}/{table.places[b][0]}" for b in sorted(buckets) if b in table.places]
        return self.spark.read.schema(table.schema).parquet(*folders) if folders else self.spark.createDataFrame([], table.schema)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        table = self.table(name, version)
        if table is None:
            raise KeyError(name)
        return self._rows(table, list(table.places))

    def lookup(self, name: str, keys: Sequence[Any], version: int | None = None) -> DataFrame:
        """The rows of some values of a one-column key: only their buckets are read, and of these the row groups whose
        bounds and bloom filters allow them."""
        table = self.table(name, version)
        (key,) = table.keys
        kind = table.schema[key].dataType
        wanted = self.spark.createDataFrame([(k,) for k in keys], StructType([StructField(key, kind)]))
        buckets = [r[0] for r in wanted.select(bucket_of([key], table.buckets)).distinct().collect()]
        return self._rows(table, buckets).where(F.col(key).isin(list(keys)))

    def differing(self, name: str, before: int, after: int) -> list[int]:
        """The buckets in which two versions of a table differ; pages that both share are not read."""
        old, new = (self._version(v)["tables"][name] for v in (before, after))
        if old["buckets"] != new["buckets"]:
            raise ValueError("the versions have other numbers of buckets")
        pages = [int(p) for p in {*old["pages"], *new["pages"]} if old["pages"].get(p) != new["pages"].get(p)]
        a, b = (self.table(name, v, pages).places for v in (before, after))
        return sorted(k for k in {*a, *b} if a.get(k, ("", "", 0))[1:] != b.get(k, ("", "", 0))[1:])

    def changed(self, name: str, before: int, after: int) -> tuple[DataFrame, DataFrame]:
        """Both versions of the buckets that differ, for a comparison of rows."""
        buckets = self.differing(name, before, after)
        return tuple(self._rows(self.table(name, v), buckets) for v in (before, after))

    # ------------------------------------------------------------ writing

    def stage(self, name: str, rows: DataFrame, keys: Sequence[str], buckets: int = 64, only: Sequence[int] | None = None) -> tuple[str, Table]:
        """Writes rows as buckets that no version names yet. only says which buckets the rows are all of; the others are
        taken over from the latest version at commit. Rows are sorted by key, and keys have bloom filters."""
        job = f"data/{name}/{uuid4().hex}"
        dealt = rows.withColumn("bucket", bucket_of(keys, buckets))
        writer = dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", *keys).write
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.partitionBy("bucket").parquet(f"{self.path}/{job}")
        # Nullability is not kept by files.
        schema = StructType.fromJson(json.loads(rows.schema.json().replace('"nullable":false', '"nullable":true')))
        written = self.spark.read.schema(StructType([*schema.fields, StructField("bucket", IntegerType())])).parquet(f"{self.path}/{job}")
        counted = written.groupBy("bucket").agg(*_row_sums(rows.columns), F.count("*").alias("n")).collect()
        places = {r["bucket"]: (f"{job}/bucket={r['bucket']}", sha256(json.dumps([r[f"w{k}"] for k in range(8)]).encode()).hexdigest(), r["n"]) for r in counted}
        return name, Table(list(keys), buckets, schema, places, None if only is None else list(only))

    def commit(self, staged: Sequence[tuple[str, Table]], meta: dict[str, Any] | None = None, needs: dict[str, Sequence[str]] | None = None, after: int | None = None) -> int:
        """Makes staged tables visible together, as the next version; tables that are not staged stay as they are.

        needs names the companions without which a table must not be written. after is the version that the work began
        from, the latest if none is named; if another commit came since, nothing changes.
        """
        names = {name for name, _ in staged}
        for name, companions in (needs or {}).items():
            if name in names and not names.issuperset(companions):
                raise Conflict(f"{name} is not written without {', '.join(sorted(set(companions) - names))}")
        found = self.versions()
        base = found[-1] if found else 0
        if after is not None and after != base:
            raise Conflict(f"version {base} came after {after}")
        old = self._version(base) if found else {"tables": {}, "meta": {}}
        tables = dict(old["tables"])
        for name, new in staged:
            before = self.table(name, base) if name in tables else None
            kept = {} if before is None or before.buckets != new.buckets else before.places
            places = {k: v for k, v in kept.items() if new.only is not None and k not in new.only}
            # A bucket that was written again with the same rows stays where it is.
            places |= {k: kept[k] if k in kept and kept[k][1:] == v[1:] else v for k, v in new.places.items()}
            pages: dict[str, str] = {}
            for page in sorted({k // PAGE for k in places}):
                own = {str(k): v for k, v in sorted(places.items()) if k // PAGE == page}
                digest = sha256(json.dumps(own, sort_keys=True).encode()).hexdigest()
                self._put(f"pages/{digest}.json", own)
                pages[str(page)] = digest
            tables[name] = {"keys": new.keys, "buckets": new.buckets, "schema": json.loads(new.schema.json()), "pages": pages}
        if not self._put(f"versions/{base + 1}.json", {"tables": tables, "meta": old["meta"] | (meta or {})}):
            raise Conflict(f"version {base + 1} came first")
        return base + 1

    def refresh(self, name: str, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], number: int) -> int:
        """Merges a batch into a table: merge(old rows, batch) of the buckets of the batch's keys, and no others.

        number counts the batches of a table; one that was applied before is not applied again, so a batch may be
        repeated after the driver was lost.
        """
        base = self.versions()[-1]
        if self.meta(base).get(f"batch of {name}", -1) >= number:
            return base
        table = self.table(name, base)
        touched = [r[0] for r in batch.select(bucket_of(table.keys, table.buckets)).distinct().collect()]
        rows = merge(self._rows(table, touched), batch)
        return self.commit([self.stage(name, rows, table.keys, table.buckets, only=touched)], {f"batch of {name}": number}, after=base)

    def tidy(self, keep: int = 2) -> int:
        """Removes all but the last versions, and the folders and pages that none of these names. How many files and
        folders went. Not while a commit is under way, whose folders no version names yet."""
        found = self.versions()
        kept, gone = found[-keep:], found[:-keep]
        entries = [e for v in kept for e in self._version(v)["tables"].values()]
        pages = {d for e in entries for d in e["pages"].values()}
        folders = {place[0] for d in pages for place in self._get(f"pages/{d}.json").values()}
        doomed = [f"versions/{v}.json" for v in gone] + [f"pages/{n}" for n in self._names("pages") if n[:-5] not in pages]
        for name in self._names("data"):
            for job in self._names(f"data/{name}"):
                own = [f"data/{name}/{job}/{b}" for b in self._names(f"data/{name}/{job}") if b.startswith("bucket=")]
                dead = [f for f in own if f not in folders]
                doomed += [f"data/{name}/{job}"] if len(dead) == len(own) else dead
        for file in doomed:
            self.files.delete(self._at(file), True)
        return len(doomed)
