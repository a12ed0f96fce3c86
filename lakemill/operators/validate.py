"""Validators of nested documents: rules as data, over scalars and over the entries of lists, in one pass each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A rule on a whole document: broken where the condition holds; null does not break it."""

    path: str
    rule: str
    broken: Column
    blocking: bool = True


@dataclass(frozen=True)
class Entry:
    """A rule on each entry of a list; its path is list[i].part, counted from 0."""

    list: str
    part: str
    rule: str
    broken: Callable[[Column], Column]
    blocking: bool = True


@dataclass(frozen=True)
class Schema:
    """The rules of one kind of document."""

    name: str
    fields: Sequence[Field] = field(default_factory=tuple)
    entries: Sequence[Entry] = field(default_factory=tuple)


def required(*names: str) -> list[Field]:
    return [Field(n, "missing", F.col(n).isNull()) for n in names]


def outside(name: str, domain: Sequence[str]) -> Field:
    return Field(name, "outside_domain", F.col(name).isNotNull() & ~F.col(name).isin(list(domain)))


def unlike(name: str, pattern: str) -> Field:
    return Field(name, "malformed", F.col(name).isNotNull() & ~F.col(name).rlike(pattern))


def errors(docs: DataFrame, key: str, schema: Schema) -> DataFrame:
    """(key, path, rule, blocking): one row for each broken rule; documents without one have no row.

    All rules are evaluated in one projection; a list's entries are not shuffled, as they are tested where they stand.
    """
    made = lambda path, r: F.struct(path.alias("path"), F.lit(r.rule).alias("rule"), F.lit(r.blocking).alias("blocking"))
    own = [F.when(F.coalesce(r.broken, F.lit(False)), made(F.lit(r.path), r)) for r in schema.fields]

    def listed(r: Entry) -> Column:
        hits = F.transform(F.col(r.list), lambda x, i: F.when(F.coalesce(r.broken(x), F.lit(False)), made(F.concat(F.lit(f"{r.list}["), i, F.lit(f"].{r.part}")), r)))
        return F.coalesce(F.array_compact(hits), F.array().cast("array<struct<path:string,rule:string,blocking:boolean>>"))

    parts = [F.array_compact(F.array(*own))] if own else []
    found = F.concat(*parts, *[listed(r) for r in schema.entries])
    return docs.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("e")).select("key", "e.path", "e.rule", "e.blocking")


def entry_errors(rows: DataFrame, key: str, schema: Schema, places: Mapping[str, Column]) -> DataFrame:
    """errors() of lists whose entries are rows of their own: places gives the place of a row in each list, null for a
    row that is not in it. No list is put together, however long it is."""
    entry = {c: F.col(c) for c in rows.columns}

    def told(r: Entry) -> Column:
        at = places[r.list]
        path = F.concat(F.lit(f"{r.list}["), at.cast("string"), F.lit(f"].{r.part}"))
        return F.when(at.isNotNull() & F.coalesce(r.broken(entry), F.lit(False)), F.struct(path.alias("path"), F.lit(r.rule).alias("rule"), F.lit(r.blocking).alias("blocking")))

    found = F.array_compact(F.array(*[told(r) for r in schema.entries if r.list in places]))
    return rows.select(F.col(key).cast("string").alias("key"), F.inline(found))


def repeated(docs: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has, as findings: the join-like rule that no projection can test."""
    found = docs.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    return found.select("key", F.lit(key).alias("path"), F.lit("repeated").alias("rule"), F.lit(True).alias("blocking"))


def unknown(docs: DataFrame, key: str, path: str, reference: Column, dim: DataFrame, dim_key: str) -> DataFrame:
    """References that the dimension lacks, as findings; null refers to nothing."""
    held = dim.select(F.col(dim_key).alias("__known")).where("__known is not null").distinct()
    rows = docs.select(F.col(key).cast("string").alias("key"), reference.alias("__ref")).where("__ref is not null")
    missing = rows.join(held, F.col("__ref") == F.col("__known"), "left_anti").distinct()
    return missing.select("key", F.concat_ws(":", F.lit(path), F.col("__ref").cast("string")).alias("path"), F.lit("unknown").alias("rule"), F.lit(True).alias("blocking"))


def by_document(docs: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """(key, n_errors, messages, valid) of every document, those without a finding too; messages are sorted."""
    own = found.groupBy("key").agg(F.count("*").alias("n_errors"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "path", "rule"))), "; ").alias("messages"))
    every = docs.select(F.col(key).cast("string").alias("key")).distinct()
    return every.join(own, "key", "left").select("key", F.coalesce("n_errors", F.lit(0)).cast("long").alias("n_errors"), F.coalesce("messages", F.lit("")).alias("messages"), F.col("n_errors").isNull().alias("valid"))
