"""Merging a previous state with a new one: nothing that was known is lost, and ties have a stated winner."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.dedupe import keep_one


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on keys where null equals null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def additive_union(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All old rows, repeats too, then of the new rows whose key is not among them the first of each key."""
    fresh = keep_one(new, keys, order)
    return old.unionByName(fresh.join(old.select(*keys).distinct(), same_keys(fresh, old, keys), "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key the last row: a new one if there is any, else an old one."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    return keep_one(both, keys, [F.desc("__side"), *order]).drop("__side")


def latest(old: DataFrame, new: DataFrame, keys: Sequence[str], stamp: str, order: Sequence[Column]) -> DataFrame:
    """Of each key the row with the greatest stamp; old wins a tie, a missing stamp loses."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    return keep_one(both, keys, [F.col(stamp).desc_nulls_last(), F.asc("__side"), *order]).drop("__side")


def coalesce_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A full join on keys, unique on either side: a new value wins unless it is null, so null never takes one away."""
    fields = [c for c in old.columns if c not in keys]
    o, n = old.alias("o"), new.alias("n")
    match = reduce(lambda x, y: x & y, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    return o.join(n, match, "full_outer").select(*[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in [*keys, *fields]])


def backfill(old: DataFrame, new: DataFrame, keys: Sequence[str], field: str, order: Sequence[Column]) -> DataFrame:
    """Old rows whose field is null take the first new value of their key; a null key is a key."""
    given = keep_one(new.where(F.col(field).isNotNull()), keys, order).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(field).alias("__given"))
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return old.join(given, match, "left").withColumn(field, F.coalesce(field, "__given")).select(*old.columns)


def guarded(old: Column, new: Column) -> Column:
    """A new list, unless it is empty or missing and the old one is not."""
    return F.when((F.coalesce(F.size(new), F.lit(0)) <= 0) & (F.coalesce(F.size(old), F.lit(0)) > 0), old).otherwise(new)


def fingerprint(*columns: str) -> Column:
    """SHA-256 of the columns as JSON; null fields count by their absence."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def compared(before: DataFrame, after: DataFrame, keys: Sequence[str], sizes: Sequence[str], scalars: Sequence[str]) -> DataFrame:
    """What changed between two states, one row for each key and field: keys, field, was, now, change, blocking.

    A key that is gone, a size that shrank and a scalar that became null block; growth and other values do not.
    """
    b, a = before.alias("b"), after.alias("a")
    match = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])
    joined = b.withColumn("__in", F.lit(True)).alias("b").join(a.withColumn("__in", F.lit(True)).alias("a"), match, "full_outer")
    gone, added = F.col("a.__in").isNull(), F.col("b.__in").isNull()
    entry = lambda f, change: F.struct(F.lit(f).alias("field"), F.col(f"b.{f}").cast("string").alias("was"), F.col(f"a.{f}").cast("string").alias("now"), change.alias("change"))
    size = lambda f: F.when(gone | added, None).when(F.col(f"a.{f}") < F.col(f"b.{f}"), "shrunk").when(F.col(f"a.{f}") > F.col(f"b.{f}"), "grown")
    scalar = lambda f: F.when(gone | added, None).when(F.col(f"b.{f}").isNotNull() & F.col(f"a.{f}").isNull(), "lost").when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), "changed")
    whole = F.struct(F.lit("*").alias("field"), F.lit(None).cast("string").alias("was"), F.lit(None).cast("string").alias("now"), F.when(gone, "gone").when(added, "added").alias("change"))
    entries = F.explode(F.filter(F.array(whole, *[entry(f, size(f)) for f in sizes], *[entry(f, scalar(f)) for f in scalars]), lambda e: e["change"].isNotNull())).alias("e")
    rows = joined.select(*[F.coalesce(f"b.{k}", f"a.{k}").alias(k) for k in keys], entries)
    return rows.select(*keys, "e.field", "e.was", "e.now", "e.change", F.col("e.change").isin("gone", "shrunk", "lost").alias("blocking"))


def classified(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, status): `both`, `missing` from found, or `unexpected` in it."""
    e, f = expected.select(key).distinct().withColumn("e", F.lit(1)), found.select(key).distinct().withColumn("f", F.lit(1))
    return e.join(f, key, "full_outer").select(key, F.when(F.col("f").isNull(), "missing").when(F.col("e").isNull(), "unexpected").otherwise("both").alias("status"))


def fallback_key(chain: Sequence[Column], otherwise: Sequence[str]) -> Column:
    """A row's key: the first of a chain that is neither null nor empty, else the other columns joined."""
    return F.coalesce(*[F.when(c != "", c) for c in chain], F.concat_ws("|", *otherwise))


def summary_at(node: Column, path: str) -> Column:
    """What stands at a dotted path of a JSON document, for comparison: blank text and empty containers are null, a filled
    container is `present` only, as its content is not compared, and 0 and false are values."""
    found = F.get_json_object(node, "$." + path)
    inside = F.regexp_replace(found, r"\s", "")
    return F.when(inside.isin("", "[]", "{}"), None).when(inside.rlike(r"^[\[{]"), "present").otherwise(found)


def additive_folds(rows: DataFrame, keys: Sequence[str], rank: str, position: str) -> DataFrame:
    """The additive merge of many states in the order of their rank, in one pass: rows of the first state stay, its
    duplicates too; of a key that it lacks the first row of the first state that has it is added. A null key is a key."""
    first = F.min(rank).over(Window.partitionBy(*keys))
    found = rows.withColumns({"__first": first, "__at": F.row_number().over(Window.partitionBy(*keys, rank).orderBy(position)), "__least": F.lit(0)})
    return found.where((F.col(rank) == F.col("__first")) & ((F.col(rank) == F.col("__least")) | (F.col("__at") == 1))).drop("__first", "__at", "__least")
