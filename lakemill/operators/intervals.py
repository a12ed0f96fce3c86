"""Closed intervals with open ends: a null bound is unbounded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def holds(date: Column, first: Column, last: Column) -> Column:
    """Whether an interval holds a date; a missing date cannot exclude."""
    return F.coalesce(date >= first, F.lit(True)) & F.coalesce(date <= last, F.lit(True))


def holds_strictly(date: Column, first: Column, last: Column) -> Column:
    """As holds(), but a missing date or start excludes; only the end may be open."""
    return date.isNotNull() & first.isNotNull() & F.coalesce(date >= first, F.lit(False)) & F.coalesce(date <= last, F.lit(True))


def overlap(first_a: Column, last_a: Column, first_b: Column, last_b: Column) -> Column:
    return ~(F.coalesce(first_a > last_b, F.lit(False)) | F.coalesce(last_a < first_b, F.lit(False)))


def eligible(date: Column, intervals: Column) -> Column:
    """date in any of an array of structs (first, last). No array at all is always eligible, an empty one never."""
    inside = F.exists(intervals, lambda i: holds(date, i["first"], i["last"]))
    return date.isNull() | intervals.isNull() | F.coalesce(inside, F.lit(False))


def interval_join(points: DataFrame, spans: DataFrame, date: str, first: str, last: str, keys: list[str] | None = None, days: int = 366, how: str = "inner") -> DataFrame:
    """Rows of points with each span that holds their date, without a product of the two sides.

    Spans are cut into bins of so many days, from the earliest to the latest date of points at most, and joined by bin
    (and keys). A span is met once for each point, as a point has one bin. Points without a date meet no span.
    """
    bound = points.agg(F.min(date).cast("date").alias("low"), F.max(date).cast("date").alias("high")).first()
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / days).cast("long")
    low, high = F.lit(bound["low"]).cast("date"), F.lit(bound["high"]).cast("date")
    begin, end = F.greatest(F.coalesce(F.col(first).cast("date"), low), low), F.least(F.coalesce(F.col(last).cast("date"), high), high)
    bins = F.when(begin <= end, F.sequence(number(begin), number(end)))
    cut = spans.withColumn("__bin", F.explode(bins))
    # Whether a span holds the date belongs to the join: an outer one keeps a point that only its bin brings to a span.
    x, y = points.withColumn("__bin", number(F.col(date).cast("date"))), cut
    same = [x[k] == y[k] for k in ["__bin", *(keys or [])]]
    met = x.join(y, reduce(Column.__and__, [*same, holds(x[date], y[first], y[last])]), how)
    if how in ("left_semi", "left_anti"):
        return met.drop("__bin")
    shown = [F.coalesce(x[k], y[k]).alias(k) for k in keys or []]
    return met.select(*shown, *[x[c] for c in points.columns if c not in (keys or [])], *[y[c] for c in spans.columns if c not in (keys or [])])


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], first: str = "first", last: str = "last", days: int = 366) -> DataFrame:
    """Pairs of a row of a and a row of b that agree in keys and overlap, each once, with the days that both hold.

    The columns are keys, then those of a and of b but for their bounds, then first and last of the common days; open
    ends stay open. Intervals are cut into bins of so many days, between the earliest start and the latest bound of both
    sides, and meet by keys and bin; a pair is taken in the first bin that both have. So a key with very many intervals
    is dealt out over time, and what meets in vain is what shares a bin and not a day. Intervals that end before they
    begin meet nothing.
    """
    bounds = a.select(F.col(first).cast("date").alias("f"), F.col(last).cast("date").alias("l")).union(b.select(F.col(first).cast("date"), F.col(last).cast("date")))
    edge = bounds.agg(F.min(F.coalesce("f", "l")).alias("low"), F.max(F.coalesce("l", "f")).alias("high"), F.max("f").alias("late")).first()
    low, high = F.lit(edge["low"]).cast("date"), F.greatest(F.lit(edge["high"]).cast("date"), F.lit(edge["late"]).cast("date"))
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / days).cast("long")
    begin, end = F.coalesce(F.col(first).cast("date"), low), F.coalesce(F.col(last).cast("date"), high)

    def binned(side: DataFrame, mark: str) -> DataFrame:
        rows = side.where((begin <= end) | F.col(first).isNull() | F.col(last).isNull())
        own = [F.col(c).alias(f"{mark}{c}") for c in side.columns]
        return rows.select(*own, number(begin).alias(f"{mark}from"), F.explode(F.sequence(number(begin), F.greatest(number(begin), number(end)))).alias(f"{mark}bin"))

    x, y = binned(a, "__a_"), binned(b, "__b_")
    same = reduce(Column.__and__, [x[f"__a_{k}"] == y[f"__b_{k}"] for k in keys], x["__a_bin"] == y["__b_bin"])
    once = x["__a_bin"] == F.greatest("__a_from", "__b_from")
    met = x.join(y, same & once & overlap(*[F.col(f"__{m}_{c}") for m in "ab" for c in (first, last)]))
    rest = lambda side, mark: [F.col(f"{mark}{c}").alias(c) for c in side.columns if c not in (*keys, first, last)]
    common = [F.greatest(f"__a_{first}", f"__b_{first}").alias(first), F.least(f"__a_{last}", f"__b_{last}").alias(last)]
    return met.select(*[F.col(f"__a_{k}").alias(k) for k in keys], *rest(a, "__a_"), *rest(b, "__b_"), *common)


def islands(spans: DataFrame, keys: list[str], first: str, last: str, gap_days: int = 1) -> DataFrame:
    """Spans of a key merged where the next begins at most gap_days after the latest end so far: keys, first, last,
    n_spans. An open end swallows what follows; spans without a start are left out."""
    far = F.to_date(F.lit("9999-12-31"))
    rows = spans.where(F.col(first).isNotNull()).select(*keys, F.col(first).cast("date").alias("__f"), F.coalesce(F.col(last).cast("date"), far).alias("__l"))
    order = Window.partitionBy(*keys).orderBy("__f", "__l")
    reach = F.max("__l").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.datediff("__f", reach) > gap_days, F.lit(True)).cast("int")
    numbered = rows.withColumn("__new", fresh).withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "__island").agg(F.min("__f").alias(first), F.max("__l").alias("__l"), F.count("*").alias("n_spans"))
    return merged.select(*keys, first, F.nullif("__l", far).alias(last), "n_spans")


def enclosing(spans: DataFrame, keys: list[str], first: str, last: str, active: Column | None = None) -> DataFrame:
    """The range around a key's spans: earliest start, latest end, and no end while one is open or active."""
    open_ = F.col(last).isNull() if active is None else F.col(last).isNull() | active
    return spans.groupBy(*keys).agg(F.min(first).alias(first), F.when(~F.bool_or(open_), F.max(last)).alias(last), F.bool_or(open_).alias("active"), F.count("*").alias("n_spans"))
