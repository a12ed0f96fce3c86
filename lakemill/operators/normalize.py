"""From raw records to facts with keys: resolution, signatories, memberships, statuses, trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.values import filled_text
from lakemill.operators.intervals import overlap


def resolved(facts: DataFrame, dim: DataFrame, on: Sequence[str], dim_key: str, fallback: Column, record: Sequence[str], out: str = "key") -> DataFrame:
    """facts with the key of their dimension row, found by `on` (nulls match nulls), else the fallback key.

    A fact that has neither keeps its own record as a struct in `unresolved`, which is null otherwise; nothing is dropped.
    dim holds each combination of `on` once.
    """
    side = dim.select(*[F.col(c).alias(f"__{c}") for c in on], F.col(dim_key).alias("__key"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])
    rows = facts.join(side, same, "left").withColumn(out, F.coalesce("__key", fallback))
    kept = F.when(F.col(out).isNull(), F.struct(*record))
    return rows.withColumn("unresolved", kept).drop("__key", *[f"__{c}" for c in on])


def outcome(state: Column, substate: Column, table: Mapping[tuple[str, str | None], str]) -> Column:
    """The outcome that a table gives for (state, substate), else for (state, None); null for what it does not know."""
    codes = F.create_map(*[F.lit(x) for (a, b), v in table.items() for x in (f"{a}\n{b or ''}", v)])
    exact = F.element_at(codes, F.concat(state, F.lit("\n"), F.coalesce(substate, F.lit(""))))
    return F.coalesce(exact, F.element_at(codes, F.concat(state, F.lit("\n"))))


def signatories(records: DataFrame, author: str, cosigners: str, role: str = "role", ref: str = "member") -> DataFrame:
    """A row for the author of each record and one for each distinct cosigner who is not the author; null refs give none."""
    first = F.array_compact(F.array(F.struct(F.col(author).alias(ref), F.lit("author").alias(role))))
    others = F.filter(F.array_distinct(F.coalesce(cosigners, F.array())), lambda x: x.isNotNull() & ~x.eqNullSafe(F.col(author)))
    rest = F.transform(others, lambda x: F.struct(x.alias(ref), F.lit("cosigner").alias(role)))
    keep = [c for c in records.columns if c not in (author, cosigners)]
    return records.select(*keep, F.explode(F.concat(first, rest)).alias("s")).select(*keep, f"s.{ref}", f"s.{role}").where(F.col(ref).isNotNull())


def roster(memberships: DataFrame, posts: DataFrame, periods: DataFrame) -> DataFrame:
    """(period, member, post, first, last): who belonged to each period, and as what.

    memberships(member, label, first, last), posts(member, post, first, last), periods(period, label, first, last). A
    membership counts if its label is the period's and the two overlap; its posts are those that overlap both. Without
    one there is one row with a null post and the membership's dates. Equal rows are given once.
    """
    m, p = memberships.alias("m"), periods.alias("p")
    inside = m.join(p, (F.col("m.label") == F.col("p.label")) & overlap(F.col("m.first"), F.col("m.last"), F.col("p.first"), F.col("p.last")))
    inside = inside.select("p.period", "m.member", F.col("m.first").alias("mf"), F.col("m.last").alias("ml"), F.col("p.first").alias("pf"), F.col("p.last").alias("pl"))
    x = posts.alias("x")
    both = (F.col("x.member") == inside.member) & overlap(F.col("x.first"), F.col("x.last"), F.col("mf"), F.col("ml")) & overlap(F.col("x.first"), F.col("x.last"), F.col("pf"), F.col("pl"))
    rows = inside.join(x, both, "left")
    has = F.col("x.post").isNotNull()
    return rows.select(
        "period", inside.member.alias("member"), F.col("x.post").alias("post"),
        F.when(has, F.col("x.first")).otherwise(F.col("mf")).alias("first"), F.when(has, F.col("x.last")).otherwise(F.col("ml")).alias("last"),
    ).distinct()


def sole_holder(memberships: DataFrame, posts: DataFrame, periods: DataFrame, title: str, role: str) -> DataFrame:
    """(period, holder, warning) of every period: who belonged to it and held a post of a title in it.

    Two facts are asked for, never one: a membership of the period's label that overlaps it, and a post of the title
    that overlaps both. memberships(member, label, first, last), posts(member, post, role, first, last),
    periods(period, label, first, last). A post of the title in another role is told and does not count; of several
    holders none is chosen, which is told with their names.
    """
    m, p, x = memberships.alias("m"), periods.alias("p"), posts.where(F.col("post") == title).alias("x")
    inside = m.join(p, (F.col("m.label") == F.col("p.label")) & overlap(F.col("m.first"), F.col("m.last"), F.col("p.first"), F.col("p.last")))
    both = (F.col("x.member") == F.col("m.member")) & overlap(F.col("x.first"), F.col("x.last"), F.col("m.first"), F.col("m.last")) & overlap(F.col("x.first"), F.col("x.last"), F.col("p.first"), F.col("p.last"))
    met = inside.join(x, both).select(F.col("p.period").alias("period"), F.col("m.member").alias("member"), F.coalesce(F.lower(F.btrim("x.role")) == role.lower(), F.lit(False)).alias("counts"))
    found = met.groupBy("period").agg(F.array_sort(F.collect_set(F.when(F.col("counts"), F.col("member")))).alias("holders"), F.array_sort(F.collect_set(F.when(~F.col("counts"), F.col("member")))).alias("others"))
    names = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ", ")
    several = F.when(F.size("holders") > 1, F.concat(F.size("holders").cast("string"), F.lit(" possible: "), names("holders")))
    told = F.nullif(F.concat_ws("; ", several, F.when(F.size("others") > 0, F.concat(F.lit("another role: "), names("others")))), F.lit(""))
    every = periods.select("period").distinct().join(found, "period", "left")
    return every.select("period", F.when(F.size("holders") == 1, F.col("holders")[0]).alias("holder"), told.alias("warning"))


def text_status(acts: DataFrame, key: str, code: str, date: str, position: str, statuses: Mapping[str, str], final: str, final_status: str, default: str) -> DataFrame:
    """(key, status, deposited, last_act, n_acts) of acts: the status of the latest deciding act.

    Of deciding acts of one date the first by position counts. A code of statuses decides; without a deciding act the
    status is the default; any act of the final code overrides every status that is not already better than it.
    """
    table = F.create_map(*[F.lit(x) for kv in statuses.items() for x in kv])
    decides = F.col(code).isin(*statuses)
    # The latest date, then the smallest position: of structs, the greatest of (date, -position).
    at = F.when(decides, F.struct(F.col(date), -F.col(position)))
    found = acts.groupBy(key).agg(F.max_by(F.element_at(table, F.col(code)), at).alias("status"), F.bool_or(F.col(code) == final).alias("ended"), F.min(date).alias("deposited"), F.max(date).alias("last_act"), F.count("*").alias("n_acts"))
    return found.select(key, F.when(F.coalesce("ended", F.lit(False)), final_status).otherwise(F.coalesce("status", F.lit(default))).alias("status"), "deposited", "last_act", "n_acts")


def tree_nodes(df: DataFrame, key: str, json_col: str, name: str = "name", children: str = "children", most: int = 64) -> DataFrame:
    """(key, depth, path, name) of every node of trees in JSON, to whatever depth they go; a job for each level.

    Children may be a list, one object or missing. path holds the places from the root, joined by dots.
    """
    level = df.select(key, F.lit(0).alias("depth"), F.lit("0").alias("path"), F.try_parse_json(json_col).alias("v")).where("v is not null")
    found = []
    for depth in range(most):
        found.append(level.select(key, "depth", "path", F.try_variant_get("v", f"$.{name}", "string").alias("name")))
        below = F.coalesce(F.try_variant_get("v", f"$.{children}", "array<variant>"), F.array(F.try_variant_get("v", f"$.{children}", "variant")))
        level = level.select(key, F.posexplode(F.array_compact(below)).alias("i", "c"), "path").select(key, F.lit(depth + 1).alias("depth"), F.concat_ws(".", "path", "i").alias("path"), F.col("c").alias("v"))
        if level.isEmpty():
            return reduce(DataFrame.union, found)
    raise ValueError(f"trees deeper than {most}")


def in_order(values: Column, order: Sequence[str]) -> Column:
    """The known values of an array, each once, in a fixed order; unknown ones are left out."""
    return F.array_intersect(F.array(*[F.lit(x) for x in order]), F.coalesce(values, F.array().cast("array<string>")))


def coded_ref(raw: Column, prefix: str) -> tuple[Column, Column]:
    """(reference, reason) of a raw speaker id: prefixed, completed, anonymous, pseudo, absent or unexpected."""
    text = F.btrim(raw)
    reason = (
        F.when(~filled_text(text), "absent")
        .when(text == "0", "anonymous")
        .when(text.rlike(r"^-\d+$"), "pseudo")
        .when(text.rlike(rf"^{prefix}\d+$"), "prefixed")
        .when(text.rlike(r"^\d+$"), "completed")
        .otherwise("unexpected")
    )
    return F.when(reason == "prefixed", text).when(reason == "completed", F.concat(F.lit(prefix), text)), reason


def pruned(warnings: Column, contradicted: Mapping[str, Column]) -> Column:
    """Warnings without those that start with a prefix whose condition (the data came after all) holds; each stays once."""

    def untrue(w: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.startswith(w, F.lit(p)) & F.coalesce(c, F.lit(False)) for p, c in contradicted.items()], F.lit(False))

    return F.filter(F.array_distinct(warnings), lambda w: ~untrue(w))
