"""Quality rules: a table of thresholds, compiled into one projection of SQL functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import text_or_empty, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was with on as by are this be at or from "
    "der die das und in den von zu mit sich auf für ist im dem nicht ein eine als auch "
    "le la les de des et un une du en que qui dans pour sur est pas au par avec "
    "el los las y del se por con no su al lo es para una"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if least <= 100 * part / whole <= most; either bound may be open, a whole of 0 passes.

    The rule holds from so many words on. Names are those of the statistics of text_statistics().
    """

    name: str
    part: str
    whole: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The thresholds. The first two are the base rules, the others the verdict on top of them.
BASE_RULES = (
    Rule("few_words", "n_words", "one", least=1000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=100, most=2500),
    Rule("symbols", "n_symbols", "n_words", most=25),
    Rule("adjacent_repeats", "n_adjacent", "n_words", most=20),
    Rule("stop_words", "n_stop_words", "n_words", least=1, from_words=100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=60),
)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 5, stop_words: tuple[str, ...] | list[str] = tuple(STOP_WORDS)) -> DataFrame:
    """Counts of each whole text; doc_id and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_stop_words, n_adjacent as long.

    n_repeat_words counts the words in windows of five words that occur twice or more in the text. Windows are compared
    by hash first; only where two hashes agree are the words themselves compared.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", "text", words(F.col("text")).alias("w"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    at = lambda i: F.get(F.col("w"), i)
    hashes = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[at(i + k) for k in range(window)]))
    stop = F.filter("w", lambda x: F.lower(x).isin(list(stop_words)))
    rows = rows.select(
        "doc_id", "w", n.cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").cast("long").alias("n_lines"),
        F.size(stop).cast("long").alias("n_stop_words"), F.size(F.filter("w", lambda x, i: (i > 0) & (x == at(i - 1)))).cast("long").alias("n_adjacent"),
        F.when(n >= window, hashes).alias("h"),
    )
    # Only windows whose hash another window of the text has are spelled out: as (words, place) in order of their words.
    placed = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.withColumn("p", F.when(F.size(F.array_distinct("h")) < F.size("h"), placed))
    met = lambda x, i: F.coalesce((i > 0) & (F.get("p", i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get("p", i + 1)["h"] == x["h"], F.lit(False))
    rows = rows.withColumn("p", F.filter("p", met))
    spelled = lambda x: F.struct(F.concat_ws(" ", *[at(x["i"] + k) for k in range(window)]).alias("t"), x["i"].alias("i"))
    rows = rows.withColumn("s", F.sort_array(F.transform("p", spelled)))
    near = lambda x, i: (F.get("s", i - 1)["t"] == x["t"]) | (F.get("s", i + 1)["t"] == x["t"])
    first = F.filter("s", lambda x, i: F.coalesce(near(x, i), (F.get("s", i - 1)["t"] == x["t"]), (F.get("s", i + 1)["t"] == x["t"]), F.lit(False)))
    rows = rows.withColumn("at", F.sort_array(F.transform(first, lambda x: x["i"])))
    covered = F.aggregate(F.transform("at", lambda x, i: F.least(F.lit(window), F.coalesce(F.get("at", i + 1) - x, F.lit(window)))), F.lit(0), lambda a, b: a + b)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines", "n_stop_words", "n_adjacent")


def passes(rule: Rule) -> Column:
    part, whole = 100 * F.col(rule.part), F.lit(1) if rule.whole == "one" else F.col(rule.whole)
    held = F.lit(True)
    if rule.least is not None:
        held &= part >= F.lit(rule.least) * whole
    if rule.most is not None:
        held &= part <= F.lit(rule.most) * whole
    return held if not rule.from_words else held | (F.col("n_words") < rule.from_words)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The statistics of each document with base_failed, failed (the names of all rules that it fails) and kept.

    Null and empty texts have no words and fail the base rules. There is one row for each row of docs, whatever its id;
    an empty table gives an empty result, and other columns of docs are not read.
    """
    stats = text_statistics(docs, id_col, text_col)
    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in (*base, *rules)]))
    base_failed = ~F.forall(F.array(*[passes(r) for r in base]), lambda x: x)
    return stats.withColumns({"base_failed": base_failed, "failed": failed}).withColumn("kept", F.size("failed") == 0)
