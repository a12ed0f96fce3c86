"""Scalars on presence, keys, numbers and nested values. Missing, empty and zero are three things."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled_text(text: Column) -> Column:
    """Whether a text is neither null nor empty."""
    return F.coalesce(text != "", F.lit(False))


def filled_list(items: Column) -> Column:
    """Whether a list is neither null nor empty."""
    return F.coalesce(F.size(items) > 0, F.lit(False))


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def size_or_zero(items: Column) -> Column:
    return F.when(items.isNull(), 0).otherwise(F.size(items)).cast("long")


def size_or_null(items: Column) -> Column:
    return F.when(items.isNotNull(), F.size(items)).cast("long")


def whole_number(text: Column) -> Column:
    """A whole number read from a text, null if it is none."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.btrim(text).try_cast("long"))


def joined_key(*parts: Column, prefix: str) -> Column:
    """'prefix:a:b'; null if a part is null or empty, so no key is invented."""
    whole = F.lit(True)
    for part in parts:
        whole = whole & filled_text(part.cast("string"))
    return F.when(whole, F.concat_ws(":", F.lit(prefix), *[p.cast("string") for p in parts]))


def key_part(key: Column, part: int, parts: int, prefix: str) -> Column:
    """A part of 'prefix:a:b' by its place from 1; null for a key of another form."""
    pieces = F.split(key, ":")
    good = (F.size(pieces) == parts + 1) & (F.get(pieces, F.lit(0)) == prefix)
    return F.when(good, F.nullif(F.get(pieces, F.lit(part)), F.lit("")))


def byte_weight(value: Column) -> Column:
    """Bytes of a value as compact JSON in UTF-8; null weighs nothing."""
    return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)).cast("long")


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole, rounded; null where there is no whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits, and 0 where there is nothing to fill."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * part / F.when(whole != 0, whole), 2))


def listed(value: Column) -> Column:
    """A JSON text as a list of JSON texts: a list's members, or the value alone; null stays null."""
    array = F.from_json(value, "array<string>")
    return F.when(value.isNull(), None).when(F.startswith(F.btrim(value), F.lit("[")), array).otherwise(F.array(value))
