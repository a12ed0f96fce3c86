"""Date scalars. A missing or malformed date is null, never a default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(text: Column) -> Column:
    """The date in the first ten characters, if they are one; '2024-02' and the like are not."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(head, F.lit("yyyy-MM-dd")).cast("date"))


def compact_date(text: Column) -> Column:
    """'20240131...' as '2024-01-31'; fewer than eight digits give null. The date itself is not checked."""
    return F.when(text.rlike(r"^\d{8}"), F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))


def instant(text: Column) -> Column:
    """A timestamp; zone names Z and +0000 are read, none means UTC (the session's zone)."""
    return F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2"))


def date_error(text: Column, now: Column) -> Column:
    """Null for a good or missing timestamp, else `malformed` or `future`."""
    read = instant(text)
    return F.when(text.isNull(), None).when(read.isNull(), "malformed").when(read > now, "future")


def age_days(then: Column, now: Column) -> Column:
    """Whole days from then to now, rounded down."""
    return F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))) / F.lit(86_400_000_000)).cast("long")


def calendar_label(date: Column, calendar: Sequence[tuple[str, str, str | None]]) -> Column:
    """The label of the period (label, first, last) that holds the date; last may be open; gaps give null."""
    out = F.lit(None).cast("string")
    for label, first, last in reversed(calendar):
        held = date >= F.lit(first).cast("date")
        out = F.when(held if last is None else held & (date <= F.lit(last).cast("date")), F.lit(label)).otherwise(out)
    return out


def coverage(first: Column, last: Column, bound: Column) -> Column:
    """How far a period is covered by what was read up to a bound: covered, partly, outside or undetermined."""
    return (
        F.when(first.isNull() | bound.isNull(), "undetermined")
        .when(first > bound, "outside")
        .when(last.isNotNull() & (last <= bound), "covered")
        .otherwise("partly")
    )


def compact_date(raw: Column) -> Column:
    """YYYYMMDD, with whatever follows, as an ISO date; not validated, and null if the text is shorter."""
    return F.when(F.length(raw) >= 8, F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2)))


def stamped(raw: Column) -> Column:
    """A time with an offset (+hhmm, +hh:mm or Z) as a timestamp; null if it is none."""
    whole = raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:Z|[+-]\d{2}:?\d{2})$")
    return F.when(whole, F.try_to_timestamp(F.regexp_replace(raw, r"([+-]\d{2})(\d{2})$", "$1:$2")))
