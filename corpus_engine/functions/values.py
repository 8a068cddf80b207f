"""Ids, numbers, durations, dates and "first usable" choices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: white space as the corpus defines it (the Unicode set plus the four separators
# U+001C..U+001F). Use with the (?U) flag.
SPACE = r"[\s\x1c-\x1f]"

# Link prefixes published with each row.
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
CHANNEL_URL_PREFIX = "https://www.youtube.com/channel/"


def stable_id(*parts: Column) -> Column:
    """First 20 hex digits of the SHA-256 of the parts joined by ``|``; null counts as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha2(F.concat_ws("|", *texts), 256), 1, 20)


def safe_int(value: Column) -> Column:
    """The whole number a text spells (surrounding space and digit-group ``_`` allowed), else null."""
    spelled = value.rlike(rf"(?U)^{SPACE}*[+-]?[0-9]+(_[0-9]+)*{SPACE}*$")
    digits = F.regexp_replace(value, rf"(?U){SPACE}|_", "")
    return F.when(spelled, digits.try_cast("bigint"))


def iso_duration_seconds(value: Column) -> Column:
    """Seconds of an ISO-8601 duration made of days, hours, minutes and seconds.

    Weeks, fractions and anything else give null; an empty ``P`` or ``PT`` is 0.
    """
    shape = r"^P(?:([0-9]+)D)?(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?)?$"
    total = F.lit(0).cast("bigint")
    for group, unit in enumerate((86400, 3600, 60, 1), start=1):
        digits = F.regexp_extract(value, shape, group)
        amount = F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))
        total = F.try_add(total, F.try_multiply(amount, F.lit(unit).cast("bigint")))
    return F.when(value.rlike(shape), total)


def first_text(*values: Column) -> Column:
    """The first value that is neither null nor empty; the last one as it is."""
    *head, last = values
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in head], last)


def first_object_field(field: str, *objects: Column) -> Column:
    """``field`` of the first map that has any entry, even if that map lacks the field."""
    usable = [F.when(F.size(o) > 0, o) for o in objects]
    return F.try_element_at(F.coalesce(*usable), F.lit(field))


def or_empty(values: Column) -> Column:
    """A missing array becomes an empty one."""
    return F.coalesce(values, F.array().cast("array<string>"))


def present(value: Column) -> Column:
    """True when a text is neither null nor empty."""
    return value.isNotNull() & (value != "")


def prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value)


def last_chars(value: Column, n: int) -> Column:
    return F.right(value, F.lit(n))


def iso_z(moment: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text of a UTC timestamp without zone, whatever the session's zone."""
    return F.concat(F.translate(F.left(moment.cast("string"), F.lit(19)), " ", "T"), F.lit("Z"))


def utc_now(moment: datetime | None = None) -> str:
    """The moment (now, if none is given) in UTC to the microsecond, with ``Z`` for the zone."""
    at = (moment or datetime.now(tz=timezone.utc)).astimezone(timezone.utc)
    return f"{at:%Y-%m-%dT%H:%M:%S}.{at.microsecond:06d}Z"


def new_run_id() -> str:
    """A run's name from the present moment; to the microsecond, so that quick reruns differ."""
    digits = "".join(c for c in utc_now() if c.isdigit())
    return f"{digits[:8]}T{digits[8:14]}.{digits[14:]}Z"


def date_windows(start: str | None, end: str | None, days: int) -> Column:
    """Array of ``struct<published_after, published_before>`` covering inclusive dates.

    Windows are half-open and ``days`` long, the last one cut at the day after ``end``. Without
    dates there is one window open on both sides.
    """
    if days <= 0:
        raise ValueError("window_days must be positive")
    if bool(start) != bool(end):
        raise ValueError("give both dates or neither")
    if not start:
        open_side = F.lit(None).cast("string")
        return F.array(F.struct(open_side.alias("published_after"), open_side.alias("published_before")))
    if date.fromisoformat(end) < date.fromisoformat(start):
        raise ValueError("end date precedes start date")
    stop = F.date_add(F.lit(end).cast("date"), 1)
    starts = F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {int(days)} days"))

    def midnight(day: Column) -> Column:
        return F.concat(day.cast("string"), F.lit("T00:00:00Z"))

    return F.transform(starts, lambda day: F.struct(
        midnight(day).alias("published_after"),
        midnight(F.least(F.date_add(day, int(days)), stop)).alias("published_before"),
    ))


def text_array(values: Sequence[str]) -> Column:
    """A literal ``array<string>``, typed even when empty."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def distinct_texts(values: Column) -> Column:
    """Trimmed, blanks dropped, first occurrence kept."""
    trimmed = F.transform(values, lambda v: F.regexp_replace(v, rf"(?U)^{SPACE}+|{SPACE}+$", ""))
    return F.array_distinct(F.filter(trimmed, lambda v: v != ""))
