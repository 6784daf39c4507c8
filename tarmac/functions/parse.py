"""Coercion, key clean-up and clock arithmetic, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tail numbers that mean "no tail number".
BLANK_TAILS = ["", "NAN", "NONE", "NULL", "UNKNOWN", "UNKN", "NA"]
# Text that means "no value" in a categorical column.
BLANK_CATEGORIES = ["", "nan", "none"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: Column | str) -> Column:
    """Number as double; text that is no number, and NaN, become NULL."""
    return F.nanvl(_c(c).try_cast("double"), F.lit(None).cast("double"))


def day(c: Column | str) -> Column:
    """Calendar day; text that is no date becomes NULL."""
    return _c(c).try_cast("date")


def day_strict(c: Column | str) -> Column:
    """Calendar day; text that is no date fails the job."""
    return _c(c).cast("date")


def key_text(c: Column | str) -> Column:
    """Join key as trimmed upper-case text."""
    return F.upper(F.trim(_c(c).cast("string")))


def key_int(c: Column | str) -> Column:
    return num(c).cast("bigint")


def norm_keys(
    df: DataFrame, text: Sequence[str] = (), days: Sequence[str] = (), ints: Sequence[str] = ()
) -> DataFrame:
    """Normalise the key columns that are present; others are left alone."""
    made = {c: key_text(c) for c in text if c in df.columns}
    made |= {c: day(c) for c in days if c in df.columns}
    made |= {c: key_int(c) for c in ints if c in df.columns}
    return df.withColumns(made) if made else df


def clean_tail(c: Column | str) -> Column:
    """Tail number, or NULL for the sentinel spellings of "unknown"."""
    value = key_text(c)
    return F.when(~value.isin(BLANK_TAILS), value)


def registry_number(c: Column | str) -> Column:
    """Tail number as written in the aircraft registry: no leading N, no leading zeros."""
    bare = F.trim(F.regexp_replace(key_text(c), "^N", ""))
    return F.regexp_replace(bare, "^0+", "")


def as_category(c: Column | str) -> Column:
    """Category text with every spelling of "missing" folded to ``Unknown``."""
    text = _c(c).cast("string")
    blank = text.isNull() | F.lower(F.trim(text)).isin(BLANK_CATEGORIES)
    return F.when(blank, F.lit("Unknown")).otherwise(text)


def hhmm_hour(c: Column | str) -> Column:
    return F.floor(num(c) / 100).cast("int")


def hhmm_ts(date: Column | str, hhmm: Column | str) -> Column:
    """Local wall clock from a day and an HHMM number; 2400 and 1261 become NULL."""
    d, t = _c(date), num(hhmm).cast("int")
    hour, minute = F.floor(t / 100).cast("int"), (t % 100).cast("int")
    fits = t.between(0, 2359) & (minute < 60)
    return F.when(
        fits,
        F.try_make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), hour, minute, F.lit(0)),
    )


def hhmm_minutes(c: Column | str) -> Column:
    """Minutes after midnight; hours up to 47 are allowed, minutes up to 59."""
    t = num(c).cast("int")
    # 100 h + m becomes 60 h + m.
    return F.when(t.between(0, 4799) & (t % 100 <= 59), t - 40 * F.floor(t / 100)).cast("double")


def wrap_diff(a: Column, b: Column) -> Column:
    """``a - b`` in minutes, taken across midnight when that is the shorter way."""
    d = a - b
    return d + 1440.0 * ((d < -720).cast("int") - (d > 720).cast("int"))


def time_block(hhmm: Column | str) -> Column:
    """Hour block label ``HH00-HH59``; a missing time falls in the first block."""
    hour = F.greatest(F.lit(0), F.least(F.lit(23), F.coalesce(hhmm_hour(hhmm), F.lit(0))))
    return F.format_string("%02d00-%02d59", hour, hour)


def minute_of(c: Column | str) -> Column:
    """Minute number since 1970 of a local wall clock, free of any time zone."""
    t = _c(c)
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(t) * 60 + F.minute(t)


def day_number(c: Column | str) -> Column:
    return F.datediff(_c(c), F.lit("1970-01-01").cast("date"))


def od_pair(origin: Column | str = "Origin", dest: Column | str = "Dest") -> Column:
    return F.concat_ws("_", _c(origin), _c(dest))


def first_present(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    have = set(columns)
    return next((c for c in candidates if c in have), None)


def col_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def between_days(c: Column | str, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive day window with either side open; written so that it reaches the Parquet scan."""
    held = F.lit(True)
    if start:
        held = held & (_c(c) >= F.lit(start).cast("date"))
    if end:
        held = held & (_c(c) <= F.lit(end).cast("date"))
    return held


def flown(c: Column | str = "Cancelled") -> Column:
    """Not cancelled; an unknown flag counts as flown."""
    return F.coalesce(num(c), F.lit(0.0)) == 0
