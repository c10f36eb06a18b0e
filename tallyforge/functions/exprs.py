"""Scalar expressions as Columns; all of them stay inside generated code."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from .. import fixed_values as fixed

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c: Column | str, table: dict) -> Column:
    """Value for a key of a short literal table; null for any other key."""
    return F.create_map([F.lit(x) for x in chain.from_iterable(table.items())])[_col(c)]


def device_of(user_agent: Column | str) -> Column:
    """Device name from the first word in brackets; null when there is none or it is unknown."""
    return lookup(F.regexp_extract(_col(user_agent), fixed.USER_AGENT_WORD, 1), fixed.USER_DEVICES)


def in_share(fraction: Column | float, seed: int, *key: Column | str) -> Column:
    """True for that share of the keys. The key alone decides, whatever the partitioning is."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(c).cast("string") for c in key])
    drawn = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return drawn < (fraction if isinstance(fraction, Column) else F.lit(float(fraction))) * float(1 << 32)


def to_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def event_date(ms: Column | str) -> Column:
    """UTC calendar date of an epoch-millisecond value, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(_col(ms) / DAY_MS).cast("int"))


def event_hour(ms: Column | str) -> Column:
    return F.pmod(F.floor(_col(ms) / HOUR_MS), F.lit(24)).cast("int")


def time_parts(ms: Column | str) -> dict[str, Column]:
    """month, monthDay, hour, weekDay (1 = Sunday), date, and the unambiguous monthStart."""
    day = event_date(ms)
    return {
        "month": F.month(day),
        "monthDay": F.dayofmonth(day),
        "hour": event_hour(ms),
        "weekDay": F.dayofweek(day),
        "date": day,
        "monthStart": F.trunc(day, "month"),
    }


def state_of(location: Column | str, trim: bool = False) -> Column:
    """Part after the first comma (its leading blank is kept unless ``trim``); null without one."""
    part = F.get(F.split(_col(location), ","), F.lit(1))
    return F.trim(part) if trim else part


def flag(c: Column | str, values: list) -> Column:
    """1 when the value is listed, else 0 (null counts as 0)."""
    return F.coalesce(_col(c).isin(values).cast("int"), F.lit(0))


def higher_ed(c: Column | str) -> Column:
    """1 when the text names a degree above bachelor; case matters, null gives 0."""
    hit = F.lit(False)
    for word in fixed.HIGHER_ED_WORDS:
        hit = hit | _col(c).contains(word)
    return F.coalesce(hit.cast("int"), F.lit(0))


def job_satisfied(c: Column | str) -> Column:
    """1 when the last word is exactly ``satisfied``; null gives 0."""
    return F.coalesce(_col(c).rlike(rf"(^|\s){fixed.SATISFIED_WORD}\s*$").cast("int"), F.lit(0))


def packed_name(cell: Column | str) -> Column:
    """``name-1`` -> ``name``."""
    c = _col(cell)
    return F.substring(c, F.lit(1), F.length(c) - 2)


def packed_value(cell: Column | str) -> Column:
    """``name-1`` -> 1; any last character but 0 and 1 counts as 1."""
    last = F.right(_col(cell), F.lit(1))
    return F.when(last.isNotNull(), F.when(last == "0", 0).otherwise(1))


def has_word(text: Column | str, word: str, ignore_case: bool = True) -> Column:
    """Substring test, by default on lower-cased text."""
    c = _col(text)
    return F.lower(c).contains(word) if ignore_case else c.contains(word)


def log_plus_one(c: Column | str) -> Column:
    return F.log1p(_col(c))


def between_years(years: Column | str, low: int, high: int, mode: str = "numeric") -> Column:
    """Experience range on a text column.

    ``numeric`` reads numbers and keeps low < x < high; ``text`` keeps what compares as a
    string above ``low`` or below ``high``, as a string predicate in a query would.
    """
    c = _col(years)
    if mode == "numeric":
        number = c.try_cast("double")
        return (number > low) & (number < high)
    if mode == "text":
        return (c > str(low)) | (c < str(high))
    raise ValueError(f"mode must be numeric or text, not {mode!r}")


def finite(c: Column | str) -> Column:
    """The value as double, null when it is no finite number."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def word_to_number(c: Column | str, words: dict[str, float]) -> Column:
    """Listed texts become their number, the rest is read as a number."""
    return F.coalesce(lookup(c, words), _col(c).try_cast("double"))
