"""Cleaning: dedup, filters, fills, casts, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions import exprs as E
from ..schemas import numeric_columns, text_columns
from .profile import _q, beside, blank, missing


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with no missing value (in ``subset``, or anywhere)."""
    return df.dropna("any", subset=[f"`{c}`" for c in subset] if subset else None)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all; one counting pass decides."""
    counts = df.agg(*[F.count_if(~missing(df, c)).alias(c) for c in df.columns]).first()
    return df.select([_q(c) for c in df.columns if counts[c]])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: the first in ``order``.

    A minimum over rows combines before the shuffle, so a key with very many copies sends
    one row a task; ranking the copies in a window would gather them all in one place.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*[_q(c) for c in order + rest])).alias("_first")
    picked = df.groupBy(_q(key)).agg(first)
    return picked.select([_q(c) if c == key else F.col(f"_first.`{c}`") for c in df.columns])


def keep_identified(df: DataFrame, column: str = "userId") -> DataFrame:
    return df.filter(_q(column) != "")


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def fill_means(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing numbers become the column mean."""
    columns = columns or numeric_columns(df)
    means = df.agg(F.struct(*[F.avg(F.when(~missing(df, c), _q(c))).alias(c) for c in columns]))
    return beside(df, "_means", means).withColumns({
        c: F.when(missing(df, c), F.col("_means")[c]).otherwise(_q(c).cast("double")) for c in columns
    }).drop("_means")


def impute_rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each value read as a number and rounded half-even; anything else gets the rounded mean."""
    means = df.agg(F.struct(*[F.avg(E.finite(_q(c))).alias(c) for c in columns]))
    return beside(df, "_means", means).withColumns({
        c: F.rint(F.coalesce(E.finite(_q(c)), F.col("_means")[c])) for c in columns
    }).drop("_means")


def words_to_numbers(df: DataFrame, words: dict[str, dict[str, float]]) -> DataFrame:
    return df.withColumns({c: E.word_to_number(_q(c), table) for c, table in words.items()})


def drop_text_columns(df: DataFrame) -> DataFrame:
    text = set(text_columns(df))
    return df.select([_q(c) for c in df.columns if c not in text])


def numeric_text_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is a number, with the column cast."""
    number = _q(column).try_cast("double")
    return df.filter(number.isNotNull() & ~F.isnan(number)).withColumn(column, number)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """About that share of the rows. The key (all columns by default) alone decides, so the sample is the same in every job."""
    return df.filter(E.in_share(fraction, seed, *[_q(c) for c in key or df.columns]))


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*[_q(c) for c in order]).limit(n)


def songs_without_length(clicks: DataFrame) -> DataFrame:
    """Song plays whose length is missing: invalid rows to look at."""
    return clicks.filter((F.col("page") == fixed.SONG_PAGE) & blank(clicks, "length"))


def drop_and_rename(df: DataFrame, drop: list[str], names: dict[str, str]) -> DataFrame:
    """Drops columns and renames others by name, so no column can take its neighbour's."""
    return df.drop(*drop).withColumnsRenamed(names)


def clean_clicks(raw: DataFrame) -> DataFrame:
    """Click log made ready: no copies, no anonymous rows, device, long user id, time parts, state, fills.

    The filter and the projections sit around one shuffle, that of the whole-row dedup.
    """
    rows = distinct_rows(keep_identified(raw))
    return fill_constants(
        rows.withColumns({
            "userDevice": E.device_of("userAgent"),
            "userId": E.to_long("userId"),
            **E.time_parts("ts"),
            "location": E.state_of("location"),
        }),
        fixed.CLICK_FILL,
    )
