"""Multi-choice answers: counts, shares, comparisons, bins and dummies.

A cell holds choices separated by ``;``. Choices are not trimmed, a repeated choice counts
twice, and a missing cell is the choice ``nan``. All tables here are (choice, ...) in long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed
from ..schemas import text_columns
from .clean import impute_rounded
from .profile import _q, beside, missing

MAX_COLUMNS = 2000
DECIMALS = 1000  # shares keep three decimals, rounded half-even


def cell_choices(df: DataFrame, field: str) -> Column:
    """The cell's choices as an array of text."""
    if isinstance(df.schema[field].dataType, T.StringType):
        return F.split(F.coalesce(_q(field), F.lit(fixed.MISSING_CHOICE)), fixed.CHOICE_SEPARATOR)
    number = F.when(~missing(df, field), _q(field))
    as_text = F.when(number == F.floor(number), number.cast("bigint").cast("string")).otherwise(number.cast("string"))
    return F.array(F.coalesce(as_text, F.lit(fixed.MISSING_CHOICE)))


def where_equal(df: DataFrame, where: dict | None) -> DataFrame:
    """Rows that equal every given value; an empty filter keeps all rows."""
    for name, value in (where or {}).items():
        df = df.filter(_q(name) == value)
    return df


def choice_counts(df: DataFrame, field: str, where: dict | None = None) -> DataFrame:
    """(choice, n), optionally among the rows that equal one filter value."""
    rows = where_equal(df, where)
    return (
        rows.select(F.explode(cell_choices(rows, field)).alias("choice"))
        .groupBy("choice").agg(F.count(F.lit(1)).alias("n"))
    )


def has_number_choice(counts: DataFrame) -> DataFrame:
    """One row: whether any choice reads as a finite number."""
    number = F.col("choice").try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return counts.agg(F.coalesce(F.bool_or(finite), F.lit(False)).alias("is_numerical_field"))


def choice_counts_of_columns(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(field, choice, n) of many columns in one scan and one shuffle."""
    fields = fields or text_columns(df)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), cell_choices(df, f).alias("choices")) for f in fields])
    return (
        df.select(F.inline(cells))
        .select("field", F.explode("choices").alias("choice"))
        .groupBy("field", "choice").agg(F.count(F.lit(1)).alias("n"))
    )


def rounded_share(n: Column, divisor: Column) -> Column:
    return F.rint(n / divisor * DECIMALS) / DECIMALS


def choice_shares(df: DataFrame, field: str, where: dict | None = None, norm: str = "rows") -> DataFrame:
    """(choice, share) sorted by choice.

    ``norm='rows'`` divides by the respondents; ``norm='choices'`` divides by the number of
    distinct choices. The divisor is a scalar subquery, so the plan stays one lazy query.
    """
    counts = choice_counts(df, field, where)
    if norm == "choices":
        divisor = counts.agg(F.count(F.lit(1))).scalar()
    elif norm == "rows":
        divisor = where_equal(df, where).agg(F.count(F.lit(1))).scalar()
    else:
        raise ValueError(f"norm must be rows or choices, not {norm!r}")
    return counts.select("choice", rounded_share(F.col("n"), divisor).alias("share")).orderBy("choice")


def compare_groups(df: DataFrame, field: str, group: str, values: list, norm: str = "rows") -> DataFrame:
    """Shares of each choice in two groups side by side, for choices both groups have.

    Columns: choice, ``<group>_<v1>_perc``, ``<group>_<v0>_perc``, ``<group>_Diff_Vals`` (v1 - v0).
    One scan and one conditional aggregation serve both groups.
    """
    v0, v1 = values
    rows = df.filter(_q(group).isin(v0, v1))
    g = _q(group)
    counts = (
        rows.select(g, F.explode(cell_choices(rows, field)).alias("choice"))
        .groupBy("choice").agg(F.count_if(g == v0).alias("n0"), F.count_if(g == v1).alias("n1"))
    )
    if norm == "choices":
        divisors = counts.agg(F.struct(F.count_if(F.col("n0") > 0).alias("d0"), F.count_if(F.col("n1") > 0).alias("d1")))
    elif norm == "rows":
        divisors = rows.agg(F.struct(F.count_if(g == v0).alias("d0"), F.count_if(g == v1).alias("d1")))
    else:
        raise ValueError(f"norm must be rows or choices, not {norm!r}")
    share0, share1 = [rounded_share(F.col(f"n{i}"), F.col(f"_d.d{i}")) for i in (0, 1)]
    return beside(counts.filter("n0 > 0 and n1 > 0"), "_d", divisors).select(
        "choice",
        share1.alias(f"{group}_{v1}_perc"),
        share0.alias(f"{group}_{v0}_perc"),
        (share1 - share0).alias(f"{group}_Diff_Vals"),
    )


def compare_shares(one: DataFrame, other: DataFrame, name_one: str, name_other: str, value: str = "share") -> DataFrame:
    """Two named distributions on their common choices, with ``Diff_Vals`` (first - second)."""
    return (
        one.select("choice", _q(value).alias(name_one))
        .join(other.select("choice", _q(value).alias(name_other)), "choice")
        .withColumn("Diff_Vals", _q(name_one) - _q(name_other))
    )


def yearly_change(later: DataFrame, earlier: DataFrame, value: str = "share") -> DataFrame:
    """later - earlier for every choice but ``nan``; a choice in one year only gives null."""
    named = [t.filter(F.col("choice") != fixed.MISSING_CHOICE).select("choice", _q(value).alias(v))
             for t, v in [(later, "_later"), (earlier, "_earlier")]]
    return named[0].join(named[1], "choice", "full").select(
        "choice", (F.col("_later") - F.col("_earlier")).alias("PercentageWorkedWith")
    )


# -- equal-width bins --------------------------------------------------------------------------


def bin_midpoints(df: DataFrame, column: str, bins: int, impute: bool = True) -> DataFrame:
    """Adds ``<column>Categorized``: the half-even rounded middle of the value's equal-width bin.

    Edges are rounded to three decimals (three digits below 1, more where edges would
    collide), the lowest is moved down by 0.1 % of the range, and a value on an edge belongs
    to the lower bin. By default values are first rounded and missing ones get the mean.
    """
    rows = impute_rounded(df, [column]) if impute else df
    x = _q(column)
    stats = rows.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    edges = stats.select("lo", "hi", bin_edges("lo", "hi", bins).alias("edges")).select(F.struct("lo", "hi", "edges"))
    lo, hi, edge = F.col("_s.lo"), F.col("_s.hi"), lambda i: F.get("_s.edges", i)
    # The arithmetic guess is off by one bin at most: where rounding moved an edge past the value.
    guess = F.ceil((x - lo) / F.nullif((hi - lo) / bins, F.lit(0.0)))
    g, i = F.col("_guess"), F.col("_bin")
    placed = beside(rows, "_s", edges).withColumn(
        "_guess", F.greatest(F.least(guess, F.lit(bins)), F.lit(1)).cast("int")
    ).withColumn(
        "_bin",
        F.when((g > 1) & (x <= edge(g - 1)), g - 1).when((g < bins) & (x > edge(g)), g + 1).otherwise(g),
    )
    left, right = edge(i - 1), edge(i)
    middle = F.when((x >= left) & (x <= right), F.rint((left + right) / 2)).otherwise(F.rint(x))
    return placed.withColumn(
        f"{column}Categorized", F.when(lo == hi, F.rint(x)).otherwise(middle)
    ).drop("_s", "_guess", "_bin")


def bin_edges(lo: str, hi: str, bins: int) -> Column:
    """The ``bins + 1`` rounded edges, with the fewest decimals (from three) that keep them apart."""
    low, high = F.col(lo), F.col(hi)

    def raw(i: Column) -> Column:
        return F.when(i == 0, low - (high - low) * 0.001).when(i == bins, high).otherwise(low + (high - low) / bins * i)

    def rounded(digits: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: round_edge(raw(i), digits))

    trials = F.transform(F.sequence(F.lit(3), F.lit(19)), rounded)
    apart = F.filter(trials, lambda t: F.size(F.array_distinct(t)) == bins + 1)
    return F.coalesce(F.get(apart, F.lit(0)), F.get(trials, F.lit(0)))


def round_edge(e: Column, digits: Column) -> Column:
    """Rounded half-even to ``digits`` decimals; below 1 to as many significant digits."""
    small = (F.abs(e) < 1) & (e != 0)
    places = F.when(small, digits - 1 - F.floor(F.log10(F.abs(e)))).otherwise(digits)
    scale = F.pow(F.lit(10.0), places)
    return F.when(e == 0, F.lit(0.0)).otherwise(F.rint(e * scale) / scale)


# -- multi-hot ---------------------------------------------------------------------------------


def multi_hot(df: DataFrame, cutoff: float = 0.2, fields: list[str] | None = None) -> DataFrame:
    """Text columns become 0/1 columns ``<field>_<choice>``; rare choices are left out.

    A choice stays when at least ``cutoff`` of the rows have it, which also bounds the number
    of new columns. Blanks are removed from the names; choices that then share a name share
    the column. The counting pass returns kept names only; the columns are projections.
    """
    fields = fields or text_columns(df)
    cells = {f: F.array_distinct(F.split(F.replace(
        F.coalesce(_q(f), F.lit(fixed.MISSING_CHOICE)), F.lit(" "), F.lit("")), fixed.CHOICE_SEPARATOR)) for f in fields}
    n = df.count()
    kept = (
        df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), cells[f].alias("choices")) for f in fields])))
        .select("field", F.explode("choices").alias("choice"))
        .groupBy("field", "choice").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") / n >= cutoff)
        .orderBy("field", "choice").limit(MAX_COLUMNS + 1).collect()
    )
    if len(kept) > MAX_COLUMNS:
        raise ValueError("too many choices for one column each: raise the cutoff")
    dummies = [
        F.array_contains(cells[f], k.choice).cast("int").alias(f"{f}_{k.choice}")
        for f in fields for k in kept if k.field == f
    ]
    return df.select(*[_q(c) for c in df.columns if c not in fields], *dummies)
