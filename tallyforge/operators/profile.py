"""Profiles: missing values, summaries, histograms and correlations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..schemas import numeric_columns, text_columns


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def unpivoted(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str, kind: str) -> DataFrame:
    """(ids, name, value) rows, one for each listed column, all values cast to one type."""
    return df.select(*[_q(c) for c in ids], *[_q(c).cast(kind).alias(f"_v_{c}") for c in columns]).unpivot(
        [_q(c) for c in ids], [_q(f"_v_{c}") for c in columns], name, value
    ).withColumn(name, F.substring(_q(name), F.lit(4), F.length(_q(name))))


def beside(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Adds the single value of a one-row table as a column: a scalar subquery that runs once.

    Kept as a column, the subquery appears once in the plan however often it is used.
    """
    return df.withColumn(name, one_row.scalar())


def missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in floating columns."""
    c = _q(name)
    return c.isNull() | F.isnan(c) if _is_float(df, name) else c.isNull()


def blank(df: DataFrame, name: str) -> Column:
    """``missing`` or the empty text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return _q(name).isNull() | (F.length(_q(name)) == 0)
    return missing(df, name)


def blank_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_blank) for every column, in one pass."""
    wide = df.agg(*[F.count_if(blank(df, c)).alias(c) for c in df.columns])
    return unpivoted(wide, [], df.columns, "column_name", "n_blank", "bigint")


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, numeric and categorical columns."""
    n_numeric = len(numeric_columns(df))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(n_numeric).cast("bigint").alias("n_numeric"),
        F.lit(len(df.columns) - n_numeric).cast("bigint").alias("n_categorical"),
    )


def with_missing_share(df: DataFrame, columns: list[str] | None = None, out: str = "MissingRows") -> DataFrame:
    """Adds the share of ``columns`` that are missing in each row."""
    columns = columns or df.columns
    total = sum((missing(df, c).cast("int") for c in columns), F.lit(0))
    return df.withColumn(out, total / len(columns))


def missing_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(OutlierLabels, OutlierValues): missing share of each column, in one pass."""
    columns = columns or df.columns
    wide = df.agg(*[F.avg(missing(df, c).cast("int")).alias(c) for c in columns])
    return unpivoted(wide, [], columns, "OutlierLabels", "OutlierValues", "double")


def sparse_columns(df: DataFrame, above: float = 0.15, columns: list[str] | None = None) -> DataFrame:
    """Columns whose missing share is strictly above the limit."""
    return missing_shares(df, columns).filter(F.col("OutlierValues") > above)


def sparse_columns_of_sparse_rows(
    df: DataFrame, row_above: float = 0.5, above: float = 0.8, columns: list[str] | None = None
) -> DataFrame:
    """``sparse_columns`` among the rows that miss more than ``row_above`` of their cells."""
    columns = columns or df.columns
    rows = with_missing_share(df, columns, "_share").filter(F.col("_share") > row_above)
    return sparse_columns(rows.drop("_share"), above, columns)


def complete_row_shape(df: DataFrame) -> DataFrame:
    """Row and column counts before and after dropping incomplete rows, in one pass."""
    incomplete = F.lit(False)
    for c in df.columns:
        incomplete = incomplete | missing(df, c)
    width = F.lit(len(df.columns)).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(~incomplete).alias("rows_after")
    ).select("rows_before", "rows_after", width.alias("n_columns"))


# -- summaries ---------------------------------------------------------------------------------


def summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of each numeric column, long form."""
    columns = columns or numeric_columns(df)
    values = df.select([F.when(~missing(df, c), _q(c).cast("double")).alias(c) for c in columns])
    quartiles = exact_quantiles(values, columns, [0.25, 0.5, 0.75])
    stats = []
    for c in columns:
        x = _q(c)
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(x).alias("n"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            *[q.alias(name) for q, name in zip(quartiles[c], ["q25", "q50", "q75"])],
            F.max(x).alias("max"),
        ))
    return values.agg(F.array(*stats).alias("rows")).select(F.inline("rows"))


def text_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, lowest and highest value of each text column, long form, in one pass."""
    stats = [
        F.struct(F.lit(c).alias("column_name"), F.count(_q(c)).alias("n"), F.min(_q(c)).alias("min"), F.max(_q(c)).alias("max"))
        for c in columns or text_columns(df)
    ]
    return df.agg(F.array(*stats).alias("rows")).select(F.inline("rows"))


#: Parts into which a round cuts the values among which a wanted rank lies.
PARTS = 256


def _magnitude(x: Column) -> Column:
    """A whole number that grows with x: its sign and power of two. Logarithms never fall where x grows, so no order is lost."""
    power = F.least(F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-1100)), F.lit(1100)).cast("int") + 1200
    return F.when(x == 0, 0).when(x > 0, power).otherwise(-power)


def _counted(df: DataFrame, cells: dict[str, Column]) -> list[tuple]:
    """(column number, part, n, least, greatest) of all columns' parts, in one aggregate; a null part is not counted."""
    each = [F.struct(F.lit(i).alias("i"), part.alias("part"), _q(c).cast("double").alias("x")) for i, (c, part) in enumerate(cells.items())]
    long = df.select(F.explode(F.array(*each)).alias("cell")).select("cell.*").filter(F.col("part").isNotNull())
    return sorted(tuple(r) for r in long.groupBy("i", "part").agg(F.count("*"), F.min("x"), F.max("x")).collect())


def values_at_ranks(df: DataFrame, columns: list[str], ranks) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """The values at 0-based ranks among each column's values, nulls and NaN left out, and each column's number of values. ``ranks``
    gives the wanted ranks from that number.

    The values are counted by sign and power of two; then each part that holds a wanted rank is cut into ``PARTS`` even ones between its
    least and its greatest value and counted again, until it holds one value, however often. Each round is one aggregate for all columns
    and ranks, so the columns are read about nine times at most, fewer where values are whole or repeat. What is
    collected is a count a part: columns times ranks times ``PARTS`` rows.
    """
    values = df.select(*[_q(c).cast("double").alias(c) for c in columns]).persist(StorageLevel.MEMORY_AND_DISK)  # read once a round
    try:
        return _values_at_ranks(values, columns, ranks)
    finally:
        values.unpersist()


def _values_at_ranks(values: DataFrame, columns: list[str], ranks) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    known = lambda c: _q(c).isNotNull() & ~F.isnan(_q(c))
    counted = _counted(values, {c: F.when(known(c), _magnitude(_q(c))) for c in columns})
    out: dict[str, dict[int, float]] = {c: {} for c in columns}
    sizes: dict[str, int] = {}
    open_parts: dict[str, dict[tuple[float, float], list[tuple[int, int]]]] = {}

    def settle(c: str, rows: list[tuple], wanted: list[tuple[int, int]]) -> None:
        """Ranks (in the column, among these rows) to values, or to the part they lie in."""
        ends = []
        for row in rows:
            ends.append((ends[-1] if ends else 0) + row[2])
        for rank, among in wanted:
            at = next(j for j, end in enumerate(ends) if among < end)
            _, _, n, low, high = rows[at]
            if low == high:
                out[c][rank] = low
            else:
                open_parts.setdefault(c, {}).setdefault((low, high), []).append((rank, among - (ends[at] - n)))

    for i, c in enumerate(columns):
        rows = [r for r in counted if r[0] == i]
        sizes[c] = sum(r[2] for r in rows)
        settle(c, rows, [(r, r) for r in ranks(sizes[c])] if rows else [])
    while open_parts:
        before, open_parts = open_parts, {}
        cells = {}
        for c, parts in before.items():
            cell = F.lit(None).cast("int")
            for j, (low, high) in enumerate(parts):
                # half of each difference, as that of the largest doubles is beyond them; every step grows with x
                share = (_q(c) / 2 - low / 2) / (high / 2 - low / 2)
                cell = F.when(_q(c).between(low, high), j * PARTS + F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")).otherwise(cell)
            cells[c] = cell
        counted = _counted(values, cells)
        for i, (c, parts) in enumerate(before.items()):
            for j, wanted in enumerate(parts.values()):
                settle(c, [r for r in counted if r[0] == i and r[1] // PARTS == j], wanted)
    return out, sizes


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[Column]]:
    """Exact linear-interpolated quantiles of all columns as constants, null for columns without values; see ``values_at_ranks``."""
    def ranks(n: int) -> list[int]:
        return sorted({r for p in probs for r in (int(p * (n - 1)), min(n - 1, int(p * (n - 1)) + 1))})

    found, sizes = values_at_ranks(df, columns, ranks)
    out: dict[str, list[Column]] = {}
    for c in columns:
        n, out[c] = sizes[c], []
        for p in probs:
            if not n:
                out[c].append(F.lit(None).cast("double"))
                continue
            position = p * (n - 1)
            a, b = found[c][int(position)], found[c][min(n - 1, int(position) + 1)]
            out[c].append(F.lit(a if a == b else a + (b - a) * (position - int(position))))
    return out


# -- histograms --------------------------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int = 10, by: str | None = None, classes: list | None = None) -> DataFrame:
    """``histograms`` of one column, without the column's name."""
    return histograms(df, [column], bins, by, classes).drop("column_name")


def histograms(
    df: DataFrame, columns: list[str] | None = None, bins: int = 10, by: str | None = None, classes: list | None = None
) -> DataFrame:
    """(column_name, bin, bin_left, bin_right, n) over equal-width bins, the last one closed; empty bins count 0.

    With ``by`` each listed class gets its own ranges. All ranges come from one aggregate and
    all counts from a second pass, in which only (column, class, bin) counts are shuffled
    however many columns there are.
    """
    columns = columns or [c for c in numeric_columns(df) if c != by]
    rows, key, classes = (df, by, classes) if by else (df.withColumn("_all", F.lit(0)), "_all", [0])
    kind = rows.schema[key].dataType.simpleString()
    values = {c: F.when(~missing(df, c), _q(c).cast("double")) for c in columns}
    ranges = [(c, k, F.when(_q(key) == k, x)) for c, x in values.items() for k in classes]
    edges = rows.agg(*[
        F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias(f"r{i}") for i, (_, _, x) in enumerate(ranges)
    ]).select(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(k).cast(kind).alias("class"),
            (F.col(f"r{i}.lo") - half_unit(f"r{i}")).alias("lo"), (F.col(f"r{i}.hi") + half_unit(f"r{i}")).alias("hi"),
        ) for i, (c, k, _) in enumerate(ranges)
    ]).alias("edges"))
    frame = edges.select(F.inline("edges")).filter("lo is not null").select(
        "column_name", F.col("class").alias("_class"), "lo", "hi",
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
    )
    cells = unpivoted(
        rows.filter(_q(key).isin(classes)).select(_q(key).alias("_class"), *[values[c].alias(c) for c in columns]),
        ["_class"], columns, "column_name", "_x", "double",
    )
    # The ranges travel as one map value; a row picks its own by column and class.
    ranges_map = edges.select(F.map_from_entries(F.transform("edges", lambda e: F.struct(
        F.concat_ws("|", e["column_name"], e["class"].cast("string")), F.struct(e["lo"], e["hi"])))).alias("m"))
    own = F.element_at("_ranges", F.concat_ws("|", "column_name", F.col("_class").cast("string")))
    edge = F.col("_own")
    counts = (
        beside(cells.filter("_x is not null"), "_ranges", ranges_map).withColumn("_own", own)
        .select("column_name", "_class", bin_number(F.col("_x"), edge, bins).alias("bin"))
        .groupBy("column_name", "_class", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    out = frame.join(counts, ["column_name", "_class", "bin"], "left").select(
        "column_name", F.col("_class").alias(key), "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_left"),
        (F.col("lo") + width * F.col("bin")).alias("bin_right"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
    return out.drop("_all")


def bin_number(x: Column, edge: Column, bins: int) -> Column:
    """1-based bin with left <= x < right by the same edges that are reported; the last bin is closed."""
    lo, width = edge["lo"], (edge["hi"] - edge["lo"]) / bins
    guess = F.least(F.floor((x - lo) / (edge["hi"] - lo) * bins), F.lit(bins - 1))
    moved = F.when(x < lo + width * guess, guess - 1).when((x >= lo + width * (guess + 1)) & (guess < bins - 1), guess + 1)
    return F.when(x.isNotNull(), F.coalesce(moved, guess) + 1).cast("int")


def half_unit(field: str) -> Column:
    """A constant column gets a range of one around its value."""
    return F.when(F.col(f"{field}.lo") == F.col(f"{field}.hi"), 0.5).otherwise(0.0)


# -- correlation -------------------------------------------------------------------------------


def pearson(a: Column, b: Column) -> Column:
    """Correlation as an aggregate; ``corr`` itself fails on a constant column in ANSI mode."""
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


#: A spread below this share of the mean square counts as none: it is what rounding leaves of a constant.
NO_SPREAD = 1e-13
#: Numbers that a task holds as sums of pairs before it hands them on.
PAIR_SUMS = 1 << 23


def correlations(df: DataFrame, columns: list[str] | None = None, by: str | None = None) -> DataFrame:
    """(a, b, r) for a <= b in column order, each pair over its own complete rows; null without spread.

    A row stays one row up to the aggregate: a task multiplies batches of rows at a time, values beside masks of what is there, and
    hands on five sums a pair and group. Values are taken from their column's mean, read once before, so little is lost where means
    are large. Groups (``by``) may be many: a task hands its sums on whenever they reach a fixed size.
    """
    columns = columns or [c for c in numeric_columns(df) if c != by]
    d, clean = len(columns), {c: F.when(~missing(df, c), _q(c).cast("double")) for c in columns}
    kind = df.schema[by].dataType if by else T.IntegerType()
    means = df.agg(F.struct(*[F.coalesce(F.avg(clean[c]), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(columns)]))
    rows = beside(df, "_means", means).select(
        (_q(by) if by else F.lit(0)).alias("by"), *[(clean[c] - F.col("_means")[f"m{i}"]).alias(f"x{i}") for i, c in enumerate(columns)])
    first, second = np.triu_indices(d)

    def sums(batches):
        held = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            code, groups = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            x = np.stack([batch.column(i + 1).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(d)], 1)
            order = np.argsort(code, kind="stable")
            for group, part in zip(groups, np.split(order, np.cumsum(np.bincount(code, minlength=len(groups)))[:-1])):
                there = ~np.isnan(x[part])
                v, there = np.where(there, x[part], 0.0), there.astype(float)
                one, squares = v.T @ there, (v * v).T @ there
                found = np.stack([(there.T @ there)[first, second], one[first, second], one[second, first],
                                  squares[first, second], squares[second, first], (v.T @ v)[first, second]])
                held[group] = held[group] + found if group in held else found
                if len(held) * found.size > PAIR_SUMS:
                    yield from handed_on(held)
                    held = {}
        yield from handed_on(held)

    def handed_on(held):
        for group, found in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([group] * len(first), to_arrow_type(kind)), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), *map(pa.array, found)],
                names=["by", "i", "j", "n", "x", "y", "xx", "yy", "xy"])

    fields = [T.StructField("by", kind), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())]
    numbers = ["n", "x", "y", "xx", "yy", "xy"]
    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in numbers])
    total = rows.mapInArrow(sums, schema).groupBy("by", "i", "j").agg(*[F.sum(c).alias(c) for c in numbers])

    def spread(one: str, square: str) -> Column:
        left = F.col(square) - F.try_divide(F.col(one) * F.col(one), F.col("n"))
        return F.when(left > F.col(square) * NO_SPREAD, left)

    r = F.try_divide(F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n")), F.sqrt(spread("x", "xx")) * F.sqrt(spread("y", "yy")))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(*([F.col("by").alias(by)] if by else []), F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))
