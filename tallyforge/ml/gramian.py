"""Least squares from one pass: moments of all columns, and every subset solved from its part of them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.profile import _q

#: A column is left out of a fit when the columns before it explain all but this share of its variance.
COLLINEAR = 1e-10


class Moments(NamedTuple):
    """Of the rows of one part: their number, means, and sums of products of differences from the means, the last column being the response."""
    n: int
    means: np.ndarray
    products: np.ndarray


class LinearFit(NamedTuple):
    """``coefficients`` of ``columns``, in their order; a column that others explain has 0."""
    columns: list[str]
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, b in zip(self.columns, self.coefficients):
            out = out + _q(c) * float(b)
        return out


def moments(parts: list[DataFrame], columns: list[str]) -> list[Moments]:
    """The moments of each part, from one aggregate over all of them. Rows with a null or NaN in any of the columns are left out.

    A task multiplies a batch of rows at a time and hands on one row of numbers for each part; these are summed by place, combined
    before the shuffle. Values are taken from near the middle of a few rows, so that little is lost where means are large.
    """
    whole = lambda df: df.select(*[_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    few = [r for df in parts for r in whole(df).dropna().limit(100).collect()]
    shift = np.array([[x for x in r] for r in few]).reshape(-1, len(columns)).mean(0) if few else np.zeros(len(columns))
    shift = np.where(np.isfinite(shift), shift, 0.0)
    d, upper = len(columns), np.triu_indices(len(columns))

    def sums(batches):
        total = {}
        for batch in batches:
            of = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(d)], 1)
            usable = np.isfinite(x).all(1)
            for part in np.unique(of):
                rows = x[(of == part) & usable] - shift
                found = np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows)[upper]])
                total[part] = total.get(part, 0) + found
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([list(v) for v in total.values()], pa.list_(pa.float64()))],
                                             names=["part", "sums"])

    rows = None
    for i, df in enumerate(parts):
        one = whole(df).select(F.lit(i).alias("part"), "*")
        rows = one if rows is None else rows.unionByName(one)
    partial = rows.mapInArrow(sums, "part int, sums array<double>")
    places = partial.select("part", F.posexplode("sums").alias("at", "v")).groupBy("part", "at").agg(F.sum("v").alias("v"))
    found = np.zeros((len(parts), 1 + d + len(upper[0])))
    for part, at, v in places.collect():  # the square of the number of columns, whatever the rows
        found[part, at] = v
    out = []
    for line in found:
        n, mean = int(line[0]), line[1:1 + d] / max(1, line[0])
        square = np.zeros((d, d))
        square[upper] = line[1 + d:]
        square = square + np.triu(square, 1).T - n * np.outer(mean, mean)
        out.append(Moments(n, mean + shift, square))
    return out


def swept(products: np.ndarray, pivots: list[int]) -> tuple[np.ndarray, list[int]]:
    """The matrix swept on the pivots in turn, but for those that the earlier ones explain; and the pivots taken."""
    a, taken = products.copy(), []
    for k in pivots:
        if a[k, k] <= COLLINEAR * products[k, k] or products[k, k] <= 0:
            continue
        row = a[k] / a[k, k]
        column = a[:, k].copy()
        inverse = 1 / a[k, k]
        a = a - np.outer(column, row)
        a[k], a[:, k] = row, -column * inverse
        a[k, k] = inverse
        taken.append(k)
    return a, taken


def solve(m: Moments, columns: list[str], kept: list[str]) -> LinearFit:
    """The least-squares fit of the response (the last column of the moments) on some of the columns."""
    places = [columns.index(c) for c in kept]
    a, taken = swept(m.products, places)
    b = np.array([a[k, -1] if k in taken else 0.0 for k in places])
    return LinearFit(list(kept), b, float(m.means[-1] - m.means[places] @ b))


def r2(m: Moments, columns: list[str], fit: LinearFit) -> float:
    """Share of the response's variance in a part that a fit explains, by the part's moments; NaN where it has none."""
    places = [columns.index(c) for c in fit.columns]
    b = fit.coefficients
    off = m.means[-1] - fit.intercept - m.means[places] @ b
    rest = m.products[-1, -1] - 2 * b @ m.products[places, -1] + b @ m.products[np.ix_(places, places)] @ b + m.n * off**2
    return float(1 - rest / m.products[-1, -1]) if m.products[-1, -1] > 0 else float("nan")
