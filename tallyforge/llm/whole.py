"""Inner products of whole numbers held in doubles, exact at any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

#: Whole numbers up to here are exact in a double.
EXACT = 2.0**53
MOST_DOUBLE = 1.7e308
LEAST, MOST = -(2**63 - 1), 2**63 - 1


def floored(component: Column, scale: int) -> Column:
    """floor(scale * x) as a whole number in a double; what is beyond a double's range is held near its ends."""
    held = F.greatest(F.least(component.cast("double") * scale, F.lit(MOST_DOUBLE)), F.lit(-MOST_DOUBLE))
    # a long where it fits, as FLOOR gives; beyond it every double is whole
    return F.when(F.abs(held) < 2.0**62, F.floor(held).cast("double")).otherwise(held)


def lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths, without overflow in between."""
    top = np.abs(rows).max(1, initial=0.0)
    unit = rows / np.where(top > 0, top, 1.0)[:, None]
    with np.errstate(over="ignore"):
        return top * np.sqrt((unit**2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as longs. Where the product of two rows' lengths, which no partial sum exceeds, is beyond a double's whole numbers,
    it is worked out in whole numbers of any size; results beyond a long are held at its ends."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = a @ b.T
        unsafe = ~(lengths(a)[:, None] * lengths(b)[None, :] < EXACT * (1 - 1e-9))
    out[unsafe] = 0
    out = out.astype(np.int64)
    wide, most = np.flatnonzero(unsafe.any(1)), None
    for i in wide:
        at = np.flatnonzero(unsafe[i])
        left = [int(x) for x in a[i]]
        most = most if most is not None else {}
        for j in at:
            right = most.get(j)
            if right is None:
                right = most[j] = [int(x) for x in b[j]]
            out[i, j] = min(MOST, max(LEAST, sum(x * y for x, y in zip(left, right))))
    return out
