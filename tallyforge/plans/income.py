"""Census pipeline: log, scale, one-hot, vector."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.exprs import log_plus_one
from ..ml.prep import min_max_scale
from ..operators.encode import one_hot
from ..operators.profile import _q
from ..schemas import text_columns


def census_features(
    census: DataFrame, key: str, numeric: list[str] = fixed.CENSUS_NUMERIC, skewed: list[str] = fixed.CENSUS_SKEWED,
    income: str = "income", values: dict[str, list[str]] | None = None,
) -> tuple[DataFrame, list[str]]:
    """(key, label, features) and the feature names."""
    logged = census.withColumns({c: log_plus_one(_q(c)) for c in skewed})
    coded = min_max_scale(logged, numeric).withColumn("label", (_q(income) == fixed.INCOME_HIGH).cast("double"))
    texts = [c for c in text_columns(census) if c not in (income, key)]
    wide = one_hot(coded.drop(income), texts, values)
    names = [c for c in wide.columns if c not in (key, "label")]
    plain = wide.select(key, "label", *[_q(c).alias(f"f{i}") for i, c in enumerate(names)])
    vector = VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol="features")
    return vector.transform(plain).select(key, "label", "features"), names
