"""Evaluation from (label, prediction) rows: everything rests on one small count table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.profile import _q
from ..workspace import keep


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return predictions.groupBy(_q(label).alias("label"), _q(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def f_beta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    b = beta * beta
    return ratio((1 + b) * precision * recall, b * precision + recall)


def class_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction", betas=(1.0, 0.5)) -> DataFrame:
    """(class, precision, recall, f1, f05, support) of each class, and accuracy on every row."""
    cells = confusion(predictions, label, prediction)
    n = cells.agg(F.sum("n")).scalar()
    hits = cells.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))).scalar()
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")),
    )))
    totals = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    precision, recall = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    return totals.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        f_beta(precision, recall, betas[0]).alias("f1"), f_beta(precision, recall, betas[1]).alias("f05"),
        "support", (hits / n).alias("accuracy"),
    )


def binary_cells(y: Column, p: Column, weight: Column | None = None) -> dict[str, Column]:
    def count(cell: Column) -> Column:
        return F.count_if(cell) if weight is None else F.coalesce(F.sum(F.when(cell, weight)), F.lit(0))

    return {
        "tp": count((y == 1) & (p == 1)), "fp": count((y == 0) & (p == 1)),
        "fn": count((y == 1) & (p == 0)), "tn": count((y == 0) & (p == 0)),
    }


def binary_scores(df: DataFrame, beta: float = 0.5, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """One row: accuracy, precision, recall and F-beta of class 1; a row counts ``weight`` times."""
    cells = df.agg(*[c.alias(n) for n, c in binary_cells(_q(label), _q(prediction), _q(weight) if weight else None).items()])
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return cells.select(
        ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), f_beta(precision, recall, beta).alias("f_beta"),
    )


def long_outputs(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """(label_name, y, p) from one (label column, prediction column) pair a label."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("label_name"), _q(y).cast("int").alias("y"), _q(p).cast("int").alias("p"))
        for name, (y, p) in pairs.items()
    ])))


def label_report(outputs: DataFrame) -> DataFrame:
    """(label_name, class, precision, recall, f1, support, accuracy) from (label_name, y, p), one aggregate."""
    cells = outputs.groupBy("label_name").agg(*[c.alias(n) for n, c in binary_cells(F.col("y"), F.col("p")).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def side(cls: int, hit: Column, predicted: Column, support: Column) -> Column:
        precision, recall = ratio(hit, predicted), ratio(hit, support)
        return F.struct(
            F.lit(cls).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f_beta(precision, recall).alias("f1"), support.alias("support"),
        )

    return cells.select(
        "label_name", ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        F.inline(F.array(side(0, tn, tn + fn, tn + fp), side(1, tp, tp + fp, tp + fn))),
    )


def label_averages(outputs: DataFrame) -> DataFrame:
    """(label_name, average, precision, recall, f1, support): per label the mean of its two classes, plain and by support."""
    report, names = label_report(outputs), ("precision", "recall", "f1")
    support = F.sum("support")
    plain = [F.avg(c).alias(c) for c in names]
    weighted = [(F.sum(F.col(c) * F.col("support")) / support).alias(c) for c in names]
    return report.groupBy("label_name").agg(
        support.alias("support"), F.struct(F.lit("macro").alias("average"), *plain).alias("a"),
        F.struct(F.lit("weighted").alias("average"), *weighted).alias("b"),
    ).select("label_name", F.inline(F.array("a", "b")), "support")


def average_scores(outputs: DataFrame) -> DataFrame:
    """One row: mean over labels of accuracy and of class-1 F1."""
    return label_report(outputs).filter(F.col("class") == 1).agg(
        F.avg("accuracy").alias("average_accuracy"), F.avg("f1").alias("average_f1")
    )


def naive_baseline(df: DataFrame, label: str, beta: float = 0.5) -> DataFrame:
    """One row: scores of predicting class 1 for everything."""
    counts = df.agg(F.count_if(_q(label) == 1).alias("tp"), F.count_if(_q(label) == 0).alias("fp"))
    share, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp"))
    return counts.select(
        share.alias("accuracy"), share.alias("precision"), recall.alias("recall"),
        f_beta(share, recall, beta).alias("f_beta"),
    )


def area_under_pr(predictions: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Area under precision over recall by the score of class 1, exact: no bins, and equal scores are one step."""
    rows = predictions.select(_q(label).cast("int").alias("y"), vector_to_array(_q(raw))[1].alias("score"))
    return precision_recall_area(rows, "y", "score").first()[0]


def precision_recall_area(df: DataFrame, label: str, score: Column | str) -> DataFrame:
    """One row, area: between the points of all different scores, highest first, by trapezoids; the first step is level.

    Rows are counted by score, scores sorted by range, and a range's running sums go on from the sums of those before it (a number a
    range, all that the driver holds). Rows without label or score are left out; null without rows of class 1.
    """
    by = _q(score) if isinstance(score, str) else score
    known = df.select(_q(label).cast("int").alias("y"), by.cast("double").alias("s")).filter("y IS NOT NULL AND s IS NOT NULL")
    steps = known.groupBy("s").agg(F.sum("y").alias("hits"), F.count(F.lit(1)).alias("n"))
    ranges = keep(steps.repartitionByRange(F.desc("s")).select("*", F.spark_partition_id().alias("slot")), "score-ranges")
    before, sums = {}, (0, 0)
    for slot, hits, n in sorted(tuple(r) for r in ranges.groupBy("slot").agg(F.sum("hits"), F.sum("n")).collect()):
        before[slot], sums = sums, (sums[0] + hits, sums[1] + n)
    at = lambda i: F.create_map(*[F.lit(x) for k, v in (before or {0: (0, 0)}).items() for x in (k, v[i])])[F.col("slot")]
    order = Window.partitionBy("slot").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    points = ranges.select("hits", "n", (at(0) + F.sum("hits").over(order)).alias("tp"), (at(1) + F.sum("n").over(order)).alias("all"))
    precision = F.col("tp") / F.col("all")
    earlier = F.when(F.col("all") > F.col("n"), (F.col("tp") - F.col("hits")) / F.nullif(F.col("all") - F.col("n"), F.lit(0))).otherwise(precision)
    return points.agg(F.sum(F.col("hits") * (precision + earlier) / 2).alias("area")).select(
        (F.col("area") / F.nullif(F.lit(sums[0]), F.lit(0))).alias("area"))


def importances(spark, model, names: list[str], top: int = 5) -> DataFrame:
    """(rank, feature, importance, cumulative) of the ``top`` features of a fitted tree model."""
    values = [(name, float(v)) for name, v in zip(names, model.featureImportances.toArray())]
    rows = spark.createDataFrame(values, "feature string, importance double")
    best = rows.orderBy(F.desc("importance"), "feature").limit(top)
    # At most ``top`` rows are left, so one ordered window is fine.
    order = Window.orderBy(F.desc("importance"), "feature")
    return best.select(
        F.row_number().over(order).alias("rank"), "feature", "importance", F.sum("importance").over(order).alias("cumulative")
    )
