"""Census queries: order lines as people, their price as income."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.exprs import log_plus_one
from ..ml import evaluate as Ev
from ..ml.prep import in_train, min_max_scale, standardize
from ..operators import encode as En
from ..operators import grouping as G
from ..operators import profile as P
from ..operators.profile import _q
from .registry import query, rounded
from .stand_ins import CENSUS_SQL, PREDICTIONS_SQL, census, histogram_sql, predictions

CEN = f"WITH {CENSUS_SQL} "
PRED = f"WITH {PREDICTIONS_SQL} "
NUMERIC = fixed.CENSUS_NUMERIC
DIMENSIONS = ["sex", "workclass", "education-num", "hours-per-week"]


@query("A10", CEN + """SELECT count(*) AS n_records, count(*) FILTER (income = '>50K') AS n_greater_50k, count(*) FILTER (income = '<=50K') AS n_at_most_50k,
  round(count(*) FILTER (income = '>50K') * 100 / count(*), 9) AS greater_percent FROM census""")
def income_profile(spark, folder):
    out = G.class_profile(census(spark, folder), "income", fixed.INCOME_HIGH, fixed.INCOME_LOW)
    return rounded(out, "greater_percent", digits=9)


@query("A11", CEN + " UNION ALL ".join(
    f"""SELECT income, '{d}' AS dimension, {f'"{d}"' if d in ("sex", "workclass") else f'printf(chr(37) || chr(46) || chr(49) || chr(102), "{d}")'} AS level, round(avg("capital-gain"), 4) AS mean_value FROM census GROUP BY ALL"""
    for d in DIMENSIONS))
def gain_by_income_and_dimension(spark, folder):
    return rounded(G.mean_by_dimensions(census(spark, folder), "capital-gain", "income", DIMENSIONS), "mean_value", digits=4)


@query("A17", CEN + """, v AS (SELECT "capital-gain" AS x FROM census), """ + histogram_sql("v", 25))
def gain_histogram(spark, folder):
    return rounded(P.histogram(census(spark, folder), "capital-gain", 25), "bin_left", "bin_right", digits=4)


@query("A19", CEN + " UNION ALL ".join(
    f"""SELECT income, '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS r FROM census GROUP BY income"""
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]))
def correlations_by_income(spark, folder):
    return rounded(P.correlations(census(spark, folder), NUMERIC, by="income"), "r")


@query("E11", CEN + 'SELECT id, round(ln("capital-gain" + 1), 6) AS gain, round(ln("capital-loss" + 1), 6) AS loss FROM census')
def logged_amounts(spark, folder):
    return census(spark, folder).select(
        "id", F.round(log_plus_one(_q("capital-gain")), 6).alias("gain"), F.round(log_plus_one(_q("capital-loss")), 6).alias("loss"))


@query("E12", CEN + "SELECT id, income, CASE WHEN income = '>50K' THEN 1 ELSE 0 END AS income_code FROM census")
def income_codes(spark, folder):
    return En.label_encode(census(spark, folder).select("id", "income"), "income", "income_code")


@query("W13", CEN + """SELECT id, (workclass = 'Private')::int AS "workclass_Private", (workclass = 'Self-emp')::int AS "workclass_Self-emp",
  (workclass = 'State-gov')::int AS "workclass_State-gov", (sex = 'Female')::int AS "sex_Female", (sex = 'Male')::int AS "sex_Male" FROM census""")
def one_hot_columns(spark, folder):
    return En.one_hot(census(spark, folder).select("id", "workclass", "sex"))


@query("M2", CEN + "SELECT id, " + ", ".join(
    f'round(("{c}" - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()), 9) AS "{c}"' for c in NUMERIC) + " FROM census")
def min_max_scaled(spark, folder):
    return rounded(min_max_scale(census(spark, folder).select("id", *map(_q, NUMERIC)), NUMERIC), *NUMERIC, digits=9)


@query("M3", CEN + ", s AS (SELECT " + ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in NUMERIC) + " FROM census WHERE id % 100 < 70) SELECT id, id % 100 < 70 AS in_train, " + ", ".join(
    f'round(("{c}" - "m_{c}") / "s_{c}", 6) AS "{c}"' for c in NUMERIC) + " FROM census, s")
def standardized(spark, folder):
    rows = census(spark, folder).select("id", *map(_q, NUMERIC))
    picked = in_train("id", 70, method="plain")
    both = standardize(rows.filter(picked), [rows.filter(~picked)], NUMERIC)
    out = both[0].withColumn("in_train", F.lit(True)).union(both[1].withColumn("in_train", F.lit(False)))
    return rounded(out, *NUMERIC)


@query("M5", CEN + "SELECT id, id % 100 < 80 AS in_train FROM census")
def plain_split(spark, folder):
    return census(spark, folder).select("id", in_train("id", 80, method="plain").alias("in_train"))


@query("M5")
def hash_split(spark, folder):
    return census(spark, folder).select("id", in_train("id", 80, seed=0).alias("in_train"))


# -- scores ------------------------------------------------------------------------------------

_CELLS = """count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn"""


@query("M24", PRED + "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY ALL")
def confusion_counts(spark, folder):
    return Ev.confusion(predictions(spark, folder))


_CLASS_SQL = """, k AS (SELECT unnest([0.0::double, 1.0::double]) AS class), t AS (
  SELECT class, count(*) FILTER (label = class AND prediction = class) AS tp, count(*) FILTER (prediction = class) AS predicted,
         count(*) FILTER (label = class) AS support, avg((label = prediction)::int) AS accuracy FROM k, predictions GROUP BY class),
  m AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r FROM t)
  SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(2 * p * r / (p + r), 9) AS f1,
         round(1.25 * p * r / (0.25 * p + r), 9) AS f05, support, round(accuracy, 9) AS accuracy FROM m"""


@query("M24 M26", PRED + _CLASS_SQL)
def class_metrics(spark, folder):
    return rounded(Ev.class_metrics(predictions(spark, folder)), "precision", "recall", "f1", "f05", "accuracy", digits=9)


_OUTPUTS_SQL = """, o AS (SELECT 'price' AS label_name, label::int AS y, prediction::int AS p FROM predictions
  UNION ALL SELECT 'female', (sex = 'Female')::int, (age > 20)::int FROM census
  UNION ALL SELECT 'never', (workclass = 'Private')::int, 0 FROM census),
  c AS (SELECT label_name, """ + _CELLS + """ FROM o GROUP BY label_name),
  s AS (SELECT label_name, 1 AS class, tp AS hit, tp + fp AS predicted, tp + fn AS support, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM c
        UNION ALL SELECT label_name, 0, tn, tn + fn, tn + fp, (tp + tn) / (tp + fp + fn + tn) FROM c),
  q AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r FROM s),
  report AS (SELECT label_name, class, p AS precision, r AS recall, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1, support, accuracy FROM q)"""


def outputs(spark, folder):
    people = census(spark, folder)
    rows = people.select(
        (_q("income") == fixed.INCOME_HIGH).cast("int").alias("y1"), ((_q("age") > 25) & (_q("education-num") < 6)).cast("int").alias("p1"),
        (_q("sex") == "Female").cast("int").alias("y2"), (_q("age") > 20).cast("int").alias("p2"),
        (_q("workclass") == "Private").cast("int").alias("y3"), F.lit(0).alias("p3"))
    return Ev.long_outputs(rows, {"price": ("y1", "p1"), "female": ("y2", "p2"), "never": ("y3", "p3")})


@query("M25", PRED + _OUTPUTS_SQL + """ SELECT label_name, class, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, support, round(accuracy, 9) AS accuracy FROM report""")
def label_report(spark, folder):
    return rounded(Ev.label_report(outputs(spark, folder)), "precision", "recall", "f1", "accuracy", digits=9)


@query("M25", PRED + _OUTPUTS_SQL + """ SELECT label_name, 'macro' AS average, round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall,
    round(avg(f1), 9) AS f1, sum(support) AS support FROM report GROUP BY label_name
  UNION ALL SELECT label_name, 'weighted', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
    round(sum(f1 * support) / sum(support), 9), sum(support) FROM report GROUP BY label_name""")
def label_report_averages(spark, folder):
    return rounded(Ev.label_averages(outputs(spark, folder)), "precision", "recall", "f1", digits=9)


@query("M25", PRED + _OUTPUTS_SQL + " SELECT round(avg(accuracy), 9) AS average_accuracy, round(avg(f1), 9) AS average_f1 FROM report WHERE class = 1")
def average_label_scores(spark, folder):
    return rounded(Ev.average_scores(outputs(spark, folder)), "average_accuracy", "average_f1", digits=9)


@query("M26", PRED + f", c AS (SELECT {_CELLS} FROM (SELECT label AS y, prediction AS p FROM predictions)), q AS (SELECT *, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM c) " + """
  SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(p, 9) AS precision, round(r, 9) AS recall, round(1.25 * p * r / (0.25 * p + r), 9) AS f_beta FROM q""")
def f_half_score(spark, folder):
    return rounded(Ev.binary_scores(predictions(spark, folder), 0.5), "accuracy", "precision", "recall", "f_beta", digits=9)


@query("M27", PRED + ", q AS (SELECT avg(label) AS p FROM predictions) SELECT round(p, 9) AS accuracy, round(p, 9) AS precision, 1.0::double AS recall, round(1.25 * p / (0.25 * p + 1), 9) AS f_beta FROM q")
def naive_baseline(spark, folder):
    return rounded(Ev.naive_baseline(predictions(spark, folder), "label"), "accuracy", "precision", "f_beta", digits=9)
