import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge.operators import clean as C
from tallyforge.operators import profile as P
from tallyforge.schemas import CLICKS

MIXED = [(1, "a", 1.0), (2, "", float("nan")), (3, None, None), (4, "b", 2.5)]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(MIXED, "id bigint, t string, x double")


def test_blank_counts(mixed):
    assert rows(P.blank_counts(mixed)) == [("id", 0), ("t", 2), ("x", 2)]


def test_shape_and_missing(mixed):
    assert rows(P.table_shape(mixed)) == [(4, 3, 2, 1)]
    shares = {r.id: r.MissingRows for r in P.with_missing_share(mixed).collect()}
    assert shares == {1: 0.0, 2: 1 / 3, 3: 2 / 3, 4: 0.0}
    assert rows(P.missing_shares(mixed)) == [("id", 0.0), ("t", 0.25), ("x", 0.5)]
    assert rows(P.sparse_columns(mixed, 0.25)) == [("x", 0.5)]  # strictly above
    assert rows(P.sparse_columns_of_sparse_rows(mixed, 0.5, 0.8)) == [("t", 1.0), ("x", 1.0)]
    assert rows(P.complete_row_shape(mixed)) == [(4, 2, 3)]
    assert C.drop_incomplete(mixed).count() == 2


def test_summary_and_exact_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [4, 1, 3, 2]], "x double")
    r = P.summary(df).first()
    assert (r.n, r.mean, r.min, r.q25, r.q50, r.q75, r.max) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert math.isclose(r["std"], math.sqrt(5 / 3))


def jobs_of(spark, work):
    """The result of some work and the number of Spark jobs it ran."""
    group = f"jobs-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


HARD = [
    [0.0, -0.0, 1e-310, -1e-310, 5e-324, 1.7e308, -1.7e308, 1.0, 1.0000000000000002, 0.9999999999999999],
    [float("inf"), float("-inf"), 2.0, 2.0, 3.0], [10.0 ** e for e in range(-300, 300, 7)], [-(1.5 ** e) for e in range(-200, 200, 3)],
    [7.0] * 50, [1.0], [math.sin(i) * 1000 for i in range(700)],
]


def test_values_at_all_ranks_of_hard_columns(spark):
    longest = max(map(len, HARD))
    data = [tuple(c[i] if i < len(c) else (None if i % 2 else float("nan")) for c in HARD) for i in range(longest)]
    names = [f"c {i}" for i in range(len(HARD))]
    df = spark.createDataFrame(data, ", ".join(f"`{n}` double" for n in names)).repartition(3)
    found, sizes = P.values_at_ranks(df, names, lambda n: list(range(0, n, max(1, n // 20))))
    for name, column in zip(names, HARD):
        assert sizes[name] == len(column)
        assert found[name] == {r: sorted(column)[r] for r in range(0, len(column), max(1, len(column) // 20))}


def test_rounds_do_not_depend_on_columns_and_ranks(spark):
    df = spark.range(5000).select(*[(F.sin(F.col("id") + i) * 10 ** (i % 3)).alias(f"x{i}") for i in range(12)])
    one = jobs_of(spark, lambda: P.values_at_ranks(df, ["x1"], lambda n: [n // 2]))[1]
    many = jobs_of(spark, lambda: P.values_at_ranks(df, [f"x{i}" for i in range(12)], lambda n: [n // 4, n // 2, n // 2 + 1, n - 1]))[1]
    assert one <= 2 * 9 and many <= 2 * 9  # at most nine rounds, each a shuffle and its result


def test_quartiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert rows(P.summary(df).select("column_name", "n", "q25", "q50", "q75")) == [("a", 0, None, None, None), ("b", 2, 1.25, 1.5, 1.75)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 4, 5, 9, 10]] + [(None,)], "x double")
    assert [r.n for r in P.histogram(df, "x", 2).orderBy("bin").collect()] == [3, 3]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    got = P.histogram(flat, "x", 4).orderBy("bin").collect()
    assert (got[0].bin_left, got[-1].bin_right, sum(r.n for r in got)) == (2.5, 3.5, 2)


def test_histogram_by_class_has_own_ranges(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 10.0), (1, 100.0), (1, 200.0)], "c int, x double")
    got = P.histogram(df, "x", 2, by="c", classes=[0, 1]).orderBy("c", "bin").collect()
    assert [(r.c, r.bin, r.bin_left, r.n) for r in got] == [(0, 1, 0.0, 1), (0, 2, 5.0, 1), (1, 1, 100.0, 1), (1, 2, 150.0, 1)]


def test_correlation_skips_missing_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0)], "a double, b double, k double")
    got = {(r.a, r.b): r.r for r in P.correlations(df).collect()}
    xs, ys = [1, 2, 4], [2, 4, 9]
    mx, my = sum(xs) / 3, sum(ys) / 3
    expected = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert math.isclose(got["a", "b"], expected)
    assert got["a", "k"] is None


def test_first_per_key_takes_lowest_id_of_many_copies(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("message"), F.lit("g").alias("genre"))
    got = C.first_per_key(df.repartition(8), "message", ["id"])
    assert got.count() == 2001
    assert got.filter("message = 'hot'").first().id == 1
    assert got.columns == ["id", "message", "genre"]


def test_imputation(spark):
    df = spark.createDataFrame([("0.5",), ("1.5",), ("2.5",), ("x",), (None,), ("inf",)], "x string")
    assert [r.x for r in C.impute_rounded(df, ["x"]).collect()] == [0.0, 2.0, 2.0, 2.0, 2.0, 2.0]  # mean 1.5, half-even
    filled = C.fill_means(spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double"))
    assert [r.x for r in filled.collect()] == [1.0, 2.0, 2.0, 3.0]


def test_empty_and_text_columns(spark):
    df = spark.createDataFrame([(1, "a", None, float("nan")), (2, None, None, float("nan"))], "id int, t string, u string, v double")
    assert C.drop_empty_columns(df).columns == ["id", "t"]
    assert C.drop_text_columns(df).columns == ["id", "v"]


def test_numeric_text_rows_and_first_rows(spark):
    df = spark.createDataFrame([("7",), ("many",), ("3",), (None,), ("NaN",)], "x string")
    assert rows(C.numeric_text_rows(df, "x")) == [(3.0,), (7.0,)]
    assert rows(C.first_rows(spark.range(10), 3, ["id"])) == [(0,), (1,), (2,)]


def test_sample_is_seeded(spark):
    df = spark.range(10000)
    assert rows(C.sample_rows(df, 0.01)) == rows(C.sample_rows(df, 0.01))


def click(**kw):
    base = dict.fromkeys(CLICKS.names)
    base |= dict(userId="1", sessionId=1, itemInSession=0, page="NextSong", ts=1538352000000, registration=1538000000000,
                 userAgent="Mozilla/5.0 (X11)", location="Austin, TX", gender="F", level="free", auth="Logged In", length=10.0)
    return tuple((base | kw)[c] for c in CLICKS.names)


def test_clean_clicks(spark):
    raw = spark.createDataFrame([click(), click(), click(userId=""), click(userId="2", userAgent="curl", location="Nowhere", length=None, artist=None)], CLICKS)
    got = {r.userId: r for r in C.clean_clicks(raw).collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].userDevice, got[1].location, got[1].hour, got[1].weekDay) == ("Linux", " TX", 0, 2)
    assert (got[2].userDevice, got[2].location, got[2].length, got[2].artist) == (None, None, 0.0, "unknown")
    assert C.songs_without_length(raw).count() == 1


def test_rename_is_by_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = C.drop_and_rename(df, ["a"], {"c": "z", "b": "y"})
    assert out.columns == ["y", "z"] and tuple(out.first()) == (2, 3)
