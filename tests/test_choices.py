import math

import pytest
from conftest import rows

from tallyforge.operators import choices as Ch
from tallyforge.operators import grouping as G
from tallyforge.operators.encode import label_encode, one_hot, one_hot_vector

SURVEY = [(1, "Python;SQL", "Man"), (2, "SQL;SQL", "Man"), (3, None, "Woman"), (4, "Python", "Woman"), (5, "C; C", None)]


@pytest.fixture(scope="module")
def survey(spark):
    return spark.createDataFrame(SURVEY, "id int, lang string, gender string")


def test_counts(survey):
    assert rows(Ch.choice_counts(survey, "lang")) == [(" C", 1), ("C", 1), ("Python", 2), ("SQL", 3), ("nan", 1)]
    assert rows(Ch.choice_counts(survey, "lang", {"gender": "Man"})) == [("Python", 1), ("SQL", 3)]
    assert rows(Ch.choice_counts(survey, "lang", {})) == rows(Ch.choice_counts(survey, "lang"))


def test_numeric_fields_count_as_choices(spark):
    df = spark.createDataFrame([(20.0,), (20.0,), (2.5,), (None,), (float("nan"),)], "x double")
    counts = Ch.choice_counts(df, "x")
    assert rows(counts) == [("2.5", 1), ("20", 2), ("nan", 2)]
    assert Ch.has_number_choice(counts).first()[0] is True


def test_number_flag_ignores_nan_and_infinity(spark):
    df = spark.createDataFrame([("inf",), (None,), ("a",)], "x string")
    assert Ch.has_number_choice(Ch.choice_counts(df, "x")).first()[0] is False


def test_shares_by_choices_and_by_rows(survey):
    assert rows(Ch.choice_shares(survey, "lang", norm="choices")) == [(" C", 0.2), ("C", 0.2), ("Python", 0.4), ("SQL", 0.6), ("nan", 0.2)]
    assert rows(Ch.choice_shares(survey, "lang", {"gender": "Man"})) == [("Python", 0.5), ("SQL", 1.5)]
    with pytest.raises(ValueError):
        Ch.choice_shares(survey, "lang", norm="other")


def test_shares_round_half_even(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 1997, "x string")
    assert rows(Ch.choice_shares(df, "x")) == [("a", 0.002), ("b", 0.998)]  # 0.0015 -> 0.002, 0.9985 -> 0.998


def test_many_columns_at_once(survey):
    both = Ch.choice_counts_of_columns(survey, ["lang", "gender"])
    assert rows(both.filter("field = 'gender'").drop("field")) == [("Man", 2), ("Woman", 2), ("nan", 1)]


def test_compare_groups_keeps_common_choices(survey):
    got = Ch.compare_groups(survey, "lang", "gender", ["Man", "Woman"], norm="choices")
    assert got.columns == ["choice", "gender_Woman_perc", "gender_Man_perc", "gender_Diff_Vals"]
    assert rows(got) == [("Python", 0.5, 0.5, 0.0)]


def test_two_years(spark):
    a = spark.createDataFrame([("x", 0.5), ("y", 0.2), ("nan", 0.1)], "choice string, share double")
    b = spark.createDataFrame([("x", 0.25), ("z", 0.3), ("nan", 0.4)], "choice string, share double")
    assert rows(Ch.yearly_change(a, b)) == [("x", 0.25), ("y", None), ("z", None)]
    assert rows(Ch.compare_shares(a, b, "a", "b").filter("choice = 'x'")) == [("x", 0.5, 0.25, 0.25)]


def bins(spark, values, n, impute=False):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r.xCategorized for r in Ch.bin_midpoints(df, "x", n, impute).orderBy("i").collect()]


def test_bins_put_edges_low_and_round_half_even(spark):
    # edges -0.1, 25, 50, 75, 100
    assert bins(spark, [0.0, 25.0, 25.5, 50.0, 100.0], 4) == [12.0, 12.0, 38.0, 38.0, 88.0]


def test_bins_impute_with_rounded_mean(spark):
    assert bins(spark, [0.0, 100.0, None], 4, impute=True) == [12.0, 88.0, 38.0]


def test_constant_and_small_bins(spark):
    assert bins(spark, [7.0, 7.0], 4) == [7.0, 7.0]
    assert bins(spark, [0.0, 0.0004, 0.001], 2) == [0.0, 0.0, 0.0]


def test_bins_agree_with_a_plain_search(spark):
    values = [round(0.37 * i * i - 3 * i, 3) for i in range(60)]
    n, lo, hi = 7, min(values), max(values)

    def edge(e):
        if e == 0 or abs(e) >= 1:
            return round(e * 1000) / 1000
        digits = -math.floor(math.log10(abs(e))) - 1 + 3
        return round(e * 10**digits) / 10**digits

    edges = [edge(lo - (hi - lo) * 0.001)] + [edge(lo + (hi - lo) / n * i) for i in range(1, n)] + [edge(hi)]
    expected = []
    for v in values:
        hit = next((i for i in range(n) if edges[i] <= v <= edges[i + 1]), None)
        expected.append(float(round(v if hit is None else (edges[hit] + edges[hit + 1]) / 2)))
    assert bins(spark, values, n) == expected


def test_multi_hot(survey):
    hot = Ch.multi_hot(survey, cutoff=0.2, fields=["lang"])
    assert hot.columns == ["id", "gender", "lang_C", "lang_Python", "lang_SQL", "lang_nan"]
    assert [tuple(r)[2:] for r in hot.orderBy("id").collect()] == [(0, 1, 1, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 1, 0, 0), (1, 0, 0, 0)]
    assert Ch.multi_hot(survey, cutoff=0.4, fields=["lang"]).columns == ["id", "gender", "lang_Python", "lang_SQL"]


def test_one_hot_and_codes(spark):
    df = spark.createDataFrame([(1, "b", ">50K"), (2, "a", "<=50K"), (3, None, ">50K")], "id int, w string, income string")
    assert rows(one_hot(df, ["w"]).drop("income")) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    assert [r.code for r in label_encode(df, "income", "code").orderBy("id").collect()] == [1, 0, 1]
    vec = one_hot_vector(["income"]).fit(df).transform(df).orderBy("id").collect()
    assert vec[0].income_vec.toArray().sum() == 1.0 and vec[0].income_vec.size == 3


def test_group_means_and_profiles(spark):
    df = spark.createDataFrame([("Man", "x", 10.0), ("Man", None, 20.0), ("Woman", "x", 30.0), (None, "x", 50.0)], "g string, e string, v double")
    assert rows(G.group_means(df, "v", ["g"])) == [("Man", 15.0), ("Woman", 30.0)]
    both = G.compare_group_means(G.group_means(df, "v", ["g"]), G.group_means(df, "v", ["g"], df["e"] == "x"), ["g"], ["a", "b"])
    assert rows(both) == [("Man", 15.0, 10.0, 5.0), ("Woman", 30.0, 30.0, 0.0)]
    assert rows(G.class_profile(df, "g", "Woman", "Man")) == [(4, 1, 2, 25.0)]
    assert rows(G.mean_by_dimensions(df, "v", "g", ["e"]).filter("g = 'Man'").select("level", "mean_value"), "mean_value") == [("x", 10.0), (None, 20.0)]
    ones = spark.createDataFrame([(1, 0), (1, 0), (0, 1), (1, 0), (1, 0)], "a int, b int")
    assert rows(G.column_totals(ones, ["a", "b"])) == [("a", 4.0, 0.8), ("b", 1.0, 0.2)]
    assert G.drop_rare_columns(ones, ["a", "b"], 0.5).columns == ["a"]
