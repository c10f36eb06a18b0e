import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge.functions import exprs as E
from tallyforge.functions.text import content_words, drop_stop_words, tokenize, word_ngrams


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize("agent, device", [
    ("Mozilla/5.0 (Windows NT 6.1)", "Windows"), ("Mozilla/5.0 (compatible; MSIE)", "Windows"),
    ("Mozilla/5.0 (Macintosh; Intel)", "Machintosh"), ("Mozilla/5.0 (X11; Linux)", "Linux"),
    ("Mozilla/5.0 (iPad; CPU)", "iPad"), ("Mozilla/5.0 (iPhone; CPU)", "iPhone"),
    ("Opera (Plan9)", None), ("curl/7.1", None), (None, None),
])
def test_device(spark, agent, device):
    assert one(spark, agent, E.device_of("x")) == device


def test_user_id_cast_takes_empty_text(spark):
    assert one(spark, "", E.to_long("x")) is None
    assert one(spark, "17", E.to_long("x")) == 17


def test_time_parts_are_utc_whatever_the_session_zone(spark):
    ms = 1538352000000  # 2018-10-01 00:00:00 UTC, a Monday
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        parts = spark.createDataFrame([(ms,), (ms - 1,)], "ts bigint").select(
            *[c.alias(n) for n, c in E.time_parts("ts").items()]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(parts[0]) == (10, 1, 0, 2, datetime.date(2018, 10, 1), datetime.date(2018, 10, 1))
    assert tuple(parts[1]) == (9, 30, 23, 1, datetime.date(2018, 9, 30), datetime.date(2018, 9, 1))


def test_state_keeps_its_blank(spark):
    assert one(spark, "Austin, TX", E.state_of("x")) == " TX"
    assert one(spark, "Austin, TX", E.state_of("x", trim=True)) == "TX"
    assert one(spark, "Nowhere", E.state_of("x")) is None


@pytest.mark.parametrize("text, expected", [
    ("Master’s degree", 1), ("Master's degree", 0), ("Other doctoral degree", 0), ("Doctoral degree", 1),
    ("Professional degree (JD)", 1), ("Bachelor’s degree", 0), (None, 0),
])
def test_higher_ed(spark, text, expected):
    assert one(spark, text, E.higher_ed("x")) == expected


@pytest.mark.parametrize("text, expected", [
    ("Very satisfied", 1), ("satisfied", 1), ("Slightly satisfied  ", 1), ("Very dissatisfied", 0),
    ("Neither satisfied nor dissatisfied", 0), ("", 0), (None, 0),
])
def test_job_satisfied(spark, text, expected):
    assert one(spark, text, E.job_satisfied("x")) == expected


@pytest.mark.parametrize("cell, name, value", [("water-0", "water", 0), ("water-1", "water", 1), ("related-2", "related", 1), ("a-b-1", "a-b", 1)])
def test_packed_cell(spark, cell, name, value):
    assert one(spark, cell, E.packed_name("x")) == name
    assert one(spark, cell, E.packed_value("x")) == value


def test_years_as_text_and_as_numbers(spark):
    df = spark.createDataFrame([(x,) for x in ["1", "2", "5", "6", "9", "10", "49", "50", "51", "Less than 1 year", None]], "x string")
    text = {r.x for r in df.filter(E.between_years("x", 5, 10, "text")).collect()}
    assert text == {"1", "6", "9", "50", "51", "Less than 1 year"}
    assert {r.x for r in df.filter(E.between_years("x", 5, 10)).collect()} == {"6", "9"}
    with pytest.raises(ValueError):
        E.between_years("x", 5, 10, "other")


def test_flag_and_word(spark):
    assert one(spark, None, E.flag("x", ["a"])) == 0
    assert one(spark, "Please HELP us", E.has_word("x", "help")) is True
    assert one(spark, "Please HELP us", E.has_word("x", "help", ignore_case=False)) is False


@pytest.mark.parametrize("text, tokens", [
    ("Hello, World! 42", ["hello", "world", "42"]), ("We cannot go; I'm gonna", ["we", "can", "not", "go", "i", "m", "gon", "na"]),
    ("cannots Xcannot gimme", ["cannots", "xcannot", "gim", "me"]), ("...!!!", []), ("", []), ("a_b", ["a", "b"]),
    ("wanna\nlemme gotta", ["wan", "na", "lem", "me", "got", "ta"]),
])
def test_tokenize(spark, text, tokens):
    assert one(spark, text, tokenize("x")) == tokens


def test_stop_words_and_ngrams(spark):
    assert one(spark, "the cat and the hat don't", drop_stop_words(tokenize("x"))) == ["cat", "hat"]
    assert one(spark, "cat hat cat", word_ngrams(tokenize("x"), 2)) == ["cat", "hat", "cat", "cat hat", "hat cat"]
    assert one(spark, "cat", content_words("x", 2)) == ["cat"]
    assert one(spark, "the", content_words("x", 2)) == []


def test_word_to_number(spark):
    words = {"Less than 1 year": 0.5}
    df = spark.createDataFrame([("Less than 1 year",), ("7",), ("many",), (None,)], "x string")
    assert [r[0] for r in df.select(E.word_to_number("x", words)).collect()] == [0.5, 7.0, None, None]
    df = spark.createDataFrame([("inf",), ("nan",), ("2.5",)], "x string")
    assert [r[0] for r in df.select(E.finite("x")).collect()] == [None, None, 2.5]
    assert rows(df.select(F.lit(1)).limit(1)) == [(1,)]
