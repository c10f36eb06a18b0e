import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge.operators import behavior as B

DAY = 86_400_000
T0 = 1538352000000  # 2018-10-01 00:00 UTC
REGISTERED = T0 - 10 * DAY


def event(user, session, item, page, ts, length=0.0, level="free"):
    return (user, session, item, page, ts, REGISTERED, length, level)


# User 1: two months, one session over midnight, cancels. User 2: one session. User 3: cancel pages only.
EVENTS = [
    event(1, 10, 0, "NextSong", T0 + DAY - 60_000, 100.0), event(1, 10, 1, "NextSong", T0 + DAY + 60_000, 200.0),
    event(1, 10, 2, "Thumbs Up", T0 + DAY + 61_000), event(1, 11, 5, "Home", T0 + 35 * DAY, level="paid"),
    event(1, 11, 6, "Cancellation Confirmation", T0 + 35 * DAY + 30_000, level="paid"),
    event(2, 20, 0, "NextSong", T0, 50.0), event(2, 20, 9, "NextSong", T0 + 9_000, 70.0),
    event(3, 30, 0, "Cancel", T0), event(3, 30, 1, "Cancellation Confirmation", T0 + 1_000),
]
PAGES = ["Home", "NextSong", "Thumbs Up"]
DUMMIES = {"level": ["free", "paid"]}


@pytest.fixture(scope="module")
def log(spark):
    df = spark.createDataFrame(EVENTS, "userId bigint, sessionId bigint, itemInSession bigint, page string, ts bigint, registration bigint, length double, level string")
    day = F.date_from_unix_date(F.floor(F.col("ts") / DAY).cast("int"))
    return df.withColumns({"date": day, "month": F.month(day), "monthStart": F.trunc(day, "month"), "hour": F.lit(1), "weekDay": F.dayofweek(day), "monthDay": F.dayofmonth(day)})


def test_churn_labels(log):
    assert {(r.userId, r.churn) for r in B.label_churn(log).collect()} == {(1, 1), (2, 0), (3, 1)}
    assert B.label_churn(log).count() == len(EVENTS)
    assert rows(B.users_per_class(log, B.churned_users(log))) == [(0, 1), (1, 2)]
    other = B.churned_users(log, ["Home"])
    assert rows(other) == [(1,)]


def test_totals_and_top_sessions(log):
    assert rows(B.user_session_totals(log)) == [(3, 4)]
    assert [tuple(r) for r in B.busiest_sessions(log, 3).collect()] == [(1, 10, 3), (1, 11, 2), (2, 20, 2)]


def test_counts_by_churn(log):
    churned = B.churned_users(log)
    assert rows(B.session_lengths(log, churned)) == [(1, 10, 300.0, 1), (1, 11, 0.0, 1), (2, 20, 120.0, 0), (3, 30, 0.0, 1)]
    assert rows(B.sessions_per_user(log, churned)) == [(1, 2, 1), (2, 1, 0), (3, 1, 1)]
    assert rows(B.items_per_session(log, churned)) == [(1, 10, 2, 1), (1, 11, 6, 1), (2, 20, 9, 0), (3, 30, 1, 1)]
    freq = B.churn_frequency(log, churned, ["level", "month"])
    assert rows(freq.filter("column_name = 'level'").drop("column_name")) == [("free", 0, 2), ("free", 1, 5), ("paid", 1, 2)]
    assert rows(B.cancellations_by(log, ["monthDay"])) == [("monthDay", 1, 1), ("monthDay", 5, 1)]


def test_pages(log):
    assert rows(B.page_features(log, PAGES, "month", grain="user_month")) == [(1, 10, 0, 2, 1), (1, 11, 1, 0, 0), (2, 10, 0, 2, 0)]
    got = B.page_features(log, PAGES)
    assert got.columns == ["userId", "HomePageMonth", "NextSongPageMonth", "ThumbsUpPageMonth"]
    assert rows(got) == [(1, 0.5, 1.0, 0.5), (2, 0.0, 2.0, 0.0)]
    assert rows(B.dummy_features(log, "level", ["free", "paid"])) == [(1, 3, 2), (2, 2, 0), (3, 2, 0)]


def test_session_features(log):
    assert rows(B.sessions_per_bucket(log, "month", "x")) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert rows(B.sessions_per_bucket(log, "date", "x")) == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert rows(B.session_duration_per_bucket(log, "month", "x")) == [(1, (121.0 + 30.0) / 2), (2, 9.0), (3, 1.0)]
    # over midnight: 0 s on the first day, 1 s on the second, 30 s on the last
    assert rows(B.session_duration_per_bucket(log, "date", "x")) == [(1, 31.0 / 3), (2, 9.0), (3, 1.0)]
    assert rows(B.session_items_per_bucket(log, "month", "x")) == [(1, 4.0), (2, 9.0), (3, 1.0)]
    assert rows(B.session_items_per_bucket(log, "date", "x")) == [(1, 8.0 / 3), (2, 9.0), (3, 1.0)]
    assert rows(B.active_duration(log)) == [(1, (45 * DAY + 30_000) / 1000), (2, (10 * DAY + 9_000) / 1000), (3, (10 * DAY + 1_000) / 1000)]


def test_fused_features_equal_the_separate_ones(log):
    fused = B.user_features(log, PAGES, DUMMIES)
    separate = B.with_churn(log.select("userId").distinct(), B.churned_users(log))
    for part in (
        B.sessions_per_bucket(log, "month", "avgSessionsMonth"), B.session_duration_per_bucket(log, "month", "avgSessionMonthDuration"),
        B.session_items_per_bucket(log, "month", "avgSessionitemsMonth"), B.sessions_per_bucket(log, "date", "avgSessionsDay"),
        B.session_duration_per_bucket(log, "date", "avgSessionDayDuration"), B.session_items_per_bucket(log, "date", "avgSessionitemsDay"),
        B.active_duration(log), B.average_length(log), B.dummy_features(log, "level", ["free", "paid"]),
    ):
        separate = separate.join(part, "userId")
    separate = separate.join(B.page_features(log, PAGES), "userId", "left").fillna(0.0)
    columns = sorted(separate.columns)
    assert sorted(fused.columns) == columns
    for a, b in zip(rows(fused.select(columns), "userId"), rows(separate.select(columns), "userId")):
        assert [float(x) for x in a] == pytest.approx([float(x) for x in b])
    assert fused.filter("userId = 3").first().NextSongPageMonth == 0.0


def test_fused_features_survive_missing_cells(spark, log):
    nulls = log.withColumns({"itemInSession": F.lit(None).cast("bigint"), "length": F.lit(None).cast("double")})
    got = B.user_features(nulls, PAGES, DUMMIES)
    assert got.count() == 3 and got.first().avgLength is None
    assert log.filter(F.col("date") == datetime.date(2018, 10, 1)).count() > 0


def test_the_same_month_of_two_years_is_two_periods(spark):
    log = spark.sql("SELECT * FROM VALUES (1, 'Home', DATE'2018-01-01'), (1, 'Home', DATE'2019-01-01') AS t(userId, page, monthStart)")
    assert rows(B.page_features(log, ["Home"])) == [(1, 1.0)]
