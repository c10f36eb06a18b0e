"""Click-log analytics: churn labels, counts by churn, and per-user features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions.exprs import flag
from .profile import _q, unpivoted

USER, SESSION, ITEM, PAGE = "userId", "sessionId", "itemInSession", "page"


def churned_users(clicks: DataFrame, churn_events: list[str] = [fixed.CHURN_PAGE]) -> DataFrame:
    """Users with any churn event; the page filter reaches the scan."""
    return clicks.filter(F.col(PAGE).isin(churn_events)).select(USER).distinct()


def with_churn(facts: DataFrame, churned: DataFrame) -> DataFrame:
    """Adds ``churn`` (0/1) to any table keyed by user. One row a user on the right, so a
    very active user is a skewed left side only, which AQE splits."""
    return facts.join(churned.withColumn("churn", F.lit(1)), USER, "left").withColumn(
        "churn", F.coalesce("churn", F.lit(0))
    )


def label_churn(clicks: DataFrame, churn_events: list[str] = [fixed.CHURN_PAGE]) -> DataFrame:
    """Every event with its user's churn label."""
    known = clicks.drop("churn").filter(F.col(USER).isNotNull())
    return with_churn(known, churned_users(known, churn_events))


def user_session_totals(clicks: DataFrame) -> DataFrame:
    """One row: distinct users and distinct (user, session) pairs; two plain aggregates, no Expand."""
    return (
        clicks.groupBy(USER, SESSION).agg(F.lit(1).alias("one"))
        .groupBy(USER).agg(F.count("one").alias("sessions"))
        .agg(F.count(F.lit(1)).alias("n_users"), F.coalesce(F.sum("sessions"), F.lit(0)).alias("n_sessions"))
    )


def busiest_sessions(clicks: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` sessions with most events; ties go to the lower user and session."""
    counts = clicks.groupBy(USER, SESSION).agg(F.count(F.lit(1)).alias("n_events"))
    return counts.orderBy(F.desc("n_events"), USER, SESSION).limit(n)


def cancellations_by(clicks: DataFrame, parts: list[str] = ["hour", "weekDay", "monthDay"]) -> DataFrame:
    """(part, value, n) of the churn events over several time parts, in one pass."""
    rows = clicks.filter(F.col(PAGE) == fixed.CHURN_PAGE)
    return unpivoted(rows, [], parts, "part", "value", "bigint").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))


def session_lengths(clicks: DataFrame, churned: DataFrame) -> DataFrame:
    """(user, session, churn, total length); events are summed before they meet the labels."""
    return with_churn(clicks.groupBy(USER, SESSION).agg(F.sum("length").alias("total_length")), churned)


def sessions_per_user(clicks: DataFrame, churned: DataFrame) -> DataFrame:
    pairs = clicks.groupBy(USER, SESSION).agg(F.lit(1).alias("one"))
    return with_churn(pairs.groupBy(USER).agg(F.count("one").alias("n_sessions")), churned)


def items_per_session(clicks: DataFrame, churned: DataFrame) -> DataFrame:
    return with_churn(clicks.groupBy(USER, SESSION).agg(F.max(ITEM).alias("max_item")), churned)


def churn_frequency(clicks: DataFrame, churned: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, churn, n) of events for many columns at once.

    Events collapse to one row per user and value before the label join, so neither the join
    nor the second count sees the raw log.
    """
    cells = unpivoted(clicks, [USER], columns, "column_name", "value", "string")
    per_user = cells.groupBy(USER, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return with_churn(per_user, churned).groupBy("column_name", "value", "churn").agg(F.sum("n").alias("n"))


def users_per_class(clicks: DataFrame, churned: DataFrame) -> DataFrame:
    return with_churn(clicks.select(USER).distinct(), churned).groupBy("churn").agg(F.count(F.lit(1)).alias("n_users"))


# -- per-user features -------------------------------------------------------------------------


def page_feature(page: str) -> str:
    return page.replace(" ", "") + "PageMonth"


def page_features(clicks: DataFrame, pages: list[str], period: str = "monthStart", grain: str = "user") -> DataFrame:
    """Counts of the given pages: a mean over the user's periods, or one row per user and period.

    Cancel pages never count. The pages are given, so no job looks for pivot values, and the
    counts are conditional sums that combine before the shuffle.
    """
    rows = clicks.filter(~F.col(PAGE).isin(fixed.CANCEL_PAGES))
    counts = rows.groupBy(USER, _q(period)).agg(*[F.count_if(F.col(PAGE) == p).alias(page_feature(p)) for p in pages])
    if grain == "user_month":
        return counts
    return counts.groupBy(USER).agg(*[F.avg(page_feature(p)).alias(page_feature(p)) for p in pages])


def dummy_feature(column: str, value: str) -> str:
    return column + value.replace(" ", "")


def dummy_features(clicks: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Events of a user for each given value of one column."""
    return clicks.groupBy(USER).agg(
        *[F.count_if(_q(column) == v).alias(dummy_feature(column, v)) for v in values]
    )


def sessions_per_bucket(clicks: DataFrame, bucket: str, out: str) -> DataFrame:
    """Mean over the user's buckets (months, days) of distinct sessions."""
    pairs = clicks.filter(F.col(SESSION).isNotNull()).groupBy(USER, _q(bucket), SESSION).agg(F.lit(1).alias("one"))
    return pairs.groupBy(USER, _q(bucket)).agg(F.count("one").alias("n")).groupBy(USER).agg(F.avg("n").alias(out))


def session_duration_per_bucket(clicks: DataFrame, bucket: str, out: str) -> DataFrame:
    """Mean over buckets of the mean session duration in seconds within the bucket."""
    spans = clicks.groupBy(USER, _q(bucket), SESSION).agg(((F.max("ts") - F.min("ts")) / 1000).alias("seconds"))
    return spans.groupBy(USER, _q(bucket)).agg(F.avg("seconds").alias("s")).groupBy(USER).agg(F.avg("s").alias(out))


def session_items_per_bucket(clicks: DataFrame, bucket: str, out: str) -> DataFrame:
    """Mean over (session, bucket) of the highest item number; buckets are not weighted."""
    tops = clicks.groupBy(USER, _q(bucket), SESSION).agg(F.max(ITEM).alias("top"))
    return tops.groupBy(USER).agg(F.avg("top").alias(out))


def active_duration(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(USER).agg(((F.max("ts") - F.min("registration")) / 1000).alias("activeDuration"))


def average_length(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(USER).agg(F.avg("length").alias("avgLength"))


def user_features(
    clicks: DataFrame,
    pages: list[str] = fixed.FEATURE_PAGES,
    dummies: dict[str, list[str]] = fixed.DUMMY_VALUES,
    period: str = "monthStart",
    day: str = "date",
    churn_events: list[str] = [fixed.CHURN_PAGE],
) -> DataFrame:
    """Every per-user feature and the churn label, one row a user, from one scan of the log.

    Two grouping sets, (user, session, period) and (user, session, day), carry all that the
    features need: extremes and sums compose, so the log is read and shuffled once (after
    map-side combining), then two smaller shuffles roll sessions up to buckets and users.
    Written out feature by feature it takes ten scans and ten joins for the same numbers.
    """
    rows = clicks.filter(F.col(USER).isNotNull()).select(
        USER, SESSION, ITEM, PAGE, "ts", "registration", "length", *[_q(c) for c in dummies],
        _q(period).alias("_period"), _q(day).alias("_day"),
    )
    kept = ~F.col(PAGE).isin(fixed.CANCEL_PAGES)
    counts = {page_feature(p): F.count_if((F.col(PAGE) == p) & kept) for p in pages}
    counts["_other_pages"] = F.count_if(kept)
    for c, values in dummies.items():
        counts |= {dummy_feature(c, v): F.count_if(_q(c) == v) for v in values}
    counts |= {"_length": F.sum("length"), "_songs": F.count("length")}
    counts["_churn"] = F.max(flag(PAGE, churn_events))

    sessions = rows.groupingSets(
        [[F.col(USER), F.col(SESSION), F.col("_period")], [F.col(USER), F.col(SESSION), F.col("_day")]],
        F.col(USER), F.col(SESSION), F.col("_period"), F.col("_day"),
    ).agg(
        F.grouping("_period").alias("_by_day"),
        ((F.max("ts") - F.min("ts")) / 1000).alias("_seconds"),
        F.max("ts").alias("_last"), F.min("registration").alias("_registered"), F.max(ITEM).alias("_top"),
        *[c.alias(n) for n, c in counts.items()],
    )

    sums = [n for n in counts if n != "_churn"]
    buckets = sessions.groupBy(USER, "_by_day", "_period", "_day").agg(
        F.count(SESSION).alias("_sessions"), F.avg("_seconds").alias("_seconds"),
        F.sum("_top").alias("_tops"), F.count("_top").alias("_n_tops"),
        F.max("_last").alias("_last"), F.min("_registered").alias("_registered"),
        F.max("_churn").alias("_churn"), *[F.sum(n).alias(n) for n in sums],
    )

    by_month, by_day = F.col("_by_day") == 0, F.col("_by_day") == 1
    # Pages average over the periods in which the user saw any page that counts.
    paged = F.count_if(by_month & (F.col("_other_pages") > 0))

    def total(name: str):
        return F.sum(F.when(by_month, _q(name)))

    out = buckets.groupBy(USER).agg(
        *[piece for side, name in [(by_month, "Month"), (by_day, "Day")] for piece in (
            F.avg(F.when(side & (F.col("_sessions") > 0), F.col("_sessions"))).alias(f"avgSessions{name}"),
            F.avg(F.when(side, F.col("_seconds"))).alias(f"avgSession{name}Duration"),
            F.try_divide(F.sum(F.when(side, F.col("_tops"))), F.sum(F.when(side, F.col("_n_tops")))).alias(f"avgSessionitems{name}"),
        )],
        ((F.max("_last") - F.min("_registered")) / 1000).alias("activeDuration"),
        F.try_divide(total("_length"), total("_songs")).alias("avgLength"),
        *[total(dummy_feature(c, v)).alias(dummy_feature(c, v)) for c, values in dummies.items() for v in values],
        *[F.coalesce(F.try_divide(total(page_feature(p)), paged), F.lit(0.0)).alias(page_feature(p)) for p in pages],
        F.max("_churn").alias("churn"),
    )
    return out
