"""Click-log queries on the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import exprs as E
from ..ml.prep import all_but, in_train
from ..operators import behavior as B
from ..operators import clean as C
from ..operators import profile as P
from ..schemas import CLICKS
from ..sources.files import read_event_log
from ..workspace import scratch_path
from .registry import query, rounded
from .stand_ins import CLICKS_SQL, PAGES, RAW_CLICKS_SQL, clicks, clicks_and_churned, histogram_sql, raw_clicks

WITH_CHURN = 'CASE WHEN "userId" IN (SELECT "userId" FROM churned) THEN 1 ELSE 0 END AS churn'
RAW = f"WITH {RAW_CLICKS_SQL} "
LOG = f"WITH {CLICKS_SQL} "


@query("S1", RAW + "SELECT * FROM raw")
def event_log_from_json(spark, folder):
    path = scratch_path(spark, "clicks-json")
    raw_clicks(spark, folder).write.json(path)
    return read_event_log(spark, path, CLICKS)


@query("P1", RAW + "SELECT column_name, n_blank FROM (" + " UNION ALL ".join(
    f"""SELECT '{f.name}' AS column_name, count(*) FILTER ("{f.name}" IS NULL{f" OR {f.name} = ''" if f.dataType.typeName() == 'string' else ''}) AS n_blank FROM raw"""
    for f in CLICKS.fields) + ")")
def click_blank_counts(spark, folder):
    return P.blank_counts(raw_clicks(spark, folder))


@query("P3", RAW + "SELECT count(*) AS n_rows, 18::bigint AS n_columns, 6::bigint AS n_numeric, 12::bigint AS n_categorical FROM raw")
def click_table_shape(spark, folder):
    return P.table_shape(raw_clicks(spark, folder))


@query("P2", RAW + "SELECT column_name, n, round(mean, 4) AS mean, round(std, 4) AS std, min, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75, max FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count("{c}") AS n, avg("{c}") AS mean, stddev_samp("{c}") AS std, min("{c}")::double AS min,
    quantile_cont("{c}"::double, 0.25) AS q25, quantile_cont("{c}"::double, 0.5) AS q50, quantile_cont("{c}"::double, 0.75) AS q75, max("{c}")::double AS max FROM raw"""
    for c in ["itemInSession", "length", "sessionId", "status"]) + ")")
def click_summary(spark, folder):
    out = P.summary(raw_clicks(spark, folder), ["itemInSession", "length", "sessionId", "status"])
    return rounded(out, "mean", "std", "q25", "q50", "q75", digits=4)


@query("P2", RAW + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count("{c}") AS n, min("{c}") AS min, max("{c}") AS max FROM raw""" for c in ["page", "location", "artist", "level"]))
def click_text_summary(spark, folder):
    return P.text_summary(raw_clicks(spark, folder), ["page", "location", "artist", "level"])


@query("P11", RAW + "SELECT DISTINCT * FROM raw")
def distinct_clicks(spark, folder):
    return C.distinct_rows(raw_clicks(spark, folder))


@query("P13", RAW + """SELECT * FROM raw WHERE "userId" <> ''""")
def identified_clicks(spark, folder):
    return C.keep_identified(raw_clicks(spark, folder))


@query("E1", RAW + """SELECT "userAgent", CASE WHEN "userAgent" LIKE '%(Windows%' OR "userAgent" LIKE '%(compatible%' THEN 'Windows'
    WHEN "userAgent" LIKE '%(iPad%' THEN 'iPad' WHEN "userAgent" LIKE '%(iPhone%' THEN 'iPhone'
    WHEN "userAgent" LIKE '%(Macintosh%' THEN 'Machintosh' WHEN "userAgent" LIKE '%(X11%' THEN 'Linux' END AS "userDevice",
    count(*) AS n FROM raw GROUP BY ALL""")
def devices_of_agents(spark, folder):
    return raw_clicks(spark, folder).groupBy("userAgent", E.device_of("userAgent").alias("userDevice")).agg(F.count(F.lit(1)).alias("n"))


@query("E2", RAW + """SELECT TRY_CAST("userId" AS bigint) AS user_id, count(*) AS n FROM raw GROUP BY ALL""")
def user_ids_as_long(spark, folder):
    return raw_clicks(spark, folder).groupBy(E.to_long("userId").alias("user_id")).agg(F.count(F.lit(1)).alias("n"))


@query("E3", LOG + 'SELECT month, "monthDay", hour, "weekDay", date, "monthStart", count(*) AS n FROM clicks GROUP BY ALL')
def clicks_by_time_parts(spark, folder):
    return clicks(spark, folder).groupBy("month", "monthDay", "hour", "weekDay", "date", "monthStart").agg(F.count(F.lit(1)).alias("n"))


@query("E4", RAW + "SELECT CASE WHEN contains(location, ',') THEN split_part(location, ',', 2) END AS state, count(*) AS n FROM raw GROUP BY ALL")
def clicks_by_state(spark, folder):
    return raw_clicks(spark, folder).groupBy(E.state_of("location").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("E5", RAW + "SELECT page, CASE WHEN page = 'Cancellation Confirmation' THEN 1 ELSE 0 END AS is_churn, count(*) AS n FROM raw GROUP BY ALL")
def churn_page_flags(spark, folder):
    return raw_clicks(spark, folder).groupBy("page", E.flag("page", [fixed.CHURN_PAGE]).alias("is_churn")).agg(F.count(F.lit(1)).alias("n"))


@query("P14", RAW + "SELECT coalesce(length, 0) AS length, coalesce(artist, 'unknown') AS artist, coalesce(song, 'unknown') AS song, count(*) AS n FROM raw GROUP BY ALL")
def filled_clicks(spark, folder):
    filled = C.fill_constants(raw_clicks(spark, folder), fixed.CLICK_FILL)
    return filled.groupBy("length", "artist", "song").agg(F.count(F.lit(1)).alias("n"))


@query("P24", RAW + "SELECT * FROM raw WHERE page = 'NextSong' AND length IS NULL")
def songs_without_length(spark, folder):
    return C.songs_without_length(raw_clicks(spark, folder))


@query("P11 P13 P14 E1 E2 E3 E4", LOG + "SELECT * FROM clicks")
def cleaned_clicks(spark, folder):
    return clicks(spark, folder)


@query("P25", LOG + """SELECT "userId" AS user_id, "sessionId" AS session_id, "itemInSession", page, ts, gender, level, "userDevice", churn
  FROM (SELECT *, """ + WITH_CHURN + " FROM clicks)")
def final_click_columns(spark, folder):
    log, churned = clicks_and_churned(spark, folder)
    drop = ["artist", "length", "firstName", "lastName", "location", "method", "userAgent", "song", "auth", "registration",
            "date", "month", "hour", "monthDay", "status", "weekDay", "monthStart", "week"]
    return C.drop_and_rename(B.with_churn(log, churned), drop, {"userId": "user_id", "sessionId": "session_id"})


# -- counts ------------------------------------------------------------------------------------


@query("A1 E5 J1", LOG + 'SELECT "userId", "sessionId", page, ts, ' + WITH_CHURN + " FROM clicks")
def churn_labelled_events(spark, folder):
    return B.label_churn(clicks(spark, folder)).select("userId", "sessionId", "page", "ts", "churn")


@query("A2", LOG + 'SELECT count(DISTINCT "userId") AS n_users, count(DISTINCT ("userId", "sessionId")) AS n_sessions FROM clicks')
def user_and_session_totals(spark, folder):
    return B.user_session_totals(clicks(spark, folder))


@query("A3", LOG + 'SELECT "userId", "sessionId", count(*) AS n_events FROM clicks GROUP BY ALL ORDER BY n_events DESC, "userId", "sessionId" LIMIT 20')
def busiest_sessions(spark, folder):
    return B.busiest_sessions(clicks(spark, folder))


@query("A4", LOG + ", c AS (SELECT * FROM clicks WHERE page = 'Cancellation Confirmation') " + " UNION ALL ".join(
    f"""SELECT '{p}' AS part, CAST("{p}" AS bigint) AS value, count(*) AS n FROM c GROUP BY ALL""" for p in ["hour", "weekDay", "monthDay"]))
def cancellations_by_time(spark, folder):
    return B.cancellations_by(clicks(spark, folder))


@query("A5", LOG + 'SELECT "userId", "sessionId", ' + WITH_CHURN + ', round(sum(length), 4) AS total_length FROM clicks GROUP BY "userId", "sessionId"')
def session_lengths(spark, folder):
    return rounded(B.session_lengths(*clicks_and_churned(spark, folder)), "total_length", digits=4)


@query("A6", LOG + 'SELECT "userId", ' + WITH_CHURN + ', count(DISTINCT "sessionId") AS n_sessions FROM clicks GROUP BY "userId"')
def sessions_per_user(spark, folder):
    return B.sessions_per_user(*clicks_and_churned(spark, folder))


@query("A7", LOG + 'SELECT "userId", "sessionId", ' + WITH_CHURN + ', max("itemInSession") AS max_item FROM clicks GROUP BY "userId", "sessionId"')
def items_per_session(spark, folder):
    return B.items_per_session(*clicks_and_churned(spark, folder))


CHURN_COLUMNS = ["auth", "gender", "level", "page", "userDevice", "location", "month", "monthDay", "hour", "weekDay"]


@query("A8", LOG + ", l AS (SELECT *, " + WITH_CHURN + " FROM clicks) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST("{c}" AS varchar) AS value, churn, count(*) AS n FROM l GROUP BY ALL""" for c in CHURN_COLUMNS))
def churn_frequency(spark, folder):
    return B.churn_frequency(*clicks_and_churned(spark, folder), CHURN_COLUMNS)


@query("A9", LOG + 'SELECT churn, count(*) AS n_users FROM (SELECT DISTINCT "userId", ' + WITH_CHURN + " FROM clicks) GROUP BY churn")
def users_per_churn_class(spark, folder):
    return B.users_per_class(*clicks_and_churned(spark, folder))


@query("A17 A6", LOG + ', s AS (SELECT "userId", ' + WITH_CHURN + """, count(DISTINCT "sessionId")::double AS x FROM clicks GROUP BY "userId"), """ + histogram_sql("s", 10, ["churn"]))
def sessions_per_user_histogram(spark, folder):
    sessions = B.sessions_per_user(*clicks_and_churned(spark, folder))
    return rounded(P.histogram(sessions, "n_sessions", 10, by="churn", classes=[0, 1]), "bin_left", "bin_right", digits=4)


# -- features ----------------------------------------------------------------------------------

_PAGE_COUNTS = ", ".join(
    f"count(*) FILTER (page = '{p}') AS \"{B.page_feature(p)}\"" for p in PAGES
)
_KEPT = "page NOT IN ('Cancel', 'Cancellation Confirmation')"
_PAGES_BY_WEEK = f'SELECT "userId", week, {_PAGE_COUNTS} FROM clicks WHERE {_KEPT} GROUP BY "userId", week'


@query("W1", LOG + _PAGES_BY_WEEK)
def page_counts_per_user_and_period(spark, folder):
    return B.page_features(clicks(spark, folder), PAGES, "week", grain="user_month")


@query("W1", LOG + f', p AS ({_PAGES_BY_WEEK}) SELECT "userId", ' + ", ".join(
    f'round(avg("{B.page_feature(p)}"), 6) AS "{B.page_feature(p)}"' for p in PAGES) + ' FROM p GROUP BY "userId"')
def page_features_per_user(spark, folder):
    return rounded(B.page_features(clicks(spark, folder), PAGES, "week"), *[B.page_feature(p) for p in PAGES])


_DUMMIES = {
    c: ", ".join(f"count(*) FILTER (\"{c}\" = '{v}') AS \"{B.dummy_feature(c, v)}\"" for v in values)
    for c, values in fixed.DUMMY_VALUES.items()
}


@query("W2 J1", LOG + 'SELECT "userId", ' + ", ".join(_DUMMIES.values()) + ' FROM clicks GROUP BY "userId"')
def dummy_features_per_user(spark, folder):
    log = clicks(spark, folder)
    out = None
    for column, values in fixed.DUMMY_VALUES.items():
        part = B.dummy_features(log, column, values)
        out = part if out is None else out.join(part, "userId")
    return out


def _bucket_sql(kind: str, bucket: str, out: str) -> str:
    if kind == "sessions":
        return f'SELECT "userId", avg(n) AS "{out}" FROM (SELECT "userId", {bucket}, count(DISTINCT "sessionId") AS n FROM clicks GROUP BY ALL) GROUP BY "userId"'
    if kind == "duration":
        return f"""SELECT "userId", avg(s) AS "{out}" FROM (SELECT "userId", {bucket}, avg(d) AS s FROM (
            SELECT "userId", {bucket}, "sessionId", (max(ts) - min(ts)) / 1000 AS d FROM clicks GROUP BY ALL) GROUP BY ALL) GROUP BY "userId\""""
    return f"""SELECT "userId", avg(m) AS "{out}" FROM (
            SELECT "userId", {bucket}, "sessionId", max("itemInSession") AS m FROM clicks GROUP BY ALL) GROUP BY "userId\""""


SESSION_FEATURES = [
    ("sessions", "week", "avgSessionsMonth"), ("duration", "week", "avgSessionMonthDuration"), ("items", "week", "avgSessionitemsMonth"),
    ("sessions", "date", "avgSessionsDay"), ("duration", "date", "avgSessionDayDuration"), ("items", "date", "avgSessionitemsDay"),
]
_BUILD = {"sessions": B.sessions_per_bucket, "duration": B.session_duration_per_bucket, "items": B.session_items_per_bucket}


def _one(kind: str, bucket: str, out: str) -> str:
    return LOG + f'SELECT "userId", round("{out}", 5) AS "{out}" FROM ({_bucket_sql(kind, bucket, out)})'


@query("W3", _one(*SESSION_FEATURES[0]))
def sessions_per_period(spark, folder):
    return rounded(B.sessions_per_bucket(clicks(spark, folder), "week", "avgSessionsMonth"), "avgSessionsMonth", digits=5)


@query("W4", _one(*SESSION_FEATURES[1]))
def session_duration_per_period(spark, folder):
    return rounded(B.session_duration_per_bucket(clicks(spark, folder), "week", "avgSessionMonthDuration"), "avgSessionMonthDuration", digits=5)


@query("W5", _one(*SESSION_FEATURES[2]))
def session_items_per_period(spark, folder):
    return rounded(B.session_items_per_bucket(clicks(spark, folder), "week", "avgSessionitemsMonth"), "avgSessionitemsMonth", digits=5)


@query("W6", _one(*SESSION_FEATURES[3]))
def sessions_per_day(spark, folder):
    return rounded(B.sessions_per_bucket(clicks(spark, folder), "date", "avgSessionsDay"), "avgSessionsDay", digits=5)


@query("W7", _one(*SESSION_FEATURES[4]))
def session_duration_per_day(spark, folder):
    return rounded(B.session_duration_per_bucket(clicks(spark, folder), "date", "avgSessionDayDuration"), "avgSessionDayDuration", digits=5)


@query("W8", _one(*SESSION_FEATURES[5]))
def session_items_per_day(spark, folder):
    return rounded(B.session_items_per_bucket(clicks(spark, folder), "date", "avgSessionitemsDay"), "avgSessionitemsDay", digits=5)


@query("W9", LOG + 'SELECT "userId", round((max(ts) - min(registration)) / 1000, 4) AS "activeDuration" FROM clicks GROUP BY "userId"')
def active_duration(spark, folder):
    return rounded(B.active_duration(clicks(spark, folder)), "activeDuration", digits=4)


@query("W10", LOG + 'SELECT "userId", round(avg(length), 9) AS "avgLength" FROM clicks GROUP BY "userId"')
def average_song_length(spark, folder):
    return rounded(B.average_length(clicks(spark, folder)), "avgLength", digits=9)


FEATURE_COLUMNS = [out for _, _, out in SESSION_FEATURES] + ["activeDuration", "avgLength"]
DUMMY_COLUMNS = [B.dummy_feature(c, v) for c, values in fixed.DUMMY_VALUES.items() for v in values]
PAGE_COLUMNS = [B.page_feature(p) for p in PAGES]
FEATURES_CTE = CLICKS_SQL + ", " + ", ".join(
    f"f{i} AS ({_bucket_sql(*spec)})" for i, spec in enumerate(SESSION_FEATURES)
) + f""", pages AS ({_PAGES_BY_WEEK}),
page_means AS (SELECT "userId", {", ".join(f'avg("{c}") AS "{c}"' for c in PAGE_COLUMNS)} FROM pages GROUP BY "userId"),
totals AS (SELECT "userId", (max(ts) - min(registration)) / 1000 AS "activeDuration", avg(length) AS "avgLength", {", ".join(_DUMMIES.values())},
  {WITH_CHURN} FROM clicks GROUP BY "userId"),
features AS (SELECT totals.*, {", ".join(f'"{out}"' for _, _, out in SESSION_FEATURES)},
  {", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in PAGE_COLUMNS)}
  FROM totals {" ".join(f'JOIN f{i} USING ("userId")' for i in range(6))} LEFT JOIN page_means USING ("userId"))"""


DIGITS = {"avgLength": 9}


def rounded_features(df):
    df = rounded(df, *[c for c in FEATURE_COLUMNS + PAGE_COLUMNS if c not in DIGITS], digits=5)
    return rounded(df, "avgLength", digits=DIGITS["avgLength"])


def user_features(spark, folder):
    return B.user_features(clicks(spark, folder), pages=PAGES, period="week")


def _feature_select(source: str) -> str:
    return "SELECT " + ", ".join(
        ['"userId"', "churn"] + [f'"{c}"' for c in DUMMY_COLUMNS]
        + [f'round("{c}", {DIGITS.get(c, 5)}) AS "{c}"' for c in FEATURE_COLUMNS + PAGE_COLUMNS]
    ) + f" FROM {source}"


@query("W1 W2 W3 W4 W5 W6 W7 W8 W9 W10 W11", f"WITH {FEATURES_CTE} " + _feature_select("features"))
def user_feature_table(spark, folder):
    return rounded_features(user_features(spark, folder))


@query("W11 J1", f"WITH {FEATURES_CTE} " + _feature_select("features f JOIN page_means p USING (\"userId\")").replace('"userId", churn', 'f."userId", churn').replace(
    'round("', 'round(f."') )
def user_feature_table_by_joins(spark, folder):
    """The same table written feature by feature and joined on the user."""
    log, churned = clicks_and_churned(spark, folder)
    out = B.with_churn(log.select("userId").distinct(), churned)
    for kind, bucket, name in SESSION_FEATURES:
        out = out.join(_BUILD[kind](log, bucket, name), "userId")
    for part in (B.active_duration(log), B.average_length(log), B.page_features(log, PAGES, "week")):
        out = out.join(part, "userId")
    for column, values in fixed.DUMMY_VALUES.items():
        out = out.join(B.dummy_features(log, column, values), "userId")
    return rounded_features(out)


HISTOGRAM_COLUMNS = ["avgSessionsDay", "activeDuration", *PAGE_COLUMNS, *DUMMY_COLUMNS]


@query("A17", f"WITH {FEATURES_CTE}, v AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, churn, CAST("{c}" AS double) AS x FROM features WHERE "{c}" IS NOT NULL""" for c in HISTOGRAM_COLUMNS
) + "), " + histogram_sql("v", 10, ["column_name", "churn"]))
def feature_histograms_by_churn(spark, folder):
    out = P.histograms(user_features(spark, folder), HISTOGRAM_COLUMNS, 10, by="churn", classes=[0, 1])
    return rounded(out, "bin_left", "bin_right", digits=4)


@query("J6", LOG + """, s AS (SELECT DISTINCT "userId", "sessionId", level FROM clicks)
  SELECT * FROM s EXCEPT SELECT * FROM s WHERE "userId" % 100 < 80""")
def test_rows_by_difference(spark, folder):
    rows = clicks(spark, folder).select("userId", "sessionId", "level").distinct()
    return all_but(rows, rows.filter(in_train("userId", 80, method="plain")))
