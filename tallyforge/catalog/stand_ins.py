"""The given tables seen as a click log, a survey, messages and a census, in Spark and in SQL.

Every stand-in is a projection (or one small aggregate) of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.behavior import churned_users
from ..operators.clean import clean_clicks
from ..operators.profile import _q
from .registry import table

# -- click log ---------------------------------------------------------------------------------

PAGES = ["Add to Playlist", "Error", "Home", "NextSong", "Thumbs Up"]

_PAGE = """CASE
  WHEN event_type = 'error' AND value > 200 THEN 'Cancellation Confirmation'
  WHEN event_type = 'error' AND value > 150 THEN 'Cancel'
  WHEN event_type = 'error' THEN 'Error'
  WHEN event_type = 'view' THEN 'NextSong'
  WHEN event_type = 'click' THEN 'Thumbs Up'
  WHEN event_type = 'purchase' THEN 'Add to Playlist'
  ELSE 'Home' END"""
_AGENT = """CASE k % 8
  WHEN 0 THEN 'Mozilla/5.0 (Windows NT 6.1; WOW64)' WHEN 1 THEN 'Mozilla/5.0 (Macintosh; Intel)'
  WHEN 2 THEN 'Mozilla/5.0 (iPhone; CPU)' WHEN 3 THEN 'Mozilla/5.0 (iPad; CPU)'
  WHEN 4 THEN 'Mozilla/5.0 (X11; Linux)' WHEN 5 THEN 'Mozilla/5.0 (compatible; MSIE)'
  WHEN 6 THEN 'Opera (Plan9)' ELSE 'curl/7.1' END"""
_PLACE = """CASE WHEN k % 10 = 0 THEN 'Nowhere' ELSE concat('Town ', CAST(k AS {text}), ', ',
  CASE k % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX-OK' WHEN 3 THEN 'WA' ELSE 'FL' END) END"""


def _click_columns(text: str) -> dict[str, str]:
    return {
        "userId": f"CASE WHEN value < 0.5 THEN '' ELSE CAST(user_id AS {text}) END",
        "sessionId": "k",
        "itemInSession": "minute_of_day",
        "page": _PAGE,
        "ts": "ms",
        "registration": "ms - 86400000",
        "userAgent": _AGENT,
        "location": _PLACE.format(text=text),
        "gender": "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END",
        "level": "CASE WHEN value > 40 THEN 'paid' ELSE 'free' END",
        "auth": "CASE WHEN event_type = 'signup' THEN 'Guest' ELSE 'Logged In' END",
        "length": "CASE WHEN event_type = 'view' AND value >= 2 THEN value END",
        "artist": f"CASE WHEN event_type = 'view' THEN concat('artist ', CAST(k AS {text})) END",
        "song": f"CASE WHEN event_type = 'view' THEN concat('song ', CAST(k AS {text})) END",
        "firstName": f"concat('first ', CAST(user_id AS {text}))",
        "lastName": f"concat('last ', CAST(user_id AS {text}))",
        "method": "CASE WHEN event_type = 'view' THEN 'PUT' ELSE 'GET' END",
        "status": "CAST(CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS bigint)",
    }


def raw_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw clicks; purchases come twice, so there are copies to remove."""
    events = table(spark, folder, "events").selectExpr(
        "*",
        "CAST(get_json_object(props, '$.k') AS bigint) AS k",
        "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS ms",
        "CAST(hour(ts) * 60 + minute(ts) AS bigint) AS minute_of_day",
    )
    copies = F.when(F.col("event_type") == "purchase", F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return events.withColumn("copy", F.explode(copies)).selectExpr(
        *[f"{e} AS {name}" for name, e in _click_columns("string").items()]
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned clicks, with the ISO week as the period (all events lie in one month)."""
    return clean_clicks(raw_clicks(spark, folder)).withColumn("week", F.weekofyear("date"))


def clicks_and_churned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    log = clicks(spark, folder)
    return log, churned_users(log)


RAW_CLICKS_SQL = """raw AS (
  SELECT {columns}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS bigint) AS k, epoch_us(ts) // 1000 AS ms,
               CAST(hour(ts) * 60 + minute(ts) AS bigint) AS minute_of_day FROM events) e,
       (VALUES (1), (2)) c(n)
  WHERE n = 1 OR event_type = 'purchase')""".format(
    columns=",\n".join(f'{e} AS "{name}"' for name, e in _click_columns("varchar").items())
)

CLICKS_SQL = RAW_CLICKS_SQL + """,
clicks AS (
  SELECT CAST(r."userId" AS bigint) AS "userId", "sessionId", "itemInSession", page, ts, registration, "userAgent",
    CASE WHEN contains(location, ',') THEN split_part(location, ',', 2) END AS location,
    gender, level, auth, coalesce(length, 0) AS length, coalesce(artist, 'unknown') AS artist,
    coalesce(song, 'unknown') AS song, "firstName", "lastName", method, status,
    CASE WHEN "userAgent" LIKE '%(Windows%' OR "userAgent" LIKE '%(compatible%' THEN 'Windows'
         WHEN "userAgent" LIKE '%(iPad%' THEN 'iPad' WHEN "userAgent" LIKE '%(iPhone%' THEN 'iPhone'
         WHEN "userAgent" LIKE '%(Macintosh%' THEN 'Machintosh' WHEN "userAgent" LIKE '%(X11%' THEN 'Linux' END AS "userDevice",
    CAST(month(epoch_ms(ts)) AS int) AS month, CAST(day(epoch_ms(ts)) AS int) AS "monthDay",
    CAST(hour(epoch_ms(ts)) AS int) AS hour, CAST(dayofweek(epoch_ms(ts)) + 1 AS int) AS "weekDay",
    CAST(epoch_ms(ts) AS date) AS date, CAST(date_trunc('month', epoch_ms(ts)) AS date) AS "monthStart",
    CAST(week(epoch_ms(ts)) AS int) AS week
  FROM (SELECT DISTINCT * FROM raw) r WHERE r."userId" <> ''),
churned AS (SELECT DISTINCT "userId" FROM clicks WHERE page = 'Cancellation Confirmation')"""

def histogram_sql(values: str, bins: int, keys: list[str] | None = None, digits: int = 4) -> str:
    """CTEs and a final select that place ``x`` of the CTE ``values`` into equal-width bins by their edges."""
    by = "".join(f"{k}, " for k in keys or [])
    same = " AND ".join([f"b.{k} = v.{k}" for k in keys or []] + ["x >= lft", f"(x < rgt OR b.bin = {bins})"])
    return f"""edges AS (SELECT {by}min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo,
    max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM {values} {"GROUP BY ALL" if keys else ""}),
  bins AS (SELECT {by}CAST(t.i AS int) AS bin, lo + (hi - lo) / {bins} * (t.i - 1) AS lft, lo + (hi - lo) / {bins} * t.i AS rgt
    FROM edges, range(1, {bins + 1}) t(i))
  SELECT {"".join(f"b.{k}, " for k in keys or [])}b.bin, round(b.lft, {digits}) AS bin_left, round(b.rgt, {digits}) AS bin_right, count(x) AS n
  FROM bins b LEFT JOIN {values} v ON {same} GROUP BY ALL"""


# -- survey ------------------------------------------------------------------------------------

_SURVEY = {
    "Respondent": "c_custkey",
    "MainBranch": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'I am a developer by profession' ELSE 'I code primarily as a hobby' END",
    "EdLevel": "CASE c_nationkey % 5 WHEN 0 THEN 'Master’s degree (M.A.)' WHEN 1 THEN 'Bachelor’s degree (B.A.)' WHEN 2 THEN 'Other doctoral degree' WHEN 3 THEN 'Professional degree (JD)' END",
    "JobSat": "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2000 THEN 'Very dissatisfied' WHEN c_acctbal < 4000 THEN 'Slightly dissatisfied' WHEN c_acctbal < 6000 THEN 'Neither satisfied nor dissatisfied' WHEN c_acctbal < 8000 THEN 'Slightly satisfied' ELSE 'Very satisfied' END",
    "Gender": "CASE c_custkey % 3 WHEN 0 THEN 'Woman' WHEN 1 THEN 'Man' END",
    "LanguageWorkedWith": "priorities",
    "LanguageDesireNextYear": "statuses",
    "OrgSize": "c_mktsegment",
    "YearsCodePro": "CASE WHEN c_nationkey = 0 THEN 'Less than 1 year' WHEN c_nationkey = 24 THEN 'More than 50 years' WHEN c_nationkey <> 7 THEN CAST(c_nationkey AS {text}) END",
    "Age1stCode": "CASE WHEN c_nationkey = 3 THEN 'Younger than 5 years' WHEN c_nationkey = 4 THEN 'Older than 85' ELSE CAST(c_nationkey + 5 AS {text}) END",
    "Age": "CASE WHEN c_acctbal >= 0 THEN 18 + c_acctbal / 250 END",
    "ConvertedComp": "top_price",
    "CompTotal": "low_price",
    "WorkWeekHrs": "n_orders * 7.5",
}
SURVEY_COLUMNS = list(_SURVEY)


def survey(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """Customers as respondents; their orders (of one year, if given) give the multi-choice cells and amounts."""
    orders = table(spark, folder, "orders")
    if year:
        orders = orders.filter((F.col("o_orderdate") >= f"{year}-01-01") & (F.col("o_orderdate") < f"{year + 1}-01-01"))
    orders = orders.groupBy("o_custkey").agg(
        # At most five priorities and three statuses exist, so these sets stay tiny.
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";").alias("priorities"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ";").alias("statuses"),
        F.max("o_totalprice").alias("top_price"), F.min("o_totalprice").alias("low_price"),
        F.count(F.lit(1)).cast("double").alias("n_orders"),
    )
    rows = table(spark, folder, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.selectExpr(*[f"{e.format(text='string')} AS {c}" for c, e in _SURVEY.items()])


def survey_sql(name: str = "survey", year: int | None = None) -> str:
    columns = ",\n".join(f'{e.format(text="varchar")} AS "{c}"' for c, e in _SURVEY.items())
    return f"""{name} AS (
  SELECT {columns}
  FROM customer LEFT JOIN (
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities,
           string_agg(DISTINCT o_orderstatus, ';' ORDER BY o_orderstatus) AS statuses,
           max(o_totalprice) AS top_price, min(o_totalprice) AS low_price, CAST(count(*) AS double) AS n_orders
    FROM orders {f"WHERE year(o_orderdate) = {year}" if year else ""} GROUP BY o_custkey) o ON c_custkey = o_custkey)"""


HIGHER_ED_SQL = """CASE WHEN "EdLevel" LIKE '%Master’s%' OR "EdLevel" LIKE '%Doctoral%' OR "EdLevel" LIKE '%Professional%' THEN 1 ELSE 0 END"""
JOB_SATISFIED_SQL = """CASE WHEN "JobSat" LIKE '% satisfied' THEN 1 ELSE 0 END"""


def flagged_sql(name: str = "survey", year: int | None = None) -> str:
    """The survey with its two derived flags, under ``name``."""
    return survey_sql(f"{name}_raw", year) + f""",
{name} AS (SELECT *, {HIGHER_ED_SQL} AS "HigherEd", {JOB_SATISFIED_SQL} AS "JobSatisfied" FROM {name}_raw)"""


# -- messages ----------------------------------------------------------------------------------

LABELS = ["quality", "toxic", "either", "none"]


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr(
        "doc_id AS id", "text AS message", "source AS original", "lang AS genre"
    )


def packed_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Packed cells; ``either`` may be 2, ``none`` is always 0."""
    return table(spark, folder, "labels").selectExpr(
        "doc_id AS id",
        "concat('quality-', quality, ';toxic-', toxic, ';either-', quality + toxic, ';none-0') AS categories",
    )


MESSAGES_SQL = """messages AS (SELECT doc_id AS id, text AS message, source AS original, lang AS genre FROM documents),
categories AS (SELECT doc_id AS id, concat('quality-', quality, ';toxic-', toxic, ';either-', quality + toxic, ';none-0') AS categories FROM labels)"""
CLEAN_MESSAGES_SQL = MESSAGES_SQL + """,
labelled AS (
  SELECT m.*, l.quality, l.toxic, CASE WHEN l.quality + l.toxic = 0 THEN 0 ELSE 1 END AS either, 0 AS "none"
  FROM messages m JOIN labels l ON m.id = l.doc_id WHERE m.message IS NOT NULL),
clean AS (SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY message ORDER BY id) = 1)"""

# -- census ------------------------------------------------------------------------------------

_CENSUS = {
    "id": "l_orderkey * 10 + l_linenumber",
    "age": "l_quantity",
    "education-num": "CAST(l_linenumber AS double)",
    "capital-gain": "CASE WHEN l_returnflag = 'R' THEN l_quantity * l_extendedprice ELSE 0 END",
    "capital-loss": "CASE WHEN l_discount > 0.05 THEN l_discount * 10000 ELSE 0 END",
    "hours-per-week": "l_tax * 500",
    "workclass": "CASE l_returnflag WHEN 'A' THEN 'Private' WHEN 'N' THEN 'Self-emp' ELSE 'State-gov' END",
    "sex": "CASE l_linestatus WHEN 'F' THEN 'Female' ELSE 'Male' END",
    "income": "CASE WHEN l_quantity * 1500 + l_extendedprice > 100000 THEN '>50K' ELSE '<=50K' END",
}


def census(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} AS `{c}`" for c, e in _CENSUS.items()])


CENSUS_SQL = "census AS (SELECT {} FROM lineitem)".format(", ".join(f'{e} AS "{c}"' for c, e in _CENSUS.items()))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, label, prediction): a stated rule as the predictor, so the scores have an exact answer."""
    return census(spark, folder).select(
        "id", (_q("income") == ">50K").cast("double").alias("label"),
        ((_q("age") > 25) & (_q("education-num") < 6)).cast("double").alias("prediction"),
    )


PREDICTIONS_SQL = CENSUS_SQL + """,
predictions AS (SELECT id, CASE WHEN income = '>50K' THEN 1.0::double ELSE 0 END AS label,
  CASE WHEN age > 25 AND "education-num" < 6 THEN 1.0::double ELSE 0 END AS prediction FROM census)"""
