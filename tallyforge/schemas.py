"""Explicit schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

CLICKS = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("page", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("registration", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("artist", T.StringType()),
    T.StructField("song", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("status", T.LongType()),
])

DICTIONARY = T.StructType([
    T.StructField("Column", T.StringType()),
    T.StructField("QuestionText", T.StringType()),
])

MESSAGES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("original", T.StringType()),
    T.StructField("genre", T.StringType()),
])

PACKED_LABELS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("categories", T.StringType()),
])

CENSUS = T.StructType([
    T.StructField("age", T.DoubleType()),
    T.StructField("workclass", T.StringType()),
    T.StructField("education_level", T.StringType()),
    T.StructField("education-num", T.DoubleType()),
    T.StructField("marital-status", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("relationship", T.StringType()),
    T.StructField("race", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("capital-gain", T.DoubleType()),
    T.StructField("capital-loss", T.DoubleType()),
    T.StructField("hours-per-week", T.DoubleType()),
    T.StructField("native-country", T.StringType()),
    T.StructField("income", T.StringType()),
])

# Survey columns that hold numbers; every other column stays text.
SURVEY_NUMBERS = {
    "Respondent": "bigint",
    "Age": "double",
    "CompTotal": "double",
    "ConvertedComp": "double",
    "WorkWeekHrs": "double",
}


def numeric_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
