"""Survey queries: customers as respondents, orders of 1999 and 2000 as two survey years."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import exprs as E
from ..operators import choices as Ch
from ..operators import clean as C
from ..operators import grouping as G
from ..operators import profile as P
from ..plans.survey import with_flags
from ..sources.files import read_table_csv
from ..sources.tables import column_description, describe_columns, dictionary_of, read_dictionary, shared_columns
from ..workspace import scratch_path
from .registry import query, rounded, table
from .stand_ins import HIGHER_ED_SQL, JOB_SATISFIED_SQL, SURVEY_COLUMNS, flagged_sql, histogram_sql, survey, survey_sql

S = f"WITH {survey_sql()} "
TWO = f"WITH {survey_sql('s19', 1999)}, {survey_sql('s20', 2000)}"
FLAGS = f"WITH {flagged_sql()}"
NUMBERS = ["Age", "ConvertedComp", "CompTotal", "WorkWeekHrs"]
TEXTS = [c for c in SURVEY_COLUMNS if c not in NUMBERS + ["Respondent"]]


def flagged(spark, folder, year=None):
    return with_flags(survey(spark, folder, year))


# -- files and dictionaries --------------------------------------------------------------------


@query("S2", S + "SELECT * FROM survey")
def survey_from_csv(spark, folder):
    path = scratch_path(spark, "survey-csv")
    survey(spark, folder).write.option("header", True).option("nullValue", "NA").option("escape", '"').csv(path)
    types = {"Respondent": "bigint", **{c: "double" for c in NUMBERS}}
    return read_table_csv(spark, path, SURVEY_COLUMNS, types)


DICTIONARY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"Column\", '{t}' AS \"QuestionText\"" for c, t in
    [(c, {"Respondent": "bigint", **{n: "double" for n in NUMBERS}}.get(c, "string")) for c in SURVEY_COLUMNS])


def stored_dictionary(spark, folder):
    path = scratch_path(spark, "dictionary-csv")
    dictionary_of(survey(spark, folder)).write.option("header", True).csv(path)
    return read_dictionary(spark, path)


@query("S6 P7", FLAGS.replace("WITH ", "WITH d AS (" + DICTIONARY_SQL + "), ", 1) + """,
  m AS (SELECT """ + ", ".join(f'avg(("{c}" IS NULL)::int) AS "{c}"' for c in SURVEY_COLUMNS) + """ FROM survey
        WHERE (""" + " + ".join(f'("{c}" IS NULL)::int' for c in SURVEY_COLUMNS) + f""") / {len(SURVEY_COLUMNS)}.0 > 0.25),
  o AS (""" + " UNION ALL ".join(f"""SELECT '{c}' AS "OutlierLabels", "{c}" AS "OutlierValues" FROM m""" for c in SURVEY_COLUMNS) + """)
  SELECT "OutlierLabels", round("OutlierValues", 6) AS "OutlierValues", "QuestionText" FROM o JOIN d ON "OutlierLabels" = "Column" WHERE "OutlierValues" > 0.3""")
def sparse_columns_described(spark, folder):
    rows = survey(spark, folder)
    sparse = P.sparse_columns_of_sparse_rows(rows, 0.25, 0.3)
    return rounded(describe_columns(sparse, stored_dictionary(spark, folder), "OutlierLabels"), "OutlierValues")


@query("S6", "SELECT * FROM (" + DICTIONARY_SQL + """) WHERE "Column" = 'ConvertedComp'""")
def one_column_described(spark, folder):
    return column_description(stored_dictionary(spark, folder), "ConvertedComp")


@query("S7 J7", """SELECT column_name AS "Column" FROM duckdb_columns() WHERE table_name = 'lineitem'
  INTERSECT SELECT column_name FROM (SELECT unnest(['l_orderkey', 'l_quantity', 'l_tax', 'year']) AS column_name)""")
def columns_in_both_dictionaries(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    other = lineitem.select("l_tax", "l_quantity", "l_orderkey", F.year("l_shipdate").alias("year"))
    return shared_columns(dictionary_of(lineitem), dictionary_of(other))


# -- missing values ----------------------------------------------------------------------------

_MISSING = " + ".join(f'("{c}" IS NULL)::int' for c in SURVEY_COLUMNS)


@query("P4", S + f'SELECT "Respondent", round(({_MISSING}) / {len(SURVEY_COLUMNS)}.0::double, 9) AS "MissingRows" FROM survey')
def missing_share_per_row(spark, folder):
    return rounded(P.with_missing_share(survey(spark, folder)), "MissingRows", digits=9).select("Respondent", "MissingRows")


_SHARES = S + ", m AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "OutlierLabels", avg(("{c}" IS NULL)::int) AS "OutlierValues" FROM survey""" for c in SURVEY_COLUMNS) + """)
  SELECT "OutlierLabels", round("OutlierValues", 9) AS "OutlierValues" FROM m"""


@query("P5", _SHARES)
def missing_share_per_column(spark, folder):
    return rounded(P.missing_shares(survey(spark, folder)), "OutlierValues", digits=9)


@query("P6", _SHARES + ' WHERE "OutlierValues" > 0.15')
def sparse_columns(spark, folder):
    return rounded(P.sparse_columns(survey(spark, folder), 0.15), "OutlierValues", digits=9)


_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in SURVEY_COLUMNS)


@query("P8", S + f"SELECT count(*) AS rows_before, count(*) FILTER ({_COMPLETE}) AS rows_after, {len(SURVEY_COLUMNS)}::bigint AS n_columns FROM survey")
def complete_row_shape(spark, folder):
    return P.complete_row_shape(survey(spark, folder))


@query("P8", S + f"SELECT * FROM survey WHERE {_COMPLETE}")
def complete_rows(spark, folder):
    return C.drop_incomplete(survey(spark, folder))


@query("P9", S + """SELECT * FROM survey WHERE "JobSat" IS NOT NULL AND "Gender" IS NOT NULL""")
def rows_with_answers(spark, folder):
    return C.drop_incomplete(survey(spark, folder), ["JobSat", "Gender"])


@query("P10", S + 'SELECT "Respondent", "Age" FROM survey')
def without_empty_columns(spark, folder):
    rows = survey(spark, folder).select("Respondent", "Age", F.lit(None).cast("string").alias("Unused"), F.lit(float("nan")).alias("Broken"))
    return C.drop_empty_columns(rows)


@query("P15", S + "SELECT \"Respondent\", " + ", ".join(f'round(coalesce("{c}", avg("{c}") OVER ()), 4) AS "{c}"' for c in NUMBERS) + " FROM survey")
def numbers_filled_with_means(spark, folder):
    filled = C.fill_means(survey(spark, folder).select("Respondent", *NUMBERS), NUMBERS)
    return rounded(filled, *NUMBERS, digits=4)


@query("P16", S + "SELECT \"Respondent\", " + ", ".join(f'round_even(coalesce("{c}", avg("{c}") OVER ()), 0) AS "{c}"' for c in NUMBERS) + " FROM survey")
def numbers_imputed_and_rounded(spark, folder):
    return C.impute_rounded(survey(spark, folder).select("Respondent", *NUMBERS), NUMBERS)


YEARS_SQL = """CASE "YearsCodePro" WHEN 'Less than 1 year' THEN 0.5 WHEN 'More than 50 years' THEN 51 ELSE TRY_CAST("YearsCodePro" AS double) END"""
FIRST_SQL = """CASE "Age1stCode" WHEN 'Younger than 5 years' THEN 4 WHEN 'Older than 85' THEN 86 ELSE TRY_CAST("Age1stCode" AS double) END"""


@query("P17", S + f'SELECT "Respondent", ({YEARS_SQL})::double AS "YearsCodePro", ({FIRST_SQL})::double AS "Age1stCode" FROM survey')
def words_to_numbers(spark, folder):
    rows = survey(spark, folder).select("Respondent", "YearsCodePro", "Age1stCode")
    return C.words_to_numbers(rows, {"YearsCodePro": fixed.YEARS_WORDS, "Age1stCode": fixed.FIRST_CODE_WORDS})


@query("P18", S + 'SELECT "Respondent", ' + ", ".join(f'"{c}"' for c in NUMBERS) + " FROM survey")
def without_text_columns(spark, folder):
    return C.drop_text_columns(survey(spark, folder))


@query("P19", S + """SELECT "Respondent", TRY_CAST("YearsCodePro" AS double) AS "YearsCodePro" FROM survey WHERE TRY_CAST("YearsCodePro" AS double) IS NOT NULL""")
def rows_with_numeric_years(spark, folder):
    return C.numeric_text_rows(survey(spark, folder).select("Respondent", "YearsCodePro"), "YearsCodePro")


@query("P20", S + """SELECT * FROM survey WHERE ('0x' || substr(md5('42|' || "Respondent"), 1, 8))::bigint < 0.1::double * 4294967296""")
def random_sample(spark, folder):
    return C.sample_rows(survey(spark, folder), 0.1, 42, ["Respondent"])


@query("P21", S + 'SELECT * FROM survey ORDER BY "ConvertedComp" NULLS FIRST, "Respondent" LIMIT 10')
def first_rows(spark, folder):
    return C.first_rows(survey(spark, folder), 10, ["ConvertedComp", "Respondent"])


# -- expressions -------------------------------------------------------------------------------


@query("E6 E7", S + f'SELECT "Respondent", "EdLevel", "JobSat", {HIGHER_ED_SQL} AS "HigherEd", {JOB_SATISFIED_SQL} AS "JobSatisfied" FROM survey')
def degree_and_satisfaction_flags(spark, folder):
    return flagged(spark, folder).select("Respondent", "EdLevel", "JobSat", "HigherEd", "JobSatisfied")


@query("E13", S + """SELECT "Respondent", "YearsCodePro" FROM survey WHERE "YearsCodePro" > '5' OR "YearsCodePro" < '10'""")
def years_between_as_text(spark, folder):
    return survey(spark, folder).filter(E.between_years("YearsCodePro", 5, 10, "text")).select("Respondent", "YearsCodePro")


@query("E13", S + """SELECT "Respondent", "YearsCodePro" FROM survey WHERE TRY_CAST("YearsCodePro" AS double) > 5 AND TRY_CAST("YearsCodePro" AS double) < 10""")
def years_between_as_numbers(spark, folder):
    return survey(spark, folder).filter(E.between_years("YearsCodePro", 5, 10)).select("Respondent", "YearsCodePro")


def _bins_sql(column: str, bins: int, source: str = "survey") -> str:
    """Rounded edges listed in full, then the first bin that holds the value."""
    return f"""filled AS (SELECT *, round_even(coalesce("{column}", avg("{column}") OVER ()), 0) AS x FROM {source}),
  r AS (SELECT min(x) AS lo, max(x) AS hi FROM filled),
  e AS (SELECT i, round_even(CASE WHEN i = 0 THEN lo - (hi - lo) * 0.001 WHEN i = {bins} THEN hi ELSE lo + (hi - lo) / {bins} * i END, 3) AS edge
        FROM r, range(0, {bins + 1}) t(i)),
  b AS (SELECT a.i + 1 AS bin, a.edge AS lft, z.edge AS rgt FROM e a JOIN e z ON z.i = a.i + 1),
  v AS (SELECT x, arg_min(round_even((lft + rgt) / 2, 0), bin) AS mid FROM (SELECT DISTINCT x FROM filled), b WHERE lft <= x AND x <= rgt GROUP BY x),
  binned AS (SELECT filled.*, coalesce(mid, round_even(filled.x, 0)) AS "{column}Categorized" FROM filled LEFT JOIN v ON filled.x = v.x)"""


@query("E14", S + ", " + _bins_sql("ConvertedComp", 20) + 'SELECT "Respondent", x AS "ConvertedComp", "ConvertedCompCategorized" FROM binned')
def salary_bins(spark, folder):
    return Ch.bin_midpoints(survey(spark, folder).select("Respondent", "ConvertedComp"), "ConvertedComp", 20)


@query("E14", S + ", " + _bins_sql("Age", 40) + 'SELECT "Respondent", x AS "Age", "AgeCategorized" FROM binned')
def age_bins(spark, folder):
    return Ch.bin_midpoints(survey(spark, folder).select("Respondent", "Age"), "Age", 40)


# -- choices -----------------------------------------------------------------------------------


def _counts_sql(field: str, source: str = "survey", where: str = "true") -> str:
    return f"""SELECT choice, count(*) AS n FROM (SELECT unnest(string_split(coalesce("{field}", 'nan'), ';')) AS choice FROM {source} WHERE {where}) GROUP BY choice"""


@query("A14", S + _counts_sql("LanguageWorkedWith"))
def choice_counts(spark, folder):
    return Ch.choice_counts(survey(spark, folder), "LanguageWorkedWith")


@query("A14", S + _counts_sql("LanguageWorkedWith", where=""""Gender" = 'Woman'"""))
def choice_counts_of_women(spark, folder):
    return Ch.choice_counts(survey(spark, folder), "LanguageWorkedWith", {"Gender": "Woman"})


@query("A14", S + f', c AS ({_counts_sql("YearsCodePro")}) ' + """SELECT bool_or(coalesce(isfinite(TRY_CAST(choice AS double)), false)) AS is_numerical_field FROM c""")
def has_number_choice(spark, folder):
    return Ch.has_number_choice(Ch.choice_counts(survey(spark, folder), "YearsCodePro"))


@query("A15", S + f', c AS ({_counts_sql("LanguageWorkedWith")}) ' + "SELECT choice, round_even(n / (SELECT count(*) FROM c) * 1000, 0) / 1000 AS share FROM c")
def choice_shares_by_choices(spark, folder):
    return Ch.choice_shares(survey(spark, folder), "LanguageWorkedWith", norm="choices")


@query("A15", S + f', c AS ({_counts_sql("LanguageWorkedWith")}) ' + "SELECT choice, round_even(n / (SELECT count(*) FROM survey) * 1000, 0) / 1000 AS share FROM c")
def choice_shares_by_respondents(spark, folder):
    return Ch.choice_shares(survey(spark, folder), "LanguageWorkedWith")


@query("A15", S + " UNION ALL ".join(f"SELECT '{c}' AS field, choice, n FROM ({_counts_sql(c)})" for c in TEXTS))
def choice_counts_of_all_columns(spark, folder):
    return Ch.choice_counts_of_columns(survey(spark, folder))


def _compare_sql(field: str, group: str, v0, v1, source: str = "survey") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return f"""c0 AS ({_counts_sql(field, source, f'"{group}" = {lit(v0)}')}), c1 AS ({_counts_sql(field, source, f'"{group}" = {lit(v1)}')}),
  p0 AS (SELECT choice, round_even(n / (SELECT count(*) FROM c0) * 1000, 0) / 1000 AS s FROM c0),
  p1 AS (SELECT choice, round_even(n / (SELECT count(*) FROM c1) * 1000, 0) / 1000 AS s FROM c1)
  SELECT choice, p1.s AS "{group}_{v1}_perc", p0.s AS "{group}_{v0}_perc", round(p1.s - p0.s, 6) AS "{group}_Diff_Vals" FROM p1 JOIN p0 USING (choice)"""


@query("J2", FLAGS + ", " + _compare_sql("LanguageWorkedWith", "HigherEd", 0, 1))
def languages_by_degree(spark, folder):
    return rounded(Ch.compare_groups(flagged(spark, folder), "LanguageWorkedWith", "HigherEd", [0, 1], "choices"), "HigherEd_Diff_Vals")


@query("J2", FLAGS + ", " + _compare_sql("MainBranch", "Gender", "Man", "Woman"))
def branches_by_gender(spark, folder):
    return rounded(Ch.compare_groups(flagged(spark, folder), "MainBranch", "Gender", ["Man", "Woman"], "choices"), "Gender_Diff_Vals")


@query("J2 E14", FLAGS + ", " + _bins_sql("WorkWeekHrs", 20) + """,
  k AS (SELECT *, CAST(CAST("WorkWeekHrsCategorized" AS bigint) AS varchar) AS hours FROM binned), """ + _compare_sql("hours", "JobSatisfied", 0, 1, "k"))
def hours_by_satisfaction(spark, folder):
    binned = Ch.bin_midpoints(flagged(spark, folder), "WorkWeekHrs", 20)
    return rounded(Ch.compare_groups(binned, "WorkWeekHrsCategorized", "JobSatisfied", [0, 1], "choices"), "JobSatisfied_Diff_Vals")


def _share_sql(name: str, field: str, source: str) -> str:
    return f"""{name}c AS ({_counts_sql(field, source)}), {name} AS (SELECT choice, round_even(n / (SELECT count(*) FROM {name}c) * 1000, 0) / 1000 AS s FROM {name}c)"""


@query("J3", TWO + ", " + _share_sql("a", "LanguageDesireNextYear", "s20") + ", " + _share_sql("b", "LanguageDesireNextYear", "s19") + """
  SELECT choice, a.s AS share_2020, b.s AS share_2019, round(a.s - b.s, 6) AS "Diff_Vals" FROM a JOIN b USING (choice)""")
def choices_of_two_years(spark, folder):
    later, earlier = [Ch.choice_shares(survey(spark, folder, y), "LanguageDesireNextYear", norm="choices") for y in (2000, 1999)]
    return rounded(Ch.compare_shares(later, earlier, "share_2020", "share_2019"), "Diff_Vals")


@query("J4", TWO + ", " + _share_sql("a", "LanguageWorkedWith", "s20") + ", " + _share_sql("b", "LanguageWorkedWith", "(SELECT * FROM s19 WHERE \"Gender\" = 'Man' AND \"JobSat\" IS NULL)") + """
  SELECT choice, round(a.s - b.s, 6) AS "PercentageWorkedWith" FROM (SELECT * FROM a WHERE choice <> 'nan') a FULL JOIN (SELECT * FROM b WHERE choice <> 'nan') b USING (choice)""")
def yearly_change_of_choices(spark, folder):
    later = Ch.choice_shares(survey(spark, folder, 2000), "LanguageWorkedWith", norm="choices")
    earlier = Ch.choice_shares(
        survey(spark, folder, 1999).filter("Gender = 'Man' and JobSat is null"), "LanguageWorkedWith", norm="choices")
    return rounded(Ch.yearly_change(later, earlier), "PercentageWorkedWith")


HOT_FIELDS = ["LanguageWorkedWith", "LanguageDesireNextYear", "EdLevel"]
HOT = [("LanguageWorkedWith", c) for c in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOTSPECIFIED", "5-LOW", "nan"]] + [
    ("LanguageDesireNextYear", c) for c in ["F", "O", "P", "nan"]] + [
    ("EdLevel", c) for c in ["Bachelor’sdegree(B.A.)", "Master’sdegree(M.A.)", "Otherdoctoraldegree", "Professionaldegree(JD)", "nan"]]


@query("W12 A20", S + ", h AS (SELECT \"Respondent\", " + ", ".join(
    f"""CASE WHEN list_contains(string_split(replace(coalesce("{f}", 'nan'), ' ', ''), ';'), '{c}') THEN 1 ELSE 0 END AS "{f}_{c}\"""" for f, c in HOT) + """ FROM survey)
  SELECT column_name, total FROM (""" + " UNION ALL ".join(f"""SELECT '{f}_{c}' AS column_name, sum("{f}_{c}")::bigint AS total, avg("{f}_{c}") AS m FROM h""" for f, c in HOT) + ") WHERE m >= 0.2")
def multi_hot_totals(spark, folder):
    hot = Ch.multi_hot(survey(spark, folder).select("Respondent", *HOT_FIELDS), 0.2)
    names = [c for c in hot.columns if c != "Respondent"]
    return G.column_totals(hot, names).select("column_name", F.col("total").cast("bigint").alias("total"))


# -- group means -------------------------------------------------------------------------------

WHERE_SQL = """"MainBranch" = 'I am a developer by profession' AND "Gender" IN ('Man', 'Woman') AND ("YearsCodePro" > '5' OR "YearsCodePro" < '10')"""


def professionals(rows):
    return (rows["MainBranch"] == "I am a developer by profession") & rows["Gender"].isin("Man", "Woman") & E.between_years("YearsCodePro", 5, 10, "text")


@query("A16", S + f'SELECT "Gender", "EdLevel", round(avg("ConvertedComp"), 4) AS mean_value FROM survey WHERE {WHERE_SQL} AND "EdLevel" IS NOT NULL GROUP BY ALL')
def salary_by_gender_and_degree(spark, folder):
    rows = survey(spark, folder)
    return rounded(G.group_means(rows, "ConvertedComp", ["Gender", "EdLevel"], professionals(rows)), "mean_value", digits=4)


@query("J5 A16", TWO + "".join(f""", m{y} AS (SELECT "EdLevel", avg("ConvertedComp") AS m FROM s{y} WHERE {WHERE_SQL} AND "EdLevel" IS NOT NULL GROUP BY "EdLevel")""" for y in ("19", "20")) + """
  SELECT "EdLevel", round(m20.m, 4) AS "ConvertedComp_2020", round(m19.m, 4) AS "ConvertedComp_2019", round(m20.m - m19.m, 4) AS "Diff_Vals" FROM m20 JOIN m19 USING ("EdLevel")""")
def salary_by_degree_and_year(spark, folder):
    means = []
    for year in (2000, 1999):
        rows = survey(spark, folder, year)
        means.append(G.group_means(rows, "ConvertedComp", ["EdLevel"], professionals(rows)))
    names = ["ConvertedComp_2020", "ConvertedComp_2019"]
    return rounded(G.compare_group_means(*means, ["EdLevel"], names), *names, "Diff_Vals", digits=4)


_PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i:]]


@query("A18", S + " UNION ALL ".join(f"""SELECT '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS r FROM survey""" for a, b in _PAIRS))
def survey_correlations(spark, folder):
    return rounded(P.correlations(survey(spark, folder), NUMBERS), "r")


@query("A17", S + """, v AS (SELECT "ConvertedComp" AS x FROM survey WHERE "ConvertedComp" IS NOT NULL), """ + histogram_sql("v", 25))
def salary_histogram(spark, folder):
    return rounded(P.histogram(survey(spark, folder), "ConvertedComp", 25), "bin_left", "bin_right", digits=4)
