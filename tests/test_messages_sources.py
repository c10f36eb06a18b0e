import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge import fixed_values as fixed
from tallyforge import workspace
from tallyforge.functions.text import content_words, tokenize
from tallyforge.operators import labels as L
from tallyforge.operators import textfeatures as T
from tallyforge.operators.grouping import label_counts_with_word
from tallyforge.ml.score import advice_links, with_advice
from tallyforge.schemas import CLICKS, DICTIONARY
from tallyforge.sources import files, tables

MESSAGES = [(1, "Need HELP", None, "direct"), (2, "no water", None, "news"), (3, "Need HELP", None, "direct"), (4, None, None, "news"), (5, "!!!", None, "social")]
CELLS = [(1, "related-1;water-0;fire-0;child-0"), (2, "related-2;water-1;fire-1;child-0"), (3, "related-0;water-0;fire-0;child-0"),
         (4, "related-1;water-0;fire-0;child-0"), (5, "related-0;water-0;fire-0;child-0")]
NAMES = ["related", "water", "fire", "child"]


@pytest.fixture(scope="module")
def joined(spark):
    messages = spark.createDataFrame(MESSAGES, "id bigint, message string, original string, genre string")
    cells = spark.createDataFrame(CELLS, "id bigint, categories string")
    return tables.join_on_id(messages, cells)


def test_names_come_from_the_first_row(joined):
    assert rows(L.label_names(joined)) == list(enumerate(NAMES))
    assert L.split_labels(joined).columns == ["id", "message", "original", "genre", *NAMES]


def test_clean_messages(joined):
    got = L.clean_messages(joined)
    assert rows(got.select("id", *NAMES)) == [(1, 1, 0, 0, 0), (2, 1, 1, 1, 0), (5, 0, 0, 0, 0)]
    assert rows(L.drop_unlabelled(got, NAMES).select("id")) == [(1,), (2,)]
    assert L.drop_rare_labels(got, NAMES).columns == ["id", "message", "original", "genre", "related"]  # totals 2, 1, 1, 0
    assert rows(label_counts_with_word(got, "help", "related")) == [(1, 1)]
    assert rows(label_counts_with_word(got, "help", "related", ignore_case=False)) == []


def test_repeated_keys(joined):
    assert rows(tables.repeated_keys(joined)) == []
    assert rows(tables.repeated_keys(joined.union(joined.limit(1)))) [0][1] == 2


def test_store_and_load(spark, joined, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(joined.limit(1), path)
    stored = tables.replace_table(L.clean_messages(joined), path)
    texts, labels, names = tables.load_labelled(stored)
    assert names == NAMES and texts.columns == ["id", "message"] and labels.count() == 3


def test_csv_with_quotes_line_breaks_and_tokens(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,text,age\n1,"said ""hi"", twice\nand left",30\n2,NA,old\n3,plain,NaN\n4,"",7.5\n')
    got = rows(files.read_table_csv(spark, str(path), ["id", "text", "age"], {"id": "bigint", "age": "double"}, multi_line=True))
    assert got == [(1, 'said "hi", twice\nand left', 30.0), (2, None, None), (3, "plain", None), (4, None, 7.5)]


def test_event_log(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text('{"userId":"7","ts":5,"page":"Home","length":1.5,"extra":1}\n{"userId":"","ts":6}\n')
    df = files.read_event_log(spark, str(path))
    assert df.schema == CLICKS
    assert rows(df.select("userId", "ts", "length")) == [("", 6, None), ("7", 5, 1.5)]


def test_dictionaries(spark):
    one = spark.createDataFrame([("Age", "How old?"), ("JobSat", "How happy?")], DICTIONARY)
    other = spark.createDataFrame([("Age", "Age?"), ("Gender", "?")], DICTIONARY)
    assert rows(tables.column_description(one, "Age")) == [("Age", "How old?")]
    assert rows(tables.shared_columns(one, other)) == [("Age",)]


def test_term_weights(spark):
    df = spark.createDataFrame([(1, "cat cat hat"), (2, "cat dog"), (3, "the")], "id bigint, text string")
    assert rows(T.term_counts(df, "id", content_words("text"))) == [(1, "cat", 2), (1, "hat", 1), (2, "cat", 1), (2, "dog", 1)]
    from math import log, sqrt
    cat, hat = 2 * (log(4 / 3) + 1), log(4 / 2) + 1
    got = {(r.id, r.term): r.weight for r in T.tf_idf(df, "id", content_words("text")).collect()}
    assert got[1, "cat"] == pytest.approx(cat / sqrt(cat**2 + hat**2))
    counts = T.term_counts(df, "id", content_words("text"))
    assert rows(T.vocabulary(counts, 3, max_features=2), F.desc("total"), "term") == [("cat", 3, 2), ("dog", 1, 1)]
    assert rows(T.vocabulary(counts, 3, max_df=0.5).select("term")) == [("dog",), ("hat",)]


def test_lemmas_and_regrouping(spark):
    df = spark.createDataFrame([(1, "cats like cats"), (2, "dogs")], "id bigint, text string")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    long = T.normalise_tokens(df, lemmas, "id", tokenize("text"))
    assert rows(T.regroup_tokens(long, "id")) == [(1, ["cat", "like", "cat"]), (2, ["dogs"])]


def test_advice(spark):
    assert len(fixed.ADVICE_LINKS) == 33 and len(fixed.STOP_WORDS) == 179
    labels = spark.createDataFrame([("fire", 1), ("none", 0)], "label_name string, prediction int")
    got = {r.label_name: r.link for r in with_advice(labels, advice_links(spark)).collect()}
    assert got == {"fire": fixed.FIRE_LINK, "none": None}


def test_checkpoint_goes_to_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert workspace.shared_dir(spark) == named
    assert workspace.scratch_path(spark, "x").startswith(named)
    kept = workspace.cut_lineage(spark.range(5))
    assert rows(kept) == [(i,) for i in range(5)]
    assert named in spark.sparkContext.getCheckpointDir()


def test_term_places_and_sparse_rows(spark):
    from tallyforge.ml import textmodel as Tm

    df = spark.createDataFrame([(1, ["b", "a", "a"]), (2, ["c", "a", "b"]), (3, []), (4, None), (5, ["b", "a", "a"]), (6, ["zz"])], "id int, terms array<string>")
    counts = df.select("id", F.explode("terms").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    index = T.term_index(counts.repartition(7), 6)
    assert rows(index.select("term_id", "term", "total", "df"), "term_id") == [(0, "a", 5, 3), (1, "b", 3, 3), (2, "c", 1, 1), (3, "zz", 1, 1)]
    assert rows(T.term_index(counts, 6, max_features=3).select("term"), "term") == [("a",), ("b",), ("c",)]  # of equal totals the first term
    assert rows(T.term_index(counts, 6, max_df=0.4).select("term_id", "term"), "term_id") == [(0, "c"), (1, "zz")]
    assert T.term_index(counts.limit(0), 0).count() == 0
    model = Tm.TermVectors(outputCol="v", weights="counts").fit(df)
    got = {r.id: (r.v.size, r.v.indices.tolist(), r.v.values.tolist()) for r in model.transform(df).collect()}
    assert got == {1: (4, [0, 1], [2.0, 1.0]), 2: (4, [0, 1, 2], [1.0, 1.0, 1.0]), 3: (4, [], []), 4: (4, [], []), 5: (4, [0, 1], [2.0, 1.0]), 6: (4, [3], [1.0])}
