"""Message queries: documents as messages, labels as packed label cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import exprs as E
from ..functions.text import content_words, drop_stop_words, tokenize
from ..operators import clean as C
from ..operators import grouping as G
from ..operators import labels as L
from ..operators import textfeatures as T
from ..plans.messages import stored_messages
from ..sources.tables import join_on_id, load_labelled, repeated_keys
from ..workspace import scratch_path
from .registry import query, rounded, table
from .stand_ins import CLEAN_MESSAGES_SQL, LABELS, MESSAGES_SQL, messages, packed_labels

M = f"WITH {MESSAGES_SQL} "
CLEAN = f"WITH {CLEAN_MESSAGES_SQL} "


def joined(spark, folder):
    return join_on_id(messages(spark, folder), packed_labels(spark, folder))


def clean(spark, folder):
    return L.clean_messages(joined(spark, folder), LABELS)


@query("S8", M + "SELECT id, message, original, genre, categories FROM messages JOIN categories USING (id)")
def messages_with_labels(spark, folder):
    return joined(spark, folder)


@query("S8", M + "SELECT message, count(*) AS copies FROM messages GROUP BY message HAVING count(*) > 1")
def repeated_messages(spark, folder):
    return repeated_keys(messages(spark, folder), "message")


@query("E9", "SELECT * FROM (VALUES (0, 'quality'), (1, 'toxic'), (2, 'either'), (3, 'none')) t(position, label_name)")
def label_names(spark, folder):
    return L.label_names(packed_labels(spark, folder))


@query("E8", M + """SELECT id, left(c, length(c) - 2) AS label_name, CASE WHEN right(c, 1) IN ('0', '1') THEN right(c, 1)::int ELSE 1 END AS label
  FROM (SELECT id, unnest(string_split(categories, ';')) AS c FROM categories)""")
def label_cells(spark, folder):
    return L.label_cells(packed_labels(spark, folder))


@query("E8 E9", CLEAN + 'SELECT id, message, original, genre, quality, toxic, either, "none" FROM labelled')
def messages_with_label_columns(spark, folder):
    return L.split_labels(joined(spark, folder))


@query("P12 P9 E8 S8", CLEAN + 'SELECT id, message, original, genre, quality, toxic, either, "none" FROM clean')
def cleaned_messages(spark, folder):
    return clean(spark, folder)


@query("P12", M + "SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY message ORDER BY id) = 1")
def first_message_of_each_text(spark, folder):
    return C.first_per_key(messages(spark, folder), "message", ["id"])


@query("S3 S4", CLEAN + 'SELECT id, quality, toxic, either, "none" FROM clean')
def stored_message_labels(spark, folder):
    stored = stored_messages(messages(spark, folder), packed_labels(spark, folder), scratch_path(spark, "messages"), LABELS)
    return load_labelled(stored)[1]


@query("S4", CLEAN + "SELECT id, message FROM clean")
def stored_message_texts(spark, folder):
    stored = stored_messages(messages(spark, folder), packed_labels(spark, folder), scratch_path(spark, "messages"), LABELS)
    return load_labelled(stored)[0]


@query("P22", CLEAN + 'SELECT id, quality, toxic, either, "none" FROM clean WHERE quality + toxic + either + "none" <> 0')
def labelled_messages_only(spark, folder):
    return L.drop_unlabelled(clean(spark, folder), LABELS).select("id", *LABELS)


@query("P23", CLEAN + "SELECT id, quality, toxic, either FROM clean")
def without_rare_labels(spark, folder):
    return L.drop_rare_labels(clean(spark, folder).select("id", *LABELS), LABELS)


@query("E10", M + "SELECT id FROM messages WHERE contains(lower(message), 'contact')")
def messages_with_a_word(spark, folder):
    return messages(spark, folder).filter(E.has_word("message", "contact")).select("id")


@query("E10", M + "SELECT id FROM messages WHERE contains(message, 'the')")
def messages_with_the_case_sensitive(spark, folder):
    return messages(spark, folder).filter(E.has_word("message", "the", ignore_case=False)).select("id")


@query("A12", M + "SELECT genre, count(*) AS n FROM messages GROUP BY genre")
def messages_by_genre(spark, folder):
    return G.value_counts(messages(spark, folder), "genre")


@query("A13", CLEAN + "SELECT quality, count(*) AS n FROM clean WHERE contains(lower(message), 'the') GROUP BY quality")
def quality_of_messages_with_the(spark, folder):
    return G.label_counts_with_word(clean(spark, folder), "the", "quality")


@query("A20", CLEAN + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, sum("{c}")::double AS total, round(avg("{c}"), 9) AS share FROM clean""" for c in LABELS))
def label_totals(spark, folder):
    return rounded(G.column_totals(clean(spark, folder), LABELS), "share", digits=9)


# -- text --------------------------------------------------------------------------------------

_SPLIT = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
for _a, _b in fixed.SPLIT_WORDS:
    _SPLIT = f"regexp_replace({_SPLIT}, '\\b{_a}{_b}\\b', '{_a} {_b}', 'g')"
TOKENS_SQL = f"tokens AS (SELECT doc_id, CASE WHEN {_SPLIT} = '' THEN []::varchar[] ELSE string_split({_SPLIT}, ' ') END AS tokens FROM documents)"
_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in fixed.STOP_WORDS) + "]"
CONTENT_SQL = TOKENS_SQL + f""",
words AS (SELECT doc_id, list_filter(tokens, lambda t: NOT list_contains({_STOP}, t)) AS tokens FROM tokens)"""
DOC_TERMS_SQL = CONTENT_SQL + """,
counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM words) GROUP BY doc_id, term),
terms AS (SELECT term, sum(tf)::bigint AS total, count(*) AS df FROM counts GROUP BY term)"""


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


@query("T1", f"WITH {TOKENS_SQL} SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::int AS n_tokens FROM tokens")
def tokenized_documents(spark, folder):
    return documents(spark, folder).withColumn("t", tokenize("text")).select(
        "doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n_tokens"))


@query("T2", f"WITH {CONTENT_SQL} SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::int AS n_tokens FROM words")
def documents_without_stop_words(spark, folder):
    return documents(spark, folder).withColumn("t", drop_stop_words(tokenize("text"))).select(
        "doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n_tokens"))


# The lemma table of the check: each word that ends in "s" and whose form without it also occurs.
_LEMMA_SQL = DOC_TERMS_SQL + """,
lemmas AS (SELECT a.term AS token, b.term AS lemma FROM terms a JOIN terms b ON a.term = b.term || 's')"""


@query("T3", f"WITH {_LEMMA_SQL}, l AS (SELECT doc_id, unnest(tokens) AS token FROM words) " + """
  SELECT doc_id, coalesce(lemma, l.token) AS token, count(*) AS n FROM l LEFT JOIN lemmas ON l.token = lemmas.token GROUP BY ALL""")
def lemma_counts(spark, folder):
    docs = T.placed_by(documents(spark, folder), "doc_id")
    words = docs.select(F.explode(content_words("text")).alias("token")).distinct()
    lemmas = words.withColumn("plural", F.concat("token", F.lit("s"))).join(
        words.withColumnRenamed("token", "plural"), "plural").select(F.col("plural").alias("token"), F.col("token").alias("lemma"))
    return T.normalise_tokens(docs, lemmas, "doc_id", content_words("text")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("T4", f"WITH {DOC_TERMS_SQL} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, folder):
    return T.term_counts(documents(spark, folder), "doc_id", content_words("text"))


@query("T4", f"WITH {CONTENT_SQL}, g AS (SELECT doc_id, unnest(list_concat(tokens, list_transform(generate_series(1, len(tokens) - 1), lambda i: tokens[i] || ' ' || tokens[i + 1]))) AS term FROM words)" + """,
  c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL), v AS (SELECT term, sum(tf)::bigint AS total, count(*) AS df FROM c GROUP BY term)
  SELECT term, total, df FROM v WHERE df <= 0.8 * (SELECT count(*) FROM documents) ORDER BY total DESC, term LIMIT 10000""")
def vocabulary_of_words_and_pairs(spark, folder):
    docs = documents(spark, folder)
    return T.vocabulary(T.term_counts(docs, "doc_id", content_words("text", 2)), docs.agg(F.count(F.lit(1))).scalar(), 0.8, 10_000)


@query("T4", f"WITH {DOC_TERMS_SQL} SELECT term, total::bigint AS total, df, row_number() OVER (ORDER BY total DESC, term) - 1 AS term_id FROM terms")
def numbered_vocabulary(spark, folder):
    """All terms of all documents with their places."""
    docs = documents(spark, folder)
    return T.term_index(T.term_counts(docs, "doc_id", content_words("text")), docs.count())


def _weights(extra: str = "") -> str:
    return f"""WITH {DOC_TERMS_SQL}, kept AS (SELECT * FROM terms {extra}), n AS (SELECT count(*) AS n FROM documents),
  w AS (SELECT doc_id, term, tf, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM counts JOIN kept USING (term), n)
  SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM w"""


@query("T5", _weights())
def tf_idf_weights(spark, folder):
    return rounded(T.tf_idf(documents(spark, folder), "doc_id", content_words("text")), "weight", digits=9)


@query("T4 T5", _weights("WHERE df <= 0.8 * (SELECT count(*) FROM documents) ORDER BY total DESC, term LIMIT 1000"))
def tf_idf_weights_of_frequent_terms(spark, folder):
    out = T.tf_idf(documents(spark, folder), "doc_id", content_words("text"), max_df=0.8, max_features=1000)
    return rounded(out, "weight", digits=9)
