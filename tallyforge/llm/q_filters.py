"""Queries of the filtering, mixing and encoding operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import mixing, pieces, secrets, toxicity
from .common import table
from .registry import llm_query


@llm_query()
def op5_toxicity_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents; the model is fitted on at most 20,000 labelled ones."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents.select("doc_id", "text"), model).select("doc_id", "expected_severity", "p_toxic", "rejected")


@llm_query()
def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded: number of words and pieces, a digest of the ids in order, and whether they give the text."""
    rows = pieces.encode(table(spark, sf_dir, "documents"), pieces.load_pieces(), check=True)
    return rows.select("doc_id", "n_words", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"), "decodes")


LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"web": 3, "print": 1}, "lang": {"en": 4, "fr": 2, "de": 2, "es": 1}}
SHARE, EPOCHS, SEED = 0.6, 2, 7


def domain_of(source: str) -> Column:
    """Sources of even number count as web, the others as print."""
    return F.when(F.regexp_extract(source, r"(\d+)$", 1).cast("bigint") % 2 == 0, "web").otherwise("print")


def with_domain(documents: DataFrame) -> DataFrame:
    """The documents with their ``domain``."""
    return documents.withColumn("domain", domain_of("source"))


def _mixing_sql() -> str:
    same = lambda cols, a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols) or "true"
    weight = lambda c: "CASE " + " ".join(f"WHEN {c} = '{k}' THEN {v}" for k, v in WEIGHTS[c].items()) + " ELSE 1 END" if c in WEIGHTS else "1"
    parts = [f"""u AS (
  SELECT doc_id, CASE WHEN TRY_CAST(nullif(regexp_extract(source, '(\\d+)$', 1), '') AS BIGINT) % 2 = 0 THEN 'web' ELSE 'print' END AS domain,
         lang, source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS n_tokens
  FROM documents GROUP BY 1, 2, 3, 4)"""]
    for depth, level in enumerate(LEVELS):
        cols, up = LEVELS[:depth + 1], LEVELS[:depth]
        group, by = ", ".join(cols), f"PARTITION BY {', '.join(up) or '0'}"
        budget = f"n{depth - 1}.budget" if depth else f"(sum(c.lim) OVER ()) // {EPOCHS} * {round(SHARE * 1000)} // 1000"
        source = f"JOIN n{depth - 1} ON {same(up, 'c', f'n{depth - 1}')}" if depth else ""
        order = f"{by} ORDER BY CASE WHEN w = 0 THEN NULL ELSE lim * 1000000 // w END ASC NULLS LAST, {level} ASC NULLS FIRST ROWS UNBOUNDED PRECEDING"
        parts.append(f"""c{depth} AS (
  SELECT {group}, sum(n_tokens)::HUGEINT * {EPOCHS} AS lim, ({weight(level)})::HUGEINT AS w FROM u GROUP BY {group}),
b{depth} AS (SELECT {', '.join('c.' + c for c in cols)}, c.lim, c.w, ({budget})::HUGEINT AS pb FROM c{depth} c {source}),
s{depth} AS (SELECT *, sum(lim) OVER ({order}) - lim AS taken, sum(w) OVER ({by}) - sum(w) OVER ({order}) + w AS rest FROM b{depth}),
f{depth} AS (SELECT *, w > 0 AND lim * rest <= w * greatest(0, pb - taken) AS full_ FROM s{depth}),
t{depth} AS (SELECT *, sum(CASE WHEN full_ THEN lim ELSE 0 END) OVER ({by}) AS spent, sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({by}) AS open FROM f{depth}),
n{depth} AS (SELECT {group}, lim, CASE WHEN full_ THEN lim WHEN open = 0 THEN 0 ELSE least(lim, w * (pb - spent)::HUGEINT // open::HUGEINT) END::HUGEINT AS budget FROM t{depth})""")
    last = len(LEVELS) - 1
    parts.append(f"""q AS (SELECT *, CASE WHEN lim = 0 THEN 0 ELSE budget // (lim // {EPOCHS}) END AS passes,
  CASE WHEN lim = 0 THEN 0 ELSE budget % (lim // {EPOCHS}) END AS rest FROM n{last}),
k AS (SELECT u.*, q.passes, q.rest, md5(concat_ws('|', '{SEED}', q.passes::VARCHAR, coalesce(u.doc_id::VARCHAR, 'null'))) AS key
  FROM u JOIN q ON {same(LEVELS, 'u', 'q')}),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {', '.join(LEVELS)} ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k)""")
    return f"WITH {', '.join(parts)} SELECT doc_id, {', '.join(LEVELS)}, n_tokens, CAST(passes + CASE WHEN n_tokens > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r"


@llm_query(_mixing_sql())
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken, for 0.6 of all tokens by the target weights, in at most two epochs a leaf."""
    rows = with_domain(table(spark, sf_dir, "documents")).select("doc_id", *LEVELS, mixing.n_words(F.col("text")).alias("n_tokens"))
    return mixing.mixed(rows, LEVELS, WEIGHTS, SHARE, EPOCHS, SEED)


@llm_query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings of all documents, scored by a forest that is trained on at most 20,000 labelled ones."""
    return secrets.scan(table(spark, sf_dir, "documents"))
