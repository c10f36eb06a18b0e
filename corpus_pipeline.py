"""The corpus pipeline: toxicity, near duplicates, secrets, mixing, encoding. Each stage works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm import mixing, near_dup, pieces, q_filters, queries, secrets, toxicity  # noqa: F401
from tallyforge.llm.common import Scratch, new_name, table

#: Share of the tokens that the mixing stage takes, each document at most once.
MIX_SHARE, MIX_EPOCHS = 0.8, 1


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are toxic with a probability of a half or more. Columns stay, whatever their names; null texts stay;
    repeated rows are judged each; an empty table stays empty."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = tuple(new_name(c) for c in ("severity", "p", "rejected"))
    return toxicity.score(docs, model, names=names).filter(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates (shingles of five words, similarity 0.8), the one with the smallest id.

    Each row counts for itself, whatever its id: of rows with equal or null ids one stays, too. Of rows without words, which are like
    no others, one of each id and text stays.
    """
    scratch, key, word = Scratch(spark, "near-dup-stage"), new_name("key"), F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = scratch.keep(docs.withColumn(key, F.monotonically_increasing_id()), "rows")  # written, so that keys stay as they are
    found = near_dup.near_duplicates(rows.filter(word), id_column=key, width=5, percent=80).select(F.col("doc_id").alias(key), "component_id")
    ids = rows.select(key, "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key))[key].alias(key)
    stays = found.join(ids, key).groupBy("component_id").agg(first).select(key)
    without = rows.filter(~word).groupBy("doc_id", "text").agg(F.min(key).alias(key)).select(key)
    gone = scratch.keep(ids.select(key).join(stays.union(without), key, "left_anti"), "gone")
    return rows.join(gone, key, "left_anti").select(*columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark. Null texts stay null; rows of one id are searched together,
    and each of them is cleaned; an empty table stays empty; other columns stay, whatever their names."""
    found = Scratch(spark, "secret-stage").keep(secrets.scan(docs), "findings")
    return secrets.redacted(docs, found)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix, as often as they are taken.

    Rows of one id, domain, language and source are one unit and go together; null ids, languages and sources are values of their own;
    texts without words, null ones included, have no tokens and are not taken; ties go by the seeded key, then id; an empty table stays empty;
    other columns stay, whatever their names.
    """
    units = q_filters.with_domain(docs.select("doc_id", "text", "lang", "source"))
    units = units.select("doc_id", *q_filters.LEVELS, mixing.n_words(F.col("text")).alias("n_tokens"))
    taken = mixing.mixed(units, q_filters.LEVELS, q_filters.WEIGHTS, MIX_SHARE, MIX_EPOCHS, q_filters.SEED).filter("copies > 0")
    keys, copies, domain = {c: new_name(c) for c in ("doc_id", *q_filters.LEVELS)}, new_name("copies"), new_name("domain")
    taken = taken.select(*[F.col(c).alias(name) for c, name in keys.items()], F.col("copies").alias(copies))
    rows, match = docs.withColumn(domain, q_filters.domain_of("source")), F.lit(True)
    for c, name in keys.items():
        match = match & F.col(domain if c == "domain" else c).eqNullSafe(F.col(name))
    return (rows.join(taken, match).withColumn(new_name("copy"), F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_words of each document, beside its other columns. Null texts have no words; repeated rows are encoded each; an
    empty table stays empty."""
    return pieces.encode(docs, pieces.load_pieces())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each one's rows are written to the shared folder and read by the next."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
