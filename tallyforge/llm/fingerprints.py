"""Document fingerprints by one-permutation MinHash, by DataFrame operations only.

The hashes (64 bits) of a text's shingles of five words fall into 128 bins by their leading bits, each bin keeps its smallest hash.
An empty bin takes the value of the first filled bin in its own pseudo-random order of all bins (optimal densification: the
order depends on the bin and the attempt, not on the text). Stored are the low four bits of the hash of
(value, bin), a hexadecimal digit a bin; the bin is hashed in so that copies of one value do not agree or differ together. The likeness of two fingerprints is the share of equal digits, corrected for those equal by chance.

Words are what ASCII white space separates, in lower case. Defined cases: fewer than five words are one shingle; a text without
words has the empty fingerprint, whose likeness is 1 to itself and 0 to others; null texts are empty; rows that repeat are
fingerprinted each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch, text_of

BINS_LOG, BITS = 7, 4
BINS = 1 << BINS_LOG
WORD = r"[^\x20\x09-\x0D]+"


def with_fingerprint(rows: DataFrame, text: str, out: str, width: int = 5) -> DataFrame:
    """The rows with the fingerprint of column ``text``. Names that begin with ``out`` and an underscore are used on the way."""
    name = lambda s: f"{out}_{s}"
    words, sorted_, least, bins, first = map(name, ("words", "sorted", "least", "bins", "first"))
    rows = rows.withColumn(words, F.transform(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
    at = ", ".join(f"{words}[i + {j}]" for j in range(width))
    rows = rows.withColumn(sorted_, F.sort_array(F.expr(
        f"CASE WHEN size({words}) >= {width} THEN transform(sequence(0, greatest(size({words}) - {width}, 0)), i -> xxhash64({at})) "
        f"WHEN size({words}) > 0 THEN array(xxhash64({words})) ELSE CAST(array() AS array<bigint>) END")))
    shift = 64 - BINS_LOG
    bin_of = lambda h: f"CAST(shiftrightunsigned({h}, {shift}) AS INT)"
    rows = rows.withColumn(least, F.expr(f"filter({sorted_}, (h, i) -> i = 0 OR {bin_of('h')} <> {bin_of(f'{sorted_}[i - 1]')})"))
    rows = rows.withColumn(bins, F.expr(f"transform({least}, h -> {bin_of('h')})"))
    rows = rows.withColumn(first, F.expr(
        f"transform(sequence(0, {BINS - 1}), b -> get({least}, CAST(array_position({bins}, b) AS INT) - 1))"))
    # the order of bin b: its start and its odd step come from a hash of b, so it meets each bin once
    attempt = lambda t: f"{first}[CAST(pmod(pmod(xxhash64(b), {BINS}) + ({t}) * (2 * pmod(xxhash64(b, 1), {BINS // 2}) + 1), {BINS}) AS INT)]"
    early = ", ".join(attempt(t) for t in range(6))
    late = f"filter(transform(sequence(6, {BINS - 1}), t -> {attempt('t')}), x -> x IS NOT NULL)[0]"
    rows = rows.withColumn(out, F.expr(
        f"IF(size({bins}) = 0, '', array_join(transform(sequence(0, {BINS - 1}), b -> "
        f"substr('0123456789abcdef', CAST(xxhash64(coalesce({first}[b], {early}, {late}), b) & {(1 << BITS) - 1} AS INT) + 1, 1)), ''))"))
    return rows.drop(words, sorted_, least, bins, first)


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints' shingle sets, from 0 to 1."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    chance = 1.0 / (1 << BITS)
    share = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    either = (F.length(a) == 0) | (F.length(b) == 0)
    return F.when(a == b, 1.0).when(either, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def following(keys: DataFrame, slices: int = 200) -> DataFrame:
    """``key``, ``n`` -> with ``next``: the next smaller key; after the smallest the largest.

    Keys are dealt to slices by their quantiles, so that no task orders them all; a slice's last key is followed by the
    largest of the slice below.
    """
    points = keys.approxQuantile("key", [i / slices for i in range(1, slices)], 0.2 / slices)  # a fixed number of values
    at = reduce(lambda x, y: x + y, [(F.col("key").cast("double") >= p).cast("int") for p in sorted(set(points))], F.lit(0))
    placed = keys.withColumn("slice", at)
    tops = sorted((r["slice"], r["top"]) for r in placed.groupBy("slice").agg(F.max("key").alias("top")).collect())  # a row a slice
    if not tops:
        return keys.withColumn("next", F.col("key"))
    below = {s: (tops[i - 1][1] if i else tops[-1][1]) for i, (s, _) in enumerate(tops)}
    under = F.create_map(*[F.lit(x) for pair in below.items() for x in pair])[F.col("slice")]
    order = Window.partitionBy("slice").orderBy(F.desc("key"))
    return placed.withColumn("next", F.coalesce(F.lead("key").over(order), under)).drop("slice")


def edited_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """key, doc_id, text, next, edited: the last half of each text replaced by the beginning of the next document's.

    ``key`` is the id, with the smallest long for null. If ids repeat, the next document is the smallest beginning among
    the next id's rows.
    """
    rows = documents.select(F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("key"), text_of(text_column).alias("text"))
    lengths = Scratch(documents.sparkSession, "lengths").keep(rows.groupBy("key").agg(F.max(F.length("text")).alias("n")), "rows")
    order = following(lengths)
    wanted = order.select(F.col("next").alias("key"), F.col("key").alias("for"), F.expr("n DIV 2").cast("int").alias("half"))
    parts = (rows.join(wanted, "key").select(F.col("for").alias("key"), F.substring("text", F.lit(1), F.col("half")).alias("part"),
                                             F.col("key").alias("next"))
             .groupBy("key").agg(F.min("part").alias("part"), F.min("next").alias("next")))
    half = F.expr("CAST(length(text) DIV 2 AS INT)")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("part", F.lit(1), half))
    return rows.join(parts, "key").select("key", F.when(F.col("key") != -(2**63), F.col("key")).alias("doc_id"), "text", "next",
                                          edited.alias("edited"))


def fingerprinted_edits(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one row a document."""
    rows = edited_documents(documents, id_column, text_column)
    rows = with_fingerprint(with_fingerprint(rows, "text", "fingerprint"), "edited", "edited_fingerprint")
    rows = rows.select("key", "doc_id", "next", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint")
    rows = Scratch(documents.sparkSession, "fingerprints").keep(rows, "rows")
    others = rows.groupBy(F.col("key").alias("next")).agg(F.min("fingerprint").alias("other"))
    near = lambda column: F.round(likeness(F.col("fingerprint"), F.col(column)), 6)
    return rows.join(others, "next").select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                            near("edited_fingerprint").alias("near_edited"), near("other").alias("near_next"))
