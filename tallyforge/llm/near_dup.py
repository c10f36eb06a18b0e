"""Near-duplicate components: fast similarity sketching, banding, and verification on full shingle sets.

A document's set holds the hashes (64 bits) of its distinct word shingles. Documents with equal sets are one class from the
start. A sketch has ``coordinates`` values: in round i every element is thrown into a bin by that round's hash with the value
(i, hash), and a bin keeps its smallest value. Rounds go on until no bin is empty; after as many rounds as bins, each further
round throws everything into one given bin, so every coordinate fills. Two sketches agree in a coordinate with the probability
of the sets' similarity, with bounds as for independent samples.

Bands of ``rows_per_band`` coordinates give the buckets. Verification never takes all pairs of a bucket: first each member is
compared with the bucket's smallest document; then, where a bucket still holds documents of several components, its documents
are compared across components. For that, documents are dealt into blocks of bounded size, and two blocks that meet in a bucket
go to one task, which counts all intersections of their full sets as a product of matrices: no pairs of documents are shuffled.
Pairs within one component cannot change the result, so blocks of one and the same component do not meet. With the defaults a link of
similarity 0.8 shares no bucket with a probability of 8e-6; a missed one may still be joined through others.

Defined cases: null or empty text, or no words: empty set, component of its own; fewer words than a shingle: the whole sequence
is one; ids that repeat are one document (a row for each of its different sets); a null id is a component of its own with id null;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, text_of
from .components import components

ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = 2) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; A-Z count as a-z, words are what ASCII white space separates."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total + h[i:len(words) - width + 1 + i] * np.uint64(ODD[i % len(ODD)]))
    return np.unique(total)


def fast_sketch(elements: np.ndarray, coordinates: int) -> np.ndarray:
    """The sketch of a set that is not empty. Small sets do several rounds at once: a bin that an earlier round fills keeps its value."""
    empty, turn = np.uint64(0xFFFFFFFFFFFFFFFF), 0
    bins = np.full(coordinates, empty)

    def thrown(turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = mix(elements + ((turns + np.uint64(1)) * np.uint64(ODD[0]))[:, None])
        return x, (turns << np.uint64(54))[:, None] | ((x & np.uint64(0xFFFFFFFF)) << np.uint64(22))

    while turn < coordinates and (bins == empty).any():
        turns = np.arange(turn, min(coordinates, turn + max(1, 8 * coordinates // len(elements))), dtype=np.uint64)
        x, value = thrown(turns)
        np.minimum.at(bins, ((x >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64).ravel(), value.ravel())
        turn += len(turns)
    for bin_ in np.flatnonzero(bins == empty):
        bins[bin_] = thrown(np.array([coordinates + bin_], np.uint64))[1].min()
    return bins


def band_keys(sketch: np.ndarray, rows_per_band: int) -> np.ndarray:
    """One key a band; the band's number is part of it."""
    parts = sketch.reshape(-1, rows_per_band)
    key = mix(np.arange(1, len(parts) + 1, dtype=np.uint64) * np.uint64(ODD[1]))
    for i in range(rows_per_band):
        key = mix(key + parts[:, i] * np.uint64(ODD[i % len(ODD)]))
    return key.view(np.int64)


def sketches(documents: DataFrame, id_column: str, text_column: str, width: int, bands: int, rows_per_band: int) -> DataFrame:
    """doc_id, n_shingles, a digest of the set in two longs, and the band keys (none for an empty set)."""
    def run(batches):
        for batch in batches:
            n, low, high, keys, ends = [], [], [], [], [0]
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                d = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                low.append(int.from_bytes(d[:8], "little", signed=True))
                high.append(int.from_bytes(d[8:], "little", signed=True))
                if len(s):
                    keys.append(band_keys(fast_sketch(s, bands * rows_per_band), rows_per_band))
                ends.append(ends[-1] + (bands if len(s) else 0))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, low, high)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                names=["doc_id", "n_shingles", "low", "high", "keys"])

    return documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, low long, high long, keys array<long>")


def shingle_sets(documents: DataFrame, width: int) -> DataFrame:
    """doc_id and its set as an array, of rows (doc_id, text)."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(text.as_py(), width) for text in batch.column(1)]
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64()))],
                names=["doc_id", "elements"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, elements array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. The side that many pairs share is joined last."""
    one = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb")), "b")
    two = one.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea")), "a")
    both = two.select("a", "b", F.size("ea").cast("long").alias("na"), F.size("eb").cast("long").alias("nb"),
                      F.size(F.array_intersect("ea", "eb")).cast("long").alias("i"))
    return both.filter(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent).select("a", "b")


def _block_links(percent: int):
    """Links across components of the documents of two blocks (``side`` 0 and 1), or of one block with itself; one a pair of components."""
    def sides(table: pa.Table, side: int):
        rows = table.filter(pc.equal(table.column("side"), side)).combine_chunks()
        lists = rows.column("elements").combine_chunks()
        n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return (rows.column("rep").to_numpy(), rows.column("component").to_numpy(), n, np.repeat(np.arange(len(n)), n),
                lists.flatten().to_numpy(zero_copy_only=False))

    def run(key, table):
        rep_a, part_a, n_a, row_a, value_a = one = sides(table, 0)
        rep_b, part_b, n_b, row_b, value_b = one if key[0].as_py() == key[1].as_py() else sides(table, 1)
        shared = np.intersect1d(value_a, value_b)
        common = np.zeros((len(n_a), len(n_b)), np.int64)
        for start in range(0, len(shared), 4096):
            some = shared[start:start + 4096]

            def marks(rows, values, n):
                at = np.minimum(np.searchsorted(some, values), len(some) - 1)
                hit = some[at] == values
                out = np.zeros((n, len(some)), np.float32)
                out[rows[hit], at[hit]] = 1
                return out

            common += (marks(row_a, value_a, len(n_a)) @ marks(row_b, value_b, len(n_b)).T).astype(np.int64)
        near = common * 100 >= (n_a[:, None] + n_b[None, :] - common) * percent
        x, y = np.nonzero(near & (part_a[:, None] != part_b[None, :]))
        first = np.unique(np.stack([part_a[x], part_b[y]]), axis=1, return_index=True)[1] if len(x) else x
        a, b = rep_a[x[first]], rep_b[y[first]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def _links_across(placed: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, scratch: Scratch,
                  block_docs: int = 256, block_elements: int = 200000) -> DataFrame:
    """Links (a, b) between components that meet in buckets: of ``placed`` (key, rep, component, m: the key's smallest component).

    A block holds about ``block_docs`` documents, or ``block_elements`` elements, that meet one component, and either only that
    component's own or only others. The bounds decide what is compared in one task, not what is found.
    """
    rows = placed.groupBy("rep", "component").agg(F.min("m").alias("m")).join(sizes, "rep").withColumn("own", F.col("m") == F.col("component"))
    number = rows.groupBy("m", "own").agg(
        F.ceil(F.greatest(F.count("*") / block_docs, F.sum("n") / block_elements)).alias("blocks"))
    blocks = scratch.keep(rows.join(number, ["m", "own"]).select(
        "rep", "component", F.xxhash64("m", "own", F.pmod(F.xxhash64("rep"), "blocks")).alias("block")), "blocks")
    meet = placed.join(blocks.select("rep", "block"), "rep").groupBy("key", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
    other = meet.select("key", F.col("block").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    pairs = scratch.keep(meet.join(other, "key").filter("block <= other AND least(low, other_low) < greatest(high, other_high)")
                         .select("block", "other").distinct(), "block-pairs")
    held = blocks.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    columns = ["block", "other", "side", "rep", "component", "elements"]
    left = pairs.join(held, "block").withColumn("side", F.lit(0)).select(columns)
    right = pairs.filter("block <> other").join(held.withColumnRenamed("block", "other"), "other").withColumn("side", F.lit(1)).select(columns)
    return left.union(right).groupBy("block", "other").applyInArrow(_block_links(percent), "a long, b long").distinct()


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 2,
                    percent: int = 80, bands: int = 64, rows_per_band: int = 8) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept (doc_id = component_id).

    Two documents are linked when 100 * size of the intersection >= ``percent`` * size of the union of their sets.
    """
    scratch = Scratch(documents.sparkSession, "near-dup")
    rows = scratch.keep(sketches(documents, id_column, text_column, width, bands, rows_per_band), "sketches")
    full = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # stored: it is joined twice, and beside an aggregate Spark does not divide a key of very many copies
    classes = scratch.keep(full.groupBy("low", "high").agg(F.min("doc_id").alias("rep")), "classes")
    member = scratch.keep(full.select("doc_id", "low", "high").join(classes, ["low", "high"]).select("doc_id", "rep").distinct(),
                          "members")
    # a document with several sets joins their classes
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z")
    joined = member.join(several, "doc_id").select("a", F.col("rep").alias("b")).filter("a <> b")

    own = classes.select(F.col("rep").alias("doc_id"), "low", "high")
    reps = full.join(own, ["doc_id", "low", "high"])
    keyed = scratch.keep(reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n")), "keys")
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z").select("key", "a")
    shared = scratch.keep(keyed.join(buckets, "key"), "buckets")
    scratch.drop("keys", "classes")
    sizes = scratch.keep(shared.select("rep", "n").distinct(), "sizes")

    def sized(pairs: DataFrame) -> DataFrame:
        """Without the pairs whose sizes alone exclude the similarity."""
        p = pairs.join(sizes.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
        p = p.join(sizes.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a")
        return p.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b").distinct()

    first = scratch.keep(sized(shared.select("a", F.col("rep").alias("b")).filter("a <> b").distinct()), "pairs")
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    # all documents of shared buckets: the second round may need them, and the texts are read and shuffled once
    sets = scratch.keep(shingle_sets(texts.join(sizes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"), width), "sets")
    links = scratch.keep(_verified(first, sets, percent).union(joined), "links")
    parts = scratch.keep(components(links, scratch, "first"), "parts")

    placed = shared.select("key", "rep").join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    groups = placed.groupBy("key").agg(F.min("component").alias("m"), F.max("component").alias("z")).filter("m <> z").select("key", "m")
    placed = scratch.keep(placed.join(groups, "key").distinct(), "placed")
    more = scratch.keep(_links_across(placed, sizes, sets, percent, scratch), "more-links")
    parts = scratch.keep(components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), scratch, "second"),
                         "components")
    scratch.drop("buckets", "sizes", "sets", "pairs", "links", "parts", "placed", "blocks", "block-pairs", "more-links")

    ends = member.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component"))
    out = rows.groupBy("doc_id", "n_shingles", "low", "high").agg(F.count("*").alias("copies"))
    component = F.coalesce("component", "doc_id")
    return out.join(ends, "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
