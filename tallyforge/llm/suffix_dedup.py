"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Every window of ``length`` bytes has an anchor: the first of the smallest hashes of eight bytes in its front part. Equal windows have
their anchors in the same place, so it is enough to sort the suffixes that begin at anchors (about one in ``length`` / 2), by
their first ``depth`` bytes, which lie within every window of the anchor. Such a sparse suffix array is a sorted, bucketed table.

Documents come in batches. A batch gets its suffix array, is merge-scanned against the arrays of all levels for suffixes that
begin alike, and becomes the array of level 0; two arrays of one level are merged into one of the next, so that n batches
leave at most log2(n) + 1 arrays and each suffix is rewritten log2(n) times. Scans and merges are joins of tables with equal
buckets, in order, without a shuffle.

The arrays carry no documents or places: the family only filters candidates. Over all documents at once, anchors whose suffixes
begin like another's are verified on bytes: first the string of all windows of an anchor, then blocks of 64,
8 and 1 windows around what is still open. A block is settled when its whole string occurs elsewhere, dropped when not even the
part that all its windows share does, and else cut into smaller blocks. Of equal strings, one goes on for all. Strings are
compared by hashes of 128 bits.

Defined cases: null and empty texts have no bytes; ids may repeat or be null (each row is a document; equal rows cover each
other); texts shorter than ``length`` lose nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, new_name, text_of

GRAM = 8
BLOCKS = (64, 8, 1)
#: Bytes of a text that are looked at together; a longer one is cut with overlap, which moves no anchor.
CHUNK = 1 << 22


def window_minima(v: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(v.dtype).max, v.dtype)
    padded[:len(v)] = v
    parts = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    behind = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(text: bytes, length: int, depth: int) -> list[tuple[int, int, int]]:
    """(anchor, first window, last window) for each run of windows with the same anchor, in order."""
    width, out = length - depth + 1, []
    for start in range(0, max(0, len(text) - length + 1), CHUNK):
        part = text[start:start + CHUNK + length - 1]
        raw = np.frombuffer(part, np.uint8).astype(np.uint64)
        grams = len(raw) - GRAM + 1
        v = np.zeros(grams, np.uint64)
        for i in range(GRAM):
            v |= raw[i:i + grams] << np.uint64(8 * i)
        v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        v = (v & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)  # of equal hashes the first counts
        at = (window_minima(v, width)[:len(part) - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        runs = list(zip((at[first] + start).tolist(), (first + start).tolist(), (last + start).tolist()))
        if out and out[-1][0] == runs[0][0]:  # the run goes on over the cut
            runs[0] = (runs[0][0], out.pop()[1], runs[0][2])
        out.extend(runs)
    return out


def row_key(doc_id: int | None, text: bytes) -> bytes:
    """Names a row by its id and text; as ``_keyed`` does."""
    return hashlib.md5((b"" if doc_id is None else str(doc_id).encode()) + b"|" + text).digest()


def _keyed(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    doc_id, text = F.col(id_column).cast("long"), text_of(text_column)
    key = F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), text).cast("binary")))
    return documents.select(key.alias("row"), doc_id.alias("doc_id"), text.alias("text"))


def _prefix_key(prefix: bytes) -> int:
    """As Spark's xxhash64 of a binary column."""
    x = xxhash.xxh64_intdigest(prefix, 42)
    return x - (1 << 64) if x >> 63 else x


class SuffixFamily:
    """Suffix arrays of the batches so far: ``levels`` maps a level to the name of its table (prefix, n), bucketed and sorted."""

    def __init__(self, spark: SparkSession, length: int = 400, depth: int = 32):
        self.spark, self.length, self.depth = spark, length, depth
        self.levels: dict[int, str] = {}
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _stored(self, rows: DataFrame) -> str:
        name = new_name("suffixes")
        (rows.write.bucketBy(self.buckets, "prefix").sortBy("prefix").option("compression", "zstd").format("parquet").saveAsTable(name))
        return name

    def suffixes(self, documents: DataFrame, text_column: str = "text") -> DataFrame:
        """The first ``depth`` bytes of the suffix at each anchor."""
        length, depth = self.length, self.depth

        def run(batches):
            for batch in batches:
                found = []
                for text in batch.column(0):
                    raw = text.as_py().encode()
                    found.extend(raw[a:a + depth] for a, _, _ in anchors(raw, length, depth))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["prefix"])

        return documents.select(text_of(text_column).alias("text")).mapInArrow(run, "prefix binary")

    def add(self, documents: DataFrame, text_column: str = "text") -> DataFrame:
        """Takes a batch in; returns the prefixes of its suffixes that occur again in it or on any level."""
        own = self._stored(self.suffixes(documents, text_column).groupBy("prefix").agg(F.count("*").alias("n")))
        batch = self.spark.table(own)
        found = [batch.filter("n > 1").select("prefix")]
        found += [batch.join(self.spark.table(level).select("prefix").hint("merge"), "prefix").select("prefix") for level in self.levels.values()]
        shared = Scratch(self.spark, "shared-prefixes").keep(reduce(DataFrame.union, found), "found")
        level = 0
        while level in self.levels:
            other = self.levels.pop(level)
            a, b = self.spark.table(own), self.spark.table(other).select("prefix", F.col("n").alias("m")).hint("merge")
            merged = a.join(b, "prefix", "full").select("prefix", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
            name = self._stored(merged)
            self.spark.sql(f"DROP TABLE {own}")
            self.spark.sql(f"DROP TABLE {other}")
            own, level = name, level + 1
        self.levels[level] = own
        return shared

    def drop(self) -> None:
        for name in self.levels.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = {}


PLACE = "row binary, anchor int, first int, last int, low int, high int, weight int, whole boolean, need binary, all binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), *[pa.int32()] * 6, pa.bool_(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in PLACE.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _first_places(documents: DataFrame, length: int, depth: int) -> DataFrame:
    """All anchors with the hash of their suffix's prefix and of the string of all their windows."""
    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py().encode()
                found = anchors(raw, length, depth)
                row = row_key(doc_id, raw) if found else b""
                out.extend((row, a, lo, hi, a - hi, a - lo, 1, True, _prefix_key(raw[a:a + depth]).to_bytes(8, "big", signed=True),
                            digest(raw[lo:hi + length])) for a, lo, hi in found)
            yield _batch(out)

    return documents.select("doc_id", "text").mapInArrow(run, PLACE)


def _smaller_places(nodes: DataFrame, texts: DataFrame, length: int, size: int) -> DataFrame:
    """The blocks of ``size`` windows within the nodes' blocks. Windows are counted back from the anchor."""
    fields = ("anchor", "first", "last", "low", "high", "weight")
    per_row = nodes.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("nodes"))  # at most the anchors of a text

    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out = []
            for row, text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw, seen = text.as_py().encode(), set()
                for node in own.as_py():
                    a, first, last, low, high, weight = (node[f] for f in fields)
                    for block in range(low // size, high // size + 1):
                        start, end = a - block * size - size + 1, a - block * size
                        lo, hi = max(first, start), min(last, end)
                        if lo > hi or (a, lo) in seen:
                            continue
                        seen.add((a, lo))
                        whole = lo == start and hi == end
                        tag = block.to_bytes(4, "big")
                        out.append((row, a, lo, hi, block * size, block * size + size - 1, weight, whole, digest(tag + raw[end:max(end, start + length)]),
                                    digest(tag + raw[start:end + length]) if whole else digest(row + a.to_bytes(8, "big") + tag)))
                if len(out) > 20000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return texts.join(per_row, "row").select("row", "text", "nodes").mapInArrow(run, PLACE)


def _kinds(places: DataFrame) -> DataFrame:
    """The different strings, with how often they occur and one place of each."""
    return places.groupBy("need", "all", "whole").agg(F.sum("weight").alias("n"), F.min("id").alias("id"))


def _settled(places: DataFrame, kinds: DataFrame) -> DataFrame:
    """The windows (row, first, last) that are known to occur elsewhere."""
    twice = kinds.filter("whole AND n > 1").select("need", "all")
    return places.join(twice, ["need", "all"]).select("row", "first", "last")


def _open(kinds: DataFrame) -> DataFrame:
    """What blocks share that must be cut: of several kinds, at least one occurs once."""
    return kinds.groupBy("need").agg(F.count("*").alias("kinds"), F.max((F.col("n") == 1).cast("int")).alias("open")).filter(
        "kinds > 1 AND open = 1").select("need")


def _to_cut(places: DataFrame, kinds: DataFrame, open_: DataFrame) -> DataFrame:
    """One block of each open kind. ``open_`` is a stored table: beside an aggregate, Spark does not divide a key of very many kinds among tasks."""
    chosen = kinds.join(open_, "need").select("id", F.least(F.col("n"), F.lit(2)).cast("int").alias("weight"))
    return places.drop("weight").join(chosen, "id").drop("id", "whole", "need", "all")


def removed_bytes(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 400, depth: int = 32,
                  batches: int = 4) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end in bytes) of each document.

    A byte is removed if a string of ``length`` bytes that covers it also begins anywhere else in the table.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    long_ = rows.filter(F.octet_length("text") >= length)
    family = SuffixFamily(spark, length, depth)
    try:
        shared = [family.add(long_.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i)) for i in range(batches)]
        keys = scratch.keep(reduce(DataFrame.union, shared).select(F.unhex(F.lpad(F.hex(F.xxhash64("prefix")), 16, "0")).alias("need")).distinct(),
                            "prefixes")
    finally:
        family.drop()

    def numbered(places: DataFrame, name: str) -> DataFrame:
        return scratch.keep(places.withColumn("id", F.monotonically_increasing_id()), name)

    places = numbered(_first_places(long_, length, depth).join(keys, "need"), "places-0")
    wanted = scratch.keep(places.select("row").distinct(), "wanted")
    keyed = _keyed(documents, id_column, text_column)
    texts_name = new_name("texts")
    (keyed.join(wanted, "row").write.bucketBy(family.buckets, "row").option("compression", "zstd").format("parquet").saveAsTable(texts_name))
    texts = spark.table(texts_name)
    try:
        marks = []
        for turn, size in enumerate((*BLOCKS, 0), 1):
            kinds = scratch.keep(_kinds(places), f"kinds-{turn}")
            marks.append(scratch.keep(_settled(places, kinds).distinct(), f"marks-{turn}"))
            if size:
                open_ = scratch.keep(_open(kinds), f"open-{turn}")
                nodes = scratch.keep(_to_cut(places, kinds, open_), f"nodes-{turn}")
                scratch.drop(f"kinds-{turn}", f"open-{turn}")
                places = numbered(_smaller_places(nodes, texts, length, size), f"places-{turn}")
                scratch.drop(f"places-{turn - 1}", f"nodes-{turn}")
        covered = reduce(DataFrame.union, marks).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("windows"))
        out = scratch.keep(_cut(texts.join(covered, "row", "left"), length), "cut")
    finally:
        spark.sql(f"DROP TABLE {texts_name}")
    rest = keyed.join(wanted, "row", "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return out.union(rest)


def _cut(rows: DataFrame, length: int) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"

    def run(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
            for text, windows in zip(batch.column(1), batch.column(2)):
                raw, spans = text.as_py().encode(), []
                for w in sorted((w["first"], w["last"]) for w in windows.as_py() or []):
                    if spans and w[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], w[1] + length)
                    else:
                        spans.append([w[0], w[1] + length])
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(raw[at:start])
                    at = end
                kept.update(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(e - s for s, e in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(kept.hexdigest())
                out["spans"].append([{"start": s, "end": e} for s, e in spans])
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(out.values(), kinds)],
                                             names=list(out))

    return rows.select("doc_id", "text", "windows").mapInArrow(run, schema)
