"""SentencePiece encoding and decoding as a relational lattice.

A text is cut into words: spaces become the piece table's space mark, one is put in front, and a cut comes between any two characters that
no piece in use holds side by side: no piece reaches across. A piece is in use unless a path of shorter pieces over its own text has the better
score; no best path takes it then. All substrings of a word up to the longest piece's length are joined with
the table of pieces in use, a character without a piece gets an edge of its byte pieces, and the edges of a word are folded in order of
their ends by a higher-order aggregate that keeps the best score and the way to it at each place (Viterbi). Of equal scores the
longer last piece wins. The lattice runs once for each distinct word; documents are joined with its result by word.

The words most frequent in a bounded sample of documents (``cached_words``, ``sample_docs``) are looked up where the documents are
read: their encodings are sent to all tasks, and their number is fixed. All other words go through a shuffled join. The bounds
change where a word is joined, not its encoding. Texts are cut into words a megabyte at a time, on arrays of code points. Which scores the file has is not judged: a table made for another
algorithm gives the best path by its scores.

Defined cases: null text is empty, and an empty text has no words; any character is encodable by bytes; rows are independent, repeated
ones are encoded each; an empty table gives no rows; other columns are kept by ``encode`` and ignored by ``encode_words``.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, new_name, per_worker, setting, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of text that are cut into words at a time.
SLICE = 1 << 20
#: Distinct words whose edges a task groups, and how many it may hold before it sorts them.
GROUPED, HELD = 1 << 15, 1 << 16
#: No more tasks than this, however many words; a task's share then grows, and is sorted on disk.
MOST_TASKS = 1 << 15
HELD_SETTING = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


class PieceTable(NamedTuple):
    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    unknown_score: float

    @property
    def in_use(self) -> list[tuple[str, int, float]]:
        return pieces_in_use(tuple(self.pieces))

    @property
    def largest_id(self) -> int:
        return max(max(i for _, i, _ in self.pieces), *self.byte_ids)

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.in_use)

    @property
    def pairs(self) -> list[tuple[int, int]]:
        """The characters that stand side by side in any piece in use."""
        return sorted({(ord(a), ord(b)) for p, _, _ in self.in_use for a, b in zip(p, p[1:])})

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.in_use, "piece string, id int, score double")


def best_score(text: str, scores: dict[str, float], longest: int) -> float | None:
    """The score of the best path of pieces shorter than the text, none if there is no path."""
    best: list[float | None] = [0.0]
    for end in range(1, len(text) + 1):
        ways = [best[start] + scores[text[start:end]] for start in range(max(0, end - longest), end)
                if best[start] is not None and text[start:end] in scores and end - start < len(text)]
        best.append(max(ways, default=None))
    return best[-1]


@lru_cache(maxsize=4)
def pieces_in_use(pieces: tuple[tuple[str, int, float], ...]) -> list[tuple[str, int, float]]:
    """Without the pieces that a path of shorter ones beats by more than rounding: whoever takes such a piece could do better."""
    scores, longest = {p: s for p, _, s in pieces}, max(len(p) for p, _, _ in pieces)
    others = ((row, best_score(row[0], scores, longest)) for row in pieces)
    return [row for row, other in others if other is None or other <= row[2] + 1e-9 * abs(row[2])]


def load_pieces(path: str = MODEL) -> PieceTable:
    """The ordinary pieces of a model file with their ids and scores, and the ids of its 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows, bytes_ = [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rows.append((piece, i, float(model.get_score(i))))
    if len(bytes_) != 256:
        raise ValueError("the model has no byte pieces")
    return PieceTable(rows, [bytes_[b] for b in range(256)], min(s for _, _, s in rows) - 10)


class Cuts(NamedTuple):
    """The kind of each code point, 0 for those in no pair, and for each two kinds whether a cut comes between."""
    kinds: np.ndarray
    between: np.ndarray


def cuts_of(pairs: list[tuple[int, int]]) -> Cuts:
    chars = sorted({c for pair in pairs for c in pair})
    kinds = np.zeros(0x110000, np.uint16)
    kinds[chars] = np.arange(1, len(chars) + 1)
    between = np.ones((len(chars) + 1, len(chars) + 1), bool)
    if pairs:
        between[tuple(kinds[np.array(pairs)].T)] = False
    return Cuts(kinds, between)


def parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int = SLICE):
    """Parts of a batch whose rows' sizes make ``most`` at most, or one larger row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def slices(batch: pa.RecordBatch, column: str):
    """Parts of a batch with at most ``SLICE`` bytes of text each, or one longer text."""
    return parts(batch, pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))


class Words(NamedTuple):
    """The words of some texts: all in a row, where each text's words start in that row, and each text with marks, in UTF-8."""
    all: pa.StringArray
    bounds: np.ndarray
    marked: list[bytes]


def split_words(texts: pa.Array, cuts: Cuts) -> Words:
    """A word is what lies between two cuts."""
    marked = [(SPACE + t.replace(" ", SPACE)).encode() if t else b"" for t in texts.to_pylist()]
    whole, at = b"".join(marked), np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
    raw = np.frombuffer(whole, np.uint8)
    kind = cuts.kinds[np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)]
    chars = np.flatnonzero((raw & 0xC0) != 0x80)
    cut = np.ones(len(kind), bool)
    cut[1:] = cuts.between[kind[:-1], kind[1:]]
    cut[np.searchsorted(chars, at[:-1][np.diff(at) > 0])] = True
    starts = chars[cut]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(whole))
    return Words(words.cast(pa.string()), np.searchsorted(starts, at), marked)


def encoded_words(words: DataFrame, table: PieceTable, tasks: int | None = None) -> DataFrame:
    """word, ids of distinct words (column ``word``, none empty). Edges sort by end and, of one end, longer pieces come first."""
    spark, unknown = words.sparkSession, table.largest_id + 1
    longest = F.lit(min(table.longest, 255))
    placed = words.select("word").repartition(*[tasks] * (tasks is not None), "word").select("word", F.length("word").alias("n"))
    starts = placed.select("word", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("at"))
    spans = starts.select("word", "at", F.explode(F.sequence(F.lit(1), F.least(longest, F.col("n") - F.col("at") + 1))).alias("size")).select(
        "word", "at", "size", F.col("word").substr(F.col("at"), F.col("size")).alias("piece"))
    known = F.broadcast(table.frame(spark))  # the piece table: its size is that of the model file
    edge = F.struct((F.col("at") + F.col("size") - 1).alias("end"), (F.col("at") - 1).alias("start"),
                    F.coalesce("id", F.lit(unknown)).alias("id"), F.coalesce("score", F.lit(table.unknown_score)).alias("score"))
    edges = (spans.join(known, "piece", "left").filter("id IS NOT NULL OR size = 1").select("word", edge.alias("edge"))
             .groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges")))
    state = "struct<best:array<struct<score:double,start:int,id:int>>,at:int,score:double,start:int,id:int>"
    fold = f"""
      aggregate(edges,
        CAST(named_struct('best', array(), 'at', 0, 'score', 0D, 'start', 0, 'id', 0) AS {state}),
        (a, e) -> IF(e.end > a.at,
          named_struct('best', concat(a.best, array(named_struct('score', a.score, 'start', a.start, 'id', a.id))), 'at', e.end,
            'score', e.score + IF(e.start = a.at, a.score, a.best[e.start].score), 'start', e.start, 'id', e.id),
          IF(e.score + a.best[e.start].score > a.score,
            named_struct('best', a.best, 'at', a.at, 'score', e.score + a.best[e.start].score, 'start', e.start, 'id', e.id), a)),
        a -> concat(a.best, array(named_struct('score', a.score, 'start', a.start, 'id', a.id))))"""
    back = """
      aggregate(best, CAST(named_struct('at', size(best) - 1, 'way', array()) AS struct<at:int,way:array<struct<id:int,start:int>>>),
        (a, x) -> IF(a.at <= 0, a, named_struct('at', best[a.at].start,
          'way', concat(a.way, array(named_struct('id', best[a.at].id, 'start', best[a.at].start))))),
        a -> reverse(a.way))"""
    byte_ids = ", ".join(map(str, table.byte_ids))
    bytes_of = (f"transform(sequence(1, octet_length(substr(word, p.start + 1, 1))), i -> array({byte_ids})"
                "[CAST(conv(substr(hex(encode(substr(word, p.start + 1, 1), 'UTF-8')), 2 * i - 1, 2), 16, 10) AS INT)])")
    ids = f"flatten(transform(way, p -> IF(p.id = {unknown}, {bytes_of}, array(p.id))))"
    return edges.select("word", F.expr(fold).alias("best")).select("word", F.expr(back).alias("way")).select("word", F.expr(ids).alias("ids"))


def piece_bytes(table: PieceTable) -> list[bytes]:
    """What each id stands for, in UTF-8; an id that is no piece stands for nothing."""
    raw = [b""] * (table.largest_id + 1)
    for piece, i, _ in table.pieces:
        raw[i] = piece.encode()
    for b, i in enumerate(table.byte_ids):
        raw[i] = bytes([b])
    return raw


def decoded_words(words: DataFrame, table: PieceTable, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the word that their ids stand for."""
    raw = piece_bytes(table)

    def run(batches):
        for batch in batches:
            out = [b"".join([raw[i] for i in row.as_py()]).decode() for row in batch.column(batch.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    return words.mapInArrow(run, words.withColumn("decoded", F.lit("")).schema)


class Cache(NamedTuple):
    """Encodings of a fixed number of words, as sent to the tasks, frequent words first: words, where each one's ids start, all ids."""
    key: str
    words: pa.StringArray
    starts: np.ndarray
    ids: np.ndarray

    def places(self) -> dict[str, int]:
        """The number of each word; made once in a worker."""
        return per_worker("piece_words", self.key, lambda: {w: i for i, w in enumerate(self.words.to_pylist())})


def written_words(words: DataFrame, table: PieceTable, scratch: Scratch, name: str) -> DataFrame:
    """The encodings of a table's distinct words, written. Enough tasks that each one's groups fit in memory; larger ones are sorted on disk."""
    tasks = min(MOST_TASKS, words.count() // GROUPED + 1)
    with setting(words.sparkSession, HELD_SETTING, str(HELD)):
        return scratch.keep(encoded_words(words, table, tasks), name)


def frequent_words(documents: DataFrame, table: PieceTable, cached_words: int, sample_docs: int, scratch: Scratch) -> Cache:
    """The encodings of the most frequent words of the first ``sample_docs`` documents by a hash of their text."""
    rows = documents.select("text").filter("text <> ''")
    chosen = rows.select(F.xxhash64("text").alias("h")).orderBy("h").limit(sample_docs).distinct()
    sample = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # sample_docs numbers
    pairs = table.pairs

    def count(batches):
        cuts = cuts_of(pairs)
        for batch in batches:
            for part in slices(batch, "text"):
                n = split_words(part.column("text"), cuts).all.value_counts()
                yield pa.RecordBatch.from_arrays([n.field(0), n.field(1)], names=["word", "n"])

    top = (sample.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(cached_words))
    top = scratch.keep(top, "top")
    found = written_words(top, table, scratch, "top-words").join(top, "word").orderBy(F.desc("n"), "word").select("word", "ids").toArrow()  # cached_words rows
    scratch.drop("top", "top-words")
    words = pa.concat_arrays([c.cast(pa.string()) for c in found.column("word").chunks] or [pa.array([], pa.string())])
    lists = pa.concat_arrays([c.cast(pa.list_(pa.int32())) for c in found.column("ids").chunks] or [pa.array([], pa.list_(pa.int32()))])
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return Cache(new_name("cache"), words, np.concatenate([[0], np.cumsum(sizes)]), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32))


def encode_words(documents: DataFrame, table: PieceTable, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, position (from 0), ids, decodes: a row for each word of each text; one with position -1 for a text without words.

    ``decodes`` tells whether the ids decode to the word; it is false for none of them.
    """
    pairs = table.pairs

    def places(batches):
        cuts = cuts_of(pairs)
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds, _ = split_words(part.column("text"), cuts)
                doc = np.repeat(np.arange(len(part)), np.diff(bounds))
                empty = np.flatnonzero(np.diff(bounds) == 0)
                ids = part.column("doc_id").take(pa.array(np.concatenate([doc, empty])))
                at = np.concatenate([np.arange(len(words)) - bounds[doc], np.full(len(empty), -1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids, pa.array(at), pa.concat_arrays([words, pa.nulls(len(empty), pa.string())])],
                                                 names=["doc_id", "position", "word"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    found = Scratch(documents.sparkSession, "pieces").keep(rows.mapInArrow(places, "doc_id long, position int, word string"), "places")
    new = decoded_words(encoded_words(found.select("word").filter("word IS NOT NULL").distinct(), table), table)
    new = new.select("word", "ids", (F.col("decoded") == F.col("word")).alias("decodes"))
    return found.join(new, "word", "left").select(
        "doc_id", "position", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), F.coalesce("decodes", F.lit(True)).alias("decodes"))


class Numbered(NamedTuple):
    """The words of a slice of texts as numbers: a word of the cache has its place there, any other the number of cached words and its
    number within its text. Of each text and distinct other word of it: the text's number, the word's number and the word."""
    values: np.ndarray
    text: np.ndarray
    numbers: np.ndarray
    words: pa.Array


def numbered(words: Words, cache: Cache) -> Numbered:
    coded, places = words.all.dictionary_encode(), cache.places()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = np.fromiter(map(places.get, coded.dictionary.to_pylist(), repeat(-1)), np.int32, len(coded.dictionary))
    values = known[code]
    at = np.flatnonzero(values < 0)
    text, n = np.searchsorted(words.bounds, at, "right") - 1, max(1, len(known))
    keys, same = np.unique(text * n + code[at], return_inverse=True)  # by text, then word
    texts = keys // n
    numbers = np.arange(len(keys)) - np.searchsorted(texts, np.arange(len(words.bounds)))[texts]
    values[at] = len(cache.words) + numbers[same]
    return Numbered(values, texts, numbers, coded.dictionary.take(pa.array(keys % n)))


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, run after run."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def encode(documents: DataFrame, table: PieceTable, id_column: str = "doc_id", text_column: str = "text",
           cached_words: int = 1 << 17, sample_docs: int = 10000, check: bool = False) -> DataFrame:
    """doc_id, ids and n_words of each row's whole text; with ``check`` also ``decodes``: whether the ids give the text again.

    A text travels as numbers of words, not as ids: those of known words are their places among the words sent along. The other words are
    numbered in each text, joined with their ids by word, and gathered by document id and a hash of the text into small dictionaries
    (number, ids). The dictionaries are written first, so that Spark can split the join where very many rows are the same; the ids are
    filled in behind it. A space mark in a text is decoded as a space, which ``check`` allows for.
    """
    spark = documents.sparkSession
    scratch, pairs = Scratch(spark, "encoded"), table.pairs
    doc_id, text = F.col(id_column).cast("long"), text_of(text_column)
    rows = documents.select(F.coalesce(doc_id, F.lit(0).cast("long")).alias("d"), F.xxhash64(doc_id.isNull(), text).alias("h"),
                            doc_id.alias("doc_id"), text.alias("text"))
    sent = spark.sparkContext.broadcast(frequent_words(rows, table, cached_words, sample_docs, scratch))
    raw = piece_bytes(table)

    def others(batches):
        cuts, cache = cuts_of(pairs), sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = numbered(split_words(part.column("text"), cuts), cache)
                text = pa.array(found.text)
                yield pa.RecordBatch.from_arrays([part.column("d").take(text), part.column("h").take(text),
                                                  pa.array(found.numbers.astype(np.int32)), found.words], names=["d", "h", "number", "word"])

    def partly(batches):
        cuts, cache, codec = cuts_of(pairs), sent.value, pa.Codec("zstd")
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"), cuts)
                values, packed, digests = numbered(words, cache).values, [], []
                for i, (a, b) in enumerate(zip(words.bounds, words.bounds[1:])):
                    halves = values[a:b].view(np.uint16).reshape(-1, 2).T  # low halves, then high ones
                    packed.append(codec.compress(halves.tobytes(), asbytes=True) if b > a else b"")
                    digests.append(xxhash.xxh3_128_digest(words.marked[i]) if check else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("d"), part.column("h"), part.column("doc_id"), pa.array(digests, pa.binary()),
                     pa.array(np.diff(words.bounds).astype(np.int64)), pa.array(packed, pa.binary())],
                    names=["d", "h", "doc_id", "digest", "n_words", "packed"])

    def filled(batches):
        cache, codec = sent.value, pa.Codec("zstd")
        known, sizes_known = len(cache.words), np.diff(cache.starts)
        for whole in batches:
            for batch in parts(whole, whole.column("n_words").to_numpy(zero_copy_only=False).astype(np.int64)):
                lengths = batch.column("n_words").to_numpy(zero_copy_only=False).astype(np.int64)
                halves = [np.frombuffer(codec.decompress(p, 4 * int(n), asbytes=True), np.uint16).reshape(2, -1)
                          for p, n in zip(batch.column("packed").to_pylist(), lengths) if n]
                values = np.concatenate(halves, axis=1).T.copy().view(np.int32).ravel() if halves else np.empty(0, np.int32)
                found = batch.column("found")
                counts = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.cumsum(counts) - counts
                numbers, own = found.flatten().flatten()
                place = np.empty(len(numbers), np.int64)
                place[np.repeat(before, counts) + numbers.to_numpy(zero_copy_only=False)] = np.arange(len(numbers))
                own_sizes = pc.list_value_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
                gaps = np.flatnonzero(values >= known)
                which = place[np.repeat(before, lengths)[gaps] + values[gaps] - known]
                there = np.flatnonzero(values < known)
                sizes = np.empty(len(values), np.int64)
                sizes[there], sizes[gaps] = sizes_known[values[there]], own_sizes[which]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                ids = np.empty(ends[-1], np.int32)
                ids[runs(ends[there], sizes[there])] = cache.ids[runs(cache.starts[values[there]], sizes[there])]
                ids[runs(ends[gaps], sizes[gaps])] = own.flatten().to_numpy(zero_copy_only=False)[
                    runs((np.cumsum(own_sizes) - own_sizes)[which], sizes[gaps])]
                bounds = ends[np.concatenate([[0], np.cumsum(lengths)])]
                columns = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)), batch.column("n_words")]
                if check:
                    columns.append(pa.array([xxhash.xxh3_128_digest(b"".join(map(raw.__getitem__, ids[a:b].tolist()))) == digest
                                             for a, b, digest in zip(bounds, bounds[1:], batch.column("digest").to_pylist())], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_words", "decodes"][:3 + check])

    places = scratch.keep(rows.select("d", "h", "text").mapInArrow(others, "d long, h long, number int, word string"), "places")
    distinct = scratch.keep(places.select("word").distinct(), "distinct")
    new = written_words(distinct, table, scratch, "words")
    scratch.drop("distinct")
    joined = scratch.keep(places.join(new, "word").select("d", "h", "number", F.col("ids").alias("own")), "joined")
    scratch.drop("places", "words")
    found = scratch.keep(joined.groupBy("d", "h").agg(F.collect_set(F.struct("number", "own")).alias("found")), "found")
    scratch.drop("joined")
    part = rows.mapInArrow(partly, "d long, h long, doc_id long, digest binary, n_words long, packed binary")
    return part.join(found, ["d", "h"], "left").select("doc_id", "n_words", "digest", "packed", "found").mapInArrow(
        filled, "doc_id long, ids array<int>, n_words long" + ", decodes boolean" * check)


def decode(encoded: DataFrame, table: PieceTable, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the text of their ids."""
    return decoded_words(encoded, table, ids).withColumn("decoded", F.expr("substring(replace(decoded, '▁', ' '), 2)"))


def word_digests(words: DataFrame) -> DataFrame:
    """doc_id, n_words, n_pieces, ids_digest, decodes of the rows of ``encode_words``.

    The digest is the exclusive or of the hashes of (position, ids), so it can be summed in any order and still tells orders apart.
    """
    word = F.col("position") >= 0
    return words.groupBy("doc_id").agg(
        F.sum(word.cast("long")).alias("n_words"), F.sum(F.size("ids").cast("long")).alias("n_pieces"),
        F.coalesce(F.bit_xor(F.when(word, F.xxhash64("position", "ids"))), F.lit(0).cast("long")).alias("ids_digest"),
        F.min("decodes").alias("decodes"))
