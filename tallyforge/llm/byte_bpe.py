"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary file gives ranks of byte strings. Each byte stands for one printable character (the byte table), so a rank becomes a
piece of characters; the pair that made it is found by merging its bytes with the ranks below its own. From pieces and pairs the
library's BPE model is built once on the driver and sent to the tasks as a text of the size of the vocabulary.

Texts are cut before each single blank between two characters that are no white space: a match of the pattern always begins there
and none reaches across, whatever the characters are. The library then works on the distinct cuts of a megabyte or two of text, with
the pattern and the merges, and numpy puts their ids together; a worker remembers a bounded number of cuts from slice to slice. A
token's place is the span of characters in the text that hold its bytes, from the sizes of the tokens before it and the map of bytes
to characters: tokens that share a character's bytes share its place. Decoding looks the ids up, turns characters back
into bytes by the same table and joins the bytes of the whole text first, so characters split between tokens come out whole.

Defined cases: null texts are empty, empty ones have no tokens; null ids stay null; equal rows are encoded each; texts of any length
are encoded whole; an empty table gives no rows; special tokens in texts are ordinary text; other columns are kept, whatever their
names, but columns named as the outputs are replaced; bytes that are no UTF-8 after decoding (ids that do not come from a text)
become U+FFFD in ``decoded_text`` and stay as they are in ``decoded``; a null list of ids decodes to nothing, an unknown id is an error.
"""

from __future__ import annotations

import base64
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import new_name, per_worker, text_of

#: Bytes of text that are encoded at a time.
SLICE = 1 << 20
#: Cuts, and bytes of one, that a worker remembers; more and longer ones are encoded anew.
REMEMBERED, LONGEST = 200_000, 64
#: Cuts that go to the library in one text.
TOGETHER = 500
#: White space by any version of Unicode; no text is cut beside it.
WHITE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F,
         0x2060, 0x3000, 0xFEFF]


def byte_table() -> list[str]:
    """The character of each byte: itself where it is printable in Latin-1, else one after U+00FF, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> rank, from lines of base64 and number."""
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}


def made_from(word: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that are left of a word when only pairs below its own rank are merged, lowest rank first; None if there are more."""
    parts, limit = [word[i:i + 1] for i in range(len(word))], ranks[word]
    while len(parts) > 2:
        joined = [(ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(joined)
        if rank >= limit:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class Vocabulary(NamedTuple):
    """``model`` is the library's own form of the tokenizer, ``path`` names it in the workers' memory; ``bytes`` are those of all ids, one
    after the other, ``sizes`` how many each id has."""
    path: str
    model: str
    bytes: np.ndarray
    sizes: np.ndarray


def load_vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """The tokenizer of a rank file and a pattern (default: the many-language file of the public tokenizers and their pattern)."""
    import public_tokenizers
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    ranks, table = load_ranks(path), byte_table()
    name = lambda word: "".join(table[b] for b in word)
    pairs = []
    for word in sorted((w for w in ranks if len(w) > 1), key=ranks.get):
        parts = made_from(word, ranks)
        if parts:  # others are reached as whole matches only
            pairs.append((name(parts[0]), name(parts[1])))
    tokenizer = Tokenizer(models.BPE(vocab={name(w): i for w, i in ranks.items()}, merges=pairs, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tokenizer.decoder = decoders.ByteLevel()
    byte_of = {c: b for b, c in enumerate(table)}
    words = [b""] * (max(ranks.values()) + 1)
    for piece, i in tokenizer.get_vocab().items():
        words[i] = bytes(byte_of[c] for c in piece)
    return Vocabulary(f"{path}|{pattern}", tokenizer.to_str(), np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64))


class Coder:
    """The tokenizer in a worker, and the encodings that it remembers."""

    def __init__(self, model: str, sizes: np.ndarray):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer, self.sizes = Tokenizer.from_str(model), sizes
        self.white = np.zeros(0x110000, bool)
        self.white[WHITE] = True
        self.known: dict[bytes, bytes] = {}

    def ids_of(self, words: list[bytes], plain: np.ndarray) -> list[bytes]:
        """The ids of each word as bytes of 32-bit numbers, from the library or from what it gave before.

        Words that are ``plain`` (between two cuts) may stand one after the other in one text, as the pattern cuts between them.
        """
        out = list(map(self.known.get, words))
        new = [i for i, x in enumerate(out) if x is None]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        joined = [i for i in new if plain[i]]
        groups = [joined[i:i + TOGETHER] for i in range(0, len(joined), TOGETHER)] + [[i] for i in new if not plain[i]]
        found = self.tokenizer.encode_batch_fast([b"".join([words[i] for i in g]).decode() for g in groups], add_special_tokens=False)
        for group, e in zip(groups, found):
            ids = np.array(e.ids, np.int32)
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(words[i]) for i in group])) + 1
            raw, start = ids.tobytes(), 0
            for i, stop in zip(group, (4 * ends).tolist()):
                out[i], start = raw[start:stop], stop
        for i in new[:REMEMBERED]:
            if len(words[i]) <= LONGEST:
                self.known[words[i]] = out[i]
        return out


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Tokens(NamedTuple):
    """Tokens of some texts in a row: ids, first and last place in their text's characters, and where each text's tokens start."""
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def encoded_texts(texts: list[str], coder: Coder) -> Tokens:
    raw = [t.encode() for t in texts]
    joined = b"".join(raw)
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    text_bytes = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    text_chars = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not len(chars):
        return Tokens(*[np.zeros(0, np.int32)] * 3, np.zeros(len(texts) + 1, np.int64))
    black, cut = ~coder.white[chars], np.zeros(len(chars), bool)
    cut[1:-1] = (chars[1:-1] == 0x20) & black[:-2] & black[2:]
    heads = text_chars[:-1][np.diff(text_chars) > 0]
    inner = cut.copy()
    inner[heads] = False
    cut[heads] = True
    inner = inner[cut]
    begins = (np.frombuffer(joined, np.uint8) & 0xC0) != 0x80
    at = np.flatnonzero(begins)[cut]  # first byte of each cut
    cuts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(joined))), pa.py_buffer(joined)])
    coded = cuts.dictionary_encode()
    kind = coded.indices.to_numpy(zero_copy_only=False)
    plain = np.zeros(len(coded.dictionary), bool)
    plain[kind[inner & np.append(inner[1:], False)]] = True
    lists = coder.ids_of(coded.dictionary.to_pylist(), plain)
    sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
    distinct = np.frombuffer(b"".join(lists), np.int32)
    ids = distinct[spread((np.cumsum(sizes) - sizes)[kind], sizes[kind])]
    bounds = np.concatenate([[0], np.cumsum(sizes[kind])])[np.searchsorted(at, text_bytes)]
    stops = np.cumsum(coder.sizes[ids])  # tokens cover the bytes without gaps, so their sizes give their bytes and these the characters
    char_of = np.cumsum(begins)
    before = np.repeat(text_chars[:-1], np.diff(bounds))
    return Tokens(ids, (char_of[stops - coder.sizes[ids]] - 1 - before).astype(np.int32), (char_of[stops - 1] - before).astype(np.int32), bounds)


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int = SLICE):
    """Parts of a batch of at most ``most`` bytes (``sizes`` of its rows), or one larger row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _schema(df: DataFrame, **added: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name not in added], *[T.StructField(n, t) for n, t in added.items()]])


def encode(documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text") -> DataFrame:
    """The table's columns and ``ids``, ``starts``, ``ends``: token ids, and the characters of the text that each token comes from."""
    sent = documents.sparkSession.sparkContext.broadcast((vocabulary.model, vocabulary.sizes))  # of the vocabulary file's size
    key, whole = vocabulary.path, text_of(text_column)
    ints = T.ArrayType(T.IntegerType())
    schema = _schema(documents, ids=ints, starts=ints, ends=ints)
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches):
        coder = per_worker("byte-bpe", key, lambda: Coder(*sent.value))
        for batch in batches:
            last = batch.num_columns - 1
            for part in slices(batch, pc.binary_length(batch.column(last)).to_numpy(zero_copy_only=False).astype(np.int64)):
                tokens = encoded_texts(part.column(last).to_pylist(), coder)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], *[_lists(x, tokens.bounds) for x in (tokens.ids, tokens.starts, tokens.ends)]],
                    names=[*kept, "ids", "starts", "ends"])

    return documents.select(*[F.col(f"`{c}`") for c in kept], whole.alias(new_name("text"))).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids") -> DataFrame:
    """The table's columns and ``decoded`` (bytes) and ``decoded_text``, from the ids alone."""
    sent = encoded.sparkSession.sparkContext.broadcast((vocabulary.bytes, vocabulary.sizes))
    rows = encoded.drop("decoded", "decoded_text")
    schema = _schema(rows, decoded=T.BinaryType())
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches):
        words, sizes = sent.value
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            last = batch.num_columns - 1
            counts = pc.fill_null(pc.list_value_length(batch.column(last)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in slices(batch, 8 * counts):
                lists = part.column(last)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                raw = words[spread(starts[ids], sizes[ids])]
                bounds = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(n)])]
                texts = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*part.columns[:last], texts], names=[*kept, "decoded"])

    found = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids_column}`").alias(new_name("ids"))).mapInArrow(run, schema)
    return found.withColumn("decoded_text", F.make_valid_utf8(F.col("decoded").cast("string")))


def round_trip_digests(documents: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, split_tokens (tokens that hold only a part of a character's bytes, not its first).

    ``split_tokens`` counts by places: a token that begins at the same character as the one before.
    """
    rows = documents.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    encoded = encode(rows, vocabulary).select("doc_id", "ids", "starts")
    again = decode(encoded, vocabulary)
    return again.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.size("starts") - F.size(F.array_distinct("starts"))).cast("long").alias("split_tokens"))
