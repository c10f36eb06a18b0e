"""Periodic runs and byte-level BPE against brute force and the tiktoken library, on hard rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tallyforge.llm")

from pyspark.sql import functions as F  # noqa: E402

from tallyforge.llm import byte_bpe, periodic  # noqa: E402
from tallyforge.llm.queries import LLM_QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, ids string, runs string, words string, n string, a string, collapsed string, decoded string"


def texts():
    r = random.Random(9)
    some = [" ".join(r.choice(("to", "be", "or", "not")) for _ in range(r.randint(1, 60))) for _ in range(12)]
    some += ["a " * 3000, "x y z " * 700, "one two three one two three one two three one two three", "é漢😀 " * 90, "a" * 20000,
             " \n\t ", "a  b c d​e \x85f \x1cg", "<|endoftext|> <s>", "it's 12'll I've  \n\n x", "՘ Ᲊ \U0001f9ea ok",
             " lead", "trail ", "a b" * 40 + " ", "\r\n" * 9, "z"]
    return some


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7, t) for i, t in enumerate(texts())]
    rows += [(1000, None), (1001, ""), rows[3], rows[3], (None, "no id no id no id no id no id")]
    return spark.createDataFrame([(i, t, "ids", "runs", "words", "n", "a", "c", "d") for i, t in rows], SCHEMA).repartition(3)


def plain_runs(w, least=6, folds=4):
    found = set()
    for p in range(1, len(w) // folds + 1):
        i = p
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - p]:
                j += 1
            if j > i and j - i + p >= max(least, folds * p):
                if not any(all(w[x] == w[x - q] for x in range(i - p + q, j)) for q in range(1, p)):
                    found.add((i - p, j - i + p, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *first, digest(lines), digest(plain_collapsed(w, runs)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def test_runs_of_random_words_are_those_of_all_diagonals():
    r = random.Random(4)
    for _ in range(300):
        docs = []
        for _ in range(r.randint(1, 4)):
            w = []
            for _ in range(r.randint(0, 6)):
                if r.random() < 0.5:
                    block = [r.randint(0, r.choice((1, 2, 5))) for _ in range(r.randint(1, 9))]
                    w += (block * r.randint(1, 7))[:r.randint(0, 60)]
                else:
                    w += [r.randint(0, r.choice((1, 3, 30))) for _ in range(r.randint(0, 20))]
            docs.append(w)
        bounds = np.cumsum([0, *map(len, docs)])
        got = [tuple(map(int, x)) for x in periodic.word_runs(np.array([x for d in docs for x in d], np.int64), bounds)]
        assert got == [(int(s + b), n, p) for d, b in zip(docs, bounds) for s, n, p in plain_runs(d)]


def test_one_word_throughout_and_long_periods():
    n = 200_000
    assert periodic.word_runs(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]
    block = np.random.default_rng(3).integers(0, 50, 40_000)
    assert periodic.word_runs(np.tile(block, 4), np.array([0, 160_000])).tolist() == [[0, 160_000, 40_000]]
    assert periodic.word_runs(np.tile(block, 4)[:-1], np.array([0, 159_999])).tolist() == []


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.word_runs(np.zeros(9, np.int64), np.array([0, 9]), folds=2)


def test_runs_of_hard_rows(docs, monkeypatch):
    found = periodic.run_digests(periodic.periodic_runs(periodic.with_planted_periods(docs))).select(*COLUMNS).collect()
    assert sorted_rows(found) == sorted_rows(plain_row(r["doc_id"], r["text"]) for r in docs.collect())


def test_runs_keep_other_columns(docs):
    found = periodic.periodic_runs(docs)
    assert set(docs.columns) - {"runs", "collapsed"} < set(found.columns) and found.schema["runs"].dataType.typeName() == "array"
    assert {r["n"] for r in found.select("n").collect()} == {"n"}


def test_runs_query_on_whole_documents(spark):
    found = LLM_QUERIES["op11_periodic_runs"].run(spark, FOLDER).select(*COLUMNS).collect()
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert sorted_rows(found) == sorted_rows(plain_row(r["doc_id"], r["text"]) for r in rows)
    assert sum(r["n_runs"] for r in found) > 5


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.load_vocabulary()


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_places_and_bytes_of_hard_rows(docs, vocabulary, tiktoken_encoding):
    rows = byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary).collect()
    assert len(rows) == docs.count() and {r["words"] for r in rows} == {"words"}
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == tiktoken_encoding.encode_ordinary(text)
        assert bytes(r["decoded"]).decode() == text == r["decoded_text"]
        at, place_of = 0, [i for i, c in enumerate(text) for _ in c.encode()]
        for i, a, b in zip(r["ids"], r["starts"], r["ends"]):
            size = len(tiktoken_encoding.decode_single_token_bytes(i))
            assert (a, b) == (place_of[at], place_of[at + size - 1] + 1)
            at += size


def test_small_slices_give_the_same(docs, vocabulary):
    coder = byte_bpe.Coder(vocabulary.model, vocabulary.sizes)
    whole = byte_bpe.encoded_texts(texts(), coder)
    for i, text in enumerate(texts()):
        one = byte_bpe.encoded_texts([text], coder)
        a, b = whole.bounds[i], whole.bounds[i + 1]
        assert one.ids.tolist() == whole.ids[a:b].tolist() and one.starts.tolist() == whole.starts[a:b].tolist()


def test_every_character_in_many_surroundings(vocabulary, tiktoken_encoding):
    coder = byte_bpe.Coder(vocabulary.model, vocabulary.sizes)
    points = [*range(0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x110000, 997)]
    lines = [f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}?  {chr(c)}{chr(c)} {chr(c)} \n{chr(c)}\n {chr(c)} x" for c in points]
    got = byte_bpe.encoded_texts(lines, coder)
    for i, line in enumerate(lines):
        assert got.ids[got.bounds[i]:got.bounds[i + 1]].tolist() == tiktoken_encoding.encode_ordinary(line), hex(points[i])


def test_ids_that_cut_a_character(spark, vocabulary, tiktoken_encoding):
    ids = tiktoken_encoding.encode_ordinary("😀")
    assert len(ids) > 1
    rows = spark.createDataFrame([(1, ids), (2, ids[:1]), (3, None), (4, [])], "key int, ids array<int>")
    got = {r["key"]: (bytes(r["decoded"]), r["decoded_text"]) for r in byte_bpe.decode(rows, vocabulary).collect()}
    assert got[1] == ("😀".encode(), "😀") and got[2][1] == "�" and got[3] == got[4] == (b"", "")


def test_empty_tables(spark, vocabulary):
    none = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.round_trip_digests(none, vocabulary).count() == 0
    assert periodic.run_digests(periodic.periodic_runs(periodic.with_planted_periods(none))).count() == 0


def test_byte_query_on_whole_documents(spark, tiktoken_encoding):
    found = {r["doc_id"]: r for r in LLM_QUERIES["op12_byte_bpe"].run(spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(rows)
    for r in rows:
        ids, f = tiktoken_encoding.encode_ordinary(r["text"]), found[r["doc_id"]]
        assert f["n_tokens"] == len(ids) and f["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert f["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
