"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import contextlib
import hashlib
import random
import re
import subprocess
import sys
from collections import Counter

import pytest

pytest.importorskip("tallyforge.llm")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallyforge.llm import chat, common, components, fingerprints, mixing, near_dup, pieces, secrets, suffix_dedup, topk, toxicity, warc  # noqa: E402
from tallyforge.llm.queries import LLM_QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, row string, key string, nodes string, n_shingles string, part string"


def made_up(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9)))
    texts = [" ".join(word() for _ in range(r.choice((3, 30, 200, 400)))) for _ in range(24)]
    passage = " ".join(word() for _ in range(120))
    texts += [f"{texts[0]} {passage}", f"{passage} {texts[1]}", texts[4], texts[4], texts[5] + " end", "a" * 1500, "ab" * 3000, "x", " \n ", "é漢😀 " * 300]
    near = texts[6].split()
    near[len(near) // 2] = "changed"
    texts += [" ".join(near), texts[7].upper(), passage * 2]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(50, None), (51, ""), (52, "x"), rows[4], (None, "no id " * 100), (60, " ".join(word() for _ in range(9000)))]
    return [(i, t, "en", f"src{(i or 0) % 3}", "row", "key", None, "n", "part") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made_up(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def removed(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, raw):
        spans = []
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + b[at:s], e
        out.append((i, len(b), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept + b[at:]).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [400, 60])
def test_repeated_strings(spark, docs, none, length):
    rows = [(r[0], r[1]) for r in made_up()]
    found = suffix_dedup.removed_bytes(docs, length=length, depth=32, batches=3).drop("spans").collect()
    assert sorted(map(tuple, found), key=repr) == removed(rows, length)
    if length == 400:
        assert suffix_dedup.removed_bytes(none).collect() == []


def test_repeated_strings_over_cuts(spark, monkeypatch):
    r = random.Random(8)
    letters = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    texts = [letters(3000) for _ in range(12)]
    for i in range(12):
        for _ in range(6):  # a string of 400 to 460 bytes, about its shared middle a shorter one
            n, at = r.randint(400, 460), r.randint(0, 2500)
            texts.append(letters(r.randint(1, 300)) + texts[i][at:at + n] + letters(r.randint(1, 300)))
            texts.append(letters(200) + texts[i][at + 40:at + 390] + letters(200))
    whole = [suffix_dedup.anchors(t.encode(), 400, 32) for t in texts]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 97)
    assert [suffix_dedup.anchors(t.encode(), 400, 32) for t in texts] == whole
    rows = list(enumerate(texts))
    found = suffix_dedup.removed_bytes(spark.createDataFrame(rows, "doc_id long, text string"), batches=2).drop("spans").collect()
    assert sorted(map(tuple, found), key=repr) == removed(rows, 400)


def test_many_kinds_with_one_core_are_divided_among_tasks(spark, tmp_path):
    kinds = spark.range(0, 40000, 1, 16).select(
        F.when(F.col("id") % 20 > 0, F.lit("core")).otherwise(F.md5(F.col("id").cast("string"))).cast("binary").alias("need"),
        F.lit(1).cast("long").alias("n"), "id")
    kinds.write.parquet(f"{tmp_path}/kinds")
    kinds = spark.read.parquet(f"{tmp_path}/kinds")
    kinds = kinds.unionByName(kinds.withColumn("id", F.col("id") + 40000))
    places = kinds.select("id", F.lit(1).alias("weight"), F.lit(True).alias("whole"), "need", F.lit(b"").alias("all"))
    small = {"adaptive.enabled": "true", "adaptive.skewJoin.enabled": "true", "autoBroadcastJoinThreshold": "-1",
             "adaptive.autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false", "shuffle.partitions": "16",
             "adaptive.advisoryPartitionSizeInBytes": "16k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    with contextlib.ExitStack() as held:
        for key, value in small.items():
            held.enter_context(common.setting(spark, f"spark.sql.{key}", value))
        open_ = common.Scratch(spark, "test").keep(suffix_dedup._open(kinds), "open")
        assert open_.count() == 2001  # each other need has its kind and the kind's copy
        found = suffix_dedup._to_cut(places, kinds, open_)
        assert len(found.collect()) == 80000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_suffix_levels_merge_geometrically(spark, docs):
    family = suffix_dedup.SuffixFamily(spark, 60, 32)
    seen = []
    for i in range(5):
        family.add(docs.filter(F.col("doc_id") % 5 == i))
        seen.append(sorted(family.levels))
    family.drop()
    assert seen == [[0], [1], [0, 1], [2], [0, 2]]


def shingles(text, width):
    w = [bytes(x) for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, docs, none, width):
    rows = [(r[0], r[1]) for r in made_up()]
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    found = near_dup.near_duplicates(docs, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None} == {
        i: (len(sets[i]), group[i], group[i] == i) for i in sets}
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]
    if width == 2:
        assert near_dup.near_duplicates(none).collect() == []


@pytest.mark.parametrize("shape, rounds", [("stars", 0), ("none", 0), ("path", 5), ("ties", 5)])
def test_components_end_when_edges_are_stars(spark, monkeypatch, shape, rounds):
    rng = random.Random(8)
    links = {"stars": [(5, i) for i in range(6, 60)] + [(70, 71)], "none": [], "path": [(i, i + 1) for i in range(30)],
             "ties": [(a, a + rng.randint(1, 9)) for a in range(0, 400, 3) for _ in range(3)] + [(7, 7), (2, 0), (0, 2)]}[shape]
    least = {x: x for link in links if link[0] != link[1] for x in link}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    written, keep = [], common.Scratch.keep
    monkeypatch.setattr(common.Scratch, "keep", lambda self, df, name: (written.append(name), keep(self, df, name))[1])
    found = components.components(spark.createDataFrame(links, "a long, b long"), common.Scratch(spark, "test")).collect()
    assert sorted(map(tuple, found)) == sorted(least.items())
    assert len(written) <= 1 + rounds and written[0] == "stars-0"


def test_copies_of_one_text_are_divided_among_tasks(spark, monkeypatch):
    docs = spark.range(0, 20000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, "one very common text").otherwise(
        F.concat(F.lit("own words "), F.col("id").cast("string"))).alias("text"))
    plans, keep = {}, common.Scratch.keep

    def kept(self, df, name):
        if name == "members":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name)

    monkeypatch.setattr(common.Scratch, "keep", kept)
    small = {"adaptive.enabled": "true", "adaptive.skewJoin.enabled": "true", "autoBroadcastJoinThreshold": "-1",
             "adaptive.autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false", "shuffle.partitions": "16",
             "adaptive.advisoryPartitionSizeInBytes": "16k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    with contextlib.ExitStack() as held:
        for key, value in small.items():
            held.enter_context(common.setting(spark, f"spark.sql.{key}", value))
        found = near_dup.near_duplicates(docs).filter("component_id = 1").count()
    assert found == 15000 and "skew=true" in plans["members"]


@pytest.mark.parametrize("bounds", [(2, 100), (256, 200000), (5, 30)])
def test_links_across_components_in_blocks(spark, bounds):
    r = random.Random(9)
    base = r.sample(range(10000), 30)
    sets = {i: sorted(set(base[:r.randint(20, 30)] + r.sample(range(10000, 10100), r.randint(0, 6)))) for i in range(40)}
    part = {i: 0 if i < 15 else i for i in sets}
    keys = {k: set(r.sample(range(40), 12)) | {0} for k in range(9)}
    placed = spark.createDataFrame([(k, i, part[i], min(part[j] for j in m)) for k, m in keys.items() for i in m],
                                   "key long, rep long, component long, m long")
    scratch = near_dup.Scratch(spark, "blocks-test")
    got = {(x.a, x.b) for x in near_dup._links_across(
        placed, spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "rep long, n long"),
        spark.createDataFrame(list(sets.items()), "doc_id long, elements array<long>"), 80, scratch, *bounds).collect()}

    def linked(a, b):
        return 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))

    assert got and all(linked(a, b) and part[a] != part[b] for a, b in got)
    joined = {(part[a], part[b]) for a, b in got} | {(part[b], part[a]) for a, b in got}
    for m in keys.values():
        assert all((part[a], part[b]) in joined for a in m for b in m if part[a] != part[b] and linked(a, b))


def test_sketch_agreement_follows_similarity():
    import numpy as np
    rng, shares = np.random.default_rng(5), []
    for n in (8, 60, 2000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[: n * 3 // 4], rng.integers(0, 2**63, n // 4, dtype=np.uint64)])
        s, t = near_dup.fast_sketch(a, 512), near_dup.fast_sketch(b, 512)
        shares.append((s == t).mean() - 0.6)
    assert max(map(abs, shares)) < 0.12


def test_fingerprints_and_edits(spark, docs, none):
    rows = {r[0]: r[1] or "" for r in made_up() if r[0] is not None}
    ids = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprinted_edits(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    errors = []
    for k, i in enumerate(ids):
        text, other = rows[i], rows[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingles(text, 5), shingles(edited, 5)
        errors.append(abs(got[i].near_edited - (len(a & b) / len(a | b) if a | b else 1)))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.06
    assert got[52].fingerprint == got[[i for i in rows if rows[i] == "x"][0]].fingerprint and got[51].fingerprint == ""
    assert fingerprints.fingerprinted_edits(docs).count() == docs.count()  # with repeated and null ids
    assert fingerprints.fingerprinted_edits(none).collect() == []


def test_top_products(spark):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)], "x") for i in range(300)]
    rows += [(i, rows[3][1], "x") for i in range(300, 340)] + [rows[0], (400, None, "x"), (401, [1.0, None], "x"), (402, [float("nan")] * 6, "x"),
                                                              (403, [0.5], "x"), (450, [], "x"), (None, [1.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string").repartition(4)
    usable = {x.vec_id: [int(v * 256 // 1) for v in x.embedding] for x in frame.collect()
              if x.vec_id is not None and x.embedding is not None and all(v is not None and v == v for v in x.embedding)}
    want = set()
    for q in (i for i in usable if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)[:5]
        want |= {(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)}
    got = topk.top_products(frame, F.col("vec_id") % 50 == 0, block_rows=64, pivots=5, rings=4, rounds=(1, 4))
    assert {tuple(x) for x in got.collect()} == want
    assert topk.top_products(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_archives(spark, tmp_path):
    pages = [(3, "u3", "same"), (1, "u1", "same"), (2, "u\r\n2", "a\r\n\r\nb é"), (4, None, None), (5, "u5", ""), (None, "u", "same"), (1, "u1", "same"), (9, "u9", "q" * 100000)]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, payload string, refers_to string")
    path = str(tmp_path / "a")
    warc.write_archives(warc.planned_records(frame), path, records_per_file=2)
    back = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload) for r in back) == Counter([
        (3, "revisit", 1, "same"), (1, "response", None, "same"), (1, "response", None, "same"), (None, "revisit", 1, "same"),
        (2, "response", None, "a\r\n\r\nb é"), (4, "response", None, ""), (5, "revisit", 4, ""), (9, "response", None, "q" * 100000)])
    small = {r.page_id: r.record_type for r in warc.planned_records(frame, min_bytes=1).collect()}
    assert small[5] == small[4] == "response" and small[3] == "revisit"
    warc.write_archives(warc.planned_records(frame.limit(0)), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).collect() == []


def test_chat_round_trip(spark):
    rows = [(1, 1, "assistant", "[INST] \\ </s>"), (1, 0, "user", None), (1, 1, "assistant", "[INST] \\ </s>"), (2, 0, None, "x"), (None, None, "tool", "<|turn|>" * 50), (3, 0, "assistant", "é漢😀 " * 2000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, position string")
    formatted = chat.format_conversations(frame)
    back = sorted(chat.read_back(formatted).collect(), key=repr)
    assert sorted((r.conv_id, r.role, r.text) for r in back if r.conv_id) == sorted((c, r or "", t or "") for c, _, r, t in rows if c)
    assert [r.loss_text for r in back if r.conv_id == 2] == [None] and all(r.loss_text == r.text for r in back if r.role == "assistant")
    spans = sorted((r.conv_id, r.first_token, len(r.token_ids)) for r in formatted.filter("conv_id = 1").collect())
    assert all(a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:]))
    assert all(chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROLS) for t in ("\\[INST]", "<<s>s>", "</s>\\"))
    assert chat.conversation_digests(chat.format_conversations(frame.limit(0))).collect() == []


def test_pieces_follow_the_library(spark, docs, none):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(pieces.MODEL, "rb").read())
    proto.trainer_spec.model_type = 1  # best path by scores; scores of -1e9 are not exact in its single precision
    for p in proto.pieces:
        if p.type == 1:
            p.score = max(p.score, -40000)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    table = pieces.load_pieces()
    table = table._replace(pieces=[(p, i, max(s, -40000.0)) for p, i, s in table.pieces], unknown_score=-40010.0)
    for cached in (0, 50):
        got = pieces.decode(pieces.encode(docs, table, cached_words=cached), table).collect()
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(
            (r[0], tuple(library.encode(r[1] or "")), r[1] or "") for r in made_up())
    digests = {r.doc_id: r for r in pieces.word_digests(pieces.encode_words(docs.dropDuplicates(["doc_id"]), table)).collect()}
    assert all(digests[r[0]].n_pieces == len(library.encode(r[1] or "")) and digests[r[0]].decodes for r in made_up() if r[0] is not None)
    assert all(r.decodes for r in pieces.encode(docs, table, cached_words=50, check=True).collect())
    marked = spark.createDataFrame([(1, "a▁b"), (1, "a b"), (2, None), (2, "漢")], "doc_id long, text string")
    assert [r.decodes for r in pieces.encode(marked, table, check=True).collect()] == [True] * 4
    assert pieces.encode(none, table).collect() == []
    assert pieces.encode(none, table, check=True).collect() == []


def test_pieces_in_use_and_cuts_change_no_path(spark):
    rng = random.Random(4)
    table = pieces.load_pieces()
    assert len(table.in_use) < len(table.pieces) / 2

    def best(text):  # all pieces, no cuts; of equal scores the longer last piece
        scores, longest = {p: (s, i) for p, i, s in table.pieces}, max(len(p) for p, _, _ in table.pieces)
        ways = [(0.0, 0, [])]
        for end in range(1, len(text) + 1):
            found = []
            for start in range(max(0, end - longest), end):
                piece = text[start:end]
                if piece in scores:
                    found.append((ways[start][0] + scores[piece][0], -start, ways[start][2] + [scores[piece][1]]))
                elif end - start == 1:
                    found.append((ways[start][0] + table.unknown_score, -start, ways[start][2] + [table.byte_ids[b] for b in piece.encode()]))
            ways.append(max(found, key=lambda w: w[:2]))
        return ways[-1][2]

    inside = [p.replace("▁", " ") for p, _, _ in table.pieces]
    texts = ["".join(rng.choice(inside) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    texts += ["".join(rng.choice("ab the.,1\n  é漢\U0001f600") for _ in range(60)) for _ in range(50)] + ["a" * 700, "7" * 30000, " " * 300, "漢字" * 9000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.encode(rows, table, cached_words=20, check=True).collect()}
    for i, t in enumerate(texts):
        assert got[i].decodes and list(got[i].ids) == best("▁" + t.replace(" ", "▁")), t[:80]


def test_toxicity_held_out(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    held = toxicity.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.rejected == bool(r.toxic) for r in held) / len(held) > 0.93
    assert model.thresholds == sorted(model.thresholds)
    assert toxicity.fit(none, labels).weights == {}
    extra = spark.createDataFrame([(1, None, 5.0), (1, "", 5.0)], "doc_id long, text string, p_toxic double")
    assert [r.rejected for r in toxicity.score(extra, model).collect()] == [False, False]


def test_the_sample_of_the_fit_is_in_order_and_holds_no_python_numbers(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 2), rng.randint(0, 3), sorted(rng.sample(range(400), n)), [1 + rng.choice([0.0, 0.7, 1.1]) for _ in range(n)])
            for n in [rng.choice([0, 1, 1, 2, 5]) for _ in range(300)]] * 2
    frame = spark.createDataFrame(rows, "label int, marks long, at array<int>, value array<double>").repartition(5)
    found = toxicity.in_order(frame.toArrow())
    assert [(y, m, at.tolist(), value.tolist()) for y, m, at, value in found] == sorted(rows)
    assert all(x.base is not None for row in found for x in row[2:])


def test_mixing_budgets(spark, none):
    rows = [(1, "a", "s1", 100), (2, "a", "s2", 1000), (3, "b", "s3", 5000)]
    leaves = spark.createDataFrame([(a, s, t) for _, a, s, t in rows], "lang string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, ["lang", "source"], {"lang": {"a": 1, "b": 1}}, 500, 1).collect()}
    assert got == {"s1": 100, "s2": 1000, "s3": 1950}  # a is short by its own limit, after s2 took what s1 lacks
    units = spark.createDataFrame([(i, "a", "s", 7) for i in range(1000)], "doc_id long, lang string, source string, n_tokens long")
    copies = mixing.mixed(units, ["lang", "source"], {}, 1.25, 2).agg(F.sum(F.col("copies") * 7)).first()[0]
    assert 8750 - 7 < copies <= 8750
    assert mixing.mixed(none.select("doc_id", "lang", "source", F.lit(1).cast("long").alias("n_tokens")), ["lang", "source"], {}, 1.0).collect() == []


def test_secrets(spark, none):
    key = "AKIA" + "ABCD1234EFGH5678"
    texts = [(1, f"id {key} end\npassword = \"9f8e7d6c5b4a39281706\""), (2, f"{key}"), (3, "order 1234567890123456 sent"), (4, None), (5, ""), (None, f"x {key}"), (2, f"{key}")]
    frame = spark.createDataFrame([(*t, "a") for t in texts], "doc_id long, text string, candidate string")
    found = secrets.scan(frame)
    got = {(r.doc_id, r.candidate): r.is_secret for r in found.collect()}
    assert got == {(1, key): True, (1, "9f8e7d6c5b4a39281706"): True, (2, key): True, (3, "1234567890123456"): False, (None, key): True}
    clean = secrets.redacted(frame, found).collect()
    assert len(clean) == len(texts) and not any(key in (r.text or "") for r in clean) and [r.text for r in clean if r.doc_id == 3] == [texts[2][1]]
    assert secrets.scan(none).collect() == []


def test_secrets_in_every_context(spark):
    a, b = "Zk9Qw2Lp7Vx4Tn8Rb5Yc", "9f8e7d6c5b4a39281706"
    texts = [(1, f"{a}\ntoken = \"{a}\""), (2, f"commit {b} and token = {b}"), (3, f"commit {b}"), (4, "😀" * 70 + f" x{a}x {a}"), (5, f"{a} {a}")]
    texts += [(i, f"token = {i}{a}") for i in range(100, 140)] + [(i, f"commit {i}{b}") for i in range(200, 240)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.candidate): r for r in secrets.scan(frame).collect()}
    assert got[1, a].is_secret and got[2, b].is_secret and not got[3, b].is_secret
    assert [got[i, a].n_lines for i in (1, 4, 5)] == [2, 1, 1]
    assert got[4, a].before == "😀" * 36 + f" x{a}x " and got[2, b].before.endswith("token = ")
    found = [(r.before, r.after, r.n_lines) for r in secrets.findings(frame.filter("doc_id = 5")).orderBy("before").collect()]
    assert found == [("", f" {a}", 1), (f"{a} ", "", 0)]
    clean = {r.doc_id: r.text for r in secrets.redacted(frame, secrets.scan(frame)).collect()}
    assert clean[1] == "<secret>\ntoken = \"<secret>\"" and b not in clean[2]


def test_secrets_of_any_form(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.abcDEF"
    wanted = {1: "hunter2", 2: "correct-horse-battery-staple", 3: "qwertyuiopasdfghjklzxcvbnm", 4: "Zk9$wQ!t7#pLx2@vB4", 5: jwt, 6: "a \\E$1 b"}
    texts = [(1, 'password = "hunter2" # hunter2, not hunter20'), (2, f'password = "{wanted[2]}"'), (3, f'secret = "{wanted[3]}"'),
             (4, f'api_key: "{wanted[4]}"'), (5, f"sent {jwt}. Then"), (6, f"pwd='{wanted[6]}' secret"), (7, "password = getpass()"), (8, 'token = ""')]
    texts += [(i, f'see order {i}1234567890123456 or token: null, token = $TOKEN') for i in range(100, 130)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = secrets.scan(frame)
    got = {(r.doc_id, r.candidate): r.is_secret for r in found.collect()}
    assert all(got[x] for x in wanted.items()) and not got[7, "getpass()"] and not any(i == 8 for i, _ in got)
    assert not got[100, "null,"] and not got[100, "$TOKEN"]
    clean = {r.doc_id: r.text for r in secrets.redacted(frame, found).collect()}
    assert clean[1] == 'password = "<secret>" # <secret>, not hunter20' and clean[5] == "sent <secret>. Then" and clean[6] == "pwd='<secret>' secret"
    assert [clean[i] for i in (7, 8, 100)] == [t for i, t in texts if i in (7, 8, 100)]
    long_ = "x1" * 100000 + ".y" * 100000 + ' pwd="' + "\\\"z" * 50000
    assert secrets.findings(frame.limit(1).withColumn("text", F.lit(long_))).count() == 3


def test_near_duplicate_stage_counts_rows(spark):
    same, other = "one two three four five six seven", "a b c d e f g h"
    rows = [(5, same), (5, same), (3, same), (None, same), (None, other), (None, other), (7, "alone in here"), (7, f"{other} x y z q"), (8, None), (8, None),
            (9, ""), (None, " "), (None, " ")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, key string").repartition(3)
    got = corpus_pipeline.near_duplicate_stage(spark, frame, FOLDER).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(3, same), (None, other), (7, "alone in here"), (7, f"{other} x y z q"), (8, None), (9, ""), (None, " ")], key=repr)


def test_rare_labels_are_in_every_sample(spark):
    assert common.shares({0: 1000, 1: 3}, 20) == {0: 17, 1: 3} and common.shares({0: 9, 1: 9}, 10) == {0: 5, 1: 5} and common.shares({}, 5) == {}
    texts = spark.range(1, 4001).selectExpr("id AS doc_id", "CASE WHEN id % 200 = 0 THEN 'vile nasty words ' || id ELSE 'fine kind words ' || id END AS text")
    labels = texts.selectExpr("doc_id", "CASE WHEN doc_id % 200 = 0 THEN 1 ELSE 0 END AS toxic")
    labels = labels.union(spark.range(5000, 9000).selectExpr("id", "1"))  # labels without a document
    model = toxicity.fit(texts, labels, max_labelled=40)
    assert [r.doc_id for r in toxicity.score(texts, model).filter("rejected").orderBy("doc_id").collect()] == list(range(200, 4001, 200))
    key = "AKIA" + "ABCD1234EFGH56"
    keys = texts.selectExpr("doc_id", f"CASE WHEN doc_id % 200 = 0 THEN '{key}' || (10 + doc_id div 200) ELSE '123456789012' || (10000 + doc_id) END AS text")
    found = secrets.scan(keys, max_labelled=16).filter("is_secret").orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(200, 4001, 200))


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER).cache()
        assert after.columns == columns and 0 < after.count() <= before, name
        docs, before = after, after.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == before
    assert not docs.filter(docs.text.rlike("AKIA[0-9A-Z]{16}")).count()


def test_large_components_of_products(spark):
    rows = [(i * 10, [1e9 * (1 + i % 3), float(i), -2.0]) for i in range(12)] + [(7, [1e9, 1.0]), (8, [-3e8, 2.0, 1.0]), (9, [0.5])]
    found = topk.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0)
    whole = {i: [int(256 * x) for x in v] + [0] * (3 - len(v)) for i, v in rows}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        best = sorted((-min(2**63 - 1, max(1 - 2**63, sum(a * b for a, b in zip(whole[q], v)))), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_a_megabyte_of_credential_names(spark):
    line = "token=" * 170_000
    docs = spark.createDataFrame([(1, line), (2, "password=hunter2 token=hunter3")], "doc_id long, text string")
    found = secrets.findings(docs).collect()
    assert len([r for r in found if r.doc_id == 1]) == 1 and sum(len(r.candidate) for r in found) < 1.1 * len(line)
    assert {r.candidate for r in found if r.doc_id == 2} == {"hunter2", "hunter3"}


def test_pipeline_keeps_columns_of_any_name(spark, monkeypatch):
    """Columns that stages make for themselves do not meet the table's own, and null ids, texts and an empty table come through."""
    names = ["rejected", "p_toxic", "domain", "copy", "copies", "n_tokens", "slice", "key", "order"]
    rows = [(i, f"text {i} with a few plain words " * (1 + i % 4), "en", f"src{i % 4}") for i in range(40)] + [(None, "no id at all here", "fr", None), (99, None, None, "src1")]
    docs = spark.createDataFrame([(*r, *[f"own {n}" for n in names]) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    for table_ in (docs, docs.limit(0)):
        kept = table_
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = common.Scratch(spark, "names").keep(stage(spark, kept, FOLDER), name)
            assert kept.columns == docs.columns
        found = kept.collect()
        assert all(r[n] == f"own {n}" for r in found for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_entry_works_without_this_part():
    code = ("import sys; sys.modules['tallyforge.llm'] = None; import __spark_entry__ as e; "
            "assert e.queries() and not [q for q in e.queries() if re.match('op[0-9]|pipeline', q)]")
    subprocess.run([sys.executable, "-c", "import re; " + code], check=True, cwd=re.sub("/tests/llm/.*", "", __file__))


def test_no_query_reads_python_where_native_is_asked(spark):
    for name in ("op7_fingerprints", "op9_source_mixing", "op10_secret_scan"):
        plan = LLM_QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
