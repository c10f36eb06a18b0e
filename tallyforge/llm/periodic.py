"""Periodic runs of words by an online sparse diagonal DP over earlier occurrences.

A word at place i that also stands at place i - p extends the match on diagonal p by one; a diagonal whose match ends with at least
``folds`` periods (match length and lag together) and ``least`` words is a run. Not all pairs of equal words are followed, which would
be quadratic in a frequent word: periods are taken in classes, p in (k / 2, k] for k = 1, 2, 4, ..., and a place counts by the k
words that start there. Inside a run of smallest period p the k-gram at a place cannot return before p words, or the run would have a
shorter period (Fine and Wilf, as k >= p), and with three periods or more each stretch holds such pairs (k <= 2p - 1). So on the
class's diagonals only the nearest earlier occurrence of each k-gram has to be followed, one entry a place, and none is lost. For the
same reason the lag found is the smallest period, and a stretch ends only where the run ends. k-grams are numbered exactly, those of
2k words by the pairs of their halves' numbers (no hashes); a place whose k-gram stands alone in its document leaves all larger classes.

Documents never meet: places of many documents are numbered in one row, in parts of some megabytes, or one longer text. Work is n log n
in the words of a part, with no shuffle.

Words are ``[^\\x20\\x09-\\x0D]+``, and equal if their bytes are.

Defined cases: null texts are empty, and without words there is no run; null ids stay null; repeated rows get equal results; texts of any
length are taken whole; a word repeated throughout is one run of period 1; an empty table gives no rows; other columns are kept but for
those named as the outputs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import new_name, text_of

#: Bytes of text that are numbered together.
SLICE = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int = SLICE):
    """Parts of a batch of at most ``most`` bytes (``sizes`` of its rows), or one larger row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _nearest(kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at`` (ascending) and the numbers of their grams: how far back the same gram stands last (0: nowhere), and whether
    it stands anywhere else."""
    order = np.argsort(kind, kind="stable")
    same = kind[order[1:]] == kind[order[:-1]]
    back = np.zeros(len(at), np.int64)
    back[order[1:][same]] = at[order[1:][same]] - at[order[:-1][same]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return back, again


def word_runs(words: np.ndarray, bounds: np.ndarray, least: int = 6, folds: int = 4) -> np.ndarray:
    """start, length, period of all runs, sorted by start and period, of documents whose word numbers stand in one row (from ``bounds``).

    ``folds`` of at least 3 is what the classes of periods rest on. Starts count in the row, not in the document.
    """
    if folds < 3:
        raise ValueError("runs need three periods or more")
    n = len(words)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(n)
    _, kind = np.unique(doc * (int(words.max(initial=0)) + 1) + words, return_inverse=True)
    found, k = [], 1
    while len(at):
        back, again = _nearest(kind, at)
        live = (back > k // 2) & (back <= k)
        i, p = at[live], back[live]
        if len(i):
            first = np.flatnonzero(np.append(True, (i[1:] != i[:-1] + 1) | (p[1:] != p[:-1])))
            stops = np.append(first[1:], len(i))
            period = p[first]
            length = (stops - first) + (k - 1) + period  # words on the diagonal, and the first period
            run = (length >= folds * period) & (length >= least)
            found.append(np.stack([i[first] - period, length, period], 1)[run])
        # k-grams of twice the length start where both halves stand elsewhere too, in documents long enough for a period above k
        number = np.full(n, -1, np.int64)
        number[at[again]] = kind[again]
        pairs = at[again]
        pairs = pairs[pairs + 2 * k <= end[pairs]]
        pairs = pairs[number[pairs + k] >= 0]
        if len(pairs):
            _, kind = np.unique(number[pairs] * (int(kind.max()) + 1) + number[pairs + k], return_inverse=True)
        at, k = pairs, 2 * k
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(covered)[:n] == 0


def periodic_runs(documents: DataFrame, text_column: str = "text", least: int = 6, folds: int = 4) -> DataFrame:
    """The table's columns and ``n_words``, ``runs`` (array of start, length, period, sorted by start and period; words count from 0)
    and ``collapsed``: the words that no run holds after its first period, joined by one blank.

    A run is a longest stretch of words with smallest period q that has at least ``least`` words and ``folds`` periods.
    """
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    added = {"n_words": T.LongType(), "runs": T.ArrayType(run), "collapsed": T.StringType()}
    kept = [f for f in documents.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *[T.StructField(c, t) for c, t in added.items()]])
    names = [f.name for f in schema.fields]
    arrow_run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def find(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for part in slices(batch, pc.binary_length(batch.column(last)).to_numpy(zero_copy_only=False).astype(np.int64)):
                lists = [t.split() for t in part.column(last).cast(pa.binary()).to_pylist()]  # bytes: cut at blanks of ASCII only
                bounds = np.cumsum([0, *map(len, lists)])
                flat = [w for x in lists for w in x]
                words = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                runs = word_runs(words, bounds, least, folds)
                stays = kept_words(len(words), runs)
                of = np.searchsorted(bounds, runs[:, 0], "right") - 1
                at = np.searchsorted(of, np.arange(len(lists) + 1))
                local = runs[:, 0] - bounds[of]
                short = np.flatnonzero(np.diff(at) > 0)
                collapsed = [b" ".join(x) for x in lists]
                for d in short:
                    a, b = bounds[d], bounds[d + 1]
                    collapsed[d] = b" ".join(flat[i] for i in a + np.flatnonzero(stays[a:b]))
                rows = pa.StructArray.from_arrays([pa.array(x) for x in (local, runs[:, 1], runs[:, 2])], fields=list(arrow_run))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), rows),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=names)

    return documents.select(*[F.col(f"`{f.name}`") for f in kept], text_of(text_column).alias(new_name("text"))).mapInArrow(find, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first by start, then period. Null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    wins = lambda a, b: b["length"].cast("decimal(19,0)") * a["period"] > a["length"].cast("decimal(19,0)") * b["period"]
    return F.aggregate(runs, none, lambda a, b: F.when(a.isNull() | wins(a, b), b).otherwise(a))


def run_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row a document of ``periodic_runs``: number of runs, the strongest one and digests of all runs and of the collapsed text."""
    best = F.col("best")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(F.col(f"`{id_column}`").alias("doc_id"), "runs", "n_words", "collapsed", strongest(F.col("runs")).alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def with_planted_periods(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text: of each tenth document by crc32 of its id, the words from one place on repeat a first stretch from there.

    With h the crc32 of the decimal id and g = h div 10, that place is a = g mod n and the stretch has 1 + (n - a) div (3 + g mod 8)
    words; n is the number of words. Other texts, those without words and those of null ids stay as they are.
    """
    h = F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary"))
    rows = documents.select(F.col(f"`{id_column}`").alias("doc_id"), text_of(text_column).alias("text"), h.alias("h"))
    chosen = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    chosen = chosen.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    chosen = chosen.withColumn("a", F.expr("IF(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(concat(slice(words, 1, int(a)), transform(sequence(a, n - 1), i -> words[int(a + (i - a) % p)])), ' ')")
    return chosen.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
