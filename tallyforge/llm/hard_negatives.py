"""Hard negatives by angular triangle filtering.

Each vector stores its length and its angles to some reference directions (rows of the table, ``references`` of them). The angle
between two vectors lies between the difference and the sum of their angles to any reference (the sum folded at a half turn), so the
stored angles give an interval of their cosine, and the two lengths make it an interval of the inner product. Widened by more than
all rounding, intervals that miss an anchor's wanted scores rule rows out; only what is left is scored, in whole numbers.

The test runs twice. Rows are dealt into blocks by label group, nearest reference and ring of angles around it; a block has ranges of
angles and lengths, and an anchor is sent only to blocks whose interval overlaps a window of scores it still wants. Inside a block,
anchors of similar angle go together, and the rows whose interval misses all of theirs are left out of the product.

Positives are the ``positives`` best of the anchor's label: the window is open above and begins at the worst of those found so far.
Negatives are the ``negatives`` best of other labels in the window of each positive's score. Both are searched in two rounds, first in
the ``first`` most promising blocks of each anchor, then in all others whose interval overlaps the windows as the first round left them.

The number of label groups, references and rings is fixed, and so is what the driver holds of them. Blocks and groups of anchors have
about ``block_rows`` and ``anchor_rows`` rows, whatever group, label or copies they are of. Of equal vectors of a label only those with
the smallest ids can be among the best, so a group of copies is cut to these before it is dealt; all of them stay anchors.

Defined cases: rows whose label, vector or any component is null or not finite take no part, nor do null ids; shorter vectors count as
filled up with zeros; a zero vector has the product 0 with all; equal rows (id, vector and label) count once; rows of the anchor's own id are neither its
positives nor its negatives; equal scores go by smaller id; anchors without positives, and positives without negatives in their
window (so all of a score below 0), give no rows; components may be large: scores are exact and held at a long's ends; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch
from .whole import LEAST, MOST, floored, lengths, products

#: More than the error of an angle worked out in doubles, also near 0 and the half turn.
ANGLE_ERROR = 1e-6
#: Below all scores.
NONE = LEAST - 1


def matrix(lists, width: int) -> np.ndarray:
    """Rows as doubles, filled up with zeros."""
    out = np.zeros((len(lists), width))
    for i, row in enumerate(lists):
        out[i, :len(row)] = row
    return out


def usable_rows(vectors: DataFrame, scale: int, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label (string), v: distinct usable rows, each component floor(scale * x), a whole number in a double."""
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("string").alias("label"),
                          F.col(f"`{vector_column}`").alias("x"))
    return (rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(usable)
            .select("vec_id", "label", F.transform("x", lambda c: floored(c, scale)).alias("v")).distinct())


def angles_to(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles to each direction (unit rows); those of a zero vector are 0, its length makes all bounds 0."""
    top = np.abs(rows).max(1, initial=0.0)
    unit = rows / np.where(top > 0, top, 1.0)[:, None]
    size = np.sqrt((unit**2).sum(1))
    return np.where(size[:, None] > 0, np.arccos(np.clip(unit @ directions.T / np.where(size > 0, size, 1.0)[:, None], -1, 1)), 0.0)


def score_bounds(angles: tuple[np.ndarray, np.ndarray], sizes: tuple, others: tuple[np.ndarray, np.ndarray], other_sizes: tuple):
    """Least and greatest inner product of a vector from one side and one from the other, safe against rounding.

    Each side gives the lowest and the highest angle to each reference (last axis) and the lowest and the highest length; the shapes
    without the last axis are put together by numpy's rules.
    """
    near, far = 0.0, np.pi
    for r in range(angles[0].shape[-1]):
        a, b, c, d = angles[0][..., r], angles[1][..., r], others[0][..., r], others[1][..., r]
        near = np.maximum(near, np.maximum(a - d, c - b))
        far = np.minimum(far, np.minimum(b + d, 2 * np.pi - a - c))
    high, low = np.cos(np.maximum(near - ANGLE_ERROR, 0)), np.cos(np.minimum(far + ANGLE_ERROR, np.pi))
    with np.errstate(over="ignore", invalid="ignore"):
        short, long = sizes[0] * other_sizes[0], sizes[1] * other_sizes[1]
        error = 1 + 1e-9 * long
        greatest = np.floor(high * np.where(high > 0, long, short) + error)
        least = np.ceil(low * np.where(low > 0, short, long) - error)
    return np.nan_to_num(least, nan=-np.inf), np.nan_to_num(greatest, nan=np.inf)


class Blocks:
    """Which block a label group, reference and ring belong to, how many parts a block has, and the blocks' ranges."""

    def __init__(self, annuli: list, references: int, block_rows: int):
        """``annuli``: (group, cell, ring, rows, lowest angles, highest angles, shortest, longest), a bounded number of them."""
        self.block_of, self.groups, counts, ranges = {}, [], [], []
        for group, cell, ring, n, low, high, short, long in sorted(annuli, key=lambda a: a[:3]):
            if not counts or self.groups[-1] != group or counts[-1] + n > block_rows:
                self.groups.append(group)
                counts.append(0)
                ranges.append((np.array(low), np.array(high), short, long))
            before = ranges[-1]
            ranges[-1] = (np.minimum(before[0], low), np.maximum(before[1], high), min(before[2], short), max(before[3], long))
            counts[-1] += n
            self.block_of[group, cell, ring] = len(counts) - 1
        self.parts = [max(1, -(-n // block_rows)) for n in counts]
        self.groups = np.array(self.groups)
        self.low, self.high = (np.array([r[i] for r in ranges]).reshape(-1, references) for i in (0, 1))
        self.short, self.long = (np.array([r[i] for r in ranges]) for i in (2, 3))


def _map(pairs: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def _searched(scratch: Scratch, name: str, anchors: DataFrame, index: DataFrame, blocks: Blocks, width: int, same_label: bool, k: int,
              first: int) -> DataFrame:
    """row, slot, nth, vec_id, score: the k best of each window of each anchor, of its label or of the others.

    ``anchors``: row, vec_id, label, grp, v, size, angles, chunk, windows (array of slot, low, high; null bounds are open).
    """
    far, order = len(blocks.parts), Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id")
    parts = F.array(*[F.lit(n) for n in blocks.parts])

    def ranges(windows: list) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest wanted score by anchor and window; windows that an anchor does not have are empty."""
        most = max(map(len, windows), default=0)
        low, high = np.full((len(windows), most), MOST), np.full((len(windows), most), LEAST)
        for i, of_row in enumerate(windows):
            for j, w in enumerate(of_row):
                low[i, j] = LEAST if w["low"] is None else w["low"]
                high[i, j] = MOST if w["high"] is None else w["high"]
        return low, high

    def wanted(start: int, stop: int):
        def run(batches):
            for batch in batches:
                rows, chunks, groups = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
                sizes, angles = batch.column(3).to_numpy(zero_copy_only=False), np.array(batch.column(4).to_pylist())
                low, high = ranges(batch.column(5).to_pylist())
                out = []
                for a in range(0, len(rows), 256):
                    z = slice(a, a + 256)
                    own = angles[z][:, None, :]
                    s = sizes[z][:, None]
                    least, greatest = score_bounds((own, own), (s, s), (blocks.low, blocks.high), (blocks.short, blocks.long))
                    meets = ((greatest[:, :, None] >= low[z][:, None, :]) & (least[:, :, None] <= high[z][:, None, :])).any(2)
                    if same_label:
                        meets &= groups[z][:, None] == blocks.groups[None, :]
                    ranked = np.argsort(-greatest, axis=1, kind="stable")
                    of_kind = (groups[z][:, None] == blocks.groups[None, :]) if same_label else np.ones_like(meets)
                    place = np.cumsum(np.take_along_axis(of_kind, ranked, 1), 1) - 1  # the order of blocks does not change between rounds
                    i, j = np.nonzero(np.take_along_axis(meets, ranked, 1) & (place >= start) & (place < stop))
                    out.append(np.stack([i + a, ranked[i, j]], 1))
                both = np.concatenate(out) if out else np.zeros((0, 2), int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[both[:, 0]]), pa.array(chunks[both[:, 0]]), pa.array(both[:, 1].astype(np.int32))], names=["row", "chunk", "block"])
        return run

    def scan(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["row", "slot", "vec_id", "score"]
        found = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            codes = pd.factorize(pd.concat([left["label"], right["label"]]))[0]
            label, labels = codes[:len(left)], codes[len(left):]
            if same_label:
                left, label = left[np.isin(label, labels)], label[np.isin(label, labels)]
        if len(left) and len(right):
            own, ids, rows = left["vec_id"].to_numpy(), right["vec_id"].to_numpy(), left["row"].to_numpy()
            a, v = matrix(left["v"].tolist(), width), matrix(right["v"].tolist(), width)
            turn, turns = np.array(left["angles"].tolist()), np.array(right["angles"].tolist())
            size, sizes = left["size"].to_numpy(), right["size"].to_numpy()
            low, high = ranges(left["windows"].tolist())
            slots = left["windows"].tolist()
            spread = turns.max(0) - turns.min(0)
            order_ = np.argsort(turn[:, int(spread.argmin())], kind="stable")  # anchors of similar angle to the block's own reference
            for b in range(0, len(order_), 64):
                z = order_[b:b + 64]
                least, greatest = score_bounds((turn[z].min(0), turn[z].max(0)), (size[z].min(), size[z].max()), (turns, turns), (sizes, sizes))
                at = np.flatnonzero((greatest >= low[z].min()) & (least <= high[z].max()))
                if not len(at):
                    continue
                score = products(a[z], v[at])
                fits = (label[z][:, None] == labels[at][None, :]) == same_label
                fits &= own[z][:, None] != ids[at][None, :]
                for w in range(low.shape[1]):
                    inside = fits & (score >= low[z, w][:, None]) & (score <= high[z, w][:, None])
                    left_over = np.where(inside, score, NONE)
                    for _ in range(k):
                        top = left_over.argmax(1)
                        some = np.flatnonzero(inside[np.arange(len(z)), top])
                        if not len(some):
                            break
                        found.append(np.stack([rows[z[some]], [slots[i][w]["slot"] for i in z[some]], ids[at[top[some]]], score[some, top[some]]], 1))
                        inside[some, top[some]] = False
                        left_over[some, top[some]] = NONE
        data = np.concatenate(found).astype(np.int64) if found else np.zeros((0, 4), np.int64)
        return pd.DataFrame({n: data[:, i] for i, n in enumerate(names)}).astype({"slot": "int32"})

    best = None
    for turn, (start, stop) in enumerate(((0, first), (first, far))):
        if start >= far:
            break
        pending = anchors
        if best is not None:
            worst = best.filter(F.col("nth") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("worst"))
            pending = anchors.join(worst, "row", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
                w["slot"].alias("slot"), F.greatest(w["low"], F.try_element_at("worst", w["slot"])).alias("low"), w["high"].alias("high")))).drop("worst")
            pending = scratch.keep(pending, f"{name}-pending-{turn}")
        pairs = scratch.keep(pending.select("row", "chunk", "grp", "size", "angles", "windows").mapInArrow(
            wanted(start, stop), "row long, chunk int, block int"), f"{name}-pairs-{turn}")
        part = F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("block") + 1) - 1)).alias("part")
        left = pending.drop("chunk").join(pairs, "row").select("row", "vec_id", "label", "v", "size", "angles", "windows", "chunk", "block", part)
        asked = pairs.select(F.col("chunk").alias("chunk"), F.col("block").alias("block")).distinct()
        right = index.join(asked.select("chunk", "block", part), ["block", "part"])
        keys = ["chunk", "block", "part"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(scan, "row long, slot int, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("nth"))
        best = scratch.keep(found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k), f"{name}-best-{turn}")
    return best


def _percent(score: str, percent: int, up: bool) -> Column:
    """floor or ceil of percent * score / 100 for scores of 0 and more, without overflow."""
    return F.expr(f"({score} div 100) * {percent} + (({score} % 100) * {percent} + {99 if up else 0}) div 100")


def _chunks(counts: list[tuple[int, int]], most: int) -> dict[int, tuple[int, int]]:
    """First chunk and number of chunks of each group of anchors: small groups share one, large ones have several."""
    out, free, room = {}, 0, 0
    for group, n in counts:
        if n <= room:
            out[group], room = (free - 1, 1), room - n
        else:
            out[group] = (free, -(-n // most))
            free += out[group][1]
            room = max(0, most - n)
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", references: int = 8, rings: int = 4,
                   label_groups: int = 16, block_rows: int = 4096, anchor_rows: int = 4096, first: int = 2) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on vec_id. A negative n of an anchor's positive p has another label than the anchor and
    low * p <= 100 * n <= high * p by their scores; ``rank`` counts the ``negatives`` best of them from 1.
    """
    scratch = Scratch(vectors.sparkSession, "hard-negatives")
    rows = scratch.keep(usable_rows(vectors, scale, id_column, vector_column, label_column).withColumn("row", F.monotonically_increasing_id()), "rows")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    chosen = rows.filter(F.exists("v", lambda x: x != 0)).select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(references).collect()
    direction = matrix([r["v"] for r in chosen], width)
    direction = direction / np.maximum(np.abs(direction).max(1, initial=0.0), 1e-300)[:, None] if len(direction) else np.zeros((1, width))
    direction = direction / np.maximum(np.sqrt((direction**2).sum(1)), 1e-300)[:, None]

    def place(batches):
        for batch in batches:
            m = matrix(batch.column(2).to_pylist(), width)
            angles = angles_to(m, direction)
            cell = angles.argmin(1) if len(m) else np.zeros(0, int)
            ring = np.minimum(rings - 1, (angles[np.arange(len(m)), cell] * rings / np.pi * 2)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths(m)), pa.array(angles.tolist(), pa.list_(pa.float64())), pa.array(cell.astype(np.int32)), pa.array(ring)],
                names=["vec_id", "label", "v", "row", "size", "angles", "cell", "ring"])

    placed = scratch.keep(rows.select("vec_id", "label", "v", "row").mapInArrow(
        place, "vec_id long, label string, v array<double>, row long, size double, angles array<double>, cell int, ring int")
        .withColumn("grp", F.pmod(F.xxhash64("label"), F.lit(label_groups)).cast("int")), "placed")
    same = Window.partitionBy("v", "label").orderBy("vec_id")
    kept = scratch.keep(placed.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= max(positives, negatives) + 1).drop("nth"), "kept")
    cells = ["grp", "cell", "ring"]
    ends = [f(F.col("angles")[i]) for f in (F.min, F.max) for i in range(len(direction))]
    annuli = [(*r[:4], r[6:6 + len(direction)], r[6 + len(direction):], r[4], r[5]) for r in kept.groupBy(*cells).agg(
        F.count("*"), F.min("size"), F.max("size"), *ends).collect()]  # label groups * references * rings rows at most
    blocks = Blocks(annuli, len(direction), block_rows)
    key = lambda g, c, r: (g * len(direction) + c) * rings + r
    if not annuli:
        none = rows.limit(0)
        return none.select(F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.lit(1).alias("rank"),
                           F.col("vec_id").alias("negative_id"), F.col("vec_id").alias("positive_score"), F.col("vec_id").alias("negative_score"))
    block = _map({key(*a): b for a, b in blocks.block_of.items()}, key(F.col("grp"), F.col("cell"), F.col("ring")))
    part = F.pmod(F.xxhash64("vec_id"), F.element_at(F.array(*[F.lit(n) for n in blocks.parts]), F.col("block") + 1)).cast("int")
    index = scratch.keep(kept.withColumn("block", block).withColumn("part", part).select("vec_id", "label", "v", "size", "angles", "block", "part"), "index")

    starts = placed.filter(is_anchor)
    at = F.col("grp") * len(direction) + F.col("cell")
    many = starts.groupBy(at.alias("at")).count().orderBy("at").collect()  # label groups * references rows at most
    chunks = _chunks([tuple(r) for r in many], anchor_rows) or {0: (0, 1)}
    chunk = (_map({a: c for a, (c, _) in chunks.items()}, at) + F.pmod(F.xxhash64("vec_id"), _map({a: n for a, (_, n) in chunks.items()}, at))).cast("int")
    window = "array<struct<slot:int,low:bigint,high:bigint>>"
    anchors = scratch.keep(starts.select("row", "vec_id", "label", "grp", "v", "size", "angles", chunk.alias("chunk"),
                                         F.expr(f"CAST(array(named_struct('slot', 0, 'low', NULL, 'high', NULL)) AS {window})").alias("windows")), "anchors")
    best = _searched(scratch, "positives", anchors, index, blocks, width, True, positives, first)
    named = best.select("row", F.col("nth").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    spans = named.filter("positive_score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        F.col("slot"), _percent("positive_score", low, True).alias("low"), _percent("positive_score", high, False).alias("high")))).alias("windows"))
    seeking = scratch.keep(anchors.drop("windows").join(spans, "row"), "seeking")
    worst = _searched(scratch, "negatives", seeking, index, blocks, width, False, negatives, first)
    return (worst.select("row", "slot", F.col("nth").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(named, ["row", "slot"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
