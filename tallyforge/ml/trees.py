"""Boosted decision trees grown from sums of weights: a pass over the rows gives, for each open node, feature, bin and class, the sum of its rows.

The trees are those of Spark's learner (Gini, continuous features, 32 bins whose edges follow from the same sample of about 10,000 rows),
but no executor holds a row: a task reads its rows in Arrow batches, works out each row's weight from the trees grown so far and hands on
the sums. Fits over the same rows share their passes. What the driver holds is the sample and, for a pass, at most ``CELLS`` sums a fit.
"""

from __future__ import annotations

import pickle
from collections.abc import Generator
from contextlib import ExitStack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..workspace import kept

#: Bins of a feature, rows that the edges of bins are taken from, and sums of a pass and fit, at most.
BINS, SAMPLE, CELLS = 32, 10_000, 1 << 20
EPS = float(np.finfo(float).eps)


class Tree(NamedTuple):
    """Node i has feature -1 if it is a leaf, else its children are left[i] (value <= threshold) and left[i] + 1."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray


class Step(NamedTuple):
    """What a grown tree does to the weights: by its leaf and the row's class, times ``scale``."""
    tree: Tree
    factor: np.ndarray
    scale: float


class Request(NamedTuple):
    """Sums wanted by a fit: of the rows in ``nodes`` of the tree so far, by the edges of each feature."""
    place: int
    past: list[Step]
    tree: Tree
    nodes: np.ndarray
    edges: list[np.ndarray]
    classes: int


def leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node in which each row ends."""
    at = np.zeros(len(x), np.int64)
    if tree.feature[0] < 0:
        return at
    rows = np.arange(len(x))
    while True:
        f = tree.feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        at = np.where(inner, tree.left[at] + (x[rows, f] > tree.threshold[at]), at)


def weigh(past: list[Step], x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    for step in past:
        w = w * step.factor[leaves(step.tree, x), y] * step.scale
    return w


def _dense(vectors: pa.StructArray, width: int) -> np.ndarray:
    """Spark's vectors, dense or sparse, as a matrix."""
    sparse, indices, values = vectors.field("type").to_numpy(zero_copy_only=False) == 0, vectors.field("indices"), vectors.field("values")
    cells = values.flatten().to_numpy(zero_copy_only=False)
    if not sparse.any():
        x = cells.reshape(len(vectors), width)
    else:
        sizes = np.diff(values.offsets.to_numpy())
        row = np.repeat(np.arange(len(vectors)), sizes)
        column = np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        column[sparse[row]] = indices.filter(pa.array(sparse)).flatten().to_numpy(zero_copy_only=False)
        x = np.zeros((len(vectors), width))
        x[row, column] = cells
    if not np.isfinite(x).all():
        raise ValueError("features must not be NaN or infinite")
    return x


def _add(sums: dict, request: Request, key: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
    """Adds a batch to {(key, node): [sums by feature, bin and class, rows by feature and bin]}."""
    w = weigh(request.past, x, y, w)
    slot_of = np.full(len(request.tree.feature), -1)
    slot_of[request.nodes] = np.arange(len(request.nodes))
    slot = slot_of[leaves(request.tree, x)]
    if (slot < 0).any():
        some = slot >= 0
        x, y, w, slot = x[some], y[some], w[some], slot[some]
    if not len(x):
        return
    slots, classes = len(request.nodes), request.classes
    weights, counts = [], []
    for f, edges in enumerate(request.edges):
        bins, column = len(edges) + 1, x[:, f]
        at = np.searchsorted(edges, column) if bins > 4 else sum((column > e).astype(np.int64) for e in edges) if bins > 1 else 0
        at = slot * bins + at
        weights.append(np.bincount(at * classes + y, w, slots * bins * classes).reshape(slots, -1))
        counts.append(np.bincount(at, minlength=slots * bins).reshape(slots, -1))
    weights, counts = np.concatenate(weights, 1), np.concatenate(counts, 1).astype(float)
    for i in range(slots):
        of = sums.setdefault((key, i), [0.0, 0.0])
        of[0], of[1] = of[0] + weights[i], of[1] + counts[i]


_SUMS = "fit int, node int, weights array<double>, counts array<double>"


def _as_batch(sums: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
        *[pa.array([v[i].tolist() for v in sums.values()], pa.list_(pa.float64())) for i in (0, 1)]], names=["fit", "node", "weights", "counts"])


def _read(batch: pa.RecordBatch, width: int, places: int):
    """Features, classes and, for each fit, weights of a batch of (label, vector, w)."""
    x, y = _dense(batch.column(1), width), batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    stored = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    return x, y, stored.reshape(len(x), places) if len(stored) else np.ones((len(x), places))


def _pass(rows: DataFrame, width: int, places: int, requests: list[Request]) -> list[dict]:
    """For each request {node: (weights, counts)}, from one pass over the rows; equal requests are worked out once."""
    # fits that have not been weighed apart (no stored weights) may ask for the same
    different = {pickle.dumps(r._replace(place=0) if rows.schema["w"].metadata.get("ones") else r): r for r in requests}
    number, asked = {k: i for i, k in enumerate(different)}, list(different.values())

    def run(batches):
        sums: dict = {}
        for batch in batches:
            if len(batch):
                x, y, w = _read(batch, width, places)
                for i, request in enumerate(asked):
                    _add(sums, request, i, x, y, w[:, request.place])
        yield _as_batch(sums)

    def total(batches):
        sums: dict = {}
        for batch in batches:
            for fit, node, weights, counts in zip(*[batch.column(i) for i in range(4)]):
                of = sums.setdefault((fit.as_py(), node.as_py()), [0.0, 0.0])
                of[0], of[1] = of[0] + weights.values.to_numpy(), of[1] + counts.values.to_numpy()
        yield _as_batch(sums)

    found: list[dict] = [{} for _ in asked]
    for r in rows.mapInArrow(run, _SUMS).repartition("fit", "node").mapInArrow(total, _SUMS).toLocalIterator():
        found[r.fit][r.node] = np.array(r.weights), np.array(r.counts)
    at = lambda r: number[pickle.dumps(r._replace(place=0) if rows.schema["w"].metadata.get("ones") else r)]
    return [{int(r.nodes[i]): v for i, v in found[at(r)].items()} for r in requests]


# -- edges of bins -----------------------------------------------------------------------------


def _edges(values: np.ndarray, w: np.ndarray, bins: int, expected: float) -> np.ndarray:
    """Edges of a feature's bins, of about equal weight; ``expected`` is what the sample should weigh, and what it lacks counts as zeros."""
    full = values != 0
    if not full.any():
        return np.zeros(0)
    value, place = np.unique(values[full], return_inverse=True)
    weight = np.bincount(place, w[full])
    if expected - weight.sum() > EPS * full.sum() * 100:
        at = np.searchsorted(value, 0.0)
        value, weight = np.insert(value, at, 0.0), np.insert(weight, at, expected - weight.sum())
    if len(value) <= bins:
        return (value[1:] + value[:-1]) / 2
    stride, seen, out = expected / bins, np.cumsum(weight), []
    target = stride
    for i in range(1, len(value)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append((value[i - 1] + value[i]) / 2)
            target += stride
    return np.array(out)


# -- one tree ----------------------------------------------------------------------------------


class _Node:
    """A node while its tree grows: ``stats`` and ``raw`` as Spark has them (a right child's by subtraction), ``plain`` added up row by row."""

    def __init__(self, at, level, stats=None, raw=0.0, plain=None):
        self.at, self.level, self.stats, self.raw, self.plain = at, level, stats, raw, plain
        self.gain, self.split, self.children, self.valid = 0.0, None, (), True

    @property
    def prediction(self) -> int:
        return int(np.argmax(self.stats)) if self.stats.sum() else 0


def gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(-1)
    share = stats / np.where(total == 0, 1, total)[..., None]
    return np.where(total == 0, 0.0, 1 - (share**2).sum(-1))


def _split(node: _Node, weights: np.ndarray, counts: np.ndarray, edges: list[np.ndarray], classes: int) -> tuple | None:
    """(feature, place of the edge, children's stats and raw counts) of the split with the largest gain, the first of equal ones."""
    best, start, sides = None, 0, []
    for f, of in enumerate(edges):
        bins = len(of) + 1
        w, n = weights[start * classes:(start + bins) * classes].reshape(bins, classes), counts[start:start + bins]
        start += bins
        sides.append((w, np.cumsum(w, 0), np.cumsum(n)))
    node.plain = sides[0][0].sum(0) if node.plain is None else node.plain
    for f, (w, below, rows) in enumerate(sides):
        if len(w) == 1:
            continue
        left, right, raw_left, raw_right = below[:-1], below[-1] - below[:-1], rows[:-1], rows[-1] - rows[:-1]
        if node.stats is None:
            node.stats, node.raw = left[0] + right[0], rows[-1]
        n_left, n_right = left.sum(1), right.sum(1)
        whole = n_left + n_right
        whole = np.where(whole == 0, 1, whole)
        gain = gini(node.stats) - n_left / whole * gini(left) - n_right / whole * gini(right)
        gain = np.where((raw_left < 1) | (raw_right < 1) | (gain < 0), -np.inf, gain)
        i = int(np.argmax(gain))
        if best is None or gain[i] > best[0]:
            best = (gain[i], f, i, left[i], right[i], raw_left[i], raw_right[i], w[:i + 1].sum(0), w[i + 1:].sum(0))
    if node.stats is None:  # no feature has an edge
        node.stats, node.raw = sides[0][0].sum(0), counts[:len(edges[0]) + 1].sum()
    return best


def grow(place: int, past: list[Step], edges: list[np.ndarray], classes: int, depth: int) -> Generator[Request, dict, _Node]:
    """Asks for sums level by level and returns the root."""
    nodes = [_Node(0, 0)]
    open_, most = [nodes[0]], max(1, CELLS // (classes * sum(len(e) + 1 for e in edges)))
    while open_:
        some, open_ = open_[:most], open_[most:]
        sums = yield Request(place, past, arrays(nodes), np.array([n.at for n in some]), edges, classes)
        for node in some:
            weights, counts = sums.get(node.at, (np.zeros(classes * sum(len(e) + 1 for e in edges)), np.zeros(sum(len(e) + 1 for e in edges))))
            best = _split(node, weights, counts, edges, classes)
            node.valid = best is not None and best[0] > -np.inf
            if not node.valid or best[0] <= 0 or node.level == depth:
                continue
            node.gain, f, i, left, right, raw_left, raw_right, plain_left, plain_right = best
            node.split = f, float(edges[f][i])
            node.children = tuple(_Node(len(nodes) + k, node.level + 1, *of) for k, of in enumerate(((left, raw_left, plain_left), (right, raw_right, plain_right))))
            nodes += node.children
            open_ += [c for c in node.children if c.level < depth and gini(c.stats) >= EPS]
    return nodes[0]


def prune(node: _Node) -> _Node:
    """Two leaves that predict the same are one."""
    if node.children:
        node.children = tuple(prune(c) for c in node.children)
        if not any(c.children for c in node.children) and len({c.prediction for c in node.children}) == 1:
            node.children, node.split, node.valid = (), None, True
    return node


def listed(root: _Node) -> list[_Node]:
    """All nodes, children side by side."""
    out = [root]
    for node in out:
        out += node.children
    return out


def arrays(nodes: list[_Node]) -> Tree:
    """The nodes, in this order, as arrays."""
    at = {id(n): i for i, n in enumerate(nodes)}
    inner = [bool(n.children) for n in nodes]
    return Tree(np.array([n.split[0] if k else -1 for n, k in zip(nodes, inner)]), np.array([n.split[1] if k else 0.0 for n, k in zip(nodes, inner)]),
                np.array([at[id(n.children[0])] if k else -1 for n, k in zip(nodes, inner)]))


def spark_model(spark, learner: DecisionTreeClassifier, root: _Node, width: int, classes: int) -> DecisionTreeClassificationModel:
    jvm, gateway = spark._jvm.org.apache.spark, spark.sparkContext._gateway

    def stats(node):
        cells = gateway.new_array(spark._jvm.double, classes)
        for i, v in enumerate(node.stats):
            cells[i] = float(v)
        return jvm.mllib.tree.impurity.GiniCalculator(cells, int(node.raw))

    def built(node):
        impurity = float(gini(node.stats))
        if not node.children:
            return jvm.ml.tree.LeafNode(float(node.prediction), impurity if node.valid else -1.0, stats(node))
        left, right = (built(c) for c in node.children)
        return jvm.ml.tree.InternalNode(float(node.prediction), impurity, float(node.gain), left, right, jvm.ml.tree.ContinuousSplit(*node.split), stats(node))

    return learner._copyValues(learner._create_model(jvm.ml.classification.DecisionTreeClassificationModel(learner.uid, built(root), width, classes)))


# -- rows --------------------------------------------------------------------------------------


class Rows:
    """(label, features) as fits read them; a fit's place is that of its weight in ``w`` once weights are stored."""

    def __init__(self, df: DataFrame, width: int, places: int):
        self.spark, self.width, self.places, self.stack = df.sparkSession, width, places, ExitStack()
        self.source = df.select("features", "label")
        none = F.array().cast("array<double>").alias("w", metadata={"ones": True})
        self.rows = df.select("label", F.unwrap_udt("features").alias("vector"), none)

    def sample(self, n: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Features and classes of about ``SAMPLE`` rows (all if there are no more), and their share: the rows Spark's learner would take."""
        share, rows = 1.0, self.source
        if n > SAMPLE:
            share = SAMPLE / n
            drawn = self.spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
            picked = rows._jdf.toJavaRDD().sample(False, share, drawn)
            rows = DataFrame(self.spark._jsparkSession.createDataFrame(picked, rows._jdf.schema()), self.spark)
        found = rows.collect()
        x = np.array([r.features.toArray() for r in found]).reshape(len(found), self.width)
        return x, np.array([r.label for r in found]).astype(np.int64), share

    def sums(self, requests: list[Request]) -> list[dict]:
        return _pass(self.rows, self.width, self.places, requests)

    def store(self, past: list[list[Step]]) -> None:
        """Weights written beside the rows; the steps so far are in them."""
        width, places = self.width, self.places

        def run(batches):
            for batch in batches:
                if len(batch):
                    x, y, w = _read(batch, width, places)
                    w = np.stack([weigh(p, x, y, w[:, i]) for i, p in enumerate(past)], 1)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(w), pa.list_(pa.float64()))], names=["label", "vector", "w"])

        before, self.stack = self.stack, ExitStack()
        kind = self.rows.drop("w").schema.add("w", ArrayType(DoubleType()))
        self.rows = self.stack.enter_context(kept(self.rows.mapInArrow(run, kind), "boost-weights"))
        before.close()

    def close(self) -> None:
        self.stack.close()
