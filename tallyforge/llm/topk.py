"""Exact top-k inner products over a pivot-distance index.

Vectors are scaled to whole numbers. One more coordinate, sqrt(M^2 - |x|^2) with M the largest length, makes the largest
inner product the smallest distance, |q - x|^2 = |q|^2 + M^2 - 2 q.x for a query with 0 there. Each vector is keyed by its
nearest pivot and its distance from it; the distances of a pivot's vectors are cut into annuli. For a query, the triangle
inequality gives a lower bound of the distance to all vectors of an annulus. Annuli are taken in order of that bound, in
rounds of growing numbers, until the bound of the next one shows that it can hold no better score than the k-th so far.

Pivots, annuli and their bounds are fixed in number (``pivots`` * ``rings``); an annulus is read in blocks of about
``block_rows`` vectors, each by up to ``block_rows`` queries. Of equal vectors, only the k + 1 with the smallest ids can be
among the best, so a group of copies is reduced before it is placed. Scores are whole numbers and exact.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter vectors count as filled up
with zeros; an empty vector is zero; equal rows count once; rows of the query's own id are no candidates; null ids take no
part; equal scores go by smaller id; components may be large: scores are exact and held at a long's ends; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch
from .whole import LEAST, floored, products


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id, v: distinct usable rows, each component floor(scale * x), a whole number in a double."""
    usable = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.filter(F.col(vector_column).isNotNull() & F.col(id_column).isNotNull()).filter(usable)
            .select(F.col(id_column).cast("long").alias("vec_id"),
                    F.transform(vector_column, lambda x: floored(x, scale)).alias("v"))
            .distinct())


def matrix(lists, width: int) -> np.ndarray:
    """Rows as doubles, filled up with zeros."""
    out = np.zeros((len(lists), width))
    for i, row in enumerate(lists):
        out[i, :len(row)] = row
    return out


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id",
                 vector_column: str = "embedding", pivots: int = 16, rings: int = 16, block_rows: int = 4096,
                 rounds: tuple[int, ...] = (2, 16)) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query. ``is_query`` is a condition on vec_id.

    After ``rounds`` (numbers of annuli), the last round takes all annuli that the bounds leave.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    rows = scratch.keep(whole_vectors(vectors, id_column, vector_column, scale), "vectors")
    sums = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square"),
                    F.count_if(is_query).alias("queries")).first()
    width, longest, n_queries = sums["width"] or 0, sums["square"] or 0.0, sums["queries"]
    same = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).drop("nth")
    centres = [r["v"] for r in rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()]
    if not centres:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)

    centre = matrix(centres, width)
    lift = np.sqrt(np.maximum(0, longest - (centre**2).sum(1)))

    def distances(m: np.ndarray, last: np.ndarray) -> np.ndarray:
        """From each row to each pivot, with the added coordinate."""
        d = (m**2).sum(1)[:, None] + last[:, None]**2 + longest - 2 * (m @ centre.T + last[:, None] * lift[None, :])
        return np.sqrt(np.maximum(0, d))

    def place(batches):
        for batch in batches:
            m = matrix(batch.column(1).to_pylist(), width)
            d = distances(m, np.sqrt(np.maximum(0, longest - (m**2).sum(1))))
            cell = d.argmin(1) if len(m) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(m)), cell])],
                names=["vec_id", "v", "cell", "distance"])

    placed = scratch.keep(kept.mapInArrow(place, "vec_id long, v array<double>, cell int, distance double"), "placed")
    far = {r["cell"]: r["far"] for r in placed.groupBy("cell").agg(F.max("distance").alias("far")).collect()}  # a row a pivot
    step = F.create_map(*[F.lit(x) for c, f in far.items() for x in (c, max(f, 1e-9) / rings)])[F.col("cell")]
    ringed = placed.withColumn("ring", F.least(F.lit(rings - 1), F.floor(F.col("distance") / step)).cast("int"))
    annuli = [tuple(r) for r in ringed.groupBy("cell", "ring").agg(
        F.min("distance"), F.max("distance"), F.count("*")).collect()]  # pivots * rings rows at most
    blocks = {(c, r): -(-n // block_rows) for c, r, _, _, n in annuli}
    groups = max(1, -(-n_queries // block_rows))
    chunks = F.create_map(*[F.lit(x) for (c, r), n in blocks.items() for x in (c * rings + r, n)])
    at = (F.col("cell") * rings + F.col("ring")).alias("annulus")
    index = ringed.select(at, "vec_id", "v").withColumn("block", F.pmod(F.xxhash64("vec_id"), chunks[F.col("annulus")]).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    info = np.array([(c * rings + r, c, lo, hi) for c, r, lo, hi, _ in annuli])
    slack = 1e-9 * (longest + 1)

    def bounds(batches):
        """Each query with its annuli in order of the bound, and the largest score that each may hold."""
        for batch in batches:
            m = matrix(batch.column(1).to_pylist(), width)
            to = distances(m, np.zeros(len(m)))[:, info[:, 1].astype(int)]
            low = np.maximum(0, np.maximum(to - info[:, 3], info[:, 2] - to))
            best = np.floor(((m**2).sum(1)[:, None] + longest - low**2) / 2 + slack + 1e-6 * np.abs(low))
            order = np.argsort(-best, axis=1, kind="stable")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(info[order, 0].astype(np.int32).tolist(), pa.list_(pa.int32())),
                 pa.array(np.take_along_axis(best, order, 1).tolist(), pa.list_(pa.float64()))],
                names=["query_id", "q", "annuli", "limits"])

    queries = scratch.keep(
        rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
        .mapInArrow(bounds, "query_id long, q array<double>, annuli array<int>, limits array<double>"), "queries")

    def scan(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k best of one block for one group of queries."""
        names = ["query_id", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        right = right.sort_values("vec_id", kind="stable")
        ids, own = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
        scores = products(matrix(left["q"], width), matrix(right["v"], width))
        scores[own[:, None] == ids[None, :]] = LEAST - 1  # below all scores
        top = np.argsort(~scores, axis=1, kind="stable")[:, :k]  # ~x falls where x grows, and never overflows
        value = np.take_along_axis(scores, top, 1)
        real = value >= LEAST
        return pd.DataFrame({"query_id": np.repeat(own, real.sum(1)), "vec_id": ids[top][real], "score": value[real]})

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = None
    for turn, (start, stop) in enumerate(zip((0, *rounds), (*rounds, len(annuli)))):
        if start >= len(annuli):
            break
        pending = queries.withColumn("kth", F.lit(None).cast("long"))
        if best is not None:
            kth = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
            pending = queries.join(kth, "query_id", "left")
        pairs = (pending.select("query_id", "q", "kth", F.explode(F.slice(F.arrays_zip("annuli", "limits"), start + 1, stop - start)).alias("a"))
                 .filter(F.col("kth").isNull() | (F.col("a.limits") >= F.col("kth")))
                 .select("query_id", "q", F.col("a.annuli").alias("annulus"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0), chunks[F.col("annulus")] - 1)))
                 .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")))
        keys = ["annulus", "block", "part"]
        found = pairs.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInPandas(scan, "query_id long, vec_id long, score long")
        if best is not None:
            found = found.union(best.select("query_id", "vec_id", "score"))
        best = scratch.keep(found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), f"best-{turn}")
    return best.select("query_id", "rank", "vec_id", "score")
