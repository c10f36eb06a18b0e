"""Mixing sources to target weights, by DataFrame operations only.

A tree of levels (domain, language, source) has weights at its nodes. The token budget goes from the root to the leaves: each
node's children share its budget by weight, and a child that has fewer tokens than its share (times ``max_epochs``) gives the
rest to its siblings. As a node's own limit is what all leaves below it hold, a shortage is met by siblings first and by
relatives of its ancestors only when all siblings are full. Budgets are whole numbers, divided by exact arithmetic; rounding
down loses less than a token a node.

A leaf's budget is spent in epochs: whole passes, then a prefix of the epoch's order, which is that of md5(seed, epoch, id). The
prefix comes from exact running sums in two steps (4,096 slices of the order, then within a slice), so no task holds a leaf.

Defined cases: null text has no tokens and is copied with whole passes only; a null level value is a value of its own; weights
that are missing are 1, a weight of 0 gets nothing; rows with equal id and leaf are one unit, chosen or left together; a budget
beyond all limits takes everything ``max_epochs`` times; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WORD = r"[^\x20\x09-\x0D]+"
BIG = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def weight_of(column: Column, weights: dict[str, int]) -> Column:
    """The whole-number weight of a node's value; 1 if none is given."""
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(column == value, F.lit(weight)).otherwise(out)
    return out.cast("long")


def shared(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Budget of each child: columns ``parents`` and ``level``, ``limit``, ``weight``, ``parent_budget`` -> ``budget``.

    A child is full when its limit is at most its share of what the children with smaller limits a weight leave. Full
    children come first in that order, so one running sum finds them.
    """
    given = children.withColumn("weight", F.greatest("weight", F.lit(0)))
    part = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = part.orderBy(F.expr(f"CASE WHEN weight = 0 THEN NULL ELSE CAST(limit AS {BIG}) * 1000000 DIV weight END").asc_nulls_last(),
                         F.col(level).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    total = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = given.withColumns({
        "taken": F.sum("limit").over(order) - F.col("limit"),
        "left": F.sum("weight").over(total) - F.sum("weight").over(order) + F.col("weight"),
    })
    full = seen.withColumn("full", (F.col("weight") > 0) & (
        F.col("limit").cast(BIG) * F.col("left").cast(BIG)
        <= F.col("weight").cast(BIG) * F.greatest(F.lit(0), F.col("parent_budget") - F.col("taken")).cast(BIG)))
    rest = full.withColumns({
        "spent": F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(total),
        "open": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(total),
    })
    share = F.expr(f"CASE WHEN open = 0 THEN 0 ELSE CAST(weight AS {BIG}) * CAST(parent_budget - spent AS {BIG}) DIV open END")
    return rest.withColumn("budget", F.when(F.col("full"), F.col("limit")).otherwise(F.least(F.col("limit"), share.cast("long")))).drop(
        "taken", "left", "full", "spent", "open")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], thousandths: int, max_epochs: int) -> DataFrame:
    """``levels``, ``tokens`` and ``budget`` of each leaf, from its ``tokens``. The budget is a share of all tokens."""
    nodes = None
    for depth, level in enumerate(levels):
        parents = levels[:depth]
        own = leaves.groupBy(*levels[:depth + 1]).agg((F.sum("tokens") * max_epochs).alias("limit"))
        if nodes is None:
            own = own.withColumn("parent_budget", F.expr(
                f"sum(limit) OVER (PARTITION BY 0) DIV {max_epochs} * {thousandths} DIV 1000"))
        else:
            up = nodes.select(*[F.col(p).alias(f"up_{p}") for p in parents], F.col("budget").alias("parent_budget"))
            match = F.lit(True)
            for p in parents:
                match = match & F.col(p).eqNullSafe(F.col(f"up_{p}"))
            own = own.join(up, match).drop(*[f"up_{p}" for p in parents])
        own = own.withColumn("weight", weight_of(F.col(level), weights.get(level, {})))
        nodes = shared(own, parents, level).select(*levels[:depth + 1], "limit", "budget")
    return nodes.select(*levels, (F.col("limit") / max_epochs).cast("long").alias("tokens"), "budget")


def mixed(units: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget_share: float, max_epochs: int = 2,
          seed: int = 7) -> DataFrame:
    """``doc_id``, ``levels``, ``n_tokens`` -> with ``copies``: how many times the unit is taken.

    The budget is ``budget_share`` of all tokens, in thousandths.
    """
    rows = units.groupBy("doc_id", *levels).agg(F.sum("n_tokens").alias("n_tokens"))
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, levels, weights, round(budget_share * 1000), max_epochs).withColumns({
        "passes": F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget DIV tokens END"),
        "rest": F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END"),
    })
    named = budgets.select(*[F.col(c).alias(f"leaf_{c}") for c in levels], "passes", "rest")
    match = F.lit(True)
    for c in levels:
        match = match & F.col(c).eqNullSafe(F.col(f"leaf_{c}"))
    placed = rows.join(named, match).withColumn("key", F.md5(F.concat_ws(
        "|", F.lit(str(seed)), F.col("passes").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    placed = placed.drop(*[f"leaf_{c}" for c in levels]).withColumn("slice", F.substring("key", 1, 3))
    slices = placed.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    before = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*[F.col(c).alias(f"leaf_{c}") for c in levels], F.col("slice").alias("at"),
                           F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("before"))
    summed = placed.join(slices, match & (F.col("slice") == F.col("at"))).drop(*[f"leaf_{c}" for c in levels], "at")
    within = Window.partitionBy(*levels, "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return summed.select("doc_id", *levels, "n_tokens", (
        F.col("passes") + F.when((F.col("n_tokens") > 0) & (F.col("before") + F.sum("n_tokens").over(within) <= F.col("rest")), 1)
        .otherwise(0)).cast("long").alias("copies"))
