"""Shapley attribution of boosted trees (I11; I9, I10 and I12 for trees).

The value of a set of features at a row is the tree's expectation when only
these features are known: at a split on another feature both branches count by
their share of the fit's rows.  For one leaf this game depends on the row only
through a bit mask: for each distinct feature of the leaf's path, whether the
row's value lies in the path's interval of that feature.  So the parts that a
leaf gives to its features are a table by (leaf, mask) with at most 2^depth
masks a leaf, built in tasks once per model; rows compute their masks in a
projection, look them up by a join, and sum up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.boosting import BoostedModel, Tree

LEAVES_PER_PASS = 256           # masks of one projection
BROADCAST_ROWS = 200_000        # rows of the weight table that are broadcast at most


@dataclass(frozen=True)
class Leaf:
    """A leaf's path: per distinct feature the open lower and closed upper bound, and the share of rows that stays."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    ratio: tuple[float, ...]
    value: float


def leaf_paths(tree: Tree) -> list[Leaf]:
    found = []

    def walk(i: int, path: dict[int, tuple[float, float, float]]) -> None:
        if tree.left[i] < 0:
            found.append(Leaf(tuple(path), *(tuple(x[k] for x in path.values()) for k in range(3)), tree.value[i]))
            return
        f, t = tree.feature[i], tree.threshold[i]
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        for child, bounds in ((tree.left[i], (low, min(high, t))), (tree.right[i], (max(low, t), high))):
            walk(child, {**path, f: (*bounds, share * (tree.cover[child] / tree.cover[i] if tree.cover[i] else 0.5))})

    walk(0, {})
    return found


def leaf_parts(ratio: tuple[float, ...], value: float, mask: int) -> list[float]:
    """Each path feature's part of the leaf's value for rows of this mask."""
    d = len(ratio)
    weight = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
    met = [float(mask >> j & 1) for j in range(d)]
    out = []
    for j in range(d):
        sums = [1.0]                    # by number of known features among the others
        for k in range(d):
            if k != j:
                sums = [a * ratio[k] + b * met[k] for a, b in zip([*sums, 0.0], [0.0, *sums])]
        out.append(value * (met[j] - ratio[j]) * sum(w * s for w, s in zip(weight, sums)))
    return out


def weight_table(spark: SparkSession, leaves: list[Leaf], step: float) -> DataFrame:
    """(leaf, mask, parts): what each leaf gives to its features at each mask."""
    rows = [(i, list(x.features), list(x.ratio), step * x.value) for i, x in enumerate(leaves)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(r.leaf, m, [{"feature": f, "phi": p} for f, p in zip(r.features, leaf_parts(tuple(r.ratio), r.value, m))])
                                for r in b.itertuples() for m in range(1 << len(r.features))], columns=["leaf", "mask", "parts"])

    base = spark.createDataFrame(rows, "leaf int, features array<int>, ratio array<double>, value double")
    return base.mapInPandas(run, "leaf int, mask int, parts array<struct<feature:int,phi:double>>")


def _mask(model: BoostedModel, leaf: Leaf) -> Column:
    out = F.lit(0)
    for j, (f, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high)):
        x = F.col(f"`{model.features[f]}`").cast("double")
        at_most = lambda t: F.coalesce(x <= F.lit(t), F.lit(False))         # noqa: E731
        inside = (at_most(high) if high < math.inf else F.lit(True)) & (~at_most(low) if low > -math.inf else F.lit(True))
        out = out + F.when(inside, 1 << j).otherwise(0)
    return out


def base_value(model: BoostedModel) -> float:
    """The margin when no feature is known."""
    return model.base + model.step * sum(x.value * math.prod(x.ratio) for t in model.trees for x in leaf_paths(t))


def tree_attribution(df: DataFrame, model: BoostedModel, key: str = "app_id") -> DataFrame:
    """(key, feature, phi): each row's parts; with :func:`base_value` they sum up to its margin.

    Features that no split uses have no row.  ``key`` must tell rows apart.
    """
    spark = df.sparkSession
    leaves = [x for t in model.trees for x in leaf_paths(t)]
    weights = weight_table(spark, leaves, model.step)
    if sum(1 << len(x.features) for x in leaves) <= BROADCAST_ROWS:
        weights = F.broadcast(weights)
    masks = None
    for at in range(0, max(1, len(leaves)), LEAVES_PER_PASS):
        group = [_mask(model, x).cast("int") for x in leaves[at:at + LEAVES_PER_PASS]]
        part = df.select(key, F.posexplode(F.array(*group).cast("array<int>")).alias("leaf", "mask")).withColumn("leaf", F.col("leaf") + at)
        masks = part if masks is None else masks.unionByName(part)
    parts = masks.join(weights, ["leaf", "mask"]).select(key, F.explode("parts").alias("x")).groupBy(key, "x.feature").agg(F.sum("x.phi").alias("phi"))
    name = F.element_at(F.array(*[F.lit(c) for c in model.features]), F.col("feature") + 1)
    return parts.select(key, name.alias("feature"), "phi")


def global_tree_attribution(df: DataFrame, model: BoostedModel, key: str = "app_id", by: str | None = None, top: int = 15) -> DataFrame:
    """I9 + F3 for trees: mean |phi| of every feature (by period if ``by``), over all rows."""
    periods = [by] if by else []
    rows = df.groupBy(*periods).agg(F.count(F.lit(1)).alias("n"))
    phi = tree_attribution(df, model, key)
    if by:
        phi = phi.join(df.select(key, by), key)
    total = phi.groupBy(*periods, "feature").agg(F.sum(F.abs("phi")).alias("total"))
    total = total.join(F.broadcast(rows), by) if by else total.withColumn("n", rows.scalar())              # a row per period
    out = total.select(*periods, "feature", F.round(F.col("total") / F.col("n"), 6).alias("mean_abs_attribution"))
    return out if by else out.orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top)


def tree_attribution_drift(df: DataFrame, model: BoostedModel, period: str, a: str, b: str, key: str = "app_id") -> DataFrame:
    """I12 + F4 for trees: mean |phi| in two periods and its change, largest change first."""
    g = global_tree_attribution(df.where(F.col(period).isin(a, b)), model, key, by=period)
    p = g.groupBy("feature").agg(*[F.max(F.when(F.col(period) == x, F.col("mean_abs_attribution"))).alias(n) for x, n in ((a, "period_a"), (b, "period_b"))])
    return p.withColumn("change", F.round(F.col("period_b") - F.col("period_a"), 6)).orderBy(F.abs(F.col("change")).desc(), "feature")
