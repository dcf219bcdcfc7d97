"""Attribution of boosted trees against all orders of the features."""

import itertools
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loanlens.operators import boosting as bo
from loanlens.operators import tree_attribution as ta

FEATS = ["a.x", "b", "c", "unused"]


@pytest.fixture(scope="module")
def fitted(spark):
    u = lambda s: F.conv(F.substring(F.md5(F.concat("id", F.lit(s))), 1, 8), 16, 10).cast("double") / (1 << 32)     # noqa: E731
    df = spark.range(1200).select(F.col("id").alias("app_id"), u("a").alias("a.x"), u("b").alias("b"), u("c").alias("c"), F.lit(1.0).alias("unused"), u("y").alias("n"))
    df = df.withColumn("default", ((F.col("`a.x`") > 0.4) & (F.col("b") > 0.3) | (F.col("c") + F.col("n") > 1.5)).cast("int"))
    df = df.withColumn("w", F.lit(1.0)).withColumn("is_val", F.col("app_id") % 3 == 0)
    plain = df.withColumnRenamed("a.x", "a_x")
    m = bo.boost(plain, ["a_x", *FEATS[1:]], bo.BoostParams(max_rounds=4, depth=4, step=0.5, min_gain=0.5, feature_fraction=1.0, patience=9))
    return df, replace(m, features=tuple(FEATS))


def expectation(tree, known, x, i=0):
    if tree.left[i] < 0:
        return tree.value[i]
    left, right = tree.left[i], tree.right[i]
    if tree.feature[i] in known:
        v = x[tree.feature[i]]
        return expectation(tree, known, x, left if v is not None and v <= tree.threshold[i] else right)
    share = tree.cover[left] / tree.cover[i]
    return share * expectation(tree, known, x, left) + (1 - share) * expectation(tree, known, x, right)


def brute(model, x):
    phi = [0.0] * len(x)
    for order in itertools.permutations(range(len(x))):
        known = set()
        for f in order:
            before = sum(expectation(t, known, x) for t in model.trees)
            known = known | {f}
            phi[f] += model.step * (sum(expectation(t, known, x) for t in model.trees) - before) / math.factorial(len(x))
    return phi


@pytest.mark.parametrize("per_pass,broadcast", [(256, 200_000), (3, 0)])
def test_parts_meet_all_orders_and_sum_to_the_margin(spark, monkeypatch, fitted, per_pass, broadcast):
    monkeypatch.setattr(ta, "LEAVES_PER_PASS", per_pass)
    monkeypatch.setattr(ta, "BROADCAST_ROWS", broadcast)
    df, model = fitted
    rows = df.limit(40).unionByName(spark.createDataFrame([(-1, None, 0.5, None, 1.0, 0.0, 0, 1.0, False)], df.schema))
    got = {}
    for r in ta.tree_attribution(rows, model).collect():
        got.setdefault(r["app_id"], {})[r["feature"]] = r["phi"]
    base = ta.base_value(model)
    assert base == pytest.approx(model.base + model.step * sum(expectation(t, set(), None) for t in model.trees))
    for r in model.with_margin(rows).collect():
        mine = got[r["app_id"]]
        assert base + sum(mine.values()) == pytest.approx(r["margin"], abs=1e-9) and "unused" not in mine
    for r in rows.orderBy("app_id").limit(6).collect():
        x = [r[c] for c in FEATS]
        assert [got[r["app_id"]].get(c, 0.0) for c in FEATS] == pytest.approx(brute(model, x), abs=1e-9)


def test_global_and_drift(fitted):
    df, model = fitted
    top = ta.global_tree_attribution(df, model).collect()
    phi = ta.tree_attribution(df, model).groupBy("feature").agg((F.sum(F.abs("phi")) / 1200).alias("m")).collect()
    assert {r["feature"]: r["mean_abs_attribution"] for r in top} == {r["feature"]: pytest.approx(r["m"], abs=1e-6) for r in phi}
    assert [r["mean_abs_attribution"] for r in top] == sorted((r["mean_abs_attribution"] for r in top), reverse=True)
    moved = df.withColumn("period", F.when(F.col("app_id") % 2 == 0, "p").otherwise("q")).withColumn(
        "b", F.when(F.col("period") == "q", 0.29).otherwise(F.col("b")))
    change = ta.tree_attribution_drift(moved, model, "period", "p", "q").collect()
    assert {r["feature"] for r in change} == {"a.x", "b", "c"} and abs(change[0]["change"]) >= abs(change[-1]["change"])
    assert all(r["change"] == pytest.approx(r["period_b"] - r["period_a"], abs=1e-6) for r in change)


def test_a_model_of_one_leaf(spark, fitted):
    df, model = fitted
    flat = replace(model, trees=())
    assert ta.tree_attribution(df.limit(3), flat).count() == 0 and ta.base_value(flat) == model.base
