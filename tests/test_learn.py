"""Learners on planted signals, permutation importance against brute force, saved models, registry."""

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanlens.operators import boosting as bo

from loanlens.operators import evaluate as ev
from loanlens.operators import explore as xe
from loanlens.operators import learn as ml


@pytest.fixture(scope="module")
def planted(spark):
    u = lambda s: (F.conv(F.substring(F.md5(F.concat("id", F.lit(s))), 1, 8), 16, 10).cast("double") / (1 << 32))
    df = spark.range(3000).select(F.col("id").alias("app_id"), u("a").alias("x.a"), u("b").alias("x_b"), u("c").alias("x_c"), u("y").alias("n"))
    return df.select("app_id", "`x.a`", "x_b", "x_c", (F.col("`x.a`") + 0.4 * F.col("x_b") + 0.3 * F.col("n") > 0.9).cast("int").alias("default"),
                     F.when(F.col("app_id") % 4 == 0, "val").otherwise("train").alias("split")).withColumnRenamed("x.a", "x_a")


FEATS = ["x_a", "x_b", "x_c"]


SMALL = bo.BoostParams(max_rounds=6, depth=3, step=0.3, min_gain=0.0, leaf_l1=0.0, block=4)


def flagged(df):
    return ml.class_weights(df, mode="ratio").withColumn("is_val", F.col("split") == "val")


def test_learners_find_the_signal(spark, planted, tmp_path):
    train, val = planted.where("split = 'train'"), planted.where("split = 'val'")
    lr = ml.logistic_pipeline(FEATS, weight_sum=train.count()).fit(ml.class_weights(train))
    gbt = bo.boost(flagged(planted), FEATS, SMALL)
    second = bo.boost(flagged(planted), FEATS, replace(SMALL, min_instances=40, max_leaves=5))
    assert all(len(t.leaves()) <= 5 for t in second.trees) and any(len(t.leaves()) > 5 for t in gbt.trees)
    assert min(c for t in second.trees for c in t.cover) >= 40
    table = ml.compare_models({"logistic": ml.score(lr, val), "gbt": ml.score(gbt, val), "gbt2": ml.score(second, val)}).collect()
    assert all(r["val_auc"] > 0.9 for r in table) and sum(r["is_champion"] for r in table) == 1
    imp = {r["feature"]: r["importance"] for r in ml.feature_importance(spark, gbt).collect()}
    assert imp["x_a"] > imp["x_b"] > imp["x_c"] and sum(imp.values()) == pytest.approx(1)
    for kind, model in (("lr", lr), ("gbt", gbt)):
        path = str(tmp_path / kind)
        ml.save_model(model, path, {"columns": FEATS, "threshold": 0.5})
        again, meta = ml.load_model(spark, path)
        assert meta["columns"] == FEATS and ml.score(again, val).exceptAll(ml.score(model, val)).count() == 0


def test_reference_settings_are_the_defaults(spark):
    p = bo.BoostParams()
    assert (p.max_rounds, p.depth, p.step, p.subsample, p.feature_fraction, p.patience) == (800, 7, 0.03, 0.75, 0.75, 40)
    assert (p.min_child_weight, p.min_gain, p.leaf_l1, p.leaf_l2) == (5, 0.1, 0.1, 1)
    assert (bo.SECOND.max_rounds, bo.SECOND.step, bo.SECOND.min_instances, bo.SECOND.max_leaves) == (600, 0.03, 40, 63)
    assert ml.logistic_pipeline(FEATS).getStages()[-1].getMaxIter() == 2000


def test_margins_of_the_model_are_those_of_the_fit(planted):
    b = bo.Booster(bo.boosting_rows(flagged(planted), FEATS), FEATS, replace(SMALL, min_gain=2.0, leaf_l1=0.5)).advance(6)
    m = replace(b.model(), trees=tuple(b.trees))
    rows = b.state.select("_m", vector_to_array("_x").alias("x")).collect()
    assert m.margins(np.array([r["x"] for r in rows])) == pytest.approx(np.array([r["_m"] for r in rows]), abs=1e-9)
    assert m.with_margin(planted.limit(0)).count() == 0


def test_patience_beats_the_first_round_without_gain(spark):
    u = lambda s: F.conv(F.substring(F.md5(F.concat("id", F.lit(s))), 1, 8), 16, 10).cast("double") / (1 << 32)     # noqa: E731
    df = spark.range(4000).select(*[u(c).alias(f"x{c}") for c in "abcdef"], u("y").alias("n"), "id")
    odd = ((F.col("xa") > 0.5).cast("int") + (F.col("xb") > 0.5).cast("int")) % 2 == 0           # no feature tells anything alone
    df = df.withColumn("default", (F.col("n") < F.when(odd, 0.8).otherwise(0.2)).cast("int"))
    df = ml.class_weights(df.withColumn("split", F.when(F.col("id") % 2 == 0, "val").otherwise("train"))).withColumn("is_val", F.col("split") == "val")
    params = bo.BoostParams(max_rounds=30, depth=2, step=0.3, feature_fraction=0.5, patience=10, block=10)
    m = bo.boost(df, [f"x{c}" for c in "abcdef"], params)
    first = next(i for i in range(1, len(m.history)) if m.history[i] <= m.history[i - 1])
    best = max(range(len(m.history)), key=lambda i: m.history[i])
    assert len(m.trees) == best + 1 > first and m.history[best] > m.history[first - 1] + 0.02
    assert len(m.history) == min(30, best + 1 + 10)


def test_boosting_without_validation_keeps_all_rounds(planted):
    rows = flagged(planted.where("split = 'train'"))
    assert len(bo.boost(rows, FEATS, replace(SMALL, max_rounds=2)).trees) == 2


def test_a_tree_by_hand():
    debug = "Tree: x\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0\n   Else (feature 1 > 2.0)\n    Predict: 0\n  Else (feature 0 > 0.5)\n   Predict: 0\n"
    p = bo.BoostParams(leaf_l1=1.0, leaf_l2=1.0, min_gain=0.0)
    sums = {0: (4.0, 2.0, 5), 1: (3.0, 1.0, 3), 2: (-6.0, 4.0, 9)}
    t, values = bo.build_tree(debug, [3, 5], sums, replace(p, min_gain=-9.0))
    assert t.feature == (3, 5, -1, -1, -1) and values == [1.0, 1.0, -1.0] and t.cover == (17, 8, 5, 3, 9)
    assert t.gain[1] == pytest.approx((9 / 3 + 4 / 2 - 36 / 4) / 2) and t.gain[1] < 0
    t, values = bo.build_tree(debug, [3, 5], sums, p)
    assert values == [6 / 4, 6 / 4, -1.0] and t.left == (1, -1, -1)             # the split that gains less is gone
    t, values = bo.build_tree(debug, [3, 5], sums, replace(p, min_gain=-9.0, max_leaves=1))
    assert t.left == (-1,) and values == [0.0] * 3


def test_search_is_seeded_and_halves(planted):
    w = ml.class_weights(planted, mode="ratio")
    args = (w.where("split = 'train'"), w.where("split = 'val'"), FEATS)
    small = {"depth": (2, 3), "step": (0.1, 0.3), "min_gain": (0.0, 1.0)}
    best, found = ml.parameter_search(*args, trials=4, max_iter=4, space=small)
    assert len(found) == 4 and best["auc"] == max(f["auc"] for f in found) and set(bo.SPACE) <= set(best)
    assert sorted(f["rounds"] for f in found) == [1, 1, 2, 4]                    # half stop at each rung
    again = ml.parameter_search(*args, trials=4, max_iter=4, space=small, threads=1)[1]
    assert [f["depth"] for f in again] == [f["depth"] for f in found] and [f["auc"] for f in again] == pytest.approx([f["auc"] for f in found])


def test_donors_are_never_broadcast(planted):
    rows = ml.with_donors(planted.select("app_id", *FEATS), "app_id", FEATS, 2, 5)        # few and small: Spark would broadcast them
    assert rows.count() == 6000
    plan = rows._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_permutation_importance_meets_brute_force(planted):
    val = planted.where("split = 'val'").limit(200)
    margin = lambda d: d.withColumn("p", F.round(0.7 * F.col("x_a") + 0.2 * F.col("x_b"), 4))     # noqa: E731
    got = {r["feature"]: r for r in ml.permutation_importance(margin, val, FEATS, repeats=3, seed=5).collect()}
    rows = sorted(val.collect(), key=lambda r: (hashlib.md5(f"{r['app_id']}|5".encode()).hexdigest(), r["app_id"]))
    n = len(rows)

    def area(scored):
        pos, neg = [p for p, y in scored if y], [p for p, y in scored if not y]
        return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)

    score = lambda a, b: round(0.7 * a + 0.2 * b, 4)                                               # noqa: E731
    base = area([(score(r["x_a"], r["x_b"]), r["default"]) for r in rows])
    for f in FEATS:
        drops = []
        for k in range(3):
            shift = 1 + int(hashlib.md5(f"5|{k}".encode()).hexdigest()[:12], 16) % (n - 1)
            swapped = []
            for i, r in enumerate(rows):
                v = {**r.asDict(), f: rows[(i + shift) % n][f]}
                swapped.append((score(v["x_a"], v["x_b"]), r["default"]))
            drops.append(base - area(swapped))
        assert got[f]["perm_importance_mean"] == pytest.approx(sum(drops) / 3, abs=2e-3)
    assert got["x_c"]["perm_importance_mean"] == 0


def test_pairing_keeps_every_row(planted):
    rows = ml.with_donors(planted.select("app_id", *FEATS), "app_id", FEATS, 2, 1)
    assert rows.count() == 2 * planted.count()
    assert rows.where("r = 0").select(F.col("donor")[0].alias("v")).exceptAll(planted.select(F.col("x_a").alias("v"))).count() == 0
    assert ml.with_donors(planted.limit(0), "app_id", FEATS, 2, 1).count() == 0


def test_registry_promotes_only_better(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert [ml.register_candidate(spark, path, "m", a, f"v{i}") for i, a in enumerate((0.7, 0.69, 0.75, 0.75))] == [
        "promoted", "kept_existing", "promoted", "kept_existing"]
    log = ml.read_registry(spark, path)
    top = ml.champion(log).first()
    assert (top["version"], top["new_auc"], top["path"]) == (3, 0.75, "v2") and log.count() == 4


def test_two_writers_get_two_versions(spark, tmp_path):
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda i: ml.register_candidate(spark, path, "m", 0.5 + i / 100, f"v{i}", f"run{i}"), range(8)))
    log = ml.read_registry(spark, path).orderBy("version").collect()
    assert [r["version"] for r in log] == list(range(1, 9)) and sum(d == "promoted" for d in made) == sum(r["decision"] == "promoted" for r in log)
    best = 0.0
    for r in log:                                                               # every version met the champion before it
        assert r["old_auc"] == best and r["decision"] == ("promoted" if r["new_auc"] > best else "kept_existing")
        best = max(best, r["new_auc"])
    assert ml.champion(ml.read_registry(spark, path)).first()["new_auc"] == pytest.approx(0.57)
    assert ml.register_candidate(spark, path, "m", 0.99, "again", "run3") == next(r["decision"] for r in log if r["run_id"] == "run3")
    assert ml.read_registry(spark, path).count() == 8


def test_stratified_split(planted):
    out = ml.stratified_split(planted.where("split = 'train'"), "app_id").groupBy("default").pivot("part").count().collect()
    assert all(r["val"] == (r["val"] + r["train"]) // 5 for r in out)


def test_variance_inflation(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(3, 1, (400, 3))
    x[:, 2] = x[:, 0] * 2 + rng.normal(0, 0.1, 400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0)], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in xe.variance_inflation(df, ["a", "b", "c"]).collect()}
    for i, c in enumerate("abc"):
        rest = np.delete(x, i, 1)
        fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        assert got[c] == pytest.approx((x[:, i] ** 2).sum() / ((x[:, i] - fit) ** 2).sum(), rel=1e-6)
    same = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "a double, b double")
    assert [r["vif"] for r in xe.variance_inflation(same, ["a", "b"]).collect()] == [float("inf")] * 2
    mixed = df.na.drop().withColumn("twice", F.col("a") * 2).withColumn("zero", F.lit(0.0))
    out = {r["feature"]: r["vif"] for r in xe.variance_inflation(mixed, ["a", "twice", "b", "zero"]).collect()}
    assert out["a"] == out["twice"] == float("inf") and 1 < out["b"] < 100 and out["zero"] is None


def test_anova_p(spark):
    df = spark.range(300).selectExpr("int(id % 2) as `default`", "double(id % 7) as x", "double(id % 2 * 3 + id % 5) as y")
    got = {r["feature"]: r for r in xe.anova_test(df, ["x", "y"]).collect()}
    plain = {r["feature"]: r["anova_f"] for r in xe.anova_f(df, ["x", "y"]).collect()}
    assert got["x"]["anova_p"] > 0.5 > 1e-6 > got["y"]["anova_p"] and got["y"]["anova_f"] == pytest.approx(plain["y"])


def test_f_tail():
    from loanlens.functions.stats import f_upper, normal_two_sided
    assert f_upper(1.0, 1, 1) == pytest.approx(0.5) and f_upper(4.0, 2, 2) == pytest.approx(1 / 5) and f_upper(0.0, 3, 4) == 1
    assert f_upper(3.0, 2, 10) == pytest.approx((1 + 2 * 3 / 10) ** -5)                # closed form for two degrees above
    assert f_upper(1.96 ** 2, 1, 10 ** 8) == pytest.approx(normal_two_sided(1.96), rel=1e-6)


def test_score_is_a_probability(planted):
    train = planted.where("split = 'train'")
    s = ml.score(ml.logistic_pipeline(FEATS, max_iter=20, weight_sum=train.count()).fit(ml.class_weights(train)), train)
    assert s.where("p < 0 or p > 1").count() == 0 and ev.auc(s).first()["auc"] > 0.9
    assert json.dumps(s.first()["decision"]) in ('"DENY"', '"APPROVE"')


def test_rows_of_a_tree_are_kept_while_it_is_fitted(planted, monkeypatch):
    seen, fit = [], bo.DecisionTreeRegressor.fit
    monkeypatch.setattr(bo.DecisionTreeRegressor, "fit", lambda self, df: (seen.append((df, df.is_cached)), fit(self, df))[1])
    bo.boost(flagged(planted), FEATS, replace(SMALL, max_rounds=2))
    assert [cached for _, cached in seen] == [True, True] and not any(df.is_cached for df, _ in seen)


def test_registered_learners_have_the_reference_settings(spark, planted, monkeypatch, tmp_path):
    """The queries' boosted learners ended after 12 rounds, or 4 without gain (F1)."""
    from loanlens.plans import queries
    seen = []

    class Prep:
        feature_columns = FEATS

    monkeypatch.setattr(queries, "_train_frame", lambda *a: (Prep, planted))
    monkeypatch.setattr(bo, "boost", lambda rows, feats, p: (seen.append((rows.count(), p)), bo.BoostedModel(tuple(feats), (), 0.0, p.step))[1])
    assert queries.feature_importance(spark, str(tmp_path)).count() == len(FEATS)
    assert queries.boosting_rounds(spark, str(tmp_path)).count() == 0
    assert seen == [(3000, bo.BoostParams()), (3000, bo.SECOND)] and [(p.max_rounds, p.patience) for _, p in seen] == [(800, 40), (600, 40)]


def test_blocks_do_not_change_the_model_and_reuse_their_folders(planted):
    rows = bo.boosting_rows(flagged(planted), FEATS)
    one, all_ = (bo.Booster(rows, FEATS, replace(SMALL, block=n)).advance(5) for n in (1, 5))
    assert one.history == pytest.approx(all_.history) and one.trees[-1].feature == all_.trees[-1].feature
    files = {f.split("/")[-2] for f in one.state.inputFiles()}
    assert len(files) == 1 and files < {f.split("/")[-1] for f in one._folders}              # five blocks in two folders (F1)
    m = replace(one.model(), trees=tuple(one.trees))
    got = one.state.select("_m", vector_to_array("_x").alias("x")).collect()
    assert len(got) == 3000 and m.margins(np.array([r["x"] for r in got])) == pytest.approx(np.array([r["_m"] for r in got]), abs=1e-9)


def test_a_block_of_trees_stays_compiled(planted):
    """Code of more than 8000 bytes is interpreted by the JVM, several times slower (F1)."""
    import contextlib
    import io
    import re
    b, text = bo.Booster(bo.boosting_rows(flagged(planted), FEATS), FEATS), io.StringIO()
    state = b.state.withColumn("_path", F.array().cast("array<double>"))
    for _ in range(b.params.block):
        state = b._add_tree(state)
    with contextlib.redirect_stdout(text):
        state.explain("codegen")
    assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())) < 8000


def test_rows_of_a_tree_are_stored_by_all_tasks(spark, planted, monkeypatch):
    """The tree's first look at its rows is one task, which must not prepare them alone (F1)."""
    seen, fit = [], bo.DecisionTreeRegressor.fit
    stored = lambda: [(i.numCachedPartitions(), i.numPartitions()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()]     # noqa: E731
    monkeypatch.setattr(bo.DecisionTreeRegressor, "fit", lambda self, df: (seen.append(stored()), fit(self, df))[1])
    bo.boost(flagged(planted), FEATS, replace(SMALL, max_rounds=2))
    assert len(seen) == 2 and all(x and all(done == parts for done, parts in x) for x in seen)
