"""Stored reference profiles against the full run, and the retraining loop."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from loanlens.operators import drift as dr
from loanlens.operators import learn as ml
from loanlens.operators import profile as pr
from loanlens.operators.retrain import retrain

FEATS = ["a", "b.c", "flag", "gaps"]
WINDOWS = ["w1", "w2", "broken"]


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: F.conv(F.substring(F.md5(F.concat("id", F.lit(s))), 1, 8), 16, 10).cast("double") / (1 << 32)     # noqa: E731
    df = spark.range(6000).withColumn("split", F.element_at(F.array(*[F.lit(x) for x in ("train", "train", "w1", "w2", "broken")]), (F.col("id") % 5 + 1).cast("int")))
    moved = F.when(F.col("split") == "w2", 0.4).otherwise(0.0)
    return df.select("id", "split", ((u("a") + moved) * F.when(F.col("split") == "broken", 1000.0).otherwise(1.0)).alias("a"),
                     F.floor(u("b") * 4).cast("double").alias("b.c"), (u("f") < 0.3 + moved / 2).cast("int").alias("flag"),
                     F.when(u("g") > 0.1, F.round(u("h"), 1)).alias("gaps"))


@pytest.fixture(scope="module")
def approval(spark):
    return spark.createDataFrame([("w1", 0.5, 0.5), ("w2", 0.55, 0.5), ("broken", 0.5, 0.5)], "window string, approval_rate double, baseline_approval_rate double")


def stored(spark, rows, path):
    p = pr.reference_profile(rows.where("split = 'train'"), FEATS, ["flag"], baseline_approval=0.5)
    assert pr.save_profile(spark, p, path) == 1
    return pr.load_profile(spark, path)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.mark.parametrize("method", ["distance", "test"])
def test_drift_equals_the_full_run_without_reading_the_reference(spark, rows, tmp_path, method):
    p = stored(spark, rows, str(tmp_path / "p"))
    windows_only = rows.where("split in ('w1', 'w2')")                           # no reference row can be read
    got = pr.drift_against(windows_only, p, ["w1", "w2"], binary=["flag"], method=method)
    want = dr.drift_features(rows, FEATS, ["w1", "w2"], binary=["flag"], method=method)
    assert same(want, got) and want.where("drift_detected").count() > 0


def test_monitoring_equals_the_full_run(spark, rows, approval, tmp_path):
    p = stored(spark, rows, str(tmp_path / "p"))
    got = pr.monitor_against(rows.where("split <> 'train'"), p, WINDOWS, approval.drop("baseline_approval_rate"), binary=["flag"])
    want = dr.monitor(rows, FEATS, WINDOWS, approval, binary=["flag"])
    assert same(want, got)
    assert {r["window"]: r["action"] for r in got.collect()}["broken"] == "fix_data"


def test_parts_merge_into_the_whole(spark, rows, tmp_path):
    train = rows.where("split = 'train'")
    a, b = (pr.reference_profile(train.where(F.col("id") % 3 == 0), FEATS), pr.reference_profile(train.where(F.col("id") % 3 != 0), FEATS))
    whole = pr.reference_profile(train, FEATS)
    assert same(whole.counts, a.merge(b).counts) and same(whole.ranges, a.merge(b).ranges)
    path = str(tmp_path / "p")
    assert [pr.save_profile(spark, x, path) for x in (a, a.merge(b))] == [1, 2]
    assert same(whole.counts, pr.load_profile(spark, path).counts) and same(a.counts, pr.load_profile(spark, path, 1).counts)


def test_writers_of_profiles_get_versions_of_their_own(spark, rows, tmp_path):
    p, path = pr.reference_profile(rows.limit(50), ["a"]), str(tmp_path / "p")
    with ThreadPoolExecutor(3) as pool:
        assert sorted(pool.map(lambda _: pr.save_profile(spark, p, path), range(3))) == [1, 2, 3]
    with pytest.raises(ValueError, match="no version"):
        pr.load_profile(spark, str(tmp_path / "none"))


def verdict(spark, *actions):
    return spark.createDataFrame([(f"w{i}", a != "none", a) for i, a in enumerate(actions)], "window string, should_retrain boolean, action string")


def test_retraining_takes_up_where_it_stopped(spark, rows, tmp_path):
    folder, registry = str(tmp_path / "runs"), str(tmp_path / "registry")
    df = rows.where("split = 'w1'").withColumn("default", F.col("flag")).withColumn("w", F.lit(1.0))
    fits, tests = [], []

    def fit(windows):
        fits.append(windows)
        return ml.logistic_pipeline(["a"], max_iter=3).fit(df)

    def test(model):
        tests.append(model)
        if len(tests) == 1:
            raise RuntimeError("driver lost")
        return 0.7

    args = (spark, folder, "run1", verdict(spark, "retrain", "none", "fix_data"), fit, test, registry, "m")
    with pytest.raises(RuntimeError):
        retrain(*args)
    steps = {r["step"]: r["detail"] for r in retrain(*args).collect()}
    assert steps == {"decide": "w0", "fit": "saved", "test": "0.700000", "register": "promoted"} and fits == [["w0"]] and len(tests) == 2
    assert retrain(*args).count() == 4 and len(tests) == 2 and ml.read_registry(spark, registry).count() == 1
    clean = retrain(spark, folder, "run2", verdict(spark, "none", "fix_data"), fit, test, registry, "m").collect()
    assert [(r["step"], r["detail"]) for r in clean] == [("decide", "")] and ml.read_registry(spark, registry).count() == 1


def test_retrain_loop_prepares_the_rows_once(spark, monkeypatch, tmp_path):
    """The loop's passes read the stored prepared rows; the raw loans are not prepared for each."""
    from loanlens.plans import pipeline, queries, queries_more
    calls = []

    class Stop(Exception):
        pass

    def retrain_with(spark, base, run, verdict, fit, test, registry, name):
        calls.extend(sorted({f.split("/")[-2] for f in verdict.inputFiles()} | {"verdict"}))
        fit(["val"])
        raise Stop

    def learned(spark, sf_dir, kind, splits, rows=None):
        calls.append((splits, {f.split("/")[-2].split("-")[0] for f in rows.inputFiles()}))

    from test_scale import _loans
    stored = str(tmp_path / "loans")
    years = F.regexp_replace("issue_d", "1994|2002", "1996")
    _loans(spark).withColumn("issue_d", years).write.parquet(stored)
    monkeypatch.setattr(pipeline, "staged_loan_applications", lambda spark, sf_dir: spark.read.parquet(stored))
    monkeypatch.setattr("loanlens.operators.retrain.retrain", retrain_with)
    monkeypatch.setattr(queries_more, "_learned", learned)
    with pytest.raises(Stop):
        queries_more.retrain_loop(spark, str(tmp_path))
    assert calls[-1] == (("train", "val"), {"prepared"}) and "loans" not in calls
