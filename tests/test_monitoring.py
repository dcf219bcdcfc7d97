"""Constructed quality-gate and drift cases (the reference has none)."""


from loanlens.operators import drift as dr
from loanlens.operators import quality as qa


def frame(spark, rows, cols="split string, a double, b double"):
    return spark.createDataFrame(rows, cols)


def ref_rows(n=100):
    return [("train", float(i), float(i % 7)) for i in range(n)]


def gate(spark, cur_rows, cols=("a", "b"), schema="split string, a double, b double"):
    df = frame(spark, ref_rows() + cur_rows, schema)
    return {r["window"]: r for r in qa.quality_gate(df, list(cols)).collect()}


def test_clean_window(spark):
    g = gate(spark, [("cur", float(i), float(i % 7)) for i in range(100)])
    assert g["cur"]["failure_type"] == "clean" and g["cur"]["severity"] == "none"


def test_scale_change_is_critical(spark):
    g = gate(spark, [("cur", float(i) * 1000, float(i % 7)) for i in range(100)])
    assert g["cur"]["failure_type"] == "pipeline_bug" and g["cur"]["severity"] == "critical"
    assert g["cur"]["affected_features"] == "a"


def test_missing_column_is_critical(spark):
    df = frame(spark, ref_rows())
    g = {r["window"]: r for r in qa.quality_gate(df.drop("b"), ["a", "b"]).collect()}
    assert g["train"]["severity"] == "critical" and "b" in g["train"]["affected_features"]


def test_null_rate_boundary(spark):
    g41 = gate(spark, [("cur", None if i < 41 else float(i), float(i % 7)) for i in range(100)])
    g40 = gate(spark, [("cur", None if i < 40 else float(i), float(i % 7)) for i in range(100)])
    assert g41["cur"]["failure_type"] == "pipeline_bug" and g41["cur"]["severity"] == "warning"
    assert g40["cur"]["failure_type"] == "clean"


def test_duplicates_warn_but_clean(spark):
    rows = [("cur", float(i), float(i % 7)) for i in range(79)] + [("cur", 1.0, 1.0)] * 21
    g = gate(spark, rows)
    assert g["cur"]["failure_type"] == "clean" and g["cur"]["severity"] == "warning"
    assert g["cur"]["duplicates_excessive"]


def test_drift_identical_is_clean_and_psi_zero(spark):
    rows = [(w, float(i % 50), float(i % 3)) for w in ("train", "cur") for i in range(2000)]
    df = frame(spark, rows)
    f = dr.drift_features(df, ["a", "b"], ["cur"]).collect()
    assert all(not r["drift_detected"] and abs(r["psi"]) < 1e-12 for r in f)
    v = dr.drift_verdict(dr.drift_features(df, ["a", "b"], ["cur"])).first()
    assert v["failure_type"] == "clean" and v["drift_score"] == 0.0


def test_drift_shift_detected(spark):
    rows = [("train", float(i % 50), float(i % 3)) for i in range(2000)]
    rows += [("cur", float(i % 50) + 30, float(i % 3)) for i in range(2000)]
    f = {r["feature"]: r for r in dr.drift_features(frame(spark, rows), ["a", "b"], ["cur"]).collect()}
    assert f["a"]["method"] == "wasserstein" and f["a"]["drift_detected"]
    assert f["b"]["method"] == "jensenshannon" and not f["b"]["drift_detected"]


def test_verdict_counts(spark):
    feats = spark.createDataFrame(
        [("w0", f"f{i}", False) for i in range(47)] + [("w1", f"f{i}", i < 1) for i in range(47)]
        + [("w2", f"f{i}", i < 10) for i in range(47)] + [("w3", f"f{i}", i < 2) for i in range(47)],
        "window string, feature string, drift_detected boolean")
    v = {r["window"]: r for r in dr.drift_verdict(feats).collect()}
    assert v["w0"]["failure_type"] == "clean"
    assert v["w1"]["failure_type"] == "investigate"
    assert v["w2"]["failure_type"] == "real_drift" and v["w2"]["drift_score"] == 0.2128
    assert v["w3"]["drift_score"] == 0.0426
