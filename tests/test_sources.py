"""Readers and sinks on files with shuffled, missing and broken columns."""

import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loanlens.operators import clean as cl
from loanlens.operators import drift as dr
from loanlens.operators import quality as qa
from loanlens.sources import loans as io

FIELDS = io.RAW_LOAN_SCHEMA.fieldNames()


def write_csv(path, header, rows):
    with gzip.open(path, "wt") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' if v is not None else "" for v in r) + "\n")


def test_columns_are_found_by_name(spark, tmp_path):
    header = ["id", *FIELDS[::-1], "extra", "hardship_flag"]
    values = {c: str(i) for i, c in enumerate(FIELDS)} | {"term": " 36 months", "issue_d": "Mar-2014", "loan_status": "Fully Paid", "dti": "n/a"}
    write_csv(tmp_path / "loans.csv.gz", header, [["7", *[values[c] for c in FIELDS[::-1]], "x", "y"]])
    r = io.read_loan_csv(spark, str(tmp_path / "loans.csv.gz"), 2).first()
    assert r["dti"] is None and r["term"] == " 36 months" and r["loan_status"] == "Fully Paid"
    assert all(r[c] == float(values[c]) for c in io.NUMERIC_RAW if c != "dti")
    bad = {x["column"]: x["n"] for x in io.failed_casts(spark, str(tmp_path / "loans.csv.gz")).collect()}
    assert bad.pop("dti") == 1 and not any(bad.values())
    assert io.read_train_years(spark, str(tmp_path / "loans.csv.gz")).count() == 1
    assert io.read_train_years(spark, str(tmp_path / "loans.csv.gz"), (2015,)).count() == 0


def test_missing_column_and_file(spark, tmp_path):
    write_csv(tmp_path / "short.csv.gz", FIELDS[1:], [["1"] * (len(FIELDS) - 1)])
    with pytest.raises(ValueError, match=FIELDS[0]):
        io.read_loan_csv(spark, str(tmp_path / "short.csv.gz"))
    with pytest.raises(AnalysisException):
        io.read_loan_csv(spark, str(tmp_path / "none.csv"))


def test_windows(spark, tmp_path):
    df = spark.range(30).select("id", F.element_at(F.array(F.lit("train"), F.lit("test"), F.lit("drift_2018")), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    shapes = {r["split"]: (r["rows"], r["width"]) for r in io.write_splits(df, str(tmp_path / "s")).collect()}
    assert shapes == {"train": (10, 1), "test": (10, 1), "drift_2018": (10, 1)}
    assert io.read_window(spark, str(tmp_path / "s"), "2018", ["id"]).count() == 10
    assert io.read_window(spark, str(tmp_path / "s"), "2017").where("split = 'test'").count() == 10
    with pytest.raises(FileNotFoundError):
        io.read_window(spark, str(tmp_path / "s"), "1900")


def test_bad_log_lines(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"request_id": "a", "champion_probability": 0.5}\n\n{broken\n')
    rows = io.read_counterfactual_log(spark, str(tmp_path / "log.json"), strict=False).collect()
    assert [r["request_id"] for r in rows if r["_corrupt_record"] is None] == ["a"] and sum(r["_corrupt_record"] is not None for r in rows) == 1
    with pytest.raises(Exception):
        io.read_counterfactual_log(spark, str(tmp_path / "log.json")).collect()


def test_marked_duplicates_and_trim(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", 1.0), (4, None, None), (5, None, None)], "k long, a string, b double")
    got = {r["k"]: r["is_duplicate"] for r in qa.mark_duplicates(df, ["a", "b"], "k").collect()}
    assert got == {1: False, 3: True, 2: False, 4: False, 5: True}
    t = spark.range(1, 102).selectExpr("double(id) as v")
    assert cl.trim_upper_quantile(t, "v", 0.99).count() == 100
    assert cl.trim_upper_quantile(t.where("v < 0"), "v").count() == 0


def test_monitor_skips_the_broken_window(spark, monkeypatch):
    df = spark.range(400).select(F.element_at(F.array(*[F.lit(x) for x in ("train", "a", "b", "c")]), (F.col("id") % 4 + 1).cast("int")).alias("split"),
                                 F.floor("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("flag"))
    df = df.withColumn("x", F.col("x") * F.when(F.col("split") == "b", 1000).when(F.col("split") == "c", 2).otherwise(1))
    approval = spark.createDataFrame([(w, 0.5, 0.5) for w in "abc"], "window string, approval_rate double, baseline_approval_rate double")
    seen = []
    real = dr.drift_features
    monkeypatch.setattr(dr, "drift_features", lambda d, f, w, *a, **k: seen.append(list(w)) or real(d, f, w, *a, **k))
    got = {r["window"]: (r["failure_type"], r["action"]) for r in dr.monitor(df, ["x", "flag"], ["a", "b", "c"], approval).collect()}
    assert seen == [["a", "c"]] and got["b"] == ("pipeline_bug", "fix_data") and got["a"][0] in ("clean", "real_drift", "investigate")


def test_binary_columns_count_the_same(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, "train").otherwise("cur").alias("split"), (F.col("id") % 7 == 0).cast("double").alias("f"),
                                 F.sqrt("id").alias("x"), F.when(F.col("id") % 5 > 0, 1.0).alias("g"))
    plain = sorted(map(str, dr.drift_features(df, ["f", "x", "g"], ["cur"]).collect()))
    assert sorted(map(str, dr.drift_features(df, ["f", "x", "g"], ["cur"], binary=["f", "g"]).collect())) == plain
    with pytest.raises(Exception):
        dr.drift_features(df, ["x"], ["cur"], binary=["x"]).collect()
