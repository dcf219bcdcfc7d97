"""Results at large row counts, and settings that must not depend on them."""

import pytest
from pyspark.sql import functions as F

from loanlens.operators import drift as dr
from loanlens.operators import evaluate as ev
from loanlens.operators import explore as xe
from loanlens.operators import quality as qa
from loanlens.plans.prefix import exact_quantiles, prefix_sums
from loanlens.session import ensure_checkpoint_dir, is_local


def test_expected_loss_of_many_large_loans(spark):
    df = spark.range(10 ** 8).select(F.lit(0.4567).alias("p"), F.lit(0).alias("default"), F.lit(150_000.0).alias("loan_amnt"))
    r = ev.business_metrics(df, 0.47).first()
    assert r["n"] == 10 ** 8 and r["expected_loss"] == pytest.approx(0.4567 * 150_000 * 10 ** 8)


def test_auc_of_billions_of_rows(spark, monkeypatch):
    counts = spark.createDataFrame([(i / 100, 3 * 10 ** 7, 3 * 10 ** 7) for i in range(100)], "score double, pos long, neg long")
    monkeypatch.setattr(ev, "_score_counts", lambda *a: counts)
    r = ev.auc(None).first()
    assert r["auc"] == 0.5 and r["positives"] == 3 * 10 ** 9


def test_products_of_large_counts(spark):
    one = spark.createDataFrame([(6 * 10 ** 9,)], "n long")
    from loanlens.functions.columns import round_ratio
    assert one.select(round_ratio(F.col("n") * 10 ** 9, F.col("n") * 10 ** 9 + 0)).first()[0] == 1.0
    assert xe.chi2_table(spark.range(100).selectExpr("string(id % 3) as c", "int(id % 2) as `default`"), ["c"]).count() == 1


@pytest.mark.parametrize("n", [1000, 1001])
def test_drift_method_does_not_depend_on_size(spark, n):
    df = spark.range(2 * n).select(F.when(F.col("id") < n, "train").otherwise("cur").alias("split"),
                                   (F.col("id") % n + F.when(F.col("id") < n, 0).otherwise(n // 25)).cast("double").alias("x"))
    r = dr.drift_features(df, ["x"], ["cur"]).first()
    assert (r["method"], r["drift_detected"]) == ("wasserstein", True) or r["method"] == "wasserstein"
    t = dr.drift_features(df, ["x"], ["cur"], method="test").first()
    assert t["method"] == "ks" and t["statistic"] == pytest.approx(0.04, abs=2e-3)


def test_quantiles_over_small_blocks(spark):
    df = spark.range(997).selectExpr("double((id * 7919) % 997) as a", "case when id % 5 = 0 then null else double(id % 10) end as b")
    got = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}, [0.0, 0.25, 0.5, 0.99, 1.0])
    assert got["a"] == pytest.approx([0, 249, 498, 986.04, 996]) and "none" not in got
    assert got["b"][0] == 1 and got["b"][-1] == 9
    c = spark.range(500).selectExpr("id % 2 as k", "double(id) as v", "1L as n")
    for blocks in (1, 7, None):
        rows = prefix_sums(c, ["k"], "v", ["n"], blocks=blocks).collect()
        assert all(r["cum_n"] == int(r["v"]) // 2 + 1 for r in rows)


def test_gate_with_dotted_names(spark):
    df = spark.range(40).select(F.when(F.col("id") < 20, "train").otherwise("cur").alias("split"),
                                F.col("id").cast("double").alias("purpose_a.b"), F.lit(1.0).alias("x"))
    g = qa.quality_gate(df, ["purpose_a.b", "x", "gone"]).first()
    assert (g["affected_features"], g["severity"]) == ("gone", "critical")
    d = dr.drift_features(df, ["purpose_a.b"], ["cur"]).first()
    assert d["feature"] == "purpose_a.b" and d["drift_detected"]


def test_duplicate_share_is_exact(spark):
    df = spark.range(1000).selectExpr("'w' as split", "id % 300 as a", "string(id % 2) as b", "cast(null as double) as c")
    r = qa.duplicate_share(df, ["a", "b", "c"]).first()
    assert (r["n"], r["n_distinct"]) == (1000, df.select("a", "b").distinct().count())


def test_no_scratch_folder_off_local_mode(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_no_nested_loop_without_keys(spark):
    df = spark.range(1000).selectExpr("round(id / 1000, 4) as p", "int(id % 3 = 0) as `default`")
    for q in (ev.roc_points(df), ev.auc(df)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ev.auc(df).first()["auc"] == pytest.approx(0.5, abs=0.02)


def _loans(spark):
    """Raw loans with five, three and fourteen categories; some fields and dates missing."""
    n = lambda k: (F.col("id") * 7919 % k).cast("double")            # noqa: E731
    gap = lambda c, k: F.when(F.col("id") % k != 0, c)               # noqa: E731
    nums = {"dti": 40, "fico_range_low": 551, "revol_util": 130, "annual_inc": 977, "loan_amnt": 991, "int_rate": 25, "delinq_2yrs": 4,
            "inq_last_6mths": 5, "open_acc": 9, "pub_rec": 3, "revol_bal": 983}
    names = {"home_ownership": 5, "verification_status": 3, "purpose": 14}
    month = F.element_at(F.array(*[F.lit(x) for x in ("Jan", "Jun", "Dec")]), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(400).select(
        F.col("id").alias("app_id"), F.when(F.col("id") % 4 == 0, "Charged Off").otherwise("Fully Paid").alias("loan_status"),
        *[gap(n(k), 11 + i).alias(c) for i, (c, k) in enumerate(nums.items())],
        *[gap(F.concat(F.lit("v"), (F.col("id") % k).cast("string")), 17).alias(c) for c, k in names.items()],
        gap(F.lit("B4"), 13).alias("sub_grade"), gap(F.lit(" 36 months"), 9).alias("term"), gap(F.lit("4 years"), 7).alias("emp_length"),
        F.when(F.col("id") % 50 == 0, "soon").otherwise(F.concat(month, F.lit("-"), (F.col("id") % 9 + 1994).cast("string"))).alias("issue_d"))


def test_preparation_stays_compiled(spark, tmp_path):
    """Code of more than 8000 bytes is interpreted by the JVM, several times slower."""
    import contextlib
    import io
    import re

    from loanlens.operators.clean import clean, temporal_split
    from loanlens.operators.prep import LoanPrep
    _loans(spark).write.parquet(str(tmp_path / "loans"))
    loans = temporal_split(clean(spark.read.parquet(str(tmp_path / "loans"))), _spec())
    out, text = LoanPrep().fit(loans).transform(loans), io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("codegen")
    assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())) < 8000
    feats = [f.name for f in out.schema if f.name not in ("app_id", "split", "default", "issue_d", "issue_year", "loan_amnt_raw")]
    assert {out.schema[c].dataType.simpleString() for c in feats} == {"double"}
    bad = out.agg(*[F.count_if(F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`")).alias(str(i)) for i, c in enumerate(feats)]).first()
    assert out.count() == loans.count() and not any(bad)


def _spec():
    from loanlens.operators.clean import SplitSpec
    return SplitSpec((1995, 1996, 1997), 1998, 1999, 2000, {"extra": (2001, 1998)})


def test_dates_are_not_parsed_for_every_window(spark):
    """A filter on the split repeats its expression; that must not multiply the parsing."""
    from loanlens.operators.clean import clean, temporal_split
    split = temporal_split(clean(_loans(spark)), _spec())
    plan = split.where(F.col("split").isin("val", "test")).select("split", "dti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_to_date") <= 4
    years = {1995: "train", 1996: "train", 1997: "train", 1998: "val", 1999: "test", 2000: "drift_2000", 2001: "extra"}
    assert {(r["issue_year"], r["split"]) for r in split.select("issue_year", "split").distinct().collect()} == set(years.items())


def test_profile_of_many_columns(spark):
    """Three aggregate functions, however many columns; text has counts of NULLs only."""
    df = spark.sql("select * from values ('a', 1.5D, 3, 'x'), ('a', null, 4, null), ('a', double('NaN'), null, 'y'), ('b', null, 7, null) as t(split, `v.1`, i, s)")
    p = qa.profile(df, ["v.1", "i", "s"])
    assert len([f for f in ("_z0", "_z1", "_lo0") if f in p._jdf.queryExecution().optimizedPlan().toString()]) == 0
    got = {(r["window"], r["feature"]): (r["n"], r["n_null"], r["min"], str(r["max"])) for r in p.collect()}
    assert got == {("a", "v.1"): (3, 1, 1.5, "nan"), ("a", "i"): (3, 1, 3.0, "4.0"), ("a", "s"): (3, 1, None, "None"),
                   ("b", "v.1"): (1, 1, None, "None"), ("b", "i"): (1, 0, 7.0, "7.0"), ("b", "s"): (1, 1, None, "None")}


def test_duplicates_tell_nulls_apart(spark):
    df = spark.sql("select 'w' as split, * from values (1, null), (null, 1), (null, 1), (1, 1) as t(a, b)")
    assert qa.duplicate_share(df, ["a", "b"]).first()["n_distinct"] == 3
