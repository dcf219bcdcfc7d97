"""Loan-file readers and log readers/writers.

No schema inference: CSV columns are found by their header names and read as
text, then cast; other sources carry explicit schemas.  Sinks are Spark writers
with atomic commits; logs are append-only tables instead of rewritten JSON
arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

NUMERIC_RAW = ["dti", "fico_range_low", "revol_util", "annual_inc", "loan_amnt", "int_rate",
               "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal"]
STRING_RAW = ["sub_grade", "term", "emp_length", "home_ownership", "verification_status", "purpose",
              "loan_status", "issue_d"]
RAW_LOAN_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in NUMERIC_RAW]
                               + [T.StructField(c, T.StringType()) for c in STRING_RAW])

COUNTERFACTUAL_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("assigned_model", T.StringType()), T.StructField("champion_probability", T.DoubleType()),
    T.StructField("champion_decision", T.StringType()), T.StructField("challenger_probability", T.DoubleType()),
    T.StructField("challenger_decision", T.StringType()), T.StructField("returned_decision", T.StringType())])

MONITORING_SCHEMA = T.StructType([
    T.StructField("window", T.StringType()), T.StructField("drift_detected", T.BooleanType()),
    T.StructField("failure_type", T.StringType()), T.StructField("drifted_features", T.StringType()),
    T.StructField("drift_score", T.DoubleType()), T.StructField("approval_rate", T.DoubleType()),
    T.StructField("baseline_approval_rate", T.DoubleType()), T.StructField("should_retrain", T.BooleanType()),
    T.StructField("action", T.StringType()), T.StructField("timestamp", T.DateType())])


def read_loan_csv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A1: header CSV files (gzip allowed); the named raw columns wherever they
    stand, of the raw types.

    A column missing from the header raises ValueError, a missing path
    Spark's path error.  Numbers that don't parse become NULL;
    :func:`failed_casts` counts them.  Gzip is not splittable, so with
    ``partitions`` the rows of each file are spread out after the scan.
    """
    text = read_loan_text(spark, path)
    df = text.select(*[F.expr(f"try_cast(trim(`{c}`) as double)").alias(c) if c in NUMERIC_RAW else F.col(f"`{c}`")
                       for c in RAW_LOAN_SCHEMA.fieldNames()])
    return df.repartition(partitions) if partitions else df


def read_loan_text(spark: SparkSession, path: str) -> DataFrame:
    """The named raw columns as text; the header is the only part read here."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    absent = [c for c in RAW_LOAN_SCHEMA.fieldNames() if c not in df.columns]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)}")
    return df.select(*[F.col(f"`{c}`") for c in RAW_LOAN_SCHEMA.fieldNames()])


def failed_casts(spark: SparkSession, path: str) -> DataFrame:
    """(column, n): values of each numeric column that are present but no number, one pass."""
    text = read_loan_text(spark, path)
    bad = text.agg(*[F.count_if(F.expr(f"`{c}` is not null and try_cast(trim(`{c}`) as double) is null")).alias(c) for c in NUMERIC_RAW])
    return bad.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in NUMERIC_RAW])).alias("s")).select("s.*")


def sample_rows(df: DataFrame, fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """A3: Bernoulli sample of the rows at load."""
    return df.sample(fraction=fraction, seed=seed)


def read_train_years(spark: SparkSession, path: str, years=(2013, 2014, 2015)) -> DataFrame:
    """A2: scan, parse the issue date, keep train years only."""
    from loanlens.operators.clean import parse_issue_date
    return parse_issue_date(read_loan_csv(spark, path)).where(F.col("issue_year").isin(*years))


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> DataFrame:
    """One parquet dataset partitioned by split (empty splits simply have
    no folder); returns [rows, width] per split as read back."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    back = df.sparkSession.read.parquet(path)
    width = len([c for c in back.columns if c != split_col])
    return back.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows")).withColumn("width", F.lit(width))


WINDOW_SPLITS = {"2018": "drift_2018", "2017": "test", "2016": "val", "train": "train"}


def read_window(spark: SparkSession, path: str, label: str, columns: list[str] | None = None,
                split_col: str = "split") -> DataFrame:
    """A4 + A5: window label → split partition (pruned at the scan), feature
    columns only; unknown labels try ``label`` then ``drift_<label>``."""
    candidates = [WINDOW_SPLITS.get(label, label), f"drift_{label}"]
    for c in candidates:
        try:        # opens this partition's folder only
            out = spark.read.option("basePath", path).parquet(f"{path}/{split_col}={c}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        return out.select(*columns) if columns else out
    raise FileNotFoundError(f"no data for window {label!r}; tried {candidates}")


def read_counterfactual_log(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """JSON-lines log with the explicit schema.  ``strict`` fails on a bad
    line (analyser behaviour); otherwise bad lines land in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(COUNTERFACTUAL_SCHEMA).option("mode", "FAILFAST").json(path)
    schema = T.StructType(COUNTERFACTUAL_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append JSON lines (counterfactual, prediction, simulation logs)."""
    df.write.mode("append").json(path)


def read_monitoring_log(spark: SparkSession, path: str) -> DataFrame:
    """A10: the append-only monitoring log; every run has written a folder of its own."""
    return spark.read.schema(MONITORING_SCHEMA).parquet(path)


def write_evidence_csv(df: DataFrame, path: str) -> None:
    """The small evidence table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


#: One made-up application: what is scored when no document is given.
SAMPLE_APPLICATION = {
    "dti": 17.5, "fico_range_low": 705.0, "revol_util": 38.2, "annual_inc": 64000.0, "loan_amnt": 9600.0, "int_rate": 12.1, "delinq_2yrs": 0.0,
    "inq_last_6mths": 1.0, "open_acc": 9.0, "pub_rec": 0.0, "revol_bal": 11800.0, "sub_grade": "B4", "term": " 36 months", "emp_length": "4 years",
    "home_ownership": "RENT", "verification_status": "Verified", "purpose": "debt_consolidation"}


def application_from_json(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One application JSON document (multi-line) as a one-row DataFrame; without a path the sample application.

    A path that is not there raises ``FileNotFoundError``.
    """
    if path is None:
        return spark.createDataFrame([[SAMPLE_APPLICATION.get(f.name) for f in RAW_LOAN_SCHEMA.fields]], RAW_LOAN_SCHEMA)
    try:
        return spark.read.schema(RAW_LOAN_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no application document at {path}") from None
