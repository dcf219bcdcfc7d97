"""Data-quality operators.

All column statistics for all windows come from ONE pass (``profile``) that
stacks the columns in the map stage and aggregates by (window, column); the
result has windows × features rows.  The duplicate share is one extra
``groupBy(window, row hash)`` whose map-side partial aggregation collapses
repeated rows before the shuffle, so hot duplicate groups stay cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from loanlens.functions.columns import round_ratio
from loanlens.session import shared_table

# Fixed thresholds of the reference's monitoring configuration.
MAX_NULL_RATE = 0.40
MAX_DUPLICATE_RATE = 0.20
SCALE_MULTIPLIER = 10.0
MIN_ROWS_WARNING = 1000
MAX_NULL_DATE_RATE = 0.05


def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types.get(c), NumericType)]


def profile(df: DataFrame, cols: Sequence[str], by: str = "split") -> DataFrame:
    """(window, feature, n, n_null, min, max) for every column, one pass.

    Columns are stacked in the map stage: an aggregate of three functions, not
    three a column, whose generated code is too long to be compiled.
    """
    nums = set(numeric_columns(df, cols))
    values = [F.col(f"`{c}`").cast("double") if c in nums else F.when(F.col(f"`{c}`").isNotNull(), F.lit(0.0)) for c in cols]
    tall = df.select(F.col(by).alias("window"), F.posexplode(F.array(*values)).alias("_at", "_v"))
    found = tall.groupBy("window", "_at").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_v").isNull()).alias("n_null"),
                                              F.min("_v").alias("min"), F.max("_v").alias("max"))
    at = F.col("_at") + 1
    ranged = F.element_at(F.array(*[F.lit(c in nums) for c in cols]), at)           # others have no minimum and maximum
    return found.select("window", F.element_at(F.array(*[F.lit(c) for c in cols]), at).alias("feature"), "n", "n_null",
                        *[F.when(ranged, F.col(m)).alias(m) for m in ("min", "max")])


def null_rates(prof: DataFrame, max_null_rate: float = MAX_NULL_RATE) -> DataFrame:
    """NULL share per feature and window; flag strictly above the limit."""
    rate = F.col("n_null") / F.col("n")
    return prof.select("window", "feature", rate.alias("null_rate"), (rate > max_null_rate).alias("flagged"))


def range_check(prof: DataFrame, reference: str = "train",
                multiplier: float = SCALE_MULTIPLIER) -> DataFrame:
    """Current max−min above reference max−min × multiplier; reference
    ranges of 0 are skipped (never flagged)."""
    ref = (prof.where(F.col("window") == reference).where(F.col("min").isNotNull())
           .select("feature", (F.col("max") - F.col("min")).alias("ref_range")))
    cur = prof.where(F.col("window") != reference).select("window", "feature",
                                                         (F.col("max") - F.col("min")).alias("cur_range"))
    j = cur.join(F.broadcast(ref), "feature")  # reference side: one row per feature
    flag = (F.col("ref_range") != 0) & (F.col("cur_range") > F.col("ref_range") * F.lit(multiplier))
    return j.select("window", "feature", "ref_range", "cur_range", F.coalesce(flag, F.lit(False)).alias("anomalous"))


def duplicate_share(df: DataFrame, cols: Sequence[str], by: str = "split",
                    max_rate: float = MAX_DUPLICATE_RATE) -> DataFrame:
    """Share of rows repeating an earlier row over ``cols`` (NULLs equal).

    Rows are counted by two independent 64-bit hashes of all columns (128 bits
    together), so the shuffle carries 16 bytes per distinct row instead of the
    row; two different rows meet with probability n² / 2^129.
    """
    v = [F.col(f"`{c}`") for c in cols]
    nulls = F.array(*[x.isNull() for x in v])        # hashes skip NULLs
    groups = df.groupBy(by, F.xxhash64(nulls, *v).alias("_h1"), F.xxhash64(*v[::-1], nulls, F.lit("second")).alias("_h2")).count()
    r = groups.groupBy(by).agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
    rate = F.lit(1.0) - F.col("n_distinct") / F.col("n")
    return r.select(F.col(by).alias("window"), "n", "n_distinct", rate.alias("duplicate_rate"),
                    (rate > max_rate).alias("is_excessive"))


def mark_duplicates(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Rows with ``is_duplicate``, false for the row of least ``key`` among equals.

    The first key of each distinct row comes from a grouped minimum with
    partial aggregation, so a hot group of equal rows meets the shuffle once
    per task; it is joined back by the same row hash as in D13.
    """
    v = [F.col(f"`{c}`") for c in cols]
    nulls = F.concat(*[x.isNull().cast("int").cast("string") for x in v])
    h = df.withColumns({"_h1": F.xxhash64(nulls, *v), "_h2": F.xxhash64(*v[::-1], nulls, F.lit("second"))})
    first = h.groupBy("_h1", "_h2").agg(F.min(key).alias("_first"))
    return h.join(first, ["_h1", "_h2"]).withColumn("is_duplicate", F.col(key) != F.col("_first")).drop("_h1", "_h2", "_first")


def schema_diff(reference_cols: Sequence[str], current_cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """Sorted missing and extra columns (metadata only)."""
    ref, cur = set(reference_cols), set(current_cols)
    return sorted(ref - cur), sorted(cur - ref)


def quality_gate(current: DataFrame, reference_cols: Sequence[str], by: str = "split",
                 reference: str = "train", multiplier: float = SCALE_MULTIPLIER,
                 max_null_rate: float = MAX_NULL_RATE, max_dup_rate: float = MAX_DUPLICATE_RATE,
                 reference_frame: DataFrame | None = None, reference_ranges: DataFrame | None = None) -> DataFrame:
    """J1 for every window at once: schema → scale → nulls → duplicates.

    ``current`` holds all windows (``by`` column) including the reference
    window unless ``reference_frame`` supplies it, or ``reference_ranges``
    (feature, n, n_null, min, max) of a stored profile.  Missing columns and scale
    anomalies are critical; high NULL share is a warning; excess duplicates
    are a warning that never makes a ``pipeline_bug``.
    """
    missing, extra = schema_diff(reference_cols, [c for c in current.columns if c != by])
    shared = [c for c in reference_cols if c in current.columns]
    quoted = [F.col(f"`{c}`") for c in shared]
    base = current if reference_frame is None else current.unionByName(reference_frame, allowMissingColumns=True)
    prof = profile(base.select(by, *quoted), shared, by)
    if reference_ranges is not None:
        prof = prof.unionByName(reference_ranges.where(F.col("feature").isin(*shared)).withColumn("window", F.lit(reference)))
    prof = shared_table(prof, "column-profile")          # windows x features rows, read by both checks
    rng = range_check(prof, reference, multiplier).where("anomalous").select("window", "feature")
    nul = null_rates(prof, max_null_rate).where("flagged").select("window", "feature")
    dup = duplicate_share(current.select(by, *quoted), shared, by, max_dup_rate)
    scale = rng.groupBy("window").agg(F.array_sort(F.collect_set("feature")).alias("scale_features"))
    nulls = nul.groupBy("window").agg(F.array_sort(F.collect_set("feature")).alias("null_features"))
    v = (dup.join(scale, "window", "left").join(nulls, "window", "left")
         .where(F.col("window") != reference if reference_frame is not None else F.lit(True)))
    empty = F.array().cast("array<string>")
    sc = F.coalesce(F.col("scale_features"), empty)
    nu = F.coalesce(F.col("null_features"), empty)
    miss = F.array(*[F.lit(m) for m in missing]).cast("array<string>") if missing else empty
    affected = F.array_sort(F.array_distinct(F.concat(miss, sc, nu)))
    critical = (F.size(miss) > 0) | (F.size(sc) > 0)
    warning = (F.size(nu) > 0) | F.col("is_excessive")
    return v.select(
        "window",
        F.when(F.size(affected) > 0, "pipeline_bug").otherwise("clean").alias("failure_type"),
        F.when(critical, "critical").when(warning, "warning").otherwise("none").alias("severity"),
        F.concat_ws(",", affected).alias("affected_features"),
        F.size(miss).alias("n_missing"), F.size(sc).alias("n_scale"), F.size(nu).alias("n_high_null"),
        F.lit(",".join(extra)).alias("extra_columns"),
        "duplicate_rate", F.col("is_excessive").alias("duplicates_excessive"))


# ------------------------------------------------------------- B14, B15
#: Field rules of the serving schema and business rules: (name, column, SQL predicate that must hold, severity).
FIELD_RULES: list[tuple[str, str, str, str]] = (
    [(f"{c}_non_negative", c, f"{c} >= 0", "reject") for c in
     ["dti", "fico_range_low", "revol_util", "annual_inc", "loan_amnt", "int_rate",
      "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal"]]
    + [("fico_range", "fico_range_low", "fico_range_low between 300 and 850", "reject"),
       ("revol_util_max", "revol_util", "revol_util <= 892", "reject")]
    + [(f"{c}_required", c, f"{c} is not null", "reject") for c in
       ["dti", "fico_range_low", "revol_util", "annual_inc", "loan_amnt", "int_rate", "delinq_2yrs",
        "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "sub_grade", "term", "emp_length",
        "home_ownership", "verification_status", "purpose"]]
    + [("fico_business_min", "fico_range_low", "not (fico_range_low < 300)", "reject"),
       ("term_known", "term", "trim(term) in ('36 months', '60 months', '')", "warn")]
)


def rule_violations(df: DataFrame, rules=FIELD_RULES, key: str = "app_id") -> DataFrame:
    """One row per (row, violated rule).  A NULL predicate on a
    present value counts as satisfied (NULLs are the 'required' rules' job)."""
    present = set(df.columns)
    items = []
    for name, col, pred, sev in rules:
        if col not in present:
            continue
        ok: Column = F.coalesce(F.expr(pred), F.lit(True))
        items.append(F.when(~ok, F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity"))))
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    return (df.select(key, F.explode(arr).alias("v")).select(key, "v.rule", "v.severity"))


def quarantine(df: DataFrame, rules=FIELD_RULES) -> DataFrame:
    """Adds ``violations`` (array of rule names) and ``status`` accept/warn/reject."""
    present = set(df.columns)
    names, sevs = [], []
    for name, col, pred, sev in rules:
        if col in present:
            bad = ~F.coalesce(F.expr(pred), F.lit(True))
            names.append(F.when(bad, F.lit(name)))
            sevs.append(F.when(bad, F.lit(sev)))
    v = F.filter(F.array(*names), lambda x: x.isNotNull())
    s = F.filter(F.array(*sevs), lambda x: x.isNotNull())
    status = (F.when(F.array_contains(s, "reject"), "reject")
              .when(F.array_contains(s, "warn"), "warn").otherwise("accept"))
    return df.select("*", v.alias("violations"), status.alias("status"))


# ------------------------------------------------------------- D45
def raw_validation(df: DataFrame, required: Sequence[str], target: str = "default",
                   date_col: str = "issue_d", by: str | None = None) -> DataFrame:
    """(check, level, message) rows from one aggregate plus metadata."""
    missing = sorted(set(required) - set(df.columns))
    aggs = [F.count(F.lit(1)).alias("n")]
    if target in df.columns:
        aggs.append(F.count_if(F.col(target).isNotNull() & ~F.col(target).isin(0, 1)).alias("bad_target"))
    if date_col in df.columns:
        aggs.append(F.count_if(F.col(date_col).isNull()).alias("null_dates"))
    keys = [by] if by else []
    r = df.groupBy(*keys).agg(*aggs)
    checks = [F.struct(F.lit("required_columns").alias("check"),
                       F.lit("error" if missing else "ok").alias("level"),
                       F.lit("absent: " + ",".join(missing) if missing else "all present").alias("message"))]
    if target in df.columns:
        checks.append(F.struct(F.lit("target_values").alias("check"),
                               F.when(F.col("bad_target") > 0, "error").otherwise("ok").alias("level"),
                               F.concat(F.col("bad_target").cast("string"), F.lit(" rows outside {0,1}")).alias("message")))
    if date_col in df.columns:
        rate = round_ratio(F.col("null_dates"), F.col("n"), 3)
        checks.append(F.struct(F.lit("issue_date_nulls").alias("check"),
                               F.when(F.col("null_dates") / F.col("n") > MAX_NULL_DATE_RATE, "warning").otherwise("ok").alias("level"),
                               F.concat(F.lit("null share "), rate.cast("string")).alias("message")))
    elif "issue_year" not in df.columns:
        checks.append(F.struct(F.lit("issue_date_present").alias("check"), F.lit("error").alias("level"),
                               F.lit("no date column").alias("message")))
    checks.append(F.struct(F.lit("row_count").alias("check"),
                           F.when(F.col("n") < MIN_ROWS_WARNING, "warning").otherwise("ok").alias("level"),
                           F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("message")))
    return r.select(*keys, F.explode(F.array(*checks)).alias("c")).select(*keys, "c.*")
