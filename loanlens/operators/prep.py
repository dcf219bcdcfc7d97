"""Train-fitted feature preparation (I1, I2, B9–B11, A8) as a Spark ML
Estimator / Model pair.

``fit`` counts (column, value) pairs of the train split, takes exact medians
and p99 caps from distributed running counts (no task holds a column), and
one aggregate for categories and class counts; the fitted parameters are a
small document (bounded by the number of features and categories).
``transform`` is a single projection: no shuffle, no Python UDF.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.plans.prefix import exact_quantiles
from loanlens.functions.columns import (
    ORDINAL_FALLBACK, TERM_DEFAULT, as_missing, clip_upper, emp_length_num,
    number_or_zero, one_hot, sub_grade_levels, sub_grade_ordinal, term_months,
    was_missing,
)

# Fixed feature lists of the reference's preparation step.
NUMERIC_FEATURES = ["dti", "fico_range_low", "revol_util", "annual_inc", "loan_amnt",
                    "int_rate", "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec",
                    "revol_bal"]
NOMINAL_FEATURES = ["home_ownership", "verification_status", "purpose"]
CAPPED_FROM_QUANTILE = ["annual_inc", "revol_bal", "dti"]
CAPPED_ORDER = ["annual_inc", "revol_bal", "revol_util", "dti"]
REVOL_UTIL_HARD_CAP = 100.0
CAP_QUANTILE = 0.99
PASS_THROUGH = ["default", "issue_d", "issue_year"]
RAW_FIELDS = NUMERIC_FEATURES + ["sub_grade", "term", "emp_length"] + NOMINAL_FEATURES


def final_columns(categories: dict[str, list[str]], impute_cols: list[str]) -> list[str]:
    """Column order: base numerics, capped, engineered, one-hot, was-missing flags."""
    base = [c for c in NUMERIC_FEATURES if c not in CAPPED_ORDER]
    capped = [f"{c}_capped" for c in CAPPED_ORDER]
    engineered = ["emp_length_num", "sub_grade_encoded", "term_num"]
    onehot = [f"{c}_{v}" for c, vals in categories.items() for v in vals]
    flags = [f"{c}_was_missing" for c in impute_cols]
    return base + capped + engineered + onehot + flags


class LoanPrep(Estimator):
    """Fit medians, caps, category lists and class counts on train rows.

    Medians and caps are exact.  ``max_categories`` bounds the categories of a
    nominal column by an exact count; a wider column raises.
    """

    def __init__(self, max_categories: int = 1000, target: str = "default"):
        super().__init__()
        self.max_categories = max_categories
        self.target = target

    def _fit(self, df: DataFrame) -> "LoanPrepModel":
        impute_cols = NUMERIC_FEATURES + ["emp_length_num"]
        present = set(df.columns)

        def source(c: str) -> Column:
            if c == "emp_length_num":
                return emp_length_num(F.col("emp_length")) if "emp_length" in present else F.lit(None).cast("double")
            return as_missing(F.col(c)) if c in present else F.lit(None).cast("double")

        found = exact_quantiles(df, {c: source(c) for c in impute_cols}, [0.5, CAP_QUANTILE])
        row: dict = {}
        if self.target in present:
            row = df.agg(F.count(F.when(F.col(self.target) == 0, 1)).alias("n_neg"),
                         F.count(F.when(F.col(self.target) == 1, 1)).alias("n_pos")).first().asDict()

        nominal = [c for c in NOMINAL_FEATURES if c in present]
        cats: dict[str, list[str]] = {c: [] for c in NOMINAL_FEATURES}
        if nominal:
            pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v"))
                                                  for i, c in enumerate(nominal)])).alias("s")).select("s.*").where(
                F.col("v").isNotNull()).distinct()
            # One row beyond the bound is enough to know that a column exceeds it.
            for r in pairs.limit(len(nominal) * self.max_categories + 1).collect():
                cats[nominal[r["i"]]].append(r["v"])
        too_wide = [c for c in nominal if len(cats[c]) > self.max_categories]
        if too_wide:
            raise ValueError(f"more than {self.max_categories} categories: {too_wide}")
        cats = {c: sorted(v) for c, v in cats.items()}

        medians = {c: (found[c][0] if c in found else None) for c in impute_cols}
        caps = {c: (found[c][1] if c in found else None) for c in CAPPED_FROM_QUANTILE}
        caps["revol_util"] = REVOL_UTIL_HARD_CAP
        n_neg, n_pos = int(row.get("n_neg", 0) or 0), int(row.get("n_pos", 0) or 0)
        params = {
            "imputation": medians,
            "caps": {c: caps[c] for c in CAPPED_ORDER},
            "categories": cats,
            "sub_grade_map": {s: i for i, s in enumerate(sub_grade_levels())},
            "final_model_columns": final_columns(cats, impute_cols),
            "expected_width": len(final_columns(cats, impute_cols)),
            "class_counts": {"negative": n_neg, "positive": n_pos},
            "scale_pos_weight": (n_neg / n_pos) if n_pos > 0 else 1.0,
        }
        return LoanPrepModel(params)


class LoanPrepModel(Model):
    """H1 → H5 → H2 → H3 → H6 → H4 → B9 → B10 as one ``select``."""

    def __init__(self, params: dict):
        super().__init__()
        self.params_doc = params

    # --- parameters -------------------------------------------------------
    @property
    def feature_columns(self) -> list[str]:
        return list(self.params_doc["final_model_columns"])

    @property
    def width(self) -> int:
        return len(self.feature_columns)

    # --- transform ----------------------------------------------------------
    def feature_expressions(self, columns: list[str]) -> dict[str, Column]:
        p = self.params_doc
        present = set(columns)
        out: dict[str, Column] = {}
        raw: dict[str, Column] = {}
        # H1: employment years (absent column → NULL → imputed, flag 1)
        raw["emp_length_num"] = emp_length_num(F.col("emp_length")) if "emp_length" in present else None
        for c in NUMERIC_FEATURES:
            raw[c] = as_missing(F.col(c)) if c in present else None
        # H5: was-missing flags computed before the fill, then the fill
        filled: dict[str, Column] = {}
        for c, med in p["imputation"].items():
            src = raw.get(c)
            medv = F.lit(med).cast("double")
            if src is None:
                out[f"{c}_was_missing"] = F.lit(1)
                filled[c] = medv
            else:
                out[f"{c}_was_missing"] = was_missing(src)
                filled[c] = F.coalesce(src, medv)
        # H2: sub-grade ordinal, absent → fallback
        out["sub_grade_encoded"] = (sub_grade_ordinal(F.col("sub_grade"), p["sub_grade_map"])
                                    if "sub_grade" in present else F.lit(float(ORDINAL_FALLBACK)))
        # H3: term months, absent → 36
        out["term_num"] = term_months(F.col("term")) if "term" in present else F.lit(TERM_DEFAULT)
        # H6: one-hot over the train categories, absent → 0
        for c, cats in p["categories"].items():
            for v in cats:
                out[f"{c}_{v}"] = one_hot(F.col(c), v) if c in present else F.lit(0)
        # H4: caps on the filled values
        for c, cap in p["caps"].items():
            out[f"{c}_capped"] = clip_upper(filled[c], cap) if cap is not None else filled[c]
        for c in NUMERIC_FEATURES + ["emp_length_num"]:
            out.setdefault(c, filled[c])
        return out

    def always_numbers(self) -> set[str]:
        """Columns whose expression is a number in every row: indicators, flags, and values filled with a median."""
        p = self.params_doc
        filled = {c for c, med in p["imputation"].items() if med is not None and med == med}
        return ({f"{c}_{v}" for c, vals in p["categories"].items() for v in vals} | {f"{c}_was_missing" for c in p["imputation"]}
                | {"sub_grade_encoded"} | filled | {f"{c}_capped" for c in p["caps"] if c in filled})

    def _transform(self, df: DataFrame) -> DataFrame:
        self.check_width()
        exprs = self.feature_expressions(df.columns)
        cols = self.feature_columns
        # Absent configured columns become 0; every value coerced to double.  What is a number anyway
        # only takes the type: the one projection must stay short enough for its code to be compiled.
        sure = self.always_numbers()
        select = [(exprs[c].cast("double") if c in exprs and c in sure else number_or_zero(exprs[c] if c in exprs else F.lit(0))).alias(c)
                  for c in cols]
        keep = [c for c in df.columns if c in PASS_THROUGH or c in self.extra_columns]
        return df.select(*keep, *select)

    def check_width(self) -> None:
        """The column list must have the width that ``fit`` stored beside it."""
        cols, width = self.feature_columns, self.params_doc.get("expected_width")
        if width is None or len(cols) != width or len(set(cols)) != len(cols):
            raise ValueError(f"expected {width} distinct feature columns, the parameter document lists {len(cols)}")

    extra_columns: tuple[str, ...] = ("app_id", "split", "loan_amnt_raw")

    def with_passthrough(self, *cols: str) -> "LoanPrepModel":
        m = LoanPrepModel(self.params_doc)
        m.extra_columns = tuple(self.extra_columns) + tuple(cols)
        return m

    # --- persistence (A8) ----------------------------------------------------
    def to_json(self) -> str:
        return json.dumps(self.params_doc, sort_keys=True)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the parameter document as one JSON row (atomic file commit)."""
        spark.createDataFrame([(self.to_json(),)], "doc string").coalesce(1) \
             .write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LoanPrepModel":
        model = cls(json.loads(spark.read.text(path).first()[0]))
        model.check_width()
        return model

    def amend(self, **fields) -> "LoanPrepModel":
        """Return a model whose document carries extra fields (e.g. final shapes)."""
        doc = dict(self.params_doc)
        doc.update(fields)
        return LoanPrepModel(doc)

    def params_frame(self, spark: SparkSession) -> DataFrame:
        """Fitted parameters in long form: (kind, name, value) — for the oracle."""
        p = self.params_doc
        rows = [("median", k, v) for k, v in p["imputation"].items()]
        rows += [("cap", k, v) for k, v in p["caps"].items()]
        rows += [("category", f"{c}={v}", float(i)) for c, vals in p["categories"].items()
                 for i, v in enumerate(vals)]
        rows += [("class_count", k, float(v)) for k, v in p["class_counts"].items()]
        rows += [("scale_pos_weight", "train", float(p["scale_pos_weight"])),
                 ("width", "final_model_columns", float(len(p["final_model_columns"])))]
        return spark.createDataFrame(rows, "kind string, name string, value double")
