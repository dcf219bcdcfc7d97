"""Registered queries: name → (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole driver tables.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators import evaluate as ev
from loanlens.operators.prep import NUMERIC_FEATURES
from loanlens.plans import oracle as O
from loanlens.plans.pipeline import (
    CHAMPION_THRESHOLD, fitted_prep, prepared, resolved_loans, scored,
)
from loanlens.operators.clean import DRIVER_SPLITS, temporal_split

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


T = CHAMPION_THRESHOLD
rr = O.rr

# ------------------------------------------------------------------ step 1
_BM_SQL = O.with_ctes(f"""
select split, count(*) as n,
 {rr("sum(case when p < 0.47 then 1 else 0 end)", "count(*)")} as approval_rate,
 {rr("count(*) - sum(case when p < 0.47 then 1 else 0 end)", "count(*)")} as denial_rate,
 {rr("coalesce(sum(case when p < 0.47 then round(p*10000)::hugeint * round(loan_amnt*100)::hugeint end), 0)", "10000", 0)} / 100.0 as expected_loss,
 {rr('sum(case when p < 0.47 and "default" = 1 then 1 else 0 end)', "sum(case when p < 0.47 then 1 else 0 end)")} as default_rate_on_approved,
 {rr("sum(round(p*10000)::hugeint)", "count(*) * 10000")} as mean_probability,
 0.47::double as threshold_used
from scored group by split""", "scored")


@register("approval_by_split", _BM_SQL)
def approval_by_split(spark, sf_dir):
    """Business metrics per split on fixed-scorecard scores of the prepared rows (flagship)."""
    return ev.business_metrics(scored(spark, sf_dir), T, by=["split"])


@register("resolved_target", O.with_ctes(
    'select app_id, loan_status, "default" from resolved', "resolved"))
def resolved_target(spark, sf_dir):
    """B1 + B2: resolved statuses only, 0/1 target."""
    return resolved_loans(spark, sf_dir).select("app_id", "loan_status", "default")


@register("temporal_split", O.with_ctes(
    "select app_id, strftime(issue_d, '%Y-%m-%d') as issue_d, issue_year, split from resolved", "resolved"))
def temporal_split_q(spark, sf_dir):
    """B3 + B6/B7: parsed issue date, year, split label."""
    return resolved_loans(spark, sf_dir).select(
        "app_id", F.date_format("issue_d", "yyyy-MM-dd").alias("issue_d"), "issue_year", "split")


@register("split_rates", O.with_ctes(
    'select split, count(*) as n, cast(sum("default") as bigint) as defaults, '
    f'{rr("sum(\"default\")", "count(*)")} as default_rate from resolved group by split', "resolved"))
def split_rates(spark, sf_dir):
    """Rows and default rate per split."""
    from loanlens.functions.columns import round_ratio
    return (resolved_loans(spark, sf_dir).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("default").cast("bigint").alias("defaults"))
            .select("split", "n", "defaults", round_ratio(F.col("defaults"), F.col("n")).alias("default_rate")))


# ------------------------------------------------------------------ step 2
_PARAM_SQL = O.with_ctes("""
select 'median' as kind, name, value from (unpivot (select * exclude (cap_annual_inc, cap_revol_bal, cap_dti, cap_revol_util) from params)
  on columns(*) into name name value value)
union all select 'cap', name, value from (unpivot (select cap_annual_inc, cap_revol_bal, cap_revol_util, cap_dti from params)
  on columns(*) into name name value value)
union all select 'category', col || '=' || cat, cast(row_number() over (partition by col order by cat) - 1 as double) from cats
union all select 'class_count', 'negative', cast(count(*) as double) from resolved where split='train' and "default" = 0
union all select 'class_count', 'positive', cast(count(*) as double) from resolved where split='train' and "default" = 1
union all select 'scale_pos_weight', 'train', sum(case when "default"=0 then 1 else 0 end) / sum(case when "default"=1 then 1 else 0 end) from resolved where split='train'
union all select 'width', 'final_model_columns', cast(26 + (select count(*) from cats) as double)
""", "params", "cats")
_PARAM_SQL = _PARAM_SQL.replace("select 'median' as kind, name, value", "select 'median' as kind, substr(name, 5) as name, value", 1)
_PARAM_SQL = _PARAM_SQL.replace("select 'cap', name, value", "select 'cap', substr(name, 5), value", 1)


@register("prep_params", _PARAM_SQL)
def prep_params(spark, sf_dir):
    """Fitted medians, caps, category lists, class counts and width (long form)."""
    return fitted_prep(spark, sf_dir).params_frame(spark)


_FIXED_FEATURES = (["fico_range_low", "loan_amnt", "int_rate", "delinq_2yrs", "inq_last_6mths",
                    "open_acc", "pub_rec", "annual_inc_capped", "revol_bal_capped",
                    "revol_util_capped", "dti_capped", "emp_length_num", "sub_grade_encoded", "term_num"]
                   + [f"{c}_was_missing" for c in NUMERIC_FEATURES + ["emp_length_num"]])
_PF_SQL = O.with_ctes(
    " union all ".join(f"select app_id, '{c}' as feature, cast({c} as double) as value from prepared"
                       for c in _FIXED_FEATURES)
    + """ union all select p.app_id, c.col || '_' || c.cat as feature,
  cast(coalesce(case c.col when 'home_ownership' then p.home_ownership = c.cat
    when 'verification_status' then p.verification_status = c.cat else p.purpose = c.cat end, false) as double) as value
  from prepared p, cats c""", "prepared", "cats")


def _long(df: DataFrame, cols: list[str], key: str = "app_id") -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols]
    return df.select(key, F.explode(F.array(*pairs)).alias("kv")).select(key, "kv.feature", "kv.value")


@register("prep_features", _PF_SQL)
def prep_features(spark, sf_dir):
    """Every prepared feature of every resolved row, long form (app_id, feature, value)."""
    model = fitted_prep(spark, sf_dir)
    return _long(prepared(spark, sf_dir, model), model.feature_columns)


@register("prep_checks", O.with_ctes(f"""
select cast({" + ".join(f"count(*) - count({c})" for c in _FIXED_FEATURES)} as bigint) as total_nulls, max(annual_inc_capped) as max_annual_inc_capped,
 max(revol_bal_capped) as max_revol_bal_capped, max(revol_util_capped) as max_revol_util_capped,
 max(dti_capped) as max_dti_capped, cast(26 + (select count(*) from cats) as bigint) as feature_count,
 cast(count(*) as bigint) as n from prepared""", "prepared", "cats"))
def prep_checks(spark, sf_dir):
    """Nulls after transform, maxima after capping, feature count."""
    model = fitted_prep(spark, sf_dir)
    df = prepared(spark, sf_dir, model)
    cols = model.feature_columns
    nulls = sum(F.sum(F.col(f"`{c}`").isNull().cast("bigint")) for c in cols)
    return df.agg(nulls.cast("bigint").alias("total_nulls"),
                  *[F.max(f"{c}_capped").alias(f"max_{c}_capped") for c in ("annual_inc", "revol_bal", "revol_util", "dti")],
                  F.lit(len(cols)).cast("bigint").alias("feature_count"),
                  F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ step 4
def _val(spark, sf_dir):
    return scored(spark, sf_dir).where(F.col("split") == "val")


def _test(spark, sf_dir):
    return scored(spark, sf_dir).where(F.col("split") == "test")


_VAL = "select * from scored where split = 'val'"
_TEST = "select * from scored where split = 'test'"


@register("threshold_sweep", O.with_ctes(O.sweep_sql(_VAL), "scored"))
def threshold_sweep(spark, sf_dir):
    """90-threshold cost sweep on the validation split, one pass."""
    return ev.threshold_sweep(_val(spark, sf_dir))


_FIRST = "(select {f} from sw {w} order by total_cost, idx limit 1)"


def _pick(f: str, feasible: bool = False) -> str:
    return _FIRST.format(f=f, w="where approval_rate >= 0.55" if feasible else "")


_OPT_SQL = O.with_ctes(f"""
select {_pick('threshold')} as unconstrained_threshold, {_pick('total_cost')} as unconstrained_cost,
 {_pick('approval_rate')} as unconstrained_approval_rate,
 coalesce({_pick('threshold', True)}, {_pick('threshold')}) as constrained_threshold,
 coalesce({_pick('total_cost', True)}, {_pick('total_cost')}) as constrained_cost,
 coalesce({_pick('approval_rate', True)}, {_pick('approval_rate')}) as constrained_approval_rate,
 coalesce((select max(total_cost) from sw where abs(threshold - 0.5) < 0.005), 0.0) - {_pick('total_cost')} as cost_savings_vs_naive,
 (select count(*) from sw where approval_rate >= 0.55) > 0 as constraint_feasible""",
    "scored", extra={"sw": O.sweep_sql(_VAL)})


@register("optimal_threshold", _OPT_SQL)
def optimal_threshold(spark, sf_dir):
    """D28 + D29: cost-optimal and ≥55 %-approval thresholds with savings vs 0.50."""
    return ev.optimal_threshold(ev.threshold_sweep(_val(spark, sf_dir)))


@register("constrained_threshold", O.with_ctes(f"""
select coalesce({_pick('threshold', True)}, 0.5) as threshold, {_pick('total_cost', True)} as total_cost,
 {_pick('approval_rate', True)} as approval_rate,
 (select count(*) from sw where approval_rate >= 0.55) > 0 as constraint_feasible""",
    "scored", extra={"sw": O.sweep_sql(_VAL)}))
def constrained_threshold(spark, sf_dir):
    """D29, script form: lowest cost with approval ≥ 0.55, first on ties, 0.50 if infeasible."""
    r = ev.optimal_threshold(ev.threshold_sweep(_val(spark, sf_dir)), min_approval=0.55, infeasible="0.5")
    return r.select(F.col("constrained_threshold").alias("threshold"),
                    F.col("constrained_cost").alias("total_cost"),
                    F.col("constrained_approval_rate").alias("approval_rate"), "constraint_feasible")


@register("threshold_reuse", O.with_ctes(f"""
select a as approval_at_current, a between 0.40 and 0.70 as reuse_current,
 case when a between 0.40 and 0.70 then 0.47 else coalesce({_pick('threshold', True)}, 0.5) end as threshold
from (select {rr("sum(case when p < 0.47 then 1 else 0 end)", "count(*)", 6)} as a from ({_VAL}) v)""",
    "scored", extra={"sw": O.sweep_sql(_VAL)}))
def threshold_reuse(spark, sf_dir):
    """Keep the champion threshold when the approval there is in [0.40, 0.70]."""
    return ev.reuse_or_select_threshold(_val(spark, sf_dir), T)


@register("class_metrics", O.with_ctes("""
select *, case when precision + recall > 0 then 2.0 * precision * recall / (precision + recall) else 0.0 end as f1
from (select t.threshold, cast(sum(case when p >= t.threshold and "default" = 1 then 1 else 0 end) as bigint) as tp,
 cast(sum(case when p >= t.threshold and "default" = 0 then 1 else 0 end) as bigint) as fp,
 cast(sum(case when p < t.threshold and "default" = 0 then 1 else 0 end) as bigint) as tn,
 cast(sum(case when p < t.threshold and "default" = 1 then 1 else 0 end) as bigint) as fn,
 coalesce(sum(case when p >= t.threshold and "default" = 1 then 1 else 0 end) / nullif(sum(case when p >= t.threshold then 1 else 0 end), 0), 0.0) as precision,
 coalesce(sum(case when p >= t.threshold and "default" = 1 then 1 else 0 end) / nullif(sum("default"), 0), 0.0) as recall,
 sum(case when (p >= t.threshold) = ("default" = 1) then 1 else 0 end) / count(*) as accuracy,
 sum(case when p < t.threshold then 1 else 0 end) / count(*) as approval_rate,
 sum(power(round((p - "default") * 10000)::hugeint, 2)) / (count(*) * 1e8) as brier
from te, (values (0.5::double), (0.3::double)) t(threshold) group by t.threshold)""", "scored",
    extra={"te": _TEST}))
def class_metrics(spark, sf_dir):
    """D31 + D32: confusion, precision, recall, F1, accuracy, Brier at 0.5 and 0.3 (test split)."""
    return ev.class_metrics(_test(spark, sf_dir), (0.5, 0.3))


@register("auc", O.with_ctes("""
select split, sum(pos * (neg_below * 2 + neg)) / (sum(pos) * sum(neg) * 2.0) as auc,
 cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives
from (select split, p, pos, neg, coalesce(sum(neg) over (partition by split order by p rows between unbounded preceding and 1 preceding), 0) as neg_below
      from (select split, p, sum("default") as pos, sum(1 - "default") as neg from scored group by split, p))
group by split""", "scored"))
def auc_q(spark, sf_dir):
    """Exact ROC AUC (ties count one half) per split."""
    return ev.auc(scored(spark, sf_dir), by=["split"])


@register("roc_points", O.with_ctes("""
select p as threshold,
 (select count(*) from s where "default" = 0 and s.p >= d.p) / (select count(*) from s where "default" = 0) as fpr,
 (select count(*) from s where "default" = 1 and s.p >= d.p) / (select count(*) from s where "default" = 1) as tpr
from (select distinct p from s) d""".replace("from s", "from (" + _TEST + ") s"), "scored"))
def roc_points(spark, sf_dir):
    """ROC points at every distinct score on the test split."""
    return ev.roc_points(_test(spark, sf_dir))


@register("calibration", O.with_ctes(f"""
select {O.calib_bin()} as bin, count(*) as n, {rr("sum(round(p*10000)::hugeint)", "count(*) * 10000")} as mean_predicted,
 {rr('sum("default")', "count(*)", 6)} as fraction_positive
from ({_TEST}) s group by 1""", "scored"))
def calibration(spark, sf_dir):
    """10-bin reliability table on the test split."""
    return ev.calibration(_test(spark, sf_dir))


@register("class_report", O.with_ctes("""
select '0' as label, p0 as precision, r0 as recall, f0 as f1, cast(s0 as bigint) as support from f
union all select '1', p1, r1, f1, cast(s1 as bigint) from f
union all select 'accuracy', null, null, (tp+tn)/n, cast(n as bigint) from f
union all select 'macro avg', (p0+p1)/2, (r0+r1)/2, (f0+f1)/2, cast(n as bigint) from f
union all select 'weighted avg', (p0*s0+p1*s1)/n, (r0*s0+r1*s1)/n, (f0*s0+f1*s1)/n, cast(n as bigint) from f""",
    "scored", extra={
        "te": _TEST,
        "c": """select sum(case when p >= 0.47 and "default"=1 then 1 else 0 end) as tp, sum(case when p >= 0.47 and "default"=0 then 1 else 0 end) as fp,
   sum(case when p < 0.47 and "default"=0 then 1 else 0 end) as tn, sum(case when p < 0.47 and "default"=1 then 1 else 0 end) as fn from te""",
        "m": """select *, coalesce(tp / nullif(tp+fp, 0), 0.0) as p1, coalesce(tp / nullif(tp+fn, 0), 0.0) as r1, tp+fn as s1,
   coalesce(tn / nullif(tn+fn, 0), 0.0) as p0, coalesce(tn / nullif(tn+fp, 0), 0.0) as r0, tn+fp as s0, tp+fp+tn+fn as n from c""",
        "f": """select *, case when p0+r0 > 0 then 2.0*p0*r0/(p0+r0) else 0.0 end as f0,
   case when p1+r1 > 0 then 2.0*p1*r1/(p1+r1) else 0.0 end as f1 from m"""}))
def class_report(spark, sf_dir):
    """Per-class report with accuracy, macro and weighted averages at 0.47 (test)."""
    return ev.class_report(_test(spark, sf_dir), T)


@register("cost_impact", O.with_ctes(f"""
select 0.47::double as threshold, fn, fp, positives, cast(300*fn + 45*fp as double) as cost_with_model,
 cast(300*positives as double) as cost_approve_all, cast(300*positives - (300*fn + 45*fp) as double) as saving,
 coalesce((300*positives - (300*fn + 45*fp)) * 100.0 / nullif(300*positives, 0), 0.0) as saving_pct
from (select cast(sum(case when p < 0.47 and "default"=1 then 1 else 0 end) as bigint) as fn,
  cast(sum(case when p >= 0.47 and "default"=0 then 1 else 0 end) as bigint) as fp,
  cast(sum("default") as bigint) as positives from ({_TEST}) s)""", "scored"))
def cost_impact(spark, sf_dir):
    """Cost with the model vs approve-all on the test split at 0.47."""
    return ev.cost_impact(_test(spark, sf_dir), T)


@register("score_distribution", O.with_ctes(f"""
select split, min(p) as min_p, max(p) as max_p, {rr("sum(round(p*10000)::hugeint)", "count(p) * 10000")} as mean_p,
 quantile_cont(p, 0.5) as median_p from scored group by split""", "scored"))
def score_distribution(spark, sf_dir):
    """Min, max, mean, median score per split."""
    return ev.score_distribution(scored(spark, sf_dir), by=["split"])


# ------------------------------------------------------------------ step 3: quality
from loanlens.operators import drift as dr  # noqa: E402
from loanlens.operators import quality as qa  # noqa: E402
from loanlens.operators.prep import RAW_FIELDS  # noqa: E402

_RAW_NUM = [c for c in RAW_FIELDS if c in NUMERIC_FEATURES]
_WINDOWS = [label for label, _ in DRIVER_SPLITS.labelled_years() if label != "train"]


def _raw(spark, sf_dir):
    return resolved_loans(spark, sf_dir).select("split", *RAW_FIELDS)


_NULL_SQL = O.with_ctes(" union all ".join(
    f"select split as window, '{c}' as feature, count_if({c} is null) / count(*) as null_rate, "
    f"count_if({c} is null) / count(*) > 0.4 as flagged from resolved group by split" for c in RAW_FIELDS), "resolved")


@register("null_rates", _NULL_SQL)
def null_rates(spark, sf_dir):
    """NULL share per raw field and window (one aggregate for all windows)."""
    return qa.null_rates(qa.profile(_raw(spark, sf_dir), RAW_FIELDS))


_RANGE_SQL = O.with_ctes(" union all ".join(
    f"select c.window, '{c}' as feature, r.rr as ref_range, c.cr as cur_range, "
    f"coalesce(r.rr <> 0 and c.cr > r.rr * 10.0, false) as anomalous from "
    f"(select split as window, max({c}) - min({c}) as cr from resolved where split <> 'train' group by split) c, "
    f"(select max({c}) - min({c}) as rr from resolved where split = 'train') r" for c in _RAW_NUM), "resolved")


@register("range_check", _RANGE_SQL)
def range_check(spark, sf_dir):
    """Scale anomaly (range growth > 10×) of every window vs train."""
    return qa.range_check(qa.profile(_raw(spark, sf_dir), RAW_FIELDS))


_DUP_SQL = O.with_ctes(f"""
select window, cast(sum(c) as bigint) as n, count(*) as n_distinct, 1.0 - count(*) / sum(c) as duplicate_rate,
 1.0 - count(*) / sum(c) > 0.2 as is_excessive
from (select split as window, {", ".join(RAW_FIELDS)}, count(*) as c from resolved group by all) group by window""", "resolved")


@register("duplicate_share", _DUP_SQL)
def duplicate_share(spark, sf_dir):
    """Share of repeated rows over the 17 application fields, per window."""
    return qa.duplicate_share(_raw(spark, sf_dir), RAW_FIELDS)


_GATE_SQL = O.with_ctes("""
select d.window, case when coalesce(a.k, 0) > 0 then 'pipeline_bug' else 'clean' end as failure_type,
 case when coalesce(s.k, 0) > 0 then 'critical' when coalesce(nn.k, 0) > 0 or d.is_excessive then 'warning' else 'none' end as severity,
 coalesce(a.feats, '') as affected_features, 0 as n_missing, coalesce(s.k, 0)::integer as n_scale,
 coalesce(nn.k, 0)::integer as n_high_null, '' as extra_columns, d.duplicate_rate, d.is_excessive as duplicates_excessive
from dup d
left join (select window, count(*) as k from rng where anomalous group by window) s using (window)
left join (select window, count(*) as k from nul where flagged group by window) nn using (window)
left join (select window, count(distinct feature) as k, string_agg(distinct feature, ',' order by feature) as feats
           from (select window, feature from rng where anomalous union select window, feature from nul where flagged)
           group by window) a using (window)""", "resolved", extra={
    "rng": " union all ".join(
        f"select c.window, '{c}' as feature, coalesce(r.rr <> 0 and c.cr > r.rr * 10.0, false) as anomalous from "
        f"(select split as window, max({c}) - min({c}) as cr from resolved where split <> 'train' group by split) c, "
        f"(select max({c}) - min({c}) as rr from resolved where split = 'train') r" for c in _RAW_NUM),
    "nul": " union all ".join(
        f"select split as window, '{c}' as feature, count_if({c} is null) / count(*) > 0.4 as flagged "
        f"from resolved group by split" for c in RAW_FIELDS),
    "dup": f"""select window, 1.0 - count(*) / sum(c) as duplicate_rate, 1.0 - count(*) / sum(c) > 0.2 as is_excessive
      from (select split as window, {", ".join(RAW_FIELDS)}, count(*) as c from resolved group by all) group by window"""})


@register("quality_gate", _GATE_SQL)
def quality_gate(spark, sf_dir):
    """Schema → scale → nulls → duplicates verdict for every window in one job."""
    return qa.quality_gate(_raw(spark, sf_dir), RAW_FIELDS)


def _rules_sql() -> str:
    parts = []
    for name, col, pred, sev in qa.FIELD_RULES:
        parts.append(f"select app_id, '{name}' as rule, '{sev}' as severity from apps "
                     f"where not coalesce({pred}, true)")
    return O.with_ctes(" union all ".join(parts), "apps")


@register("rule_violations", _rules_sql())
def rule_violations(spark, sf_dir):
    """B14 + B15: field and business rules on every application → violation rows."""
    from loanlens.sources.tables import staged_loan_applications
    return qa.rule_violations(staged_loan_applications(spark, sf_dir))


@register("raw_validation", O.with_ctes("""
select * from (
 select 'required_columns' as "check", 'ok' as level, 'all present' as message
 union all select 'issue_date_nulls', case when count_if(issue_d is null) / count(*) > 0.05 then 'warning' else 'ok' end,
   'null share ' || cast(""" + rr("count_if(issue_d is null)", "count(*)", 3) + """ as varchar) from r
 union all select 'row_count', case when count(*) < 1000 then 'warning' else 'ok' end, cast(count(*) as varchar) || ' rows' from r
 union all select 'target_values', case when count_if("default" not in (0, 1)) > 0 then 'error' else 'ok' end,
   cast(count_if("default" not in (0, 1)) as varchar) || ' rows outside {0,1}' from r)""",
    "resolved", extra={"r": 'select "default", issue_d from resolved'}))
def raw_validation(spark, sf_dir):
    """Required columns, target domain, date NULL share, row count."""
    from loanlens.operators.prep import RAW_FIELDS as req
    return qa.raw_validation(resolved_loans(spark, sf_dir), req)


# ------------------------------------------------------------------ step 5: drift / monitoring
def _prep_long_sql() -> str:
    return " union all ".join(
        f"select split, '{c}' as feature, cast({c} as double) as value from prepared" for c in _FIXED_FEATURES
    ) + """ union all select p.split, c.col || '_' || c.cat as feature,
  cast(coalesce(case c.col when 'home_ownership' then p.home_ownership = c.cat
    when 'verification_status' then p.verification_status = c.cat else p.purpose = c.cat end, false) as double) as value
  from prepared p, cats c"""


_DRIFT_EXTRA = {
    "pl": _prep_long_sql(),
    "counts": "select split as window, feature, value, count(*) as n from pl where value is not null group by all",
    "ref": "select feature, value, n as n_ref from counts where window = 'train'",
    "wins": "select distinct window from counts where window <> 'train'",
    "merged": """select window, feature, value, sum(n_ref) as n_ref, sum(n_cur) as n_cur from (
        select w.window, r.feature, r.value, r.n_ref, 0 as n_cur from ref r, wins w
        union all select window, feature, value, 0, n from counts where window <> 'train') group by all""",
    "rstats": """select r.feature, sum(value * n_ref) / sum(n_ref) as mean_ref, sum(n_ref) as tot_ref, count(*) as k_ref,
        any_value(e.edges) as edges from ref r join (select feature, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as edges
        from pl where split = 'train' and value is not null group by feature) e using (feature) group by r.feature""",
    "rstd": """select r.feature, sqrt(sum(n_ref * (value - s.mean_ref) ^ 2) / max(s.tot_ref)) as std_ref
        from ref r join rstats s using (feature) group by r.feature""",
    "tot": """select c.window, c.feature, sum(c.n) as tot_cur, any_value(s.tot_ref) as tot_ref, any_value(s.k_ref) as k_ref,
        any_value(s.edges) as edges, any_value(d.std_ref) as std_ref
        from counts c join rstats s using (feature) join rstd d using (feature) where c.window <> 'train' group by c.window, c.feature""",
    "pre": """select m.*, t.tot_ref, t.tot_cur,
        sum(n_ref) over w / t.tot_ref as Fr, sum(n_cur) over w / t.tot_cur as Gc,
        lead(value) over (partition by m.window, m.feature order by value) as nxt
        from merged m join tot t using (window, feature)
        window w as (partition by m.window, m.feature order by value rows between unbounded preceding and current row)""",
    "per": """select window, feature, max(abs(Fr - Gc)) as ks,
        sum(case when nxt is not null then abs(Fr - Gc) * (nxt - value) else 0.0 end) as w1,
        sum(case when n_ref > 0 then n_ref / tot_ref * log2((n_ref / tot_ref) / ((n_ref / tot_ref + n_cur / tot_cur) / 2)) else 0.0 end
          + case when n_cur > 0 then n_cur / tot_cur * log2((n_cur / tot_cur) / ((n_ref / tot_ref + n_cur / tot_cur) / 2)) else 0.0 end) as js2,
        sum(case when n_ref > 0 then (n_cur - n_ref / tot_ref * tot_cur) ^ 2 / (n_ref / tot_ref * tot_cur) else 0.0 end) as chi2
        from pre group by window, feature""",
    "psi": """select window, feature, sum((pc - pr) * ln(pc / pr)) as psi from (
        select m.window, m.feature, greatest(sum(m.n_ref) / any_value(t.tot_ref), 1e-6) as pr,
          greatest(sum(m.n_cur) / any_value(t.tot_cur), 1e-6) as pc
        from merged m join tot t using (window, feature)
        group by m.window, m.feature, len(list_filter(t.edges, lambda e: e < m.value))) group by window, feature""",
    "df": f"""select window, feature, method, round(stat, 6) as statistic,
        coalesce(stat >= 0.1, false) as drift_detected,
        round(psi, 6) as psi, psi >= 0.25 as psi_flag, cast(tot_ref as bigint) as n_reference, cast(tot_cur as bigint) as n_current
        from (select *, case when method = 'wasserstein' then (case when std_ref > 0 then w1 / std_ref end) else sqrt(js2 / 2) end as stat
              from (select p.*, t.tot_ref, t.tot_cur, t.k_ref, t.std_ref, s.psi,
                 case when t.k_ref > 5 then 'wasserstein' else 'jensenshannon' end as method
               from per p join tot t using (window, feature) join psi s using (window, feature)))""",
}


def _drift_sql(body: str, extra: dict | None = None) -> str:
    return O.with_ctes(body, "prepared", "cats", extra={**_DRIFT_EXTRA, **(extra or {})})


def _drift(spark, sf_dir, model=None):
    model = model or fitted_prep(spark, sf_dir)
    return dr.drift_features(prepared(spark, sf_dir, model), model.feature_columns, _WINDOWS, binary=_binary(model))


def _binary(model):
    """The prepared columns that are 0 or 1: indicators and was-missing flags."""
    return [f"{c}_{v}" for c, vals in model.params_doc["categories"].items() for v in vals] + [
        c for c in model.feature_columns if c.endswith("_was_missing")]


@register("drift_features", _drift_sql("select * from df"))
def drift_features(spark, sf_dir):
    """Per-feature drift of every window vs train on the prepared features."""
    return _drift(spark, sf_dir)


_VERDICT_SQL_BODY = """select window, count_if(drift_detected) > 0 as drift_detected,
 case when count_if(drift_detected) = 0 then 'clean' when count_if(drift_detected) < 2 then 'investigate' else 'real_drift' end as failure_type,
 coalesce(string_agg(case when drift_detected then feature end, ',' order by feature), '') as drifted_features,
 count_if(drift_detected) as n_drifted, count(*) as n_features,
 """ + rr("count_if(drift_detected)", "count(*)") + """ as drift_score,
 case when count_if(drift_detected) = 0 then 'none' when count_if(drift_detected) < 2 then 'review_feature'
      else 'retrain_candidate' end as recommended_action
from df group by window"""


@register("drift_verdict", _drift_sql(_VERDICT_SQL_BODY))
def drift_verdict(spark, sf_dir):
    """Drifted features, share and clean / investigate / real_drift per window."""
    return dr.drift_verdict(_drift(spark, sf_dir))


def _approval(spark, sf_dir, model=None):
    from loanlens.functions.columns import round_ratio
    s = scored(spark, sf_dir, model=model)
    a = s.groupBy(F.col("split").alias("window")).agg(
        round_ratio(F.count_if(F.col("p") < T), F.count(F.lit(1)), 4).alias("approval_rate"))
    base = a.where(F.col("window") == "train").select("approval_rate").scalar()
    return a.where(F.col("window") != "train").withColumn("baseline_approval_rate", base)


_RETRAIN_BODY = """
select v.window, v.drift_detected, v.failure_type, v.drifted_features, v.drift_score, a.approval_rate,
 b.approval_rate as baseline_approval_rate,
 (v.failure_type = 'real_drift' and v.drift_score > 0.25 and v.n_drifted >= 2) or abs(a.approval_rate - b.approval_rate) > 0.1 as should_retrain,
 case when (v.failure_type = 'real_drift' and v.drift_score > 0.25 and v.n_drifted >= 2) or abs(a.approval_rate - b.approval_rate) > 0.1
   then 'retrain' else 'none' end as action
from dv v join appr a using (window), (select approval_rate from appr_all where window = 'train') b"""
_APPR_EXTRA = {
    "dv": _VERDICT_SQL_BODY,
    "appr_all": "select split as window, " + rr("count_if(p < 0.47)", "count(*)") + " as approval_rate from scored group by split",
    "appr": "select * from appr_all where window <> 'train'",
}


@register("retrain_decision", O.with_ctes(_RETRAIN_BODY, "prepared", "cats", "scored",
                                          extra={**_DRIFT_EXTRA, **_APPR_EXTRA}))
def retrain_decision(spark, sf_dir):
    """Retrain on real drift, approval shift vs the measured train approval."""
    model = fitted_prep(spark, sf_dir)
    return dr.retrain_decision(dr.drift_verdict(_drift(spark, sf_dir, model)), _approval(spark, sf_dir, model))


_BUG_EXTRA = {
    "rngs": """select split as window, feature, max(v) - min(v) as r from (
      select split, feature, case when feature = 'loan_amnt' and split = 'test' then value * 1000 else value end as v from pl) group by all""",
    "bugs": """select distinct c.window from rngs c join rngs t on t.window = 'train' and t.feature = c.feature
      where c.window <> 'train' and t.r <> 0 and c.r > t.r * 10""",
}
_MONITOR_BODY = """
select a.window, case when g.window is not null then false else v.drift_detected end as drift_detected,
 case when g.window is not null then 'pipeline_bug' else v.failure_type end as failure_type,
 case when g.window is not null then '' else v.drifted_features end as drifted_features,
 case when g.window is not null then 0.0 else v.drift_score end as drift_score, a.approval_rate, b.approval_rate as baseline_approval_rate,
 g.window is not null or (v.failure_type = 'real_drift' and v.drift_score > 0.25 and v.n_drifted >= 2) or abs(a.approval_rate - b.approval_rate) > 0.1 as should_retrain,
 case when g.window is not null then 'fix_data'
   when (v.failure_type = 'real_drift' and v.drift_score > 0.25 and v.n_drifted >= 2) or abs(a.approval_rate - b.approval_rate) > 0.1 then 'retrain' else 'none' end as action
from appr a left join dv v using (window) left join bugs g using (window), (select approval_rate from appr_all where window = 'train') b"""
_MONITOR_EXTRA = {**_DRIFT_EXTRA, **_APPR_EXTRA, **_BUG_EXTRA}


def _faulty(spark, sf_dir, model):
    """Prepared features of which one window's amounts came in the wrong unit."""
    prep = prepared(spark, sf_dir, model).select("split", *[F.col(f"`{c}`") for c in model.feature_columns])
    return prep.withColumn("loan_amnt", F.col("loan_amnt") * F.when(F.col("split") == "test", 1000.0).otherwise(1.0))


@register("multi_window_monitor", O.with_ctes(_MONITOR_BODY, "prepared", "cats", "scored", extra=_MONITOR_EXTRA))
def multi_window_monitor(spark, sf_dir):
    """J5 + J6 + J7: quality gate on the prepared features of all windows, of
    which one is broken and skips the drift job; drift, approval against the
    baseline and retrain verdict of the others."""
    model = fitted_prep(spark, sf_dir)
    return dr.monitor(_faulty(spark, sf_dir, model), model.feature_columns, _WINDOWS, _approval(spark, sf_dir, model), binary=_binary(model))


# ------------------------------------------------------------------ step 6: experiments
from loanlens.functions.columns import md5_bucket  # noqa: E402
from loanlens.operators import experiment as xp  # noqa: E402
from loanlens.plans.pipeline import CHALLENGER_THRESHOLD, scored_both  # noqa: E402

TC = CHALLENGER_THRESHOLD
ROUTER_PCT = 0.10
OFFLINE_SHARE = 0.30


def _bucket_sql(x: str) -> str:
    acc = "0"
    for i in range(4):
        acc = f"(({acc}) * 96 + ('0x' || substr(md5({x}), {8 * i + 1}, 8))::bigint) % 100"
    return f"cast({acc} as integer)"


_CF_SQL = f"""select cast(app_id as varchar) as request_id,
 case when {_bucket_sql('cast(app_id as varchar)')} < {ROUTER_PCT * 100!r} then 'challenger' else 'champion' end as assigned_model,
 champion_p as champion_probability, case when champion_p >= 0.47 then 'DENY' else 'APPROVE' end as champion_decision,
 challenger_p as challenger_probability, case when challenger_p >= 0.45 then 'DENY' else 'APPROVE' end as challenger_decision
from scored_both"""
_CF_FULL = f"""select *, case when assigned_model = 'challenger' and challenger_decision is not null
   then challenger_decision else champion_decision end as returned_decision from ({_CF_SQL})"""


def _log(spark, sf_dir):
    return xp.counterfactual(scored_both(spark, sf_dir), "app_id", "champion_p", "challenger_p", T, TC, ROUTER_PCT)


@register("ab_assign", O.with_ctes(f"""
select cast(app_id as varchar) as request_id, {_bucket_sql('cast(app_id as varchar)')} as bucket,
 case when {_bucket_sql('cast(app_id as varchar)')} < 10.0 then 'challenger' else 'champion' end as assigned_model
from resolved""", "resolved"))
def ab_assign(spark, sf_dir):
    """K1 + H11: md5-bucket assignment of every request id (10 % challenger)."""
    ids = resolved_loans(spark, sf_dir).select(F.col("app_id").cast("string").alias("request_id"))
    return ids.select("request_id", md5_bucket(F.col("request_id")).alias("bucket"),
                      xp.assign(F.col("request_id"), ROUTER_PCT).alias("assigned_model"))


@register("ab_counterfactual", O.with_ctes(_CF_FULL, "scored_both"))
def ab_counterfactual(spark, sf_dir):
    """K2 + C3: both models score every request; log both decisions and the returned one."""
    return _log(spark, sf_dir)


@register("ab_summary", O.with_ctes(f"""
select count(*) as total_requests, count_if(assigned_model = 'champion') as champion_requests,
 count_if(assigned_model <> 'champion') as challenger_requests,
 {rr("count_if(champion_decision = 'APPROVE')", "count(champion_decision)")} as champion_approval_rate,
 {rr("count_if(challenger_decision = 'APPROVE')", "count(challenger_decision)")} as challenger_approval_rate,
 coalesce({rr("sum(round(champion_probability*10000)::hugeint)", "count(champion_probability) * 10000")}, 0.0) as champion_avg_probability,
 coalesce({rr("sum(round(challenger_probability*10000)::hugeint)", "count(challenger_probability) * 10000")}, 0.0) as challenger_avg_probability,
 {rr("count_if(champion_decision is not null and challenger_decision is not null and champion_decision = challenger_decision)",
     "count_if(champion_decision is not null and challenger_decision is not null)")} as agreement_rate
from cf""", "scored_both", extra={"cf": _CF_FULL}))
def ab_summary(spark, sf_dir):
    """Router summary of the counterfactual log."""
    return xp.summary(_log(spark, sf_dir))


@register("ab_analyze", O.with_ctes("""
select n >= 1000 as sufficient_data, case when n >= 1000 then n else 0 end as total_requests,
 case when n >= 1000 then n0 else 0 end as champion_requests, case when n >= 1000 then n1 else 0 end as challenger_requests,
 case when n >= 1000 then round(r0, 4) else 0.0 end as champion_approval_rate,
 case when n >= 1000 then round(r1, 4) else 0.0 end as challenger_approval_rate,
 case when n >= 1000 then round(r1 - r0, 4) else 0.0 end as approval_rate_diff,
 case when n >= 1000 then round(v1 - v0, 4) else 0.0 end as probability_diff,
 case when n < 1000 then 'insufficient_data' when r1 - r0 > 0.02 and v1 - v0 <= 0.02 then 'promote' else 'keep_champion' end as recommendation
from (select n, n0, n1, case when n0 > 0 then a0 / n0 else 0.0 end as r0, case when n1 > 0 then a1 / n1 else 0.0 end as r1,
   case when c0 > 0 then s0 / (c0 * 10000.0) else 0.0 end as v0, case when c1 > 0 then s1 / (c1 * 10000.0) else 0.0 end as v1
 from (select count(*) as n, count_if(assigned_model = 'champion') as n0, count_if(assigned_model = 'challenger') as n1,
   count_if(assigned_model = 'champion' and champion_decision = 'APPROVE') as a0,
   count_if(assigned_model = 'challenger' and challenger_decision = 'APPROVE') as a1,
   sum(round(champion_probability * 10000)::bigint) as s0, count(champion_probability) as c0,
   sum(round(challenger_probability * 10000)::bigint) as s1, count(challenger_probability) as c1 from cf))""",
    "scored_both", extra={"cf": _CF_FULL}))
def ab_analyze(spark, sf_dir):
    """D41 + K6: approval by assigned arm, online promotion rule (≥ 1000 requests)."""
    return xp.analyze(_log(spark, sf_dir))


_ARMS_SQL = f"""select app_id as request_id,
 case when {_bucket_sql('cast(app_id as varchar)')} < {OFFLINE_SHARE * 100!r} then 'challenger' else 'champion' end as assignment,
 champion_p, challenger_p, "default" as actual_default from scored_both where split = 'test'"""
_ARMS_FULL = """select request_id, assignment, p as prediction_proba,
 case when p >= t then 'deny' else 'approve' end as decision, actual_default from (
 select *, case when assignment = 'champion' then champion_p else challenger_p end as p,
   case when assignment = 'champion' then 0.47 else 0.45 end as t from arms0)"""
_STATS_SQL = """select b.assignment, b.n, b.approved, b.approved / b.n as approval_rate,
 round(b.s / (b.n * 10000.0), 4) as avg_default_probability, round(a.auc, 4) as auc
from (select assignment, count(*) as n, count_if(decision = 'approve') as approved,
   sum(round(prediction_proba * 10000)::bigint) as s from arms group by assignment) b
left join (select assignment, sum(pos * (neg_below * 2 + neg)) / (sum(pos) * sum(neg) * 2.0) as auc from (
   select assignment, prediction_proba, pos, neg, coalesce(sum(neg) over (partition by assignment order by prediction_proba
     rows between unbounded preceding and 1 preceding), 0) as neg_below from (
     select assignment, prediction_proba, sum(actual_default) as pos, sum(1 - actual_default) as neg
     from arms group by assignment, prediction_proba)) group by assignment) a using (assignment)"""
_AB_EXTRA = {"arms0": _ARMS_SQL, "arms": _ARMS_FULL, "st": _STATS_SQL,
             "pv": """select max(case when assignment='champion' then n end) as n_0, max(case when assignment='champion' then approved end) as approved_0,
   max(case when assignment='champion' then auc end) as auc_0, max(case when assignment='challenger' then n end) as n_1,
   max(case when assignment='challenger' then approved end) as approved_1, max(case when assignment='challenger' then auc end) as auc_1 from st"""}


def _arms(spark, sf_dir):
    test = scored_both(spark, sf_dir).where(F.col("split") == "test")
    return xp.offline_arms(test, "app_id", "champion_p", "challenger_p", "default", T, TC, OFFLINE_SHARE)


@register("ab_arms", O.with_ctes("select * from st", "scored_both", extra=_AB_EXTRA))
def ab_arms(spark, sf_dir):
    """K3 + K4: 70/30 hash split of the test population; per-arm approval, mean p, AUC."""
    return xp.arm_stats(_arms(spark, sf_dir))


_Z_BODY = """select n_0 as n_champion, n_1 as n_challenger, round(p0, 4) as approval_champion, round(p1, 4) as approval_challenger,
 round(z, 4) as z_statistic, abs(z) > 1.959963984540054 as significant_at_05,
 round(1.959963984540054 * sqrt(p0 * (1.0 - p0) / n_0), 6) as ci95_champion,
 round(1.959963984540054 * sqrt(p1 * (1.0 - p1) / n_1), 6) as ci95_challenger
from (select *, case when se > 0 then (p0 - p1) / se else 0.0 end as z from (
  select *, sqrt(pool * (1.0 - pool) * (1.0 / n_0 + 1.0 / n_1)) as se from (
   select *, approved_0 / n_0 as p0, approved_1 / n_1 as p1, (approved_0 + approved_1) / (n_0 + n_1) as pool from pv)))"""


@register("ab_ztest", O.with_ctes(_Z_BODY.replace("(approved_0 + approved_1) / (n_0 + n_1)",
                                                  "(cast(approved_0 as double) + approved_1) / (cast(n_0 as double) + n_1)"),
                                  "scored_both", extra=_AB_EXTRA))
def ab_ztest(spark, sf_dir):
    """D42 + D44: pooled two-proportion z-test on approval and 95 % half-widths."""
    return xp.ztest(xp.arm_stats(_arms(spark, sf_dir)))


def _chi_sql() -> str:
    cells = [("approved_0", "n_0", "(approved_0 + approved_1)"), ("(n_0 - approved_0)", "n_0", "((n_0 - approved_0) + (n_1 - approved_1))"),
             ("approved_1", "n_1", "(approved_0 + approved_1)"), ("(n_1 - approved_1)", "n_1", "((n_0 - approved_0) + (n_1 - approved_1))")]
    terms = []
    for o, r_, c_ in cells:
        e = f"(cast({r_} as double) * cast({c_} as double) / cast(n_0 + n_1 as double))"
        dev = f"greatest(abs(cast({o} as double) - {e}) - 0.5, 0.0)"
        terms.append(f"{dev} * {dev} / {e}")
    chi = " + ".join(terms)
    return f"select round({chi}, 4) as chi2_statistic, 1 as degrees_of_freedom, ({chi}) > 3.841458820694124 as significant_at_05 from pv"


@register("ab_chi2", O.with_ctes(_chi_sql(), "scored_both", extra=_AB_EXTRA))
def ab_chi2(spark, sf_dir):
    """2×2 chi-square (Yates) of arm × approved."""
    return xp.chi_square_2x2(xp.arm_stats(_arms(spark, sf_dir)))


@register("ab_decision", O.with_ctes("""
select auc_0 as auc_champion, auc_1 as auc_challenger,
 case when auc_1 >= auc_0 and approved_1 / n_1 >= approved_0 / n_0 then 'promote_challenger' else 'keep_champion' end as recommendation,
 case when auc_1 >= auc_0 and approved_1 / n_1 >= approved_0 / n_0 then 'challenger_matches_or_beats'
      when auc_1 >= auc_0 and (select significant_at_05 from z) then 'approval_differs_significantly'
      else 'champion_outperforms' end as reason from pv""", "scored_both",
    extra={**_AB_EXTRA, "z": _Z_BODY.replace("(approved_0 + approved_1) / (n_0 + n_1)",
                                             "(cast(approved_0 as double) + approved_1) / (cast(n_0 as double) + n_1)")}))
def ab_decision(spark, sf_dir):
    """K5: offline promotion rule from per-arm AUC, approval and significance."""
    return xp.offline_decision(xp.arm_stats(_arms(spark, sf_dir)))


@register("ab_significance")
def ab_significance(spark, sf_dir):
    """D42 + D43 with p-values (normal and χ²₁ tails on the result rows)."""
    st = xp.arm_stats(_arms(spark, sf_dir))
    z = xp.ztest(st, with_p=True).select("z_statistic", F.col("p_value").alias("z_p_value"))
    c = xp.chi_square_2x2(st, with_p=True).select("chi2_statistic", F.col("p_value").alias("chi2_p_value"))
    return z.select("*", c.select("chi2_statistic").scalar().alias("chi2_statistic"),
                    c.select("chi2_p_value").scalar().alias("chi2_p_value"))


# ------------------------------------------------------------------ step 7: exploration / selection
from loanlens.functions.columns import emp_length_num as _emp, literal_map  # noqa: E402
from loanlens.operators import explore as xe  # noqa: E402

_GRADE = {g: i for i, g in enumerate("ABCDEFG")}
_ANOVA_COLS = ["loan_amnt", "int_rate", "annual_inc", "dti", "delinq_2yrs", "fico_range_low", "inq_last_6mths",
               "open_acc", "pub_rec", "revol_bal", "revol_util", "emp_length_num", "grade_num"]
_CAT_COLS = ["home_ownership", "verification_status", "purpose", "term", "sub_grade"]
_PROFILE_COLS = ["loan_amnt", "int_rate", "annual_inc", "dti", "fico_range_low", "revol_util", "revol_bal",
                 "open_acc", "delinq_2yrs", "inq_last_6mths"]


def _fs(spark, sf_dir):
    """Train split with the notebook's diagnostic encodings."""
    r = resolved_loans(spark, sf_dir).where(F.col("split") == "train")
    return r.select("*", _emp(F.col("emp_length")).alias("emp_length_num"),
                    F.try_element_at(literal_map(_GRADE), F.substring("sub_grade", 1, 1)).cast("double").alias("grade_num"))


_FS_SQL = ("select *, " + O._emp_case() + " as emp_length_num, cast(instr('ABCDEFG', substr(sub_grade, 1, 1)) - 1 as double) as grade_num "
           "from resolved where split = 'train'")
_FS_EXTRA = {"fs": _FS_SQL.replace("instr('ABCDEFG', substr(sub_grade, 1, 1)) - 1",
                                   "case when instr('ABCDEFG', substr(sub_grade, 1, 1)) > 0 then instr('ABCDEFG', substr(sub_grade, 1, 1)) - 1 end")}


@register("default_rate_by_year", O.with_ctes(
    f'select issue_year, count(*) as n, cast(sum("default") as bigint) as defaults, {rr("sum(\"default\")", "count(*)", 6)} as default_rate '
    "from resolved group by issue_year", "resolved"))
def default_rate_by_year(spark, sf_dir):
    """Count, defaults and default rate per issue year."""
    return xe.target_rate_by(resolved_loans(spark, sf_dir), "issue_year")


@register("category_rates", O.with_ctes(
    f'select substr(sub_grade, 1, 1) as grade, count(*) as n, cast(sum("default") as bigint) as defaults, '
    f'{rr("sum(\"default\")", "count(*)", 6)} as default_rate from resolved group by 1', "resolved"))
def category_rates(spark, sf_dir):
    """Default rate per grade (sub-grade letter)."""
    return xe.target_rate_by(resolved_loans(spark, sf_dir), F.substring("sub_grade", 1, 1).alias("grade"))


@register("status_shares", O.with_ctes(
    f"select loan_status, count(*) as n, {rr('count(*) * 100', '(select count(*) from apps)', 1)} as pct from apps group by 1", "apps"))
def status_shares(spark, sf_dir):
    """D3: loan-status value counts with percent share over all applications."""
    from loanlens.sources.tables import staged_loan_applications
    return xe.value_shares(staged_loan_applications(spark, sf_dir), "loan_status")


@register("top_purposes", O.with_ctes(
    "select purpose, count(*) as n from resolved group by purpose order by n desc, purpose asc nulls last limit 10", "resolved"))
def top_purposes(spark, sf_dir):
    """the ten most frequent purposes (count desc, purpose asc)."""
    return xe.top_k(resolved_loans(spark, sf_dir), "purpose", 10)


@register("distinct_years", O.with_ctes("select distinct issue_year from resolved", "resolved"))
def distinct_years(spark, sf_dir):
    """sorted distinct issue years."""
    return resolved_loans(spark, sf_dir).select("issue_year").distinct().orderBy("issue_year")


_MISS_SQL = O.with_ctes(" union all ".join(
    f"select '{c}' as feature, count_if({c} is null) as missing, {rr(f'count_if({c} is null) * 100', 'count(*)', 1)} as pct from apps"
    for c in RAW_FIELDS), "apps")
_MISS_SQL = _MISS_SQL[: _MISS_SQL.index("\nselect '")] + "\nselect feature, missing, pct, case when pct > 40 then 'drop' when pct > 5 then 'impute' when pct > 0 then 'optional' else 'complete' end as action from (" + _MISS_SQL[_MISS_SQL.index("\nselect '") + 1:] + ")"


@register("missing_report", _MISS_SQL)
def missing_report(spark, sf_dir):
    """Missing count, percent and action tier of the 17 raw fields."""
    from loanlens.sources.tables import staged_loan_applications
    return xe.missing_report(staged_loan_applications(spark, sf_dir), RAW_FIELDS)


@register("class_profile", O.with_ctes(" union all ".join(
    f"select '{c}' as feature, round(avg(case when \"default\" = 0 then {c} end), 6) as mean_0, "
    f"round(avg(case when \"default\" = 1 then {c} end), 6) as mean_1, "
    f"round((avg(case when \"default\" = 1 then {c} end) - avg(case when \"default\" = 0 then {c} end)) / abs(avg(case when \"default\" = 0 then {c} end)) * 100, 4) as pct_diff from resolved"
    for c in _PROFILE_COLS), "resolved"))
def class_profile(spark, sf_dir):
    """Mean of ten fields by class with percent difference vs class 0."""
    return xe.class_profile(resolved_loans(spark, sf_dir), _PROFILE_COLS)


@register("mean_shift", O.with_ctes(" union all ".join(
    f"select '{c}' as feature, round(avg(case when split = 'train' then {c} end), 6) as base_mean, "
    f"round(avg(case when split <> 'train' then {c} end), 6) as later_mean, "
    f"round((avg(case when split <> 'train' then {c} end) - avg(case when split = 'train' then {c} end)) / abs(avg(case when split = 'train' then {c} end)) * 100, 4) as pct_change, "
    f"coalesce(abs((avg(case when split <> 'train' then {c} end) - avg(case when split = 'train' then {c} end)) / abs(avg(case when split = 'train' then {c} end)) * 100) > 10.0, false) as flagged from resolved"
    for c in _PROFILE_COLS), "resolved"))
def mean_shift(spark, sf_dir):
    """Train-period mean vs later periods, % change, flag above 10 %."""
    return xe.mean_shift(resolved_loans(spark, sf_dir), _PROFILE_COLS, F.col("split") == "train", F.col("split") != "train")


def _corr_sql(x: str, y: str) -> str:
    return (f"(select '{x}' as feature, '{y}' as other, round(r, 6) as correlation, coalesce(abs(r) > {{t}}, false) as flagged from "
            f"(select case when vx > 0 and vy > 0 then cov / sqrt(vx * vy) end as r from "
            f"(select sxy - sx * sy / n as cov, sxx - sx * sx / n as vx, syy - sy * sy / n as vy from "
            f"(select count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(y * y) as syy, sum(x * y) as sxy from "
            f"(select cast(\"{x}\" as double) as x, cast(\"{y}\" as double) as y from {{src}} where \"{x}\" is not null and \"{y}\" is not null)))))")


_LEAK_NUMS = [c for c in NUMERIC_FEATURES] + ["app_id", "issue_year"]


@register("leakage_corr", O.with_ctes(" union all ".join(
    _corr_sql(c, "default").replace("{t}", "0.3").replace("{src}", "resolved") for c in sorted(_LEAK_NUMS)), "resolved"))
def leakage_corr(spark, sf_dir):
    """D16 + D18: |Pearson r| of every numeric column with the target, flag > 0.3."""
    df = resolved_loans(spark, sf_dir)
    return xe.correlations(df, [(c, "default") for c in sorted(_LEAK_NUMS)], 0.3)


_LEAKY = ["total_pymnt", "total_rec_int", "recoveries", "hardship_amount"]
_LEAK_SRC = """select "default", """ + ", ".join(NUMERIC_FEATURES) + """, loan_amnt * (1 - "default") + dti as late_fees from resolved where split = 'train'"""


@register("leakage_report", O.with_ctes(" union all ".join(
    [f"select '{c}' as name, 'pattern:{p}' as reason, cast(null as double) as correlation" for c, p in
     (("total_pymnt", "total_pymnt"), ("total_rec_int", "total_rec_"), ("recoveries", "recoveries"), ("hardship_amount", "hardship_"))]
    + [f"select '{c}' as name, case when abs(corr({c}, \"default\")) > 0.3 then 'correlation' else 'safe' end as reason, "
       f"round(corr({c}, \"default\"), 4) as correlation from leak" for c in [*NUMERIC_FEATURES, "late_fees"]]),
    "resolved", extra={"leak": _LEAK_SRC}))
def leakage_report(spark, sf_dir):
    """D15 + D17: name-pattern and correlation flags, safe columns, on a train split
    with four columns of forbidden names and one that follows the target."""
    df = resolved_loans(spark, sf_dir).where(F.col("split") == "train")
    late = (F.col("loan_amnt") * (1 - F.col("default")) + F.col("dti")).alias("late_fees")
    return xe.leakage_report(df.select("default", *NUMERIC_FEATURES, late, *[F.lit(0.0).alias(c) for c in _LEAKY]))


_PAIRS = [("fico_range_low", "int_rate"), ("loan_amnt", "revol_bal"), ("open_acc", "delinq_2yrs"), ("dti", "revol_util")]


@register("pair_corr", O.with_ctes(" union all ".join(
    _corr_sql(x, y).replace("{t}", "0.9").replace("{src}", "resolved") for x, y in _PAIRS), "resolved"))
def pair_corr(spark, sf_dir):
    """Pairwise correlation of suspect pairs (pairwise NULL drop), flag > 0.9."""
    return xe.correlations(resolved_loans(spark, sf_dir), _PAIRS, 0.9)


def _anova_sql() -> str:
    nn = " and ".join(f"{c} is not null" for c in _ANOVA_COLS)
    parts = []
    for c in _ANOVA_COLS:
        s0, s1 = f"sum(case when \"default\" = 0 then cast({c} as double) end)", f"sum(case when \"default\" = 1 then cast({c} as double) end)"
        q0 = f"sum(case when \"default\" = 0 then cast({c} as double) * cast({c} as double) end)"
        q1 = f"sum(case when \"default\" = 1 then cast({c} as double) * cast({c} as double) end)"
        parts.append(f"select '{c}' as feature, round(case when ssw > 0 then (ssb / 1.0) / (ssw / (n0 + n1 - 2)) end, 6) as anova_f from ("
                     f"select n0, n1, n0 * (s0 / n0 - (s0 + s1) / (n0 + n1)) * (s0 / n0 - (s0 + s1) / (n0 + n1)) + "
                     f"n1 * (s1 / n1 - (s0 + s1) / (n0 + n1)) * (s1 / n1 - (s0 + s1) / (n0 + n1)) as ssb, "
                     f"(q0 - s0 * s0 / n0) + (q1 - s1 * s1 / n1) as ssw from ("
                     f"select count_if(\"default\" = 0) as n0, count_if(\"default\" = 1) as n1, {s0} as s0, {s1} as s1, {q0} as q0, {q1} as q1 "
                     f"from fs where {nn}))")
    return O.with_ctes(" union all ".join(parts), "resolved", extra=_FS_EXTRA)


@register("anova_f", _anova_sql())
def anova_f(spark, sf_dir):
    """One-way ANOVA F of 13 numeric features on the train split (list-wise NULL drop)."""
    return xe.anova_f(_fs(spark, sf_dir), _ANOVA_COLS)


def _codes_sql() -> dict[str, str]:
    ex = dict(_FS_EXTRA)
    sel = ["fs.*"]
    joins = []
    for c in _CAT_COLS:
        ex[f"code_{c}"] = f"select v, row_number() over (order by v) - 1 as code from (select distinct coalesce(cast({c} as varchar), 'nan') as v from fs)"
        sel.append(f"k_{c}.code as {c}_enc")
        joins.append(f"join code_{c} k_{c} on k_{c}.v = coalesce(cast(fs.{c} as varchar), 'nan')")
    ex["enc"] = f"select {', '.join(sel)} from fs " + " ".join(joins)
    return ex


_CODES_EXTRA = _codes_sql()


def _chi2_codes_sql() -> str:
    parts = []
    for c in _CAT_COLS:
        e = f"{c}_enc"
        parts.append(f"select '{e}' as feature, round(((o0 - n0 / (n0 + n1) * (o0 + o1)) * (o0 - n0 / (n0 + n1) * (o0 + o1)) / (n0 / (n0 + n1) * (o0 + o1))) + "
                     f"((o1 - n1 / (n0 + n1) * (o0 + o1)) * (o1 - n1 / (n0 + n1) * (o0 + o1)) / (n1 / (n0 + n1) * (o0 + o1))), 6) as chi2 from ("
                     f"select count_if(\"default\" = 0) as n0, count_if(\"default\" = 1) as n1, "
                     f"cast(sum(case when \"default\" = 0 then {e} end) as double) as o0, cast(sum(case when \"default\" = 1 then {e} end) as double) as o1 from enc)")
    return O.with_ctes(" union all ".join(parts), "resolved", extra=_CODES_EXTRA)


def _encoded(spark, sf_dir):
    return xe.encode_labels(_fs(spark, sf_dir), _CAT_COLS)


@register("chi2_codes", _chi2_codes_sql())
def chi2_codes(spark, sf_dir):
    """chi² score of label codes (library flavour) for five categorical fields."""
    return xe.chi2_codes(_encoded(spark, sf_dir), [f"{c}_enc" for c in _CAT_COLS])


@register("chi2_table", O.with_ctes(" union all ".join(
    f"select '{c}' as feature, round(sum((c0 - e0) * (c0 - e0) / e0 + (c1 - e1) * (c1 - e1) / e1), 6) as chi2, cast(count(*) - 1 as integer) as dof from ("
    f"select c0, c1, (c0 + c1) * (select count_if(\"default\" = 0) from fs) / (select count(*) from fs) as e0, "
    f"(c0 + c1) * (select count_if(\"default\" = 1) from fs) / (select count(*) from fs) as e1 from ("
    f"select coalesce(cast({c} as varchar), 'nan') as v, count_if(\"default\" = 0) as c0, count_if(\"default\" = 1) as c1 from fs group by 1))"
    for c in _CAT_COLS), "resolved", extra=_FS_EXTRA))
def chi2_table(spark, sf_dir):
    """Contingency chi-square of each categorical field × default."""
    return xe.chi2_table(_fs(spark, sf_dir), _CAT_COLS)


_MI_NUM = ["int_rate", "dti", "fico_range_low", "revol_util", "loan_amnt"]


def _mi_frame(spark, sf_dir):
    fs = _fs(spark, sf_dir)
    binned = {f"{c}_bin": b for c, b in xe.quantile_bins(fs, _MI_NUM, 10).items()}
    out = fs.select("default", *_CAT_COLS, "grade_num", "emp_length_num", *[v.alias(k) for k, v in binned.items()])
    return out.na.drop(subset=_MI_COLS)   # list-wise drop over all tested columns


_MI_COLS = _CAT_COLS + ["grade_num", "emp_length_num"] + [f"{c}_bin" for c in _MI_NUM]


def _mi_sql() -> str:
    ex = dict(_FS_EXTRA)
    sel = ["\"default\""] + [f"cast({c} as varchar) as {c}" for c in _CAT_COLS + ["grade_num", "emp_length_num"]]
    for c in _MI_NUM:
        ex[f"e_{c}"] = f"select quantile_cont({c}, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as edges from fs"
        sel.append(f"cast(case when {c} is not null then len(list_filter((select edges from e_{c}), lambda e: {c} > e)) end as varchar) as {c}_bin")
    ex["mi"] = f"select * from (select {', '.join(sel)} from fs) where " + " and ".join(f"{c} is not null" for c in _MI_COLS)
    parts = []
    for c in _MI_COLS:
        parts.append(f"select '{c}' as feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 6) as mutual_info from ("
                     f"select nxy, (select count(*) from mi) as n, sum(nxy) over (partition by v) as nx, sum(nxy) over (partition by y) as ny "
                     f"from (select {c} as v, \"default\" as y, count(*) as nxy from mi group by all))")
    return O.with_ctes(" union all ".join(parts), "resolved", extra=ex)


@register("mutual_info", _mi_sql())
def mutual_info(spark, sf_dir):
    """D22 (re-aimed): plug-in mutual information of categorical fields and
    decile-binned numerics with default."""
    return xe.mutual_info(_mi_frame(spark, sf_dir), _MI_COLS)


@register("histogram_by_class", O.with_ctes("""
select "default", bin, n, n / sum(n) over (partition by "default") / w as density from (
 select "default", least(floor((int_rate - lo) / ((hi - lo) / 40)), 39)::integer as bin, count(*) as n, any_value((hi - lo) / 40) as w
 from resolved, (select min(int_rate) as lo, max(int_rate) as hi from resolved) m
 where int_rate is not null group by 1, 2)""", "resolved"))
def histogram_by_class(spark, sf_dir):
    """40 equal-width bins of int_rate by class, with density."""
    return xe.histogram(resolved_loans(spark, sf_dir), "int_rate", 40, by="default")


@register("variance_table", O.with_ctes(" union all ".join(
    f"select '{c}' as feature, round(var_samp({c}), 4) as variance, round(sqrt(var_samp({c})) / abs(avg({c})), 6) as coef_variation from resolved"
    for c in _PROFILE_COLS), "resolved"))
def variance_table(spark, sf_dir):
    """D24 (intent): sample variance and coefficient of variation per field."""
    return xe.variance_table(resolved_loans(spark, sf_dir), _PROFILE_COLS)


def _rank_sql() -> str:
    scores = ("select f.feature, a.anova_f, c.chi2, m.mutual_info from (select distinct feature from ("
              "select feature from an union select feature from ch union select feature from mu)) f "
              "left join an a using (feature) left join ch c using (feature) left join mu m using (feature)")
    rank_parts = []
    for s in ("anova_f", "chi2", "mutual_info"):
        rank_parts.append(f"left join (select feature, rank() over (order by {s} desc) + (count(*) over (partition by {s}) - 1) / 2.0 as {s}_rank "
                          f"from sc where {s} is not null) r_{s} using (feature)")
    avail = " + ".join(f"case when {s}_rank is not null then 1 else 0 end" for s in ("anova_f", "chi2", "mutual_info"))
    tot = " + ".join(f"coalesce({s}_rank, 0.0)" for s in ("anova_f", "chi2", "mutual_info"))
    body = (f"select sc.*, anova_f_rank, chi2_rank, mutual_info_rank, case when {avail} > 0 then ({tot}) / ({avail}) end as avg_rank "
            f"from sc " + " ".join(rank_parts))
    return (f"with an as ({_anova_sql()}), ch as (select replace(feature, '_enc', '') as feature, chi2 from ({_chi2_codes_sql()})), "
            f"mu as (select replace(feature, '_bin', '') as feature, mutual_info from ({_mi_sql()})), sc as ({scores}) {body}")


@register("feature_rank", _rank_sql())
def feature_rank(spark, sf_dir):
    """C1 + E1 + E2 (+F1): left-join ANOVA F, chi² and MI tables on the cleaned
    feature name, average descending ranks, mean of available ranks."""
    # a row per feature each, written once: the ranks read them again and again
    an = shared_table(anova_f(spark, sf_dir), "anova")
    ch = shared_table(chi2_codes(spark, sf_dir).select(F.regexp_replace("feature", "_enc$", "").alias("feature"), "chi2"), "chi2")
    mu = shared_table(mutual_info(spark, sf_dir).select(F.regexp_replace("feature", "_bin$", "").alias("feature"), "mutual_info"), "mutual-info")
    feats = an.select("feature").union(ch.select("feature")).union(mu.select("feature")).distinct()
    scores = feats.join(an, "feature", "left").join(ch, "feature", "left").join(mu, "feature", "left")
    return xe.average_rank(scores, ["anova_f", "chi2", "mutual_info"]).orderBy("avg_rank")


# ------------------------------------------------------------------ step 9: streams
import uuid as _uuid  # noqa: E402
from loanlens.session import scratch_path, shared_table  # noqa: E402
from loanlens.streaming import jobs as sj  # noqa: E402

_RATE_WIDTH = 86400
_RATE_LIMIT = 3


@register("stream_scores", O.with_ctes('select app_id, split, "default", p from scored', "scored"))
def stream_scores(spark, sf_dir):
    """ST1: file stream of raw loan rows → clean → split → prep → score (availableNow)."""
    from loanlens.sources.tables import staged_loan_applications, staged_path
    schema = staged_loan_applications(spark, sf_dir).schema
    stream = sj.file_stream(spark, staged_path(spark, sf_dir), "*.parquet", schema)
    return sj.run_available_now(sj.scoring_stream(stream, fitted_prep(spark, sf_dir)), "scores")


def _repeated_requests(spark, sf_dir):
    """The event table as a folder of request files in which one request in seven was sent twice."""
    from loanlens.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events")
    path = scratch_path(spark, f"requests-{_uuid.uuid4().hex}")
    ev.unionByName(ev.where(F.col("event_id") % 7 == 0)).write.parquet(path)
    return path, ev.schema


@register("stream_ab_windows", f"""
select strftime(time_bucket(interval 1 day, ts), '%Y-%m-%d %H:%M:%S') as window_start,
 strftime(time_bucket(interval 1 day, ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as window_end,
 case when {_bucket_sql('cast(user_id as varchar)')} < 10.0 then 'challenger' else 'champion' end as arm,
 count(*) as n_requests, cast(sum(cast(value as decimal(18,2))) as double) as total_value
from events group by all""")
def stream_ab_windows(spark, sf_dir):
    """ST2 + ST5: request stream with repeated ids, de-duplicated; daily windows
    per arm in update mode, so the open window is there too."""
    path, schema = _repeated_requests(spark, sf_dir)
    stream = sj.file_stream(spark, path, "*.parquet", schema)
    return sj.run_updates(sj.ab_window_stream(stream), "ab-windows", ["window_start", "window_end", "arm"])


@register("request_rate_all", f"""
select event_id, user_id, count(*) over (partition by user_id order by ts range between interval {_RATE_WIDTH} seconds preceding and current row) as n_in_window,
 count(*) over (partition by user_id order by ts range between interval {_RATE_WIDTH} seconds preceding and current row) > {_RATE_LIMIT} as over_limit
from events""")
def request_rate_all(spark, sf_dir):
    """ST3 batch 'count all' form: events per client in the trailing day, flag above 3."""
    from loanlens.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    c = sj.trailing_counts(ev, "user_id", "ts", _RATE_WIDTH)
    return c.select("event_id", "user_id", "n_in_window", (F.col("n_in_window") > _RATE_LIMIT).alias("over_limit"))


_RATE_STEP = f"list_filter(r.acc, lambda a: a > o.us - {_RATE_WIDTH * 10 ** 6})"


@register("request_rate_accepted", f"""
with recursive o as (select event_id, user_id, epoch_us(ts) as us, row_number() over (partition by user_id order by ts, event_id) as rn from events),
r as (select event_id, user_id, rn, 'accepted' as status, [us] as acc from o where rn = 1
 union all select o.event_id, o.user_id, o.rn, case when len({_RATE_STEP}) < {_RATE_LIMIT} then 'accepted' else 'rejected' end,
  case when len({_RATE_STEP}) < {_RATE_LIMIT} then list_append({_RATE_STEP}, o.us) else {_RATE_STEP} end
 from r join o on o.user_id = r.user_id and o.rn = r.rn + 1)
select event_id, user_id, status from r""")
def request_rate_accepted(spark, sf_dir):
    """ST3 in the state store: at most 3 accepted events per client in the
    trailing day; rejected events are not counted.  The requests come in parts
    in the order of time, each of as many files as its tasks write and a
    micro-batch of the job, so later batches meet the state of earlier ones."""
    path, base = (scratch_path(spark, f"{x}-{_uuid.uuid4().hex}") for x in ("requests", "stream-rate-limit"))
    with sj.rocks_state(spark, idle_batches=False):
        for part in _request_parts(spark, sf_dir):
            part.write.mode("append").parquet(path)
            stream = sj.file_stream(spark, path, "*.parquet", part.schema)
            decided = sj.run_available_now(sj.rate_limit_stream(stream, _RATE_LIMIT, _RATE_WIDTH), "rate-limit", base=base)
    return decided


def _request_parts(spark, sf_dir, parts: int = 4):
    """The event table in ``parts`` parts that follow each other in time."""
    from loanlens.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = ev.agg(F.min(us), F.max(us)).first()
    place = F.least(F.floor((us - low) * parts / (high - low + 1)), F.lit(parts - 1))
    return [ev.where(place == i) for i in range(parts)]


_CHECK_FIELDS = NUMERIC_FEATURES
_BATCH_SQL = O.with_ctes("""select w.split as "window", any_value(w.n) as n,
 case when count_if(scale) > 0 then 'critical' when count_if(empty) > 0 then 'warning' else 'ok' end as status,
 coalesce(string_agg(case when scale or empty then w.feature end, ',' order by w.feature), '') as fields
from (select c.*, c.r > t.r * 10 and t.r <> 0 as scale, c.z / c.n > 0.4 as empty from rg c join rg t on t.split = 'train' and t.feature = c.feature
  where c.split <> 'train') w group by w.split""", "apps", extra={
    "raw": """select a.*, case when y in (1995, 1996, 1997) then 'train' when y = 1998 then 'val' when y = 1999 then 'test' when y = 2000 then 'drift_2000'
      else 'extra_2001' end as split from (select *, year(try_strptime(issue_d, '%b-%Y')) as y from apps) a where y between 1995 and 2001""",
    "rg": " union all ".join(f"select split, '{c}' as feature, count(*) as n, count(*) - count({c}) as z, max({v}) - min({v}) as r from raw group by split"
                             for c in _CHECK_FIELDS for v in [f"case when split = 'test' then {c} * 1000 else {c} end" if c == "loan_amnt" else c])})


@register("stream_batch_checks", _BATCH_SQL)
def stream_batch_checks(spark, sf_dir):
    """ST1 + J1: raw loans of one window a micro-batch, one window in the wrong
    unit; every batch is scored and judged in one read of its rows."""
    from loanlens.sources.tables import staged_loan_applications
    raw = staged_loan_applications(spark, sf_dir).withColumn("_y", F.substring("issue_d", 5, 4).cast("int"))
    folder = scratch_path(spark, f"loan-batches-{_uuid.uuid4().hex}")
    years = DRIVER_SPLITS.labelled_years()
    train = qa.profile(raw.where(F.col("_y").isin(*dict(years)["train"])).withColumn("split", F.lit("train")), _CHECK_FIELDS)
    ranges = {r["feature"]: r["max"] - r["min"] for r in train.where("min is not null").collect()}          # a row per field
    base = scratch_path(spark, f"scoring-{_uuid.uuid4().hex}")
    for label, ys in years:
        if label != "train":            # a window's files, as many as its tasks write, are the next micro-batch of the job
            amount = F.col("loan_amnt") * (1000.0 if label == "test" else 1.0)
            raw.where(F.col("_y").isin(*ys)).withColumn("loan_amnt", amount).drop("_y").write.mode("append").parquet(folder)
            stream = sj.file_stream(spark, folder, "*.parquet", raw.drop("_y").schema)
            marks = sj.scoring_job(stream, fitted_prep(spark, sf_dir), base, _CHECK_FIELDS, ranges)
    label = F.element_at(F.array(*[F.lit(w) for w in _WINDOWS]), (F.col("batch") + 1).cast("int"))
    return marks.select(label.alias("window"), "n", "status", "fields")


# ------------------------------------------------------------------ step 8: learners
import uuid as _uuid  # noqa: E402
from loanlens.operators import boosting as bo  # noqa: E402
from loanlens.operators import learn as ml  # noqa: E402
from loanlens.session import scratch_path, shared_table  # noqa: E402

_MODELS: dict[tuple, object] = {}


#: The reference's settings: its bound on the rounds and its patience too.
_BOOSTED = {"gbt": bo.BoostParams(), "gbt2": bo.SECOND}
_BOOSTED["gbt_small"] = bo.BoostParams(max_rounds=6, depth=3, step=0.3, min_gain=0.0, block=6)           # without validation rows: all six trees


def _train_frame(spark, sf_dir, splits=("train",), rows=None):
    model = fitted_prep(spark, sf_dir)
    df = (rows if rows is not None else prepared(spark, sf_dir, model)).where(F.col("split").isin(*splits))
    return model, df


def _learned(spark, sf_dir, kind: str, splits=("train",), rows=None):
    """The session's fitted learner; ``rows`` may give the prepared rows if they are stored already."""
    from loanlens.sources.tables import input_key
    key = (*input_key(spark, sf_dir), kind, splits)
    if key not in _MODELS:
        boosted = kind != "logistic"
        prep, df = _train_frame(spark, sf_dir, splits + (("val",) if kind in ("gbt", "gbt2") else ()), rows)
        feats = prep.feature_columns
        df = df.select("split", "default", *[F.col(f"`{c}`") for c in feats])
        if rows is None:        # prepared once in the shared folder: fitting passes over it many times
            df = shared_table(df, "train-rows")
        if boosted:
            rows = ml.class_weights(df, mode="ratio").withColumn("is_val", F.col("split") == "val")
            _MODELS[key] = bo.boost(rows, feats, _BOOSTED[kind])
        else:       # balanced weights sum to the row count
            _MODELS[key] = ml.logistic_pipeline(feats, weight_sum=df.count()).fit(ml.class_weights(df, mode="balanced"))
    return _MODELS[key]


def _split_rows(spark, sf_dir, split):
    return prepared(spark, sf_dir, fitted_prep(spark, sf_dir)).where(F.col("split") == split)


@register("model_compare")
def model_compare(spark, sf_dir):
    """I3 + I4 + I5 + I6 + D37: weighted logistic regression and two boosted
    learners, validation AUC table sorted, champion flagged."""
    val = _split_rows(spark, sf_dir, "val")
    return ml.compare_models({k: ml.score(_learned(spark, sf_dir, k), val) for k in ("logistic", "gbt", "gbt2")})


@register("boosting_rounds")
def boosting_rounds(spark, sf_dir):
    """I4 + I5: validation AUC of every boosting round, also of those after the best one, which the model leaves out."""
    rows = [(k, i + 1, a, i < len(m.trees)) for k in ("gbt", "gbt2") for m in [_learned(spark, sf_dir, k)] for i, a in enumerate(m.history)]
    return spark.createDataFrame(rows, "model string, round int, val_auc double, kept boolean")


@register("search_trials")
def search_trials(spark, sf_dir):
    """Four trials side by side; the better two go on after two rounds."""
    prep, df = _train_frame(spark, sf_dir, ("train", "val"))
    feats = prep.feature_columns
    df = ml.class_weights(df.select("split", "default", *[F.col(f"`{c}`") for c in feats]), mode="ratio").withColumn("is_val", F.col("split") == "val")
    _, found = bo.halving_search(bo.boosting_rows(df, feats), feats, trials=4, rungs=(2, 4), space={"depth": (2, 4)})
    return spark.createDataFrame([(i, *[float(t[c]) for c in bo.SPACE], t["auc"], t["rounds"]) for i, t in enumerate(found)],
                                 "trial int, " + ", ".join(f"{c} double" for c in bo.SPACE) + ", val_auc double, rounds int")


@register("learned_scores")
def learned_scores(spark, sf_dir):
    """I8 with a learned model: probability (4 dp), decision, threshold, version on the test split."""
    return ml.score(_learned(spark, sf_dir, "logistic"), _split_rows(spark, sf_dir, "test"),
                    threshold=0.5, version="logistic_v1")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """Boosted-tree feature importances as rows."""
    return ml.feature_importance(spark, _learned(spark, sf_dir, "gbt"))


@register("perm_importance")
def perm_importance(spark, sf_dir):
    """Permutation importance (10 repeats, AUC drop) of the logistic model on validation rows."""
    feats = fitted_prep(spark, sf_dir).feature_columns
    return ml.permutation_importance(ml.pipeline_probability(_learned(spark, sf_dir, "logistic")), _split_rows(spark, sf_dir, "val"), feats)


@register("retrain_compare")
def retrain_compare(spark, sf_dir):
    """A13 + I16 + I17: the existing model and a candidate trained on train + val,
    both saved, reloaded, scored on the test split and put in a registry
    table; the candidate is promoted only if it is better."""
    test = _split_rows(spark, sf_dir, "test")
    base = scratch_path(spark, f"models-{_uuid.uuid4().hex}")
    feats = fitted_prep(spark, sf_dir).feature_columns
    for i, splits in enumerate((("train",), ("train", "val"))):
        path = f"{base}/{i}"
        ml.save_model(_learned(spark, sf_dir, "logistic", splits), path, {"columns": feats, "threshold": 0.5, "trained_on": list(splits)})
        model, meta = ml.load_model(spark, path)
        ml.register_candidate(spark, f"{base}/registry", "logistic", ev.auc(ml.score(model, test)).first()["auc"], "+".join(meta["trained_on"]))
    return ml.read_registry(spark, f"{base}/registry").select("model_name", "version", "decision", F.round("new_auc", 6).alias("new_auc"),
                                                             F.round("old_auc", 6).alias("old_auc"), "path")


# ------------------------------------------------------------------ step 10: attribution
from loanlens.operators import attribution as at  # noqa: E402
from loanlens.operators import tree_attribution as ta  # noqa: E402
from loanlens.operators.scoring import CHAMPION  # noqa: E402


def _attr_sql(body: str) -> str:
    means = ", ".join(f"avg({c}) as m_{c}" for c, _, _ in CHAMPION.terms)
    phis = ", ".join(f"{w!r} * ({c} - m.m_{c}) as phi_{c}" for c, w, _ in CHAMPION.terms)
    return O.with_ctes(body, "prepared", extra={
        "m": f"select {means} from prepared where split = 'train'",
        "ph": f"select p.app_id, p.split, {phis} from prepared p, m"})


@register("attribution_global", _attr_sql("select * from (" + " union all ".join(
    f"select '{c}' as feature, round(avg(abs(phi_{c})), 6) as mean_abs_attribution from ph" for c, _, _ in CHAMPION.terms)
    + ") order by mean_abs_attribution desc, feature limit 15"))
def attribution_global(spark, sf_dir):
    """I9 + F3: exact linear attribution of the champion scorecard over all rows, top 15."""
    model = fitted_prep(spark, sf_dir)
    prep = prepared(spark, sf_dir, model)
    return at.global_attribution(prep, CHAMPION, prep.where(F.col("split") == "train"))


@register("attribution_drift", _attr_sql("select feature, period_a, period_b, round(period_b - period_a, 6) as change from (" + " union all ".join(
    f"select '{c}' as feature, round(avg(case when split = 'train' then abs(phi_{c}) end), 6) as period_a, "
    f"round(avg(case when split = 'test' then abs(phi_{c}) end), 6) as period_b from ph" for c, _, _ in CHAMPION.terms) + ")"))
def attribution_drift(spark, sf_dir):
    """I12 + F4: mean |attribution| train vs test per feature, change, sorted by |change|."""
    model = fitted_prep(spark, sf_dir)
    prep = prepared(spark, sf_dir, model)
    return at.attribution_drift(prep, CHAMPION, prep.where(F.col("split") == "train"), "split", "train", "test")


@register("attribution_local", _attr_sql("select l.app_id, round(" + repr(CHAMPION.intercept) + " + " + " + ".join(
    f"{w!r} * (m.m_{c} - {ctr!r})" for c, w, ctr in CHAMPION.terms) + ", 6) as base_value, round(" + " + ".join(
    f"{w!r} * ({c} - {ctr!r})" for c, w, ctr in CHAMPION.terms) + " + " + repr(CHAMPION.intercept) + ", 6) as margin, f.feature, f.attribution from ("
    "select * from prepared where split = 'test' and app_id = (select min(app_id) from prepared where split = 'test')) l, m, (" + " union all ".join(
    f"select '{c}' as feature, round(phi_{c}, 6) as attribution from ph where split = 'test' and app_id = (select min(app_id) from ph where split = 'test')"
    for c, _, _ in CHAMPION.terms) + ") f"))
def attribution_local(spark, sf_dir):
    """Per-feature attribution of the lowest test-split application id."""
    model = fitted_prep(spark, sf_dir)
    prep = prepared(spark, sf_dir, model)
    test = prep.where(F.col("split") == "test")
    first = test.agg(F.min("app_id")).scalar()
    return at.local_attribution(test.where(F.col("app_id") == first), CHAMPION, prep.where(F.col("split") == "train"))


@register("attribution_trees")
def attribution_trees(spark, sf_dir):
    """I11 + I9 + F3: exact attribution of boosted trees over all test rows, mean absolute part per feature."""
    return ta.global_tree_attribution(_split_rows(spark, sf_dir, "test"), _learned(spark, sf_dir, "gbt_small"))


@register("attribution_trees_drift")
def attribution_trees_drift(spark, sf_dir):
    """I12 for trees: mean absolute parts of two windows and their change."""
    rows = prepared(spark, sf_dir, fitted_prep(spark, sf_dir))
    return ta.tree_attribution_drift(rows, _learned(spark, sf_dir, "gbt_small"), "split", "val", "test")


@register("attribution_trees_sum")
def attribution_trees_sum(spark, sf_dir):
    """I10 + I11: of every test row the base value, the sum of its parts and the model's margin."""
    model, rows = _learned(spark, sf_dir, "gbt_small"), _split_rows(spark, sf_dir, "test")
    parts = ta.tree_attribution(rows, model).groupBy("app_id").agg(F.sum("phi").alias("parts"))
    margins = model.with_margin(rows.select("app_id", *[F.col(f"`{c}`") for c in model.features])).select("app_id", "margin")
    return margins.join(parts, "app_id", "left").select(
        "app_id", F.lit(ta.base_value(model)).alias("base_value"), F.coalesce("parts", F.lit(0.0)).alias("parts"), "margin")


# ------------------------------------------------------------------ sources / sinks round trips
from loanlens.sources import loans as io  # noqa: E402
from loanlens.session import scratch_path  # noqa: E402
import uuid as _uuid  # noqa: E402


@register("split_sink", O.with_ctes("""
select split, count(*) as rows, 40 + 0 as width from prepared group by split""".replace("40 + 0", "(26 + (select count(*) from cats) + 4)"),
    "prepared", "cats"))
def split_sink(spark, sf_dir):
    """Prepared features written partitioned by split; the per-split shape of what is read back."""
    df = prepared(spark, sf_dir, fitted_prep(spark, sf_dir))
    return io.write_splits(df, scratch_path(spark, f"splits-{_uuid.uuid4().hex[:8]}"))


@register("window_read", O.with_ctes("""select app_id, "default" from resolved where split = 'drift_2000'""", "resolved"))
def window_read(spark, sf_dir):
    """A4 + A5: a window label opened as its partition of the split dataset, named columns only."""
    path = scratch_path(spark, f"windows-{_uuid.uuid4().hex[:8]}")
    io.write_splits(resolved_loans(spark, sf_dir), path)
    return io.read_window(spark, path, "2000", ["app_id", "default"])


def _loan_file(spark, sf_dir):
    """The raw loan table as wide gzip CSV: droppable columns among the named ones, in another order."""
    from loanlens.operators.clean import LEAKAGE_COLUMNS, REDUNDANT_COLUMNS
    from loanlens.sources.tables import staged_loan_applications
    path = scratch_path(spark, f"loan-file-{_uuid.uuid4().hex[:8]}")
    raw = staged_loan_applications(spark, sf_dir)
    more = [c for c in [*LEAKAGE_COLUMNS, *REDUNDANT_COLUMNS, "hardship_flag", "settlement_date"] if c not in raw.columns]
    wide = raw.select("*", *[F.lit("x").alias(c) for c in more])
    wide.select(*sorted(wide.columns, reverse=True)).write.option("header", True).option("compression", "gzip").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


_LOAN_COLS = ", ".join(io.RAW_LOAN_SCHEMA.fieldNames())


@register("loan_file", O.with_ctes(f"select {_LOAN_COLS} from apps", "apps"))
def loan_file(spark, sf_dir):
    """A1: the named columns of a wide gzip CSV file, by header name, typed."""
    return io.read_loan_csv(spark, _loan_file(spark, sf_dir))


@register("loan_file_train", O.with_ctes(f"""select {_LOAN_COLS} from (select a.*, year(try_strptime(issue_d, '%b-%Y')) as y from apps a)
 where y in (1995, 1996, 1997)""", "apps"))
def loan_file_train(spark, sf_dir):
    """A2: the file's rows of the train years."""
    df = io.read_train_years(spark, _loan_file(spark, sf_dir), (1995, 1996, 1997))
    return df.select(*[F.date_format("issue_d", "MMM-yyyy").alias("issue_d") if c == "issue_d" else c for c in io.RAW_LOAN_SCHEMA.fieldNames()])


_KEPT = ["app_id", "loan_status", *NUMERIC_FEATURES, "sub_grade", "term", "emp_length", "home_ownership", "verification_status", "purpose",
         "default", "issue_d", "issue_year", "split"]


@register("dropped_columns", O.with_ctes(" union all ".join(
    f"select '{c}' as column_name, count(\"{c}\") as n_present from resolved" for c in _KEPT), "resolved"))
def dropped_columns(spark, sf_dir):
    """B4 + B5: leakage and redundant columns leave the wide table; every column that is left, with its values counted."""
    from loanlens.operators.clean import LEAKAGE_COLUMNS, REDUNDANT_COLUMNS, clean
    from loanlens.sources.tables import staged_loan_applications
    raw = staged_loan_applications(spark, sf_dir)
    more = [c for c in [*LEAKAGE_COLUMNS, *REDUNDANT_COLUMNS, "hardship_flag", "settlement_date"] if c not in raw.columns]
    out = temporal_split(clean(raw.select("*", *[F.lit(1).alias(c) for c in more])), DRIVER_SPLITS)
    counts = out.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(out.columns)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_present"))
                                             for i, c in enumerate(out.columns)])).alias("s")).select("s.*")


@register("ab_log_roundtrip", O.with_ctes(f"""
select count(*) as total_requests, count_if(assigned_model = 'champion') as champion_requests,
 {rr("count_if(champion_decision = 'APPROVE')", "count(champion_decision)")} as champion_approval_rate,
 {rr("count_if(challenger_decision = 'APPROVE')", "count(challenger_decision)")} as challenger_approval_rate
from cf""", "scored_both", extra={"cf": _CF_FULL}))
def ab_log_roundtrip(spark, sf_dir):
    """A11 + A6: the counterfactual log appended as JSON lines, read back with
    the explicit schema in FAILFAST mode, then summarised (D40)."""
    path = scratch_path(spark, f"ab-log-{_uuid.uuid4().hex[:8]}")
    io.append_jsonl(_log(spark, sf_dir).withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")), path)
    s = xp.summary(io.read_counterfactual_log(spark, path, strict=True))
    return s.select("total_requests", "champion_requests", "champion_approval_rate", "challenger_approval_rate")
