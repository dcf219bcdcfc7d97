"""Evaluation: thresholds, costs, AUC, ROC, calibration, reports.

Inputs are scored tables with a probability column (4 dp) and a 0/1 label.
Every metric is one pass over the scored rows; anything ordered works on a
bounded table (≤ 91 threshold buckets, ≤ 10 bins, distinct scores through the
two-level prefix-sum plan).  Money and score sums run on exact integer units
so results do not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.columns import (
    CALIBRATION_EDGES, COST_FALSE_NEGATIVE, COST_FALSE_POSITIVE, THRESHOLD_GRID,
    round_ratio, safe_ratio, threshold_bucket, units, wide,
)
from loanlens.plans.prefix import prefix_sums
from loanlens.session import shared_table


def _i(c: Column) -> Column:
    return F.sum(c.cast("int")).cast("bigint")


def _mean4(c: Column) -> Column:
    """Exact mean of a 4-dp column, rounded half-up to 4 dp."""
    return round_ratio(F.sum(wide(units(c))), wide(F.count(c)) * wide(F.lit(10000)), 4)


# ---------------------------------------------------------------- D27–D30
def threshold_sweep(scored: DataFrame, p: str = "p", y: str = "default",
                    grid: Sequence[float] = THRESHOLD_GRID,
                    cost_fn: float = COST_FALSE_NEGATIVE,
                    cost_fp: float = COST_FALSE_POSITIVE) -> DataFrame:
    """FN, FP, cost, approval and recall at each grid threshold, one pass.

    deny ⇔ p ≥ t (unrounded grid double).  Each row's bucket is the number of
    thresholds ≤ p; a ≤ 91-row ``groupBy(bucket)`` plus suffix sums over the
    grid gives every threshold's confusion counts.
    """
    grid = list(grid)
    counts = (scored.select(threshold_bucket(F.col(p), grid).alias("b"), F.col(y).alias("y"))
              .groupBy("b").agg(F.count(F.lit(1)).alias("n"), _i(F.col("y") == 1).alias("pos")))
    return sweep_of_counts(counts, grid, cost_fn, cost_fp)


def sweep_of_counts(counts: DataFrame, grid: Sequence[float] = THRESHOLD_GRID, cost_fn: float = COST_FALSE_NEGATIVE,
                    cost_fp: float = COST_FALSE_POSITIVE) -> DataFrame:
    """D27 from (b, n, pos): rows and positives by the number of thresholds that are at most p."""
    thresholds = counts.sparkSession.createDataFrame(
        [(j, grid[j - 1] if j else None, round(grid[j - 1], 2) if j else None)
         for j in range(0, len(grid) + 1)],
        "b int, t_exact double, threshold double")
    t = thresholds.join(F.broadcast(counts), "b", "left").fillna(0, ["n", "pos"])
    suffix = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.select("b", "t_exact", "threshold",
                 F.sum("n").over(suffix).alias("denied"), F.sum("pos").over(suffix).alias("tp"),
                 F.sum("n").over(everything).alias("n_all"), F.sum("pos").over(everything).alias("p_all"))
    t = t.where(F.col("b") > 0)
    fn = (F.col("p_all") - F.col("tp")).cast("bigint")
    fp = (F.col("denied") - F.col("tp")).cast("bigint")
    return t.select(
        (F.col("b") - 1).alias("idx"), "threshold",
        fn.alias("false_negatives"), fp.alias("false_positives"),
        (fn * F.lit(cost_fn) + fp * F.lit(cost_fp)).alias("total_cost"),
        safe_ratio(F.col("n_all") - F.col("denied"), F.col("n_all")).alias("approval_rate"),
        safe_ratio(F.col("tp"), F.col("p_all")).alias("recall_default"))


def optimal_threshold(sweep: DataFrame, min_approval: float = 0.55,
                      naive: float = 0.50, infeasible: str = "unconstrained") -> DataFrame:
    """D28 + D29: first-minimum cost threshold, constrained variant, savings.

    ``infeasible`` = "unconstrained" (selector) or a float literal text such as
    "0.5" (script fallback) decides the constrained threshold when no grid
    point reaches ``min_approval``.
    """
    key = F.struct("total_cost", "idx")
    feasible = F.col("approval_rate") >= F.lit(min_approval)
    best = F.min_by(F.struct("threshold", "total_cost", "approval_rate"), key)
    best_c = F.min_by(F.struct("threshold", "total_cost", "approval_rate"),
                      F.when(feasible, key))
    r = sweep.agg(best.alias("u"), best_c.alias("c"),
                  F.max(F.when(F.abs(F.col("threshold") - F.lit(naive)) < 0.005, F.col("total_cost"))).alias("naive"),
                  _i(feasible).alias("n_feasible"))
    if infeasible == "unconstrained":
        c_t, c_cost, c_appr = (F.coalesce(F.col(f"c.{f}"), F.col(f"u.{f}"))
                               for f in ("threshold", "total_cost", "approval_rate"))
    else:
        fb = float(infeasible)
        c_t = F.coalesce(F.col("c.threshold"), F.lit(fb))
        c_cost = F.col("c.total_cost")
        c_appr = F.col("c.approval_rate")
    return r.select(
        F.col("u.threshold").alias("unconstrained_threshold"),
        F.col("u.total_cost").alias("unconstrained_cost"),
        F.col("u.approval_rate").alias("unconstrained_approval_rate"),
        c_t.alias("constrained_threshold"), c_cost.alias("constrained_cost"),
        c_appr.alias("constrained_approval_rate"),
        (F.coalesce(F.col("naive"), F.lit(0.0)) - F.col("u.total_cost")).alias("cost_savings_vs_naive"),
        (F.col("n_feasible") > 0).alias("constraint_feasible"))


def reuse_or_select_threshold(scored: DataFrame, current: float, p: str = "p",
                              y: str = "default", band: tuple[float, float] = (0.40, 0.70),
                              min_approval: float = 0.55) -> DataFrame:
    """Keep ``current`` if the approval there is inside ``band``, else the
    constrained threshold (D29, falling back to 0.50).  One row.

    One pass: rows are counted by grid bucket and side of ``current``."""
    grid, at = list(THRESHOLD_GRID), "_below"
    counts = shared_table(scored.groupBy(threshold_bucket(F.col(p), grid).alias("b"), (F.col(p) < F.lit(current)).alias(at)).agg(
        F.count(F.lit(1)).alias("n"), _i(F.col(y) == 1).alias("pos")), "threshold-counts")
    sel = optimal_threshold(sweep_of_counts(counts.groupBy("b").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")), grid), min_approval, infeasible="0.5")
    lo, hi = band
    r = counts.agg(round_ratio(F.sum(F.when(F.col(at), F.col("n")).when(~F.col(at), 0)), F.sum("n"), 6).alias("approval_at_current"))
    in_band = (F.col("approval_at_current") >= lo) & (F.col("approval_at_current") <= hi)
    return r.select("approval_at_current", in_band.alias("reuse_current"),
                    F.when(in_band, F.lit(float(current)))
                     .otherwise(sel.select("constrained_threshold").scalar()).alias("threshold"))


# ---------------------------------------------------------------- D31–D32, D38
def _confusion(p: Column, y: Column, t: float) -> dict[str, Column]:
    deny = p >= F.lit(t)
    return {"tp": _i(deny & (y == 1)), "fp": _i(deny & (y == 0)),
            "tn": _i(~deny & (y == 0)), "fn": _i(~deny & (y == 1))}


def class_metrics(scored: DataFrame, thresholds: Sequence[float] = (0.5, 0.3),
                  p: str = "p", y: str = "default") -> DataFrame:
    """Confusion counts, precision/recall/F1 on class 1 (0 on zero
    division), accuracy, approval and Brier, one row per threshold — one pass."""
    aggs = []
    for i, t in enumerate(thresholds):
        for k, c in _confusion(F.col(p), F.col(y), t).items():
            aggs.append(c.alias(f"{k}_{i}"))
    sq = units(F.col(p) - F.col(y).cast("double"))
    aggs += [F.sum(sq * sq).alias("sq_units"), F.count(F.lit(1)).alias("n")]
    r = scored.agg(*aggs)
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp, tn, fn = (F.col(f"{k}_{i}") for k in ("tp", "fp", "tn", "fn"))
        prec = safe_ratio(tp, tp + fp)
        rec = safe_ratio(tp, tp + fn)
        rows.append(F.struct(
            F.lit(float(t)).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
            tn.alias("tn"), fn.alias("fn"), prec.alias("precision"), rec.alias("recall"),
            F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
            safe_ratio(tp + tn, F.col("n")).alias("accuracy"),
            safe_ratio(tn + fn, F.col("n")).alias("approval_rate")))
    brier = safe_ratio(F.col("sq_units"), F.col("n") * F.lit(10 ** 8))
    return r.select(F.explode(F.array(*rows)).alias("m"), brier.alias("brier")).select("m.*", "brier")


def cost_impact(scored: DataFrame, threshold: float, p: str = "p", y: str = "default",
                cost_fn: float = COST_FALSE_NEGATIVE, cost_fp: float = COST_FALSE_POSITIVE) -> DataFrame:
    """Cost with the model vs approving everyone, saving and percent."""
    c = _confusion(F.col(p), F.col(y), threshold)
    r = scored.agg(c["fn"].alias("fn"), c["fp"].alias("fp"), _i(F.col(y) == 1).alias("positives"))
    model = F.col("fn") * F.lit(cost_fn) + F.col("fp") * F.lit(cost_fp)
    allc = F.col("positives") * F.lit(cost_fn)
    return r.select(F.lit(float(threshold)).alias("threshold"), "fn", "fp", "positives",
                    model.alias("cost_with_model"), allc.alias("cost_approve_all"),
                    (allc - model).alias("saving"),
                    safe_ratio((allc - model) * F.lit(100.0), allc).alias("saving_pct"))


# ---------------------------------------------------------------- D33–D35
def _score_counts(scored: DataFrame, p: str, y: str, by: Sequence[str]) -> DataFrame:
    return (scored.groupBy(*by, F.col(p).alias("score"))
            .agg(_i(F.col(y) == 1).alias("pos"), _i(F.col(y) == 0).alias("neg")))


def auc(scored: DataFrame, p: str = "p", y: str = "default", by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with ties counting one half, per group of ``by``.

    ``groupBy(score)`` → running negatives below each score (ranged prefix
    sums) → Σ pos·(neg_below + neg/2) / (P·N).  Equals
    ``BinaryClassificationEvaluator(numBins=0)``.
    """
    return auc_of_counts(_score_counts(scored, p, y, by), by)


def auc_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D33 from (by, score, pos, neg) counts."""
    by = list(by)
    c = prefix_sums(counts, by, "score", ["neg"])
    pos, neg = wide(F.col("pos")), wide(F.col("neg"))
    part = pos * (wide(F.col("cum_neg")) * 2 - neg)        # pos * (2 * negatives below + negatives at the score)
    r = c.groupBy(*by).agg(F.sum(part).alias("twice"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return r.select(*by, safe_ratio(F.col("twice"), wide(F.col("P")) * wide(F.col("N")) * 2, float("nan")).alias("auc"),
                    F.col("P").alias("positives"), F.col("N").alias("negatives"))


def roc_points(scored: DataFrame, p: str = "p", y: str = "default") -> DataFrame:
    """(fpr, tpr) at every distinct score used as a threshold (p ≥ s)."""
    counts = _score_counts(scored, p, y, [])
    c = prefix_sums(counts, [], "score", ["pos", "neg"])
    totals = counts.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()     # one scan for both
    P, N = totals["P"], totals["N"]
    tp = P - F.col("cum_pos") + F.col("pos")
    fp = N - F.col("cum_neg") + F.col("neg")
    return c.select(F.col("score").alias("threshold"), safe_ratio(fp, N).alias("fpr"),
                    safe_ratio(tp, P).alias("tpr"))


def calibration(scored: DataFrame, p: str = "p", y: str = "default",
                edges: Sequence[float] = CALIBRATION_EDGES) -> DataFrame:
    """Uniform bins, right-closed; mean p and positive share; empty bins omitted."""
    b = sum((F.col(p) > F.lit(e)).cast("int") for e in edges)
    return (scored.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), _mean4(F.col(p)).alias("mean_predicted"),
                 round_ratio(_i(F.col(y) == 1), F.count(F.lit(1)), 6).alias("fraction_positive")))


# ---------------------------------------------------------------- D36, D39
def class_report(scored: DataFrame, threshold: float, p: str = "p", y: str = "default") -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted."""
    c = _confusion(F.col(p), F.col(y), threshold)
    r = scored.agg(*[v.alias(k) for k, v in c.items()])
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn

    def f1(pr, rc):
        return F.when(pr + rc > 0, F.lit(2.0) * pr * rc / (pr + rc)).otherwise(0.0)

    p1, r1, s1 = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn), tp + fn
    p0, r0, s0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp), tn + fp
    f0, f1v = f1(p0, r0), f1(p1, r1)
    rows = [
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1v.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), safe_ratio(tp + tn, n).alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1v) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), safe_ratio(p0 * s0 + p1 * s1, n).alias("precision"),
                 safe_ratio(r0 * s0 + r1 * s1, n).alias("recall"), safe_ratio(f0 * s0 + f1v * s1, n).alias("f1"),
                 n.alias("support")),
    ]
    return r.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def score_distribution(scored: DataFrame, p: str = "p", by: Sequence[str] = (),
                       accuracy: int | None = None) -> DataFrame:
    """Min, max, mean, median of the probabilities (4 dp: at most 10,001 values in the median's map)."""
    med = F.percentile(p, 0.5) if accuracy is None else F.percentile_approx(p, 0.5, accuracy)
    return scored.groupBy(*by).agg(F.min(p).alias("min_p"), F.max(p).alias("max_p"),
                                   _mean4(F.col(p)).alias("mean_p"), med.alias("median_p"))


# ---------------------------------------------------------------- D26, D17
def business_metrics(scored: DataFrame, threshold: float, p: str = "p", y: str | None = "default",
                     amount: str | None = "loan_amnt", by: Sequence[str] = ()) -> DataFrame:
    """approval/denial, expected loss Σ p·amount on approved, default rate
    on approved, mean p; approved ⇔ p < t.  0.0 when nothing is approved and
    NULL when the amount/label column is not given."""
    appr = F.col(p) < F.lit(threshold)
    aggs = [F.count(F.lit(1)).alias("n"), _i(appr).alias("n_approved"),
            F.sum(wide(units(F.col(p)))).alias("p_units")]
    if amount:
        loss = F.when(appr, wide(units(F.col(p))) * wide(units(F.col(amount), 2)))
        aggs.append(F.sum(loss).alias("loss_units"))
    if y:
        aggs.append(_i(appr & (F.col(y) == 1)).alias("approved_defaults"))
    r = scored.groupBy(*by).agg(*aggs)
    approval = round_ratio(F.col("n_approved"), F.col("n"), 4)
    out = [*by, "n", approval.alias("approval_rate"),
           round_ratio(F.col("n") - F.col("n_approved"), F.col("n"), 4).alias("denial_rate")]
    if amount:
        # loss units are 1e-6 currency; round half-up to cents in integer math
        cents = round_ratio(F.coalesce(F.col("loss_units"), wide(F.lit(0))), F.lit(10 ** 4), 0)
        out.append((cents / F.lit(100.0)).alias("expected_loss"))
    else:
        out.append(F.lit(None).cast("double").alias("expected_loss"))
    if y:
        out.append(round_ratio(F.col("approved_defaults"), F.col("n_approved"), 4).alias("default_rate_on_approved"))
    else:
        out.append(F.lit(None).cast("double").alias("default_rate_on_approved"))
    out += [round_ratio(F.col("p_units"), wide(F.col("n")) * wide(F.lit(10000)), 4).alias("mean_probability"),
            F.lit(float(threshold)).alias("threshold_used")]
    return r.select(*out)
