"""Champion/challenger experiments.

Assignment is a pure function of the request id (md5 bucket), so it is
reproducible in SQL and needs no shuffle.  Both models score every request in
one projection; every summary is one aggregate; per-arm AUC uses the exact
grouped AUC.  Tail probabilities are computed for the few result rows only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.columns import decision, md5_bucket, round_ratio, units
from loanlens.functions.stats import chi2_one_dof_udf, normal_two_sided_udf
from loanlens.operators.evaluate import auc

MIN_REQUESTS = 1000
PROMOTE_APPROVAL_GAIN = 0.02
MAX_PROB_INCREASE = 0.02
Z_CRITICAL_05 = 1.959963984540054   # two-sided 5 % normal quantile


def assign(request_id: Column, challenger_pct: float, has_challenger: bool = True) -> Column:
    """K1: bucket = int(md5(id),16) % 100; challenger iff bucket < pct·100."""
    if not 0 <= challenger_pct <= 1:
        raise ValueError(f"challenger_pct must be 0-1, got {challenger_pct}")
    if not has_challenger:
        return F.lit("champion")
    return F.when(md5_bucket(request_id) < F.lit(challenger_pct * 100), "challenger").otherwise("champion")


def counterfactual(df: DataFrame, request_id: str, champion_p: str, challenger_p: str | None,
                   champion_t: float, challenger_t: float, challenger_pct: float = 0.10) -> DataFrame:
    """Both scores and decisions per request; the returned decision is
    the assigned arm's, the champion's when the challenger score is missing."""
    ch = F.col(challenger_p) if challenger_p else F.lit(None).cast("double")
    arm = assign(F.col(request_id).cast("string"), challenger_pct, challenger_p is not None)
    champ_d = decision(F.col(champion_p), champion_t)
    chall_d = F.when(ch.isNotNull(), decision(ch, challenger_t))
    returned = F.when((arm == "challenger") & chall_d.isNotNull(), chall_d).otherwise(champ_d)
    return df.select(F.col(request_id).cast("string").alias("request_id"), arm.alias("assigned_model"),
                     F.col(champion_p).alias("champion_probability"), champ_d.alias("champion_decision"),
                     ch.alias("challenger_probability"), chall_d.alias("challenger_decision"),
                     returned.alias("returned_decision"))


def _mean4(c: Column) -> Column:
    return round_ratio(F.sum(units(c)), F.count(c) * F.lit(10000), 4)


def summary(log: DataFrame) -> DataFrame:
    """Requests per arm, approval and mean p per model (non-NULL rows),
    agreement within rows where both decided; 4 dp; empty log → zeros."""
    both = F.col("champion_decision").isNotNull() & F.col("challenger_decision").isNotNull()
    r = log.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("assigned_model") == "champion").alias("champion_requests"),
        F.count_if(F.col("assigned_model") != "champion").alias("challenger_requests"),
        round_ratio(F.count_if(F.col("champion_decision") == "APPROVE"), F.count("champion_decision")).alias("champion_approval_rate"),
        round_ratio(F.count_if(F.col("challenger_decision") == "APPROVE"), F.count("challenger_decision")).alias("challenger_approval_rate"),
        F.coalesce(_mean4(F.col("champion_probability")), F.lit(0.0)).alias("champion_avg_probability"),
        F.coalesce(_mean4(F.col("challenger_probability")), F.lit(0.0)).alias("challenger_avg_probability"),
        round_ratio(F.count_if(both & (F.col("champion_decision") == F.col("challenger_decision"))),
                    F.count_if(both)).alias("agreement_rate"))
    return r


def analyze(log: DataFrame, min_requests: int = MIN_REQUESTS,
            approval_gain: float = PROMOTE_APPROVAL_GAIN, max_prob_increase: float = MAX_PROB_INCREASE) -> DataFrame:
    """D41 + K6: approval by assigned arm, mean p over all entries, online
    promotion rule; fewer than ``min_requests`` → insufficient_data, zeros."""
    champ = F.col("assigned_model") == "champion"
    chall = F.col("assigned_model") == "challenger"
    r = log.agg(F.count(F.lit(1)).alias("n"), F.count_if(champ).alias("n0"), F.count_if(chall).alias("n1"),
                F.count_if(champ & (F.col("champion_decision") == "APPROVE")).alias("a0"),
                F.count_if(chall & (F.col("challenger_decision") == "APPROVE")).alias("a1"),
                F.sum(units(F.col("champion_probability"))).alias("s0"), F.count("champion_probability").alias("c0"),
                F.sum(units(F.col("challenger_probability"))).alias("s1"), F.count("challenger_probability").alias("c1"))
    rate0 = F.when(F.col("n0") > 0, F.col("a0") / F.col("n0")).otherwise(0.0)
    rate1 = F.when(F.col("n1") > 0, F.col("a1") / F.col("n1")).otherwise(0.0)
    avg0 = F.when(F.col("c0") > 0, F.col("s0") / (F.col("c0") * F.lit(10000.0))).otherwise(0.0)
    avg1 = F.when(F.col("c1") > 0, F.col("s1") / (F.col("c1") * F.lit(10000.0))).otherwise(0.0)
    diff, pdiff = rate1 - rate0, avg1 - avg0
    ok = F.col("n") >= F.lit(min_requests)
    rec = (F.when(~ok, "insufficient_data")
           .when((diff > approval_gain) & (pdiff <= max_prob_increase), "promote").otherwise("keep_champion"))
    z = F.lit(0).cast("bigint")
    return r.select(ok.alias("sufficient_data"),
                    F.when(ok, F.col("n")).otherwise(z).alias("total_requests"),
                    F.when(ok, F.col("n0")).otherwise(z).alias("champion_requests"),
                    F.when(ok, F.col("n1")).otherwise(z).alias("challenger_requests"),
                    F.when(ok, F.round(rate0, 4)).otherwise(0.0).alias("champion_approval_rate"),
                    F.when(ok, F.round(rate1, 4)).otherwise(0.0).alias("challenger_approval_rate"),
                    F.when(ok, F.round(diff, 4)).otherwise(0.0).alias("approval_rate_diff"),
                    F.when(ok, F.round(pdiff, 4)).otherwise(0.0).alias("probability_diff"),
                    rec.alias("recommendation"))


def offline_arms(df: DataFrame, request_id: str, champion_p: str, challenger_p: str, label: str,
                 champion_t: float, challenger_t: float, challenger_share: float = 0.30) -> DataFrame:
    """K3: hash split of a scored population into arms (reproducible form of
    the 70/30 random split); each row keeps only its arm's score and decision."""
    arm = assign(F.col(request_id).cast("string"), challenger_share)
    p = F.when(arm == "champion", F.col(champion_p)).otherwise(F.col(challenger_p))
    t = F.when(arm == "champion", F.lit(champion_t)).otherwise(F.lit(challenger_t))
    return df.select(F.col(request_id).alias("request_id"), arm.alias("assignment"), p.alias("prediction_proba"),
                     decision(p, t, upper=False).alias("decision"), F.col(label).alias("actual_default"))


def arm_stats(arms: DataFrame) -> DataFrame:
    """K4 per arm: n, approved, approval rate, mean p, AUC."""
    base = arms.groupBy("assignment").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("decision") == "approve").alias("approved"),
        (F.sum(units(F.col("prediction_proba"))) / (F.count(F.lit(1)) * F.lit(10000.0))).alias("avg_p"))
    a = auc(arms, p="prediction_proba", y="actual_default", by=["assignment"]).select("assignment", "auc")
    return base.join(a, "assignment", "left").select(
        "assignment", "n", "approved", (F.col("approved") / F.col("n")).alias("approval_rate"),
        F.round("avg_p", 4).alias("avg_default_probability"), F.round("auc", 4).alias("auc"))


def _pivot_arms(stats: DataFrame) -> DataFrame:
    c = F.col("assignment") == "champion"
    h = F.col("assignment") == "challenger"
    return stats.agg(*[F.max(F.when(c, F.col(k))).alias(f"{k}_0") for k in ("n", "approved", "auc")],
                     *[F.max(F.when(h, F.col(k))).alias(f"{k}_1") for k in ("n", "approved", "auc")])


def ztest(stats: DataFrame, with_p: bool = False) -> DataFrame:
    """Pooled two-proportion z on approval; z = 0 when se = 0."""
    r = _pivot_arms(stats)
    n0, n1, a0, a1 = (F.col(k).cast("double") for k in ("n_0", "n_1", "approved_0", "approved_1"))
    p0, p1 = a0 / n0, a1 / n1
    pool = (a0 + a1) / (n0 + n1)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / n0 + F.lit(1.0) / n1))
    z = F.when(se > 0, (p0 - p1) / se).otherwise(0.0)
    out = r.select(F.col("n_0").alias("n_champion"), F.col("n_1").alias("n_challenger"),
                   F.round(p0, 4).alias("approval_champion"), F.round(p1, 4).alias("approval_challenger"),
                   F.round(z, 4).alias("z_statistic"), (F.abs(z) > F.lit(Z_CRITICAL_05)).alias("significant_at_05"),
                   # 95 % normal half-widths of each proportion
                   F.round(F.lit(Z_CRITICAL_05) * F.sqrt(p0 * (F.lit(1.0) - p0) / n0), 6).alias("ci95_champion"),
                   F.round(F.lit(Z_CRITICAL_05) * F.sqrt(p1 * (F.lit(1.0) - p1) / n1), 6).alias("ci95_challenger"))
    if with_p:
        out = out.withColumn("p_value", normal_two_sided_udf(F.col("z_statistic")))
    return out


def chi_square_2x2(stats: DataFrame, yates: bool = True, with_p: bool = False) -> DataFrame:
    """Chi-square of the arm × approved table, dof 1, Yates by default."""
    r = _pivot_arms(stats)
    a, c = F.col("approved_0").cast("double"), F.col("approved_1").cast("double")
    b, d = F.col("n_0") - F.col("approved_0"), F.col("n_1") - F.col("approved_1")
    n = F.col("n_0") + F.col("n_1")
    cells = [(a, F.col("n_0"), a + c), (b, F.col("n_0"), b + d), (c, F.col("n_1"), a + c), (d, F.col("n_1"), b + d)]
    chi = None
    for o, rs, cs in cells:
        e = rs * cs / n
        dev = F.abs(o - e)
        if yates:
            dev = F.greatest(dev - F.lit(0.5), F.lit(0.0))
        t = dev * dev / e
        chi = t if chi is None else chi + t
    out = r.select(F.round(chi, 4).alias("chi2_statistic"), F.lit(1).alias("degrees_of_freedom"),
                   (chi > F.lit(3.841458820694124)).alias("significant_at_05"))
    if with_p:
        out = out.withColumn("p_value", chi2_one_dof_udf(F.col("chi2_statistic")))
    return out


def offline_decision(stats: DataFrame) -> DataFrame:
    """K5: promote when challenger AUC ≥ champion AUC and approval ≥ champion's;
    keep otherwise, noting a significant approval difference."""
    r = _pivot_arms(stats)
    z = ztest(stats).select("significant_at_05")
    sig = z.scalar()
    p0 = F.col("approved_0") / F.col("n_0")
    p1 = F.col("approved_1") / F.col("n_1")
    better = F.col("auc_1") >= F.col("auc_0")
    rec = F.when(better & (p1 >= p0), "promote_challenger").otherwise("keep_champion")
    reason = (F.when(better & (p1 >= p0), "challenger_matches_or_beats")
              .when(better & sig, "approval_differs_significantly").otherwise("champion_outperforms"))
    return r.select(F.col("auc_0").alias("auc_champion"), F.col("auc_1").alias("auc_challenger"),
                    rec.alias("recommendation"), reason.alias("reason"))
