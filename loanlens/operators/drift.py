"""Drift detection and monitoring verdicts.

Per feature and window, against a reference window:

* ``method="distance"`` (default): Wasserstein-1 distance ÷ reference
  (population) std for features with more than 5 distinct reference values,
  Jensen–Shannon distance (base 2) for few-valued ones; drift if ≥ 0.1;
* ``method="test"``: two-sample KS, or chi-square of current counts against
  reference shares for few-valued features; drift if p < 0.05;
* always: PSI on reference deciles (shares floored at 1e-6), flag ≥ 0.25.

The deciding method is the caller's choice and never depends on row counts.

Plan: one table of counts by (feature number, value) with a column per window;
0/1 columns need no stacking.  Deciles and ordered statistics use the two-level
prefix-sum plan, so no task ever holds a whole feature, and all windows share
one pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.columns import literal_map, round_ratio
from loanlens.functions.stats import CHI2_CRITICAL_05, KOLMOGOROV_CRITICAL_05
from loanlens.operators.quality import quality_gate
from loanlens.plans.prefix import prefix_sums, quantiles_of_counts, ranged
from loanlens.session import shared_table

# Fixed test settings (our definition; thresholds are arguments below).
DRIFT_THRESHOLD = 0.1
PSI_FLOOR = 1e-6
PSI_FLAG = 0.25
FEW_VALUES = 5
DECILES = [i / 10 for i in range(1, 10)]
KS_LAMBDA_CRIT = KOLMOGOROV_CRITICAL_05
CHI2_CRIT = {d: CHI2_CRITICAL_05[d] for d in range(1, FEW_VALUES)}
MIN_DRIFTED_FOR_RETRAIN = 2
MAX_DRIFT_SHARE = 0.25
APPROVAL_DEVIATION = 0.10


def value_counts(df: DataFrame, features: Sequence[str], windows: Sequence[str], by: str, reference: str | None,
                 binary: Sequence[str] = ()) -> DataFrame:
    """(feature number, value, n_ref, n_0, n_1, ...): how often each value occurs in the reference and each window.

    Columns are stacked inside the map stage and aggregated by (number, value).
    Those listed as ``binary`` hold 0 and 1 only (anything else raises): they are
    stacked by themselves, where the map side keeps two rows a column and window.
    Without a reference ``n_ref`` is 0.
    """
    names = [*([] if reference is None else [reference]), *windows]
    names = [None, *names] if reference is None else names
    cols = ["n_ref", *[f"n_{i}" for i in range(len(windows))]]
    number = {f: i for i, f in enumerate(features)}
    flags = [f for f in features if f in set(binary)]
    rest = [f for f in features if f not in set(binary)]
    df = df.where(F.col(by).isin(*[w for w in names if w is not None]))
    is_in = lambda w: F.col(by) == w if w is not None else F.lit(False)          # noqa: E731
    parts = []
    if rest:
        items = [F.struct(F.lit(number[f]).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in rest]
        parts.append(df.select(F.col(by), F.explode(F.array(*items)).alias("s")).where(F.col("s.value").isNotNull())
                     .groupBy("s.feature", "s.value").agg(*[F.count_if(is_in(w)).alias(c) for w, c in zip(names, cols)]))
    if flags:
        found = df.select(F.col(by).alias("_by"), F.posexplode(F.array(*[F.col(f"`{f}`").cast("double") for f in flags])).alias("_at", "value")).where(
            F.col("value").isNotNull()).groupBy("_by", "_at", "value").agg(F.count(F.lit(1)).alias("n"))        # windows x flags x 2 rows
        name = F.element_at(F.array(*[F.lit(f) for f in flags]), F.col("_at") + 1)
        value = F.when(F.col("value").isin(0.0, 1.0), F.col("value")).otherwise(
            F.raise_error(F.concat(name, F.lit(" holds other values than 0 and 1"))).cast("double"))
        place = F.element_at(F.array(*[F.lit(number[f]) for f in flags]), F.col("_at") + 1)
        has = lambda w: F.col("_by") == w if w is not None else F.lit(False)         # noqa: E731
        parts.append(found.groupBy(place.alias("feature"), value.alias("value")).agg(
            *[F.sum(F.when(has(w), F.col("n")).otherwise(F.lit(0).cast("long"))).alias(c) for w, c in zip(names, cols)]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_features(df: DataFrame, features: Sequence[str], windows: Sequence[str],
                   by: str = "split", reference: str = "train",
                   threshold: float = DRIFT_THRESHOLD, method: str = "distance",
                   psi_flag: float = PSI_FLAG, binary: Sequence[str] = ()) -> DataFrame:
    """One row per (window, feature) with method, statistic, drift flag, PSI.

    NULL values are left out of the distributions (their share is the
    quality gate's job).  All windows share one value grid per feature: the
    distribution functions only step at their own values, so the distances
    are the same as on the two windows' own values.
    """
    counts = value_counts(df, features, windows, by, reference, binary)
    return drift_of_counts(counts, features, windows, threshold, method, psi_flag)


def drift_of_counts(counts: DataFrame, features: Sequence[str], windows: Sequence[str], threshold: float = DRIFT_THRESHOLD,
                    method: str = "distance", psi_flag: float = PSI_FLAG, reference_moments: DataFrame | None = None) -> DataFrame:
    """J2 from (feature number, value, n_ref, n_0, n_1, ...), wherever the counts come from.

    ``reference_moments`` (feature, t_ref, k_ref, mean_ref, edges) spares
    taking them from the counts again.
    """
    features, windows = list(features), list(windows)
    cur = range(len(windows))
    cols = ["n_ref", *[f"n_{i}" for i in cur]]
    counts = ranged(counts, ["feature"], "value")

    # one row per feature
    windows_only = [F.sum(c).alias(f"t{c[1:]}") for c in cols[1:]]
    if reference_moments is None:
        totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), *windows_only, F.count_if(F.col("n_ref") > 0).alias("k_ref"),
                                               (F.sum(F.col("value") * F.col("n_ref")) / F.sum("n_ref")).alias("mean_ref"))
        edges = quantiles_of_counts(counts, ["feature"], "value", "n_ref", DECILES).withColumnRenamed("quantiles", "edges")
        stats = totals.join(edges, "feature")
    else:
        stats = counts.groupBy("feature").agg(*windows_only).join(reference_moments, "feature")
    stats = shared_table(stats, "drift-totals")
    grid = prefix_sums(counts, ["feature"], "value", cols, with_next=True).join(F.broadcast(stats), "feature")

    p = F.col("n_ref") / F.col("t_ref")
    aggs = [F.sqrt(F.sum(F.col("n_ref") * (F.col("value") - F.col("mean_ref")) ** 2) / F.first("t_ref")).alias("std_ref")]
    for i in cur:
        total = F.nullif(F.col(f"t_{i}"), F.lit(0))
        gap = F.abs(F.col("cum_n_ref") / F.col("t_ref") - F.col(f"cum_n_{i}") / total)
        q = F.col(f"n_{i}") / total
        mid = (p + q) / 2
        js = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)
        expect = p * total
        aggs += [F.max(gap).alias(f"ks{i}"),
                 F.sum(F.when(F.col("next_value").isNotNull(), gap * (F.col("next_value") - F.col("value"))).otherwise(0.0)).alias(f"w1{i}"),
                 F.sum(js).alias(f"js{i}"),
                 F.sum(F.when(p > 0, (F.col(f"n_{i}") - expect) ** 2 / expect).otherwise(0.0)).alias(f"chi{i}")]
    per = grid.groupBy("feature").agg(*aggs)

    # PSI on reference deciles: at most ten bins per feature
    b = F.aggregate(F.col("edges"), F.lit(0), lambda acc, e: acc + (F.col("value") > e).cast("int"))
    bins = counts.join(F.broadcast(stats), "feature").groupBy("feature", b.alias("bin")).agg(
        *[F.sum(c).alias(c) for c in cols], *[F.first(f"t{c[1:]}").alias(f"t{c[1:]}") for c in cols])
    pr = F.greatest(F.col("n_ref") / F.col("t_ref"), F.lit(PSI_FLOOR))
    shares = [F.greatest(F.col(f"n_{i}") / F.nullif(F.col(f"t_{i}"), F.lit(0)), F.lit(PSI_FLOOR)) for i in cur]
    psi = bins.groupBy("feature").agg(*[F.sum((s - pr) * F.log(s / pr)).alias(f"psi{i}") for i, s in enumerate(shares)])

    rows = [F.struct(F.lit(w).alias("window"), F.col(f"t_{i}").alias("tot_cur"), *[F.col(f"{x}{i}").alias(x) for x in ("ks", "w1", "js", "chi", "psi")])
            for i, w in enumerate(windows)]
    r = per.join(stats, "feature").join(psi, "feature").withColumn("s", F.explode(F.array(*rows)))
    r = r.select("feature", "k_ref", "std_ref", F.col("t_ref").alias("tot_ref"), "s.*").where("tot_cur > 0")

    kinds = {"distance": ("wasserstein", "jensenshannon"), "test": ("ks", "chisquare")}[method]
    kind = F.when(F.col("k_ref") > FEW_VALUES, kinds[0]).otherwise(kinds[1])
    en = F.sqrt(F.col("tot_ref") * F.col("tot_cur") / (F.col("tot_ref") + F.col("tot_cur")))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * F.col("ks")
    crit = F.try_element_at(literal_map(CHI2_CRIT), (F.col("k_ref") - 1).cast("int"))
    wnorm = F.when(F.col("std_ref") > 0, F.col("w1") / F.col("std_ref"))
    stat = (F.when(kind == "ks", F.col("ks")).when(kind == "chisquare", F.col("chi"))
            .when(kind == "wasserstein", wnorm).otherwise(F.sqrt(F.col("js") / 2)))
    drift = (F.when(kind == "ks", lam > F.lit(KS_LAMBDA_CRIT))
             .when(kind == "chisquare", F.coalesce(F.col("chi") > crit, F.lit(False)))
             .otherwise(F.coalesce(stat >= F.lit(threshold), F.lit(False))))
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return r.select("window", name.alias("feature"), kind.alias("method"), F.round(stat, 6).alias("statistic"),
                    drift.alias("drift_detected"), F.round(F.col("psi"), 6).alias("psi"),
                    (F.col("psi") >= F.lit(psi_flag)).alias("psi_flag"),
                    F.col("tot_ref").alias("n_reference"), F.col("tot_cur").alias("n_current"))


def drift_verdict(features: DataFrame, min_features: int = MIN_DRIFTED_FOR_RETRAIN) -> DataFrame:
    """Per window — drifted list, share (4 dp), clean / investigate / real_drift."""
    r = features.groupBy("window").agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if("drift_detected").alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted"))
    n = F.col("n_drifted")
    ftype = F.when(n == 0, "clean").when(n < min_features, "investigate").otherwise("real_drift")
    action = F.when(n == 0, "none").when(n < min_features, "review_feature").otherwise("retrain_candidate")
    return r.select("window", (n > 0).alias("drift_detected"), ftype.alias("failure_type"),
                    F.concat_ws(",", "drifted").alias("drifted_features"), "n_drifted", "n_features",
                    round_ratio(n, F.col("n_features"), 4).alias("drift_score"), action.alias("recommended_action"))


def retrain_decision(verdict: DataFrame, approval: DataFrame, quality: DataFrame | None = None,
                     baseline: float | None = None, max_share: float = MAX_DRIFT_SHARE,
                     min_features: int = MIN_DRIFTED_FOR_RETRAIN,
                     deviation: float = APPROVAL_DEVIATION) -> DataFrame:
    """J4 + J5: retrain if (real drift, share > max_share, ≥ min_features) or
    |approval − baseline| > deviation or a critical quality failure.  A quality
    ``pipeline_bug`` short-circuits the drift result (share 0, no drift).

    ``approval``: (window, approval_rate[, baseline_approval_rate]).
    ``baseline=None`` uses the ``baseline_approval_rate`` column.
    """
    v = approval.join(verdict, "window", "left")
    if quality is not None:
        v = v.join(quality.select("window", F.col("failure_type").alias("q_type"), "severity"), "window", "left")
        bug = F.coalesce(F.col("q_type") == "pipeline_bug", F.lit(False))
        critical = F.coalesce(F.col("severity") == "critical", F.lit(False))
    else:
        bug = critical = F.lit(False)
    base = F.lit(float(baseline)) if baseline is not None else F.col("baseline_approval_rate")
    drift_rule = ((F.col("failure_type") == "real_drift") & (F.col("drift_score") > max_share)
                  & (F.col("n_drifted") >= min_features))
    appr_rule = F.coalesce(F.abs(F.col("approval_rate") - base) > deviation, F.lit(False))
    drift_rule = F.coalesce(drift_rule, F.lit(False))
    retrain = F.when(bug, critical).otherwise(drift_rule | appr_rule | critical)
    return v.select(
        "window",
        F.when(bug, F.lit(False)).otherwise(F.coalesce("drift_detected", F.lit(False))).alias("drift_detected"),
        F.when(bug, F.lit("pipeline_bug")).otherwise(F.coalesce("failure_type", F.lit("clean"))).alias("failure_type"),
        F.when(bug, F.lit("")).otherwise(F.coalesce("drifted_features", F.lit(""))).alias("drifted_features"),
        F.when(bug, F.lit(0.0)).otherwise(F.coalesce("drift_score", F.lit(0.0))).alias("drift_score"),
        "approval_rate", base.alias("baseline_approval_rate"),
        retrain.alias("should_retrain"),
        F.when(bug, F.lit("fix_data")).when(retrain, F.lit("retrain")).otherwise(F.lit("none")).alias("action"))


VERDICT_SCHEMA = ("window string, drift_detected boolean, failure_type string, drifted_features string, n_drifted long, n_features long, "
                  "drift_score double, recommended_action string")


def monitor(df: DataFrame, features: Sequence[str], windows: Sequence[str], approval: DataFrame, by: str = "split",
            reference: str = "train", binary: Sequence[str] = ()) -> DataFrame:
    """Quality gate, then drift of the windows that pass it, then the retrain verdict of all.

    The gate's result (a row per window) is taken first; windows with a
    pipeline bug never enter the drift job.
    """
    gate = shared_table(quality_gate(df, features, by, reference), "quality-gate")
    bugged = {r["window"] for r in gate.where(F.col("failure_type") == "pipeline_bug").collect()}
    sound = [w for w in windows if w not in bugged]
    verdict = (drift_verdict(drift_features(df, features, sound, by, reference, binary=binary)) if sound else
               df.sparkSession.createDataFrame([], VERDICT_SCHEMA))
    return retrain_decision(verdict, approval.where(F.col("window").isin(*windows)), quality=gate)


def latest_entry(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Newest monitoring entry with its approval delta vs the baseline."""
    r = log.agg(F.max_by(F.struct(*log.columns), F.col(ts)).alias("e")).select("e.*")
    if {"approval_rate", "baseline_approval_rate"} <= set(log.columns):
        r = r.withColumn("approval_delta", F.col("approval_rate") - F.col("baseline_approval_rate"))
    return r


def history(log: DataFrame) -> DataFrame:
    """E5: the monitoring history as a flat table."""
    cols = [c for c in ("timestamp", "window", "failure_type", "drift_score", "approval_rate",
                        "should_retrain") if c in log.columns]
    return log.select(*cols)
