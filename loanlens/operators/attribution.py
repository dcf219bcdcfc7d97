"""Attribution for linear margins.

For a margin z = b + Σ w_i·x_i, the Shapley value of feature i with an
interventional baseline is exactly φ_i = w_i·(x_i − E[x_i]); so attribution is
plain column arithmetic over ALL rows (no sampling), and Σφ + base = z.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.operators.scoring import Card


def _phis(df: DataFrame, card: Card, reference: DataFrame):
    means = _means(card, reference)
    return {c: F.lit(w) * (F.col(f"`{c}`") - means[f"m{i}"]) for i, (c, w, _) in enumerate(card.terms)}


def _means(card: Card, reference: DataFrame):
    """Reference means of all terms from one scan."""
    return reference.agg(F.struct(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, (c, _, _) in enumerate(card.terms)])).scalar()


def global_attribution(df: DataFrame, card: Card, reference: DataFrame | None = None, top: int = 15,
                       by: str | None = None) -> DataFrame:
    """I9 + F3: mean |φ| per feature (optionally per period), top features."""
    ph = _phis(df, card, reference if reference is not None else df)
    keys = [by] if by else []
    r = df.groupBy(*keys).agg(*[F.avg(F.abs(v)).alias(f"_a{i}") for i, v in enumerate(ph.values())])
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"_a{i}").alias("mean_abs_attribution"))
             for i, c in enumerate(ph)]
    long = r.select(*keys, F.explode(F.array(*items)).alias("s")).select(*keys, "s.*")
    long = long.select(*keys, "feature", F.round("mean_abs_attribution", 6).alias("mean_abs_attribution"))
    return long if by else long.orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top)


def local_attribution(row: DataFrame, card: Card, reference: DataFrame) -> DataFrame:
    """φ of the given row(s), with base value and margin (Σφ + base = margin)."""
    ph = _phis(row, card, reference)
    base = F.lit(card.intercept)
    means = _means(card, reference)
    for i, (c, w, ctr) in enumerate(card.terms):
        base = base + F.lit(w) * (means[f"m{i}"] - F.lit(ctr))
    items = [F.struct(F.lit(c).alias("feature"), F.round(v, 6).alias("attribution")) for c, v in ph.items()]
    return row.select("app_id", F.round(base, 6).alias("base_value"), F.round(card.margin(), 6).alias("margin"),
                      F.explode(F.array(*items)).alias("s")).select("app_id", "base_value", "margin", "s.*")


def attribution_drift(df: DataFrame, card: Card, reference: DataFrame, period: str, a: str, b: str) -> DataFrame:
    """I12 + F4: mean |φ| in two periods, change, sorted by |change|."""
    g = global_attribution(df.where(F.col(period).isin(a, b)), card, reference, by=period)
    p = g.groupBy("feature").agg(F.max(F.when(F.col(period) == a, F.col("mean_abs_attribution"))).alias("period_a"),
                                 F.max(F.when(F.col(period) == b, F.col("mean_abs_attribution"))).alias("period_b"))
    return p.select("feature", "period_a", "period_b", F.round(F.col("period_b") - F.col("period_a"), 6).alias("change")) \
            .orderBy(F.abs(F.col("change")).desc(), "feature")
