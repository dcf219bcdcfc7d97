"""Stored reference profiles: what monitoring needs to know of the reference rows (J1–J3, J6, ST4).

A profile holds, for one reference window, how often each feature takes each
value, and per feature the rows, NULLs and range.  All of it is counts, sums,
minima and maxima, so profiles of parts merge into the profile of the whole.
Saved profiles also carry what follows from the counts (totals, distinct values,
means, deciles), and are versioned: a version is written in full, then committed
by a file that can be created only once.

Judging a window reads the window's rows and the profile; the reference rows are
not read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators import drift as dr
from loanlens.operators.quality import profile as column_profile, quality_gate
from loanlens.plans.prefix import quantiles_of_counts, ranged
from loanlens.session import create_exclusive, shared_table


@dataclass(frozen=True)
class ReferenceProfile:
    """``counts``: (feature, value, n); ``ranges``: (feature, n, n_null, min, max); ``moments``: (feature, t_ref, k_ref, mean_ref, edges), of saved ones."""

    counts: DataFrame
    ranges: DataFrame
    features: tuple[str, ...]
    baseline_approval: float | None = None
    moments: DataFrame | None = None

    def merge(self, other: ReferenceProfile) -> ReferenceProfile:
        """The profile of both parts' rows together (the baseline approval of this one is kept)."""
        counts = self.counts.unionByName(other.counts).groupBy("feature", "value").agg(F.sum("n").alias("n"))
        ranges = self.ranges.unionByName(other.ranges).groupBy("feature").agg(
            F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("min").alias("min"), F.max("max").alias("max"))
        return ReferenceProfile(counts, ranges, self.features, self.baseline_approval)


def reference_profile(df: DataFrame, features: Sequence[str], binary: Sequence[str] = (), baseline_approval: float | None = None) -> ReferenceProfile:
    """Profile of all rows of ``df``; columns listed as ``binary`` hold 0 and 1 only (see :func:`loanlens.operators.drift.value_counts`)."""
    rows = df.select(F.lit("reference").alias("_w"), *[F.col(f"`{c}`") for c in features])
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("feature") + 1)
    counts = dr.value_counts(rows, features, [], "_w", "reference", binary).select(name.alias("feature"), "value", F.col("n_ref").alias("n"))
    ranges = column_profile(rows, features, "_w").drop("window")
    return ReferenceProfile(counts, ranges, tuple(features), baseline_approval)


def save_profile(spark: SparkSession, p: ReferenceProfile, path: str) -> int:
    """Write the next version and commit it; returns its number.  Writers that meet take the following numbers."""
    part = f"{path}/data/{uuid.uuid4().hex}"
    c = ranged(p.counts, ["feature"], "value")
    c.drop("_range").write.parquet(f"{part}/counts")
    p.ranges.write.parquet(f"{part}/ranges")
    totals = c.groupBy("feature").agg(F.sum("n").alias("t_ref"), F.count(F.lit(1)).alias("k_ref"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean_ref"))
    edges = quantiles_of_counts(c, ["feature"], "value", "n", dr.DECILES).withColumnRenamed("quantiles", "edges")
    totals.join(edges, "feature").write.parquet(f"{part}/moments")
    version = (latest_version(spark, path) or 0) + 1
    doc = {"data": part, "features": list(p.features), "baseline_approval": p.baseline_approval}
    while not create_exclusive(spark, f"{path}/versions/{version:09d}.json", json.dumps({**doc, "version": version}) + "\n"):
        version += 1
    return version


_COMMIT = "version int, data string, features array<string>, baseline_approval double"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT).json(f"{path}/versions").where("version is not null")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return _commits(spark, path).agg(F.max("version")).first()[0]


def load_profile(spark: SparkSession, path: str, version: int | None = None) -> ReferenceProfile:
    """The given version, or the latest."""
    wanted = version or latest_version(spark, path)
    row = _commits(spark, path).where(F.col("version") == wanted).first()
    if row is None:
        raise ValueError(f"no version {wanted} of a profile in {path}")
    part = row["data"]
    return ReferenceProfile(
        spark.read.schema("feature string, value double, n long").parquet(f"{part}/counts"),
        spark.read.schema("feature string, n long, n_null long, min double, max double").parquet(f"{part}/ranges"),
        tuple(row["features"]), row["baseline_approval"],
        spark.read.schema("feature string, t_ref long, k_ref long, mean_ref double, edges array<double>").parquet(f"{part}/moments"))


def drift_against(df: DataFrame, p: ReferenceProfile, windows: Sequence[str], by: str = "split", binary: Sequence[str] = (), **options) -> DataFrame:
    """J2 of the windows' rows in ``df`` against a profile: same result as with the reference rows in ``df``."""
    features, windows = list(p.features), list(windows)
    number = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")).cast("int") - 1
    cols = [f"n_{i}" for i in range(len(windows))]
    zero = F.lit(0).cast("long")
    stored = p.counts.select(number.alias("feature"), "value", F.col("n").alias("n_ref"), *[zero.alias(c) for c in cols])
    new = dr.value_counts(df.where(F.col(by).isin(*windows)), features, windows, by, None, binary)
    counts = stored.unionByName(new).groupBy("feature", "value").agg(*[F.sum(c).alias(c) for c in ("n_ref", *cols)])
    moments = p.moments.withColumn("feature", number) if p.moments is not None else None
    return dr.drift_of_counts(counts, features, windows, reference_moments=moments, **options)


def monitor_against(df: DataFrame, p: ReferenceProfile, windows: Sequence[str], approval: DataFrame, by: str = "split", binary: Sequence[str] = ()) -> DataFrame:
    """J5–J7 with a stored reference: quality gate, drift of the windows that pass it, retrain verdict of all.

    ``approval``: (window, approval_rate); the baseline is the profile's.
    """
    rows = df.where(F.col(by).isin(*windows))
    gate = shared_table(quality_gate(rows, p.features, by, reference_ranges=p.ranges), "quality-gate")
    bugged = {r["window"] for r in gate.where(F.col("failure_type") == "pipeline_bug").collect()}        # a row per window
    sound = [w for w in windows if w not in bugged]
    verdict = dr.drift_verdict(drift_against(rows, p, sound, by, binary)) if sound else df.sparkSession.createDataFrame([], dr.VERDICT_SCHEMA)
    return dr.retrain_decision(verdict, approval.where(F.col("window").isin(*windows)), quality=gate, baseline=p.baseline_approval)
