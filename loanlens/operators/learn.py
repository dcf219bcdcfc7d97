"""Learners, champion choice, scoring with learned models, importances (I3–I8,
I13, I14, I16, I17, D37).

Training is Spark ML (distributed).  Class weights are a ``weightCol``; boosted
trees with patience on the validation AUC are in
:mod:`loanlens.operators.boosting`.  Permutation importance pairs every row with one
donor row per repeat (one distributed sort for all repeats), and swaps the
features one at a time inside the map stage; only counts by (feature, repeat,
score) are shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlens.operators.boosting import BoostedModel, boosting_rows, halving_search
from loanlens.operators.evaluate import auc, auc_of_counts
from loanlens.plans.prefix import numbered
from loanlens.session import create_exclusive, shared_table


def _q(c: str) -> str:
    return f"`{c}`"


def class_weights(df: DataFrame, label: str = "default", mode: str = "balanced") -> DataFrame:
    """Adds ``w``: balanced n/(2·n_c) (logistic) or n_neg/n_pos on positives (trees)."""
    c = df.agg(F.struct(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))).scalar()
    n0, n1 = c["n0"], c["n1"]
    n = n0 + n1
    if mode == "balanced":
        w = F.when(F.col(label) == 1, n / (F.lit(2.0) * n1)).otherwise(n / (F.lit(2.0) * n0))
    else:
        w = F.when(F.col(label) == 1, n0 / n1.cast("double")).otherwise(F.lit(1.0))
    return df.withColumn("w", w.cast("double"))


def logistic_pipeline(features: Sequence[str], label: str = "default", C: float = 0.5,
                      max_iter: int = 2000, weight_sum: float | None = None) -> Pipeline:
    """Scaled inputs, L2, C → regParam = 1/(C·Σw) so the objective equals
    C·Σ w·loss + ½‖β‖² up to a constant factor."""
    reg = 1.0 / (C * weight_sum) if weight_sum else 0.0
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol="w", maxIter=max_iter,
                           regParam=reg, elasticNetParam=0.0, standardization=False)])


def stratified_split(df: DataFrame, key: str, label: str = "default", share: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` plus ``part``: the first floor(share * n) rows of each class by
    md5 of the key are ``val``, the others ``train``.

    Rows are ranked by one distributed sort; a class's offset is the least
    place of its rows.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    placed = numbered(df.withColumn("_h", h), [F.col(label), F.col("_h"), F.col(key)], "stratified")
    first = placed.groupBy(label).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))       # a row per class
    in_val = F.col("_number") - F.col("_first") < F.floor(F.col("_n") * F.lit(share))
    return placed.join(F.broadcast(first), label).withColumn("part", F.when(in_val, "val").otherwise("train")).select(*df.columns, "part")


def parameter_search(train: DataFrame, val: DataFrame, features: Sequence[str], trials: int = 50, seed: int = 42,
                     label: str = "default", max_iter: int = 500, space: dict | None = None, threads: int = 4) -> tuple[dict, list[dict]]:
    """Seeded search of the boosted learner's eight parameters by validation AUC; the best trial and all trials.

    ``train`` and ``val`` carry ``w``.  Half of the trials go on after an
    eighth, a quarter and half of ``max_iter`` rounds each (see
    :func:`loanlens.operators.boosting.halving_search`).
    """
    both = train.withColumn("is_val", F.lit(False)).unionByName(val.withColumn("is_val", F.lit(True)))
    rungs = sorted({max(1, max_iter // k) for k in (8, 4, 2, 1)})
    _, found = halving_search(boosting_rows(both, features, label), features, trials=trials, rungs=rungs, threads=threads, seed=seed, space=space)
    return max(found, key=lambda x: x["auc"]), found


def score(model: PipelineModel | BoostedModel, df: DataFrame, keep: Sequence[str] = ("app_id", "split", "default"),
          threshold: float = 0.5, version: str = "model") -> DataFrame:
    """I8: probability of class 1 (4 dp), decision, threshold and version, of a fitted pipeline or a boosted model."""
    if isinstance(model, BoostedModel):
        out, p = model.with_margin(df, "_margin"), F.round(1 / (1 + F.exp(-F.col("_margin"))), 4)
    else:
        out, p = model.transform(df), F.round(vector_to_array("probability")[1], 4)
    return out.select(*keep, p.alias("p"), F.when(p >= threshold, "DENY").otherwise("APPROVE").alias("decision"),
                      F.lit(float(threshold)).alias("threshold_used"), F.lit(version).alias("model_version"))


def compare_models(scored: dict[str, DataFrame], label: str = "default") -> DataFrame:
    """D37 + I6: AUC per model on the same rows, sorted; champion = highest,
    first in the given order on ties."""
    parts = [s.select(F.lit(name).alias("model"), F.lit(i).alias("order"), "p", label) for i, (name, s) in enumerate(scored.items())]
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    a = auc(allp, y=label, by=["model", "order"])
    best = Window.orderBy(F.col("auc").desc(), F.col("order").asc())
    return a.select("model", F.round("auc", 6).alias("val_auc"), "positives", "negatives",
                    (F.row_number().over(best) == 1).alias("is_champion")).orderBy(F.col("val_auc").desc())


def feature_importance(spark: SparkSession, model: BoostedModel) -> DataFrame:
    """Each feature's share of the boosted trees' split gains, as rows (one per feature)."""
    return spark.createDataFrame(model.importance(), "feature string, importance double")


def with_donors(df: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """Each row ``repeats`` times with ``r`` and ``donor``, the features of another row.

    Rows stand in the order of md5(key); in repeat r a row's donor is the row
    a hash-drawn number of places further on, round the end.  One global sort
    serves all repeats.  The join is a merge join, whatever the written rows
    weigh: equal values make a file far smaller than its rows in memory.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    placed = shared_table(numbered(df.withColumn("_h", h), [F.col("_h"), F.col(key)], "permutation").drop("_h"), "permuted-rows")
    n = placed.count()
    if not n:
        return placed.drop("_number").withColumns({"r": F.lit(0), "donor": F.array(*[F.col(_q(c)) for c in features])})
    shifts = [1 + int(hashlib.md5(f"{seed}|{r}".encode()).hexdigest()[:12], 16) % max(1, n - 1) for r in range(repeats)]
    moved = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), ((F.col("_number") - s + n) % n).alias("to")) for r, s in enumerate(shifts)]))
    donors = placed.select(F.array(*[F.col(_q(c)).cast("double") for c in features]).alias("donor"), moved.alias("m")).select(
        "donor", "m.r", F.col("m.to").alias("_number"))
    return placed.hint("merge").join(donors.hint("merge"), "_number").drop("_number")


def permutation_importance(margins, df: DataFrame, features: Sequence[str], key: str = "app_id",
                           label: str = "default", repeats: int = 10, seed: int = 42) -> DataFrame:
    """AUC drop when one feature takes another row's values, mean and std over repeats.

    ``margins(rows)`` adds ``p`` to rows with the feature columns: a fitted
    pipeline's probability or a scorecard's expression.
    """
    feats = list(features)
    base = df.select(key, label, *[F.col(_q(c)) for c in feats])
    rows = with_donors(base, key, feats, repeats, seed)
    # one variant per feature, made and scored where the row stands
    variant = rows.withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(len(feats))])))
    swapped = variant.select("j", "r", label, *[F.when(F.col("j") == j, F.col("donor")[j]).otherwise(F.col(_q(c)).cast("double")).alias(c)
                                                for j, c in enumerate(feats)])
    counts = margins(swapped).groupBy("j", "r", F.col("p").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    a = auc_of_counts(shared_table(counts, "permutation-scores"), ["j", "r"])
    b = auc(margins(base), y=label).select("auc").scalar()
    names = F.element_at(F.array(*[F.lit(c) for c in feats]), F.col("j") + 1)
    drops = a.select(names.alias("feature"), (b - F.col("auc")).alias("drop"))
    return drops.groupBy("feature").agg(F.round(F.avg("drop"), 6).alias("perm_importance_mean"),
                                        F.round(F.stddev_pop("drop"), 6).alias("perm_importance_std"))


def pipeline_probability(model: PipelineModel):
    """A fitted pipeline as the scoring function of :func:`permutation_importance`."""
    return lambda rows: model.transform(rows).withColumn("p", F.round(vector_to_array("probability")[1], 4))


# ---------------------------------------------------------------- A13, I17
def save_model(model: PipelineModel | BoostedModel, path: str, metadata: dict) -> None:
    """The fitted model and its metadata document (kind, columns, threshold, metrics) side by side."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, BoostedModel):
        model.save(f"{path}/model")
        metadata = {**metadata, "kind": "boosted"}
    else:
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "doc string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel | BoostedModel, dict]:
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    boosted = meta.get("kind") == "boosted"
    return (BoostedModel.load(spark, f"{path}/model") if boosted else PipelineModel.load(f"{path}/model")), meta


REGISTRY_SCHEMA = "model_name string, version int, decision string, new_auc double, old_auc double, path string, run_id string"


def register_candidate(spark: SparkSession, registry: str, name: str, new_auc: float, path: str, run_id: str | None = None) -> str:
    """I16 + I17: put a candidate into the registry; it is promoted iff its AUC beats the champion's.

    Every version is a file of its own that can be created only once.  A
    writer whose version number was taken meanwhile reads the registry again,
    so two writers get two versions and each meets the champion before it.
    The first version meets an AUC of 0.  A ``run_id`` that is registered
    already adds nothing and returns its decision.
    """
    while True:
        log = read_registry(spark, registry).where(F.col("model_name") == name)
        known = log.where(F.col("run_id") == run_id).select("decision").first() if run_id is not None else None
        if known:
            return known[0]
        old = champion(log).select("new_auc").first()
        old_auc = old[0] if old else 0.0
        version = (log.agg(F.max("version")).first()[0] or 0) + 1
        decision = "promoted" if new_auc > old_auc else "kept_existing"
        entry = {"model_name": name, "version": version, "decision": decision, "new_auc": float(new_auc), "old_auc": float(old_auc),
                 "path": path, "run_id": run_id}
        if create_exclusive(spark, f"{registry}/{name}-{version:09d}.json", json.dumps(entry) + "\n"):
            return decision


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """All versions; a file that its writer has not filled yet has no row."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).json(registry).where("version is not null")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def champion(registry: DataFrame) -> DataFrame:
    """The latest promoted version of each model name."""
    return registry.where(F.col("decision") == "promoted").groupBy("model_name").agg(
        F.max_by(F.struct("version", "new_auc", "path"), "version").alias("c")).select("model_name", "c.*")
