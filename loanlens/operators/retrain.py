"""The retraining loop (I16): from a monitoring verdict to a registered candidate, restartable at every step.

Steps: decide (which windows ask for it), fit and save a candidate, test it,
register it.  Each step leaves a small document under its run's folder, and a
run that is started again takes up after the last one, so a lost driver repeats
at most one step.  Registering is keyed by the run, so it happens once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.learn import load_model, register_candidate, save_model


def _document(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.text(path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(row[0]) if row else None


def _step(spark: SparkSession, path: str, work: Callable[[], dict]) -> dict:
    """The step's document; the work is done only if there is none."""
    doc = _document(spark, path)
    if doc is None:
        doc = work()
        spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string").coalesce(1).write.mode("overwrite").text(path)
    return doc


def retrain(spark: SparkSession, folder: str, run_id: str, verdict: DataFrame, fit: Callable[[list[str]], object],
            test: Callable[[object], float], registry: str, name: str) -> DataFrame:
    """Rows (step, detail) of one run.

    ``verdict`` is the J4 table (a row per window).  Windows whose action is
    ``retrain`` count; broken data (``fix_data``) is not trained on.  ``fit``
    gets their labels and returns a fitted model, ``test`` the AUC of a
    reloaded one.  Without such a window the run ends after its first step.
    """
    base = f"{folder}/{run_id}"
    wanted = _step(spark, f"{base}/decide", lambda: {"windows": sorted(
        r["window"] for r in verdict.where(F.col("should_retrain") & (F.col("action") == "retrain")).select("window").collect())})
    steps = [("decide", ",".join(wanted["windows"]))]
    if wanted["windows"]:
        def fitted() -> dict:
            save_model(fit(wanted["windows"]), f"{base}/candidate", {"windows": wanted["windows"], "run_id": run_id})
            return {"path": f"{base}/candidate"}

        made = _step(spark, f"{base}/fit", fitted)
        found = _step(spark, f"{base}/test", lambda: {"auc": float(test(load_model(spark, made["path"])[0]))})
        done = _step(spark, f"{base}/register", lambda: {"decision": register_candidate(spark, registry, name, found["auc"], made["path"], run_id)})
        steps += [("fit", "saved"), ("test", f"{found['auc']:.6f}"), ("register", done["decision"])]
    return spark.createDataFrame(steps, "step string, detail string")
