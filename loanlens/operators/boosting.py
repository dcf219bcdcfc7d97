"""Boosted trees with patience on the validation AUC.

Spark ML fits every tree, as a weighted regression on Newton steps: target
(y - p) / p(1 - p), weight w p(1 - p), so that its split gains are the boosted
gains of second order.  Gradient sums by leaf (one small aggregate) then give
what Spark ML has no setting for: leaf values under both leaf penalties, the
pruning of splits below a least gain, and a bound on the leaves.

Each row's margin lives in a written table.  Trees are added in blocks: inside a
block the margins of its trees are pending columns, at its end they are written,
which cuts the lineage.  The validation AUC of every round of a block comes from
one table of counts by (round, margin).  Boosting ends ``patience`` rounds after
the best AUC, and the model keeps the trees up to that best round.
"""

from __future__ import annotations

import json
import math
import random
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loanlens.operators.evaluate import auc_of_counts
from loanlens.session import scratch_path, shared_table

MIN_SPREAD = 1e-6       # least p(1 - p) of a row


@dataclass(frozen=True)
class BoostParams:
    """Defaults: the reference's first boosted learner (I4)."""

    max_rounds: int = 800
    depth: int = 7
    step: float = 0.03
    subsample: float = 0.75
    feature_fraction: float = 0.75
    min_child_weight: float = 5.0       # least sum of second derivatives in a node
    min_instances: int = 1
    min_gain: float = 0.1
    leaf_l1: float = 0.1
    leaf_l2: float = 1.0
    max_leaves: int = 1 << 30
    patience: int = 40
    block: int = 6                      # the code that applies more than 8 pending trees is over 8000 bytes, which the JVM interprets
    bins: int = 64
    seed: int = 42


#: The second boosted learner (I5): at most 63 leaves and 40 rows a leaf.
SECOND = BoostParams(max_rounds=600, min_child_weight=0.0, min_instances=40, min_gain=0.0, max_leaves=63, seed=43)


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder.  ``left`` and ``right`` are node numbers, -1 in leaves; a row goes left if its value is at most the threshold."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]            # of leaves, before the learning rate
    cover: tuple[float, ...]            # rows of the fit
    gain: tuple[float, ...]             # of splits

    def leaves(self) -> list[int]:
        return [i for i, x in enumerate(self.left) if x < 0]


def _parsed(debug: str) -> tuple[list, list, list, list]:
    """(feature, threshold, left, right) of a fitted tree's printed form, nodes in preorder."""
    lines = [x.strip() for x in debug.splitlines()[1:] if x.strip()]
    feature, threshold, left, right = [], [], [], []
    at = 0

    def node() -> int:
        nonlocal at
        me, line = len(feature), lines[at]
        at += 1
        split = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        feature.append(int(split[1]) if split else -1)
        threshold.append(float(split[2]) if split else 0.0)
        left.append(-1)
        right.append(-1)
        if split:
            left[me] = node()
            at += 1                     # the line "Else"
            right[me] = node()
        return me

    node()
    return feature, threshold, left, right


def build_tree(debug: str, features: Sequence[int], sums: dict[int, tuple[float, float, int]], p: BoostParams) -> tuple[Tree, list[float]]:
    """The pruned tree, and the value of each leaf of the fitted one (in preorder, as Spark ML numbers them).

    ``sums``: gradient, second derivative and rows by fitted leaf.
    """
    feature, threshold, left, right = _parsed(debug)
    n = len(feature)
    fitted = [i for i in range(n) if left[i] < 0]
    g, h, rows = ([0.0] * n for _ in range(3))
    for k, i in enumerate(fitted):
        g[i], h[i], rows[i] = sums.get(k, (0.0, 0.0, 0))
    for i in reversed(range(n)):
        if left[i] >= 0:
            for x in (g, h, rows):
                x[i] = x[left[i]] + x[right[i]]
    shrunk = [math.copysign(max(abs(x) - p.leaf_l1, 0.0), x) for x in g]
    score = [s * s / (x + p.leaf_l2) if x + p.leaf_l2 > 0 else 0.0 for s, x in zip(shrunk, h)]
    gain = [(score[left[i]] + score[right[i]] - score[i]) / 2 if left[i] >= 0 else 0.0 for i in range(n)]
    closed = [x < 0 for x in left]
    tips = lambda: [i for i in range(n) if not closed[i] and closed[left[i]] and closed[right[i]]]      # noqa: E731
    for i in reversed(range(n)):
        if not closed[i] and closed[left[i]] and closed[right[i]] and gain[i] < p.min_gain:
            closed[i] = True
    value = [s / (x + p.leaf_l2) if x + p.leaf_l2 > 0 else 0.0 for s, x in zip(shrunk, h)]

    def grown(i: int) -> int:
        return 1 if closed[i] else grown(left[i]) + grown(right[i])

    for _ in range(max(0, grown(0) - p.max_leaves)):
        closed[min(tips(), key=lambda i: gain[i])] = True
    out: list[list] = [[] for _ in range(7)]
    given: list[float] = [0.0] * n

    def keep(i: int) -> int:
        me = len(out[0])
        last = closed[i]
        for col, x in zip(out, (-1 if last else features[feature[i]], 0.0 if last else threshold[i], -1, -1, value[i] if last else 0.0, rows[i],
                                0.0 if last else gain[i])):
            col.append(x)
        if last:
            below = [i]
            while below:
                j = below.pop()
                given[j] = value[i]
                below += [left[j], right[j]] if left[j] >= 0 else []
        else:
            out[2][me] = keep(left[i])
            out[3][me] = keep(right[i])
        return me

    keep(0)
    return Tree(*map(tuple, out)), [given[i] for i in fitted]


@dataclass(frozen=True)
class BoostedModel:
    """The trees of the best round; margin = base + step x the sum of the leaf values."""

    features: tuple[str, ...]
    trees: tuple[Tree, ...]
    base: float
    step: float
    history: tuple[float, ...] = ()     # validation AUC by round, also of rounds that were cut off
    params: dict = field(default_factory=dict)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for t in self.trees:
            feature, threshold, left, right, value = (np.array(c) for c in (t.feature, t.threshold, t.left, t.right, t.value))
            node = np.zeros(len(x), int)
            while (inner := left[node] >= 0).any():
                goes = x[row, feature[node]] <= threshold[node]
                node = np.where(inner, np.where(goes, left[node], right[node]), node)
            out += self.step * value[node]
        return out

    def with_margin(self, df: DataFrame, out: str = "margin") -> DataFrame:
        """``df`` plus the margin; a NULL feature goes right at every split, as it does in the fit."""
        cols, n = df.columns, len(self.features)
        wide = df.withColumn("_x", F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in self.features]))
        schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = b.column(len(cols)).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(self.margins(x))], schema.names)

        return wide.toDF(*[f"_{i}" for i in range(len(cols) + 1)]).mapInArrow(run, schema)         # dots in names do not pass through

    def importance(self) -> list[tuple[str, float]]:
        """Each feature's share of all split gains."""
        total = [0.0] * len(self.features)
        for t in self.trees:
            for f, x in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += x
        return [(c, x / sum(total) if sum(total) else 0.0) for c, x in zip(self.features, total)]

    def save(self, path: str) -> None:
        doc = json.dumps(asdict(self), sort_keys=True)
        SparkSession.getActiveSession().createDataFrame([(doc,)], "doc string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        d = json.loads(spark.read.text(path).first()[0])
        return cls(tuple(d["features"]), tuple(Tree(*(tuple(t[c]) for c in Tree.__dataclass_fields__)) for t in d["trees"]),
                   d["base"], d["step"], tuple(d["history"]), d["params"])


def boosting_rows(rows: DataFrame, features: Sequence[str], label: str = "default", weight: str = "w", val: str = "is_val") -> DataFrame:
    """Training and validation rows as one written table with the features in a vector; several boosters may share it."""
    x = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(rows)
    return shared_table(x.select(F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"),
                                 F.coalesce(F.col(val), F.lit(False)).alias("_val"), "_x").withColumn("_row", F.monotonically_increasing_id()), "boosting-rows")


class Booster:
    """Adds rounds to a model until ``finished``; ``rows`` come from :func:`boosting_rows`."""

    def __init__(self, rows: DataFrame, features: Sequence[str], params: BoostParams = BoostParams()):
        self.features, self.params = tuple(features), params
        s = rows.where("not _val").agg(F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_y")).alias("pos")).first()
        share = min(max((s["pos"] or 0.0) / s["w"], 1e-6), 1 - 1e-6) if s["w"] else 0.5
        self.base = math.log(share / (1 - share))
        self._weight = (s["w"] or 0.0) * share * (1 - share) * params.subsample      # sum of second derivatives, last known
        self.state = rows.withColumn("_m", F.lit(self.base))
        self.trees: list[Tree] = []
        self.history: list[float] = []
        self.best_round, self.best_auc, self.finished = 0, -1.0, False
        self._folders = [scratch_path(rows.sparkSession, f"boosting-margins-{uuid.uuid4().hex}") for _ in range(2)]

    def advance(self, rounds: int) -> Booster:
        """At most ``rounds`` more rounds, in blocks."""
        p = self.params
        while rounds > 0 and not self.finished:
            n = min(rounds, p.block, p.max_rounds - len(self.trees))
            state = self.state.withColumn("_path", F.array().cast("array<double>"))
            for _ in range(n):
                state = self._add_tree(state)
            state = self._stored(state)
            for a in self._aucs(state, n):
                self.history.append(a)
                if a > self.best_auc:
                    self.best_round, self.best_auc = len(self.history), a
                elif self.best_round and len(self.history) - self.best_round >= p.patience:
                    self.finished = True
                    break
            self.state, rounds = state.drop("_path"), rounds - n
            self.finished = self.finished or len(self.trees) >= p.max_rounds
        return self

    def _stored(self, state: DataFrame) -> DataFrame:
        """``state`` written and read back.  Two folders take turns: a block reads the one and writes the other, so the
        disk holds two states, however many rounds there are."""
        path = self._folders[0]
        self._folders.reverse()
        state.write.mode("overwrite").parquet(path)
        return state.sparkSession.read.schema(state.schema).parquet(path)

    def _add_tree(self, state: DataFrame) -> DataFrame:
        p, r = self.params, len(self.trees)
        drawn = random.Random(f"{p.seed}|{r}").sample(range(len(self.features)), max(1, round(p.feature_fraction * len(self.features))))
        at = sorted(drawn)
        sliced = VectorSlicer(inputCol="_x", outputCol="_s", indices=at).transform(state)
        prob = 1 / (1 + F.exp(-F.col("_m")))
        spread = F.greatest(prob * (1 - prob), F.lit(MIN_SPREAD))
        in_fit = ~F.col("_val") & (F.pmod(F.xxhash64("_row", F.lit(p.seed), F.lit(r)), F.lit(10_000)) < int(p.subsample * 10_000))
        # Kept for the tree: its fit and its leaf sums pass over these rows several times.
        fit = sliced.where(in_fit).select("_s", ((F.col("_y") - prob) / spread).alias("_z"), (F.col("_w") * spread).alias("_h")).persist()
        fit.count()         # all tasks fill the store; the tree's own first look at its rows is one task, which would fill a part alone
        least = min(0.49, p.min_child_weight / self._weight) if self._weight > 0 else 0.0
        tree = DecisionTreeRegressor(featuresCol="_s", labelCol="_z", weightCol="_h", predictionCol="_p", leafCol="_leaf", maxDepth=p.depth,
                                     maxBins=p.bins, minInstancesPerNode=p.min_instances, minWeightFractionPerNode=least, seed=p.seed + r).fit(fit)
        sums = {int(x["_leaf"]): (x["g"], x["h"], x["n"]) for x in tree.transform(fit).groupBy("_leaf").agg(
            F.sum(F.col("_h") * F.col("_z")).alias("g"), F.sum("_h").alias("h"), F.count(F.lit(1)).alias("n")).collect()}        # a row per leaf
        fit.unpersist()
        self._weight = sum(x[1] for x in sums.values())
        kept, values = build_tree(tree.toDebugString, at, sums, p)
        self.trees.append(kept)
        leaf = F.get(F.array(*[F.lit(float(p.step * v)) for v in values]), F.col("_leaf").cast("int"))
        out = tree.transform(sliced).withColumn("_m", F.col("_m") + leaf).drop("_s", "_p", "_leaf")
        return out.withColumn("_path", F.when(F.col("_val"), F.array_append("_path", F.col("_m"))).otherwise(F.col("_path")))

    def _aucs(self, state: DataFrame, n: int) -> list[float]:
        """Validation AUC of the last n rounds; -1 where it is not defined."""
        long = state.where("_val").select("_y", F.posexplode("_path").alias("i", "m"))
        counts = long.groupBy("i", F.round("m", 6).alias("score")).agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
        got = {x["i"]: x["auc"] for x in auc_of_counts(counts, ["i"]).collect()}
        return [-1.0 if (a := got.get(i)) is None or math.isnan(a) else a for i in range(n)]

    def model(self) -> BoostedModel:
        """The trees up to the best round; all of them if no validation AUC is defined."""
        trees = self.trees[:self.best_round] if self.best_round else self.trees
        return BoostedModel(self.features, tuple(trees), self.base, self.params.step, tuple(self.history), asdict(self.params))


def boost(rows: DataFrame, features: Sequence[str], params: BoostParams = BoostParams(), label: str = "default", weight: str = "w",
          val: str = "is_val") -> BoostedModel:
    """I4 (default parameters) and I5 (:data:`SECOND`): a boosted model of ``rows`` with label, weight and validation flag."""
    return Booster(boosting_rows(rows, features, label, weight, val), features, params).advance(params.max_rounds).model()


#: Ranges of the searched parameters; step is drawn on a log scale.
SPACE = {"depth": (3, 10), "step": (0.01, 0.3), "subsample": (0.6, 1.0), "feature_fraction": (0.6, 1.0), "min_child_weight": (1, 10),
         "min_gain": (0.0, 5.0), "leaf_l1": (0.0, 10.0), "leaf_l2": (0.0, 10.0)}


def drawn_params(r: random.Random, base: BoostParams, space: dict) -> BoostParams:
    found = {}
    for name, (low, high) in space.items():
        whole = isinstance(getattr(base, name), int)
        found[name] = r.randint(low, high) if whole else math.exp(r.uniform(math.log(low), math.log(high))) if name == "step" else r.uniform(low, high)
    return replace(base, **found)


def halving_search(rows: DataFrame, features: Sequence[str], base: BoostParams = BoostParams(), trials: int = 50, rungs: Sequence[int] = (50, 100, 200, 500),
                   threads: int = 4, seed: int = 42, space: dict | None = None) -> tuple[BoostedModel, list[dict]]:
    """Seeded search over :data:`SPACE` by validation AUC; the best model and all trials.

    Trials run side by side in fair scheduler pools.  After each rung (rounds
    in total) the trials below the median of those still running are dropped;
    the others go on from the rounds they have.  ``rows`` come from
    :func:`boosting_rows`.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    r = random.Random(seed)
    drawn = [drawn_params(r, replace(base, max_rounds=max(rungs)), SPACE | (space or {})) for _ in range(trials)]
    spark = rows.sparkSession

    def one(k: int, booster: Booster | None, rounds: int) -> Booster:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{k}")
        b = booster or Booster(rows, features, drawn[k])
        return b.advance(rounds - len(b.trees))

    live: dict[int, Booster | None] = dict.fromkeys(range(trials))
    last: dict[int, Booster] = {}
    for rung in sorted(set(rungs)):
        with ThreadPoolExecutor(threads) as pool:
            jobs = {k: pool.submit(inheritable_thread_target(spark)(one), k, b, rung) for k, b in live.items()}
            live = {k: j.result() for k, j in jobs.items()}
        last |= live
        order = sorted(live, key=lambda k: (-live[k].best_auc, k))
        live = {k: live[k] for k in order[:max(1, -(-len(order) // 2))]}
    found = [{**{n: getattr(drawn[k], n) for n in SPACE}, "auc": last[k].best_auc, "rounds": len(last[k].history)} for k in range(trials)]
    best = min(last, key=lambda k: (-last[k].best_auc, k))
    return last[best].model(), found
