"""Toxicity by a counterfactually regularised classifier.

A logistic model over the words of a text and their first four to six bytes
(stems).  Every feature that toxic texts hold more often, by document counts
over all labelled training texts, takes part; those that no row of the fit
holds get no weight.  For the fit, identity terms in labelled sentences
are swapped for others of their group, and the loss adds the squared change of
the score between a text and each swapped version, so that naming a group by
itself moves the score little.

The weights are fitted on at most ``max_fit_rows`` labelled rows, of which
copies of a text have their share and only feature numbers reach the driver.  Feature
counts and scores cover all rows and whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loanlens.llm.common import even_sample, shared_table, small_or_shuffled

#: Groups of identity terms; a term is swapped for the others of its group.
IDENTITY_GROUPS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("african", "european", "american", "mexican", "chinese", "indian", "arab"), ("immigrant", "refugee", "native"),
    ("immigrants", "refugees", "natives"), ("disabled", "deaf", "blind"),
    ("frau", "mann"), ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"),
    ("femme", "homme"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
)
_TERMS = {t.encode(): tuple(x.encode() for x in g if x != t) for g in IDENTITY_GROUPS for t in g}
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
STEMS = (4, 5, 6)


def _words(text: str) -> list[bytes]:
    return text.lower().encode().translate(_SPACED).split()


def features(words) -> set[bytes]:
    """The distinct words and their stems (marked by ``^``)."""
    distinct = set(words)
    out = set(distinct)
    for k in STEMS:
        out.update(b"^" + w[:k] for w in distinct if len(w) > k)
    return out


def swapped(text: str) -> list[tuple[set[bytes], set[bytes]]]:
    """What each swapped version changes: the features it loses and gains, one version per sentence and identity term.

    Features are counted by sentence, so a version costs its sentence's length and not the text's.
    """
    found = []
    sentences = [_words(s) for s in _SENTENCE.split(text)]
    held = [features(s) for s in sentences]
    times = Counter(f for h in held for f in h)
    for s, own in zip(sentences, held):
        for term in sorted(_TERMS.keys() & set(s)):
            for other in _TERMS[term]:
                new = features(other if w == term else w for w in s)
                found.append(({f for f in own - new if times[f] == 1}, {f for f in new - own if f not in times}))
    return found


def count_features(rows: DataFrame, flush: int = 500_000) -> DataFrame:
    """(feature, neg, pos): labelled rows (text, label) that hold each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[dict, dict] = ({}, {})

        def out() -> pa.RecordBatch:
            names = list(held[0].keys() | held[1].keys())
            b = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *[pa.array([h.get(n, 0) for n in names], pa.int64()) for h in held]],
                                           ["feature", "neg", "pos"])
            held[0].clear()
            held[1].clear()
            return b

        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = held[y]
                for f in features(_words(t or "")):
                    h[f] = h.get(f, 0) + 1
                if len(held[0]) + len(held[1]) > flush:
                    yield out()
        yield out()

    return rows.select("text", "label").mapInArrow(run, "feature binary, neg long, pos long").groupBy("feature").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))


@dataclass
class Classifier:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: str) -> float:
        get = self.weights.get
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(get(f, 0.0) for f in features(_words(text))), -500, 500))))


def fit(rows: list, labels: np.ndarray, swaps: list[tuple[list[int], list[int]]], n: int, penalty: float,
        copies: np.ndarray | None = None, times: np.ndarray | None = None, l2: float = 2e-5, steps: int = 500,
        part: int = 500_000) -> tuple[np.ndarray, float]:
    """Logistic weights by Adam; ``swaps`` holds the features that each swapped version loses and gains.

    Loss: mean log loss + l2 |w|^2 + penalty * mean squared change of the
    log odds over the swapped versions.  Both classes count the same.  A row
    stands for ``copies`` rows and a swap for ``times`` swaps (else for one).
    Each step goes through the rows in parts of about ``part`` feature numbers.
    """
    copies = np.ones(len(rows)) if copies is None else copies
    times = np.ones(len(swaps)) if times is None else times
    size = np.array([len(r) for r in rows], int)
    col = np.concatenate([np.asarray(r, np.int32) for r in rows]) if len(rows) else np.empty(0, np.int32)
    first = np.r_[0, np.cumsum(size)]
    cuts = np.unique(np.r_[np.searchsorted(first, np.arange(0, first[-1], part)), len(rows)])
    parts = [(slice(a, b), slice(first[a], first[b])) for a, b in zip(cuts, cuts[1:])]
    dat = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    dcol = np.array([f for a, b in swaps for f in (*a, *b)], int)
    dval = np.array([x for a, b in swaps for x in (*[1.0] * len(a), *[-1.0] * len(b))])
    share = np.clip(np.average(labels, weights=copies), 1e-3, 1 - 1e-3) if len(labels) else 0.5
    heavy = np.where(labels == (share < 0.5), max(share, 1 - share) / min(share, 1 - share), 1.0) * copies
    heavy /= max(heavy.sum(), 1.0)
    w, bias = np.zeros(n), float(np.log(share / (1 - share)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1) if len(rows) else ():
        z = np.full(len(rows), bias)
        for of, place in parts:
            z[of] += np.bincount(np.repeat(np.arange(of.stop - of.start), size[of]), w[col[place]], of.stop - of.start)
        r = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * heavy
        g = 2 * l2 * w
        for of, place in parts:
            g += np.bincount(col[place], np.repeat(r[of], size[of]), n)
        if len(swaps):
            change = np.bincount(dat, dval * w[dcol], len(swaps)) * times
            g += 2 * penalty / times.sum() * np.bincount(dcol, dval * change[dat], n)
        g = np.r_[g, r.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def train(rows: DataFrame, min_rows: int = 3, max_fit_rows: int = 10_000, penalty: float = 1.0) -> Classifier:
    """Classifier from labelled rows (text, label 0/1); rows with a null label are left out, null texts are empty."""
    rows = rows.select("text", F.col("label").cast("int").alias("label")).filter("label in (0, 1)")
    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    neg, pos = total.get(0, 0), total.get(1, 0)
    if not neg or not pos:
        return Classifier({}, 5.0 if pos else -5.0)
    counts = shared_table(count_features(rows), "toxicity-features")
    sample = even_sample(rows.withColumn("text", F.coalesce("text", F.lit(""))), "text", "label", max_fit_rows, "toxicity")
    p, q = F.col("pos").cast("double"), F.col("neg").cast("double")
    # Only features that toxic texts hold more often: many clean words then never outweigh an insult in a long text.
    head = counts.filter((p + q >= min_rows) & (p * neg > q * pos)).select("feature").join(
        count_features(sample).select("feature"), "feature", "left_semi").collect()
    terms = {f for t in _TERMS for f in features([t])}
    names = sorted({bytes(r["feature"]) for r in head} | terms)                # of about max_fit_rows rows, and the identity terms
    number = {f: i for i, f in enumerate(names)}
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        num = shared.value
        known = num.keys()
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            own = [sorted(num[f] for f in known & features(_words(t))) for t in texts]
            # lost features count from 1, gained ones from -1 downwards
            swaps = [[sorted([num[f] + 1 for f in known & lost] + [-num[f] - 1 for f in known & gained]) for lost, gained in swapped(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(own, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32())))],
                                             ["label", "copies", "own", "swaps"])

    numbers = shared_table(sample.mapInArrow(run, "label int, copies long, own array<int>, swaps array<array<int>>"), "toxicity-numbers")
    got = numbers.select("label", "copies", "own").toPandas()                  # about max_fit_rows rows
    # Versions that change the same features count together: a row per kind of change, however many sentences have it.
    kinds = numbers.select("copies", F.explode("swaps").alias("swap")).groupBy("swap").agg(F.sum("copies").alias("times")).toPandas()
    w, bias = fit(list(got["own"]), got["label"].to_numpy(float),
                  [([f - 1 for f in x if f > 0], [-f - 1 for f in x if f < 0]) for x in kinds["swap"]], len(names), penalty,
                  got["copies"].to_numpy(float), kinds["times"].to_numpy(float))
    return Classifier({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-9}, float(bias))


def score_toxicity(docs: DataFrame, model: Classifier, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the score (0 to 1) of each whole text; a null text is the empty text, which gets the bias alone.

    An input column named like the result is replaced.
    """
    docs = docs.drop(out)
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = [m.score(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, use: Column, id_col: str = "doc_id", text_col: str = "text",
             max_broadcast: int = 1_000_000) -> DataFrame:
    """(text, label) of the documents that ``use`` selects; of repeated labels the highest holds."""
    y = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("label"))
    y = small_or_shuffled(y, max_broadcast)
    return docs.filter(use).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(y, "__id").select("text", "label")
