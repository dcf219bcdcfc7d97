"""Hard negatives by segment summaries: bounds on inner products, refined before exact scoring.

Vectors become integers.  Of every vector the mean and the deviation (the norm
of what remains) of its 1, 4 and 16 segments are stored.  In a segment of width
w two vectors' product is ``w * mean * mean`` plus a rest that the product of
their deviations bounds, so the sums over the segments give an upper and a
lower bound of the score.  The whole vector is tried first, then its quarters,
then its sixteenths; only pairs that stay open get their exact integer score.

A first pass over the table finds each anchor's positives, where a pair stays
open while its upper bound reaches the anchor's last positive so far.  A second
finds the negatives: a pair stays open while its bounds meet the range of one of
the anchor's positives, from the last negative found for it up to its limit.
Both passes are map-only: a task keeps the thresholds from block to block and
hands out its best rows.  Anchors beyond ``max_anchors`` take further passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import shared_table, small_or_shuffled
from loanlens.llm.topk import NO_ID, Best, best_rows

LEVELS = (1, 4, 16)
ROWS, ANCHORS = 1024, 1024      # a block of pairs
ROWS_PER_TASK = 50_000
DENSE = 0.2                     # share of open pairs from which a block is bounded as a whole
_NEVER = np.iinfo(np.int64).max


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of every level, side by side."""
    means, rests = [], []
    for k in LEVELS:
        parts = v.reshape(len(v), k, -1).astype(np.float64)
        mean = parts.mean(axis=2)
        means.append(mean)
        rests.append(np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2)))
    return np.concatenate(means, axis=1), np.concatenate(rests, axis=1)


class Vectors:
    """Some vectors with their summaries, ready for bounds at each level."""

    def __init__(self, row, ids, label, v, mean, deviation):
        self.row, self.id, self.label, self.v, self.mean, self.deviation = row, ids, label, v, mean, deviation
        norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        slack = np.stack([1e-6 * norm, np.full(len(v), 1e-3)], axis=1)      # its products cover the rounding of the bounds
        self.level, at = [], 0
        for k in LEVELS:
            self.level.append((mean[:, at:at + k] * np.sqrt(v.shape[1] / k), np.concatenate([deviation[:, at:at + k], slack], axis=1)))
            at += k

    @staticmethod
    def read(b: pa.RecordBatch, dim: int) -> Vectors:
        grid = lambda c, k: b.column(c).flatten().to_numpy().reshape(b.num_rows, k)     # noqa: E731
        return Vectors(b.column("row").to_numpy(), b.column("id").fill_null(NO_ID).to_numpy(), b.column("label").to_numpy(),
                       grid("v", dim), grid("mean", sum(LEVELS)), grid("deviation", sum(LEVELS)))

    def take(self, at) -> Vectors:
        return Vectors(*(x[at] for x in (self.row, self.id, self.label, self.v, self.mean, self.deviation)))


def exact(x: Vectors, y: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(
        np.einsum("ij,ij->i", x.v[i[a:a + 100_000]], y.v[j[a:a + 100_000]]) for a in range(0, len(i), 100_000))])


def open_pairs(x: Vectors, y: Vectors, may: np.ndarray, wanted: Callable) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``may`` (rows, anchors) that the bounds of no level rule out; ``wanted(anchor, low, high)`` judges."""
    i, j = np.nonzero(may)
    for (px, dx), (py, dy) in zip(x.level, y.level):
        if not len(i):
            break
        if len(i) > DENSE * may.size:
            mid, rest = (px @ py.T)[i, j], (dx @ dy.T)[i, j]
        else:
            mid, rest = np.einsum("ij,ij->i", px[i], py[j]), np.einsum("ij,ij->i", dx[i], dy[j])
        ok = wanted(j, mid - rest, mid + rest)
        i, j = i[ok], j[ok]
    return i, j


def scan(x: Vectors, y: Vectors, best: Best, slots: int, same: bool, limit: np.ndarray | None = None) -> int:
    """Bring ``best`` up to date with the rows ``x`` for the anchors ``y``; the number of exact scores.

    Positives: rows of the anchor's label but itself.  Negatives: rows of other
    labels, each anchor with ``slots`` ranges from ``best.least`` to ``limit``.
    """
    scored = 0
    for a in range(0, len(x.row), ROWS):
        part = x.take(slice(a, a + ROWS))
        for b in range(0, len(y.row), ANCHORS):
            own = y.take(slice(b, b + ANCHORS))
            may = (part.label[:, None] == own.label[None, :]) == same
            if same:
                may &= part.row[:, None] != own.row[None, :]
            least = best.least.reshape(-1, slots)[b:b + ANCHORS]
            top = None if limit is None else limit.reshape(-1, slots)[b:b + ANCHORS]

            def wanted(j, low, high, least=least, top=top):
                ok = np.zeros(len(j), bool)
                for s in range(slots):
                    ok |= (high >= least[j, s]) & (True if top is None else low <= top[j, s])
                return ok

            i, j = open_pairs(part, own, may, wanted)
            score = exact(part, own, i, j)
            scored += len(i)
            for s in range(slots):
                ok = slice(None) if top is None else score <= top[j, s]
                best.add((j[ok] + b) * slots + s, score[ok], part.id[i[ok]])
    return scored


def ranges(score: np.ndarray, low_percent: int, high_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer s with low_percent * score <= 100 * s <= high_percent * score (none: least above greatest)."""
    def floor(p, x):        # of p * x / 100 without leaving 64 bits
        return p * (x // 100) + p * (x % 100) // 100
    return -floor(low_percent, -score), floor(high_percent, score)


def prepared(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int, anchors: Column) -> tuple[DataFrame, int]:
    """(row, id, label, v, mean, deviation, anchor) of the rows that take part, and the common width; written."""
    x = F.col("__vector")
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("__vector"),
                          F.coalesce(anchors, F.lit(False)).alias("anchor"))
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))      # NaN is above infinity
    slim = slim.filter(F.col("label").isNotNull() & x.isNotNull() & finite).withColumn(
        "v", F.transform(x, lambda e: F.floor(e.cast("double") * scale))).drop("__vector")
    width, largest, rows = slim.agg(F.max(F.size("v")), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))), F.count("*")).first()
    dim = max(1, -(-(width or 1) // LEVELS[-1])) * LEVELS[-1]
    if dim * (largest or 0) ** 2 >= 1 << 63:
        raise ValueError(f"components up to {largest} in {width} dimensions: scores leave 64 bits")
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    slim = slim.repartition(parts).withColumn("row", F.monotonically_increasing_id())
    slim = slim.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))))
    schema = "id long, label long, anchor boolean, v array<long>, row long, mean array<double>, deviation array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                both = summaries(b.column("v").flatten().to_numpy().reshape(b.num_rows, dim))
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(list(m), pa.list_(pa.float64())) for m in both)],
                                                 [*b.schema.names, "mean", "deviation"])

    return shared_table(slim.select("id", "label", "anchor", "v", "row").mapInArrow(run, schema), "negatives-vectors"), dim


def _pass(table: DataFrame, shard, dim: int, slots: int, top: int, same: bool) -> DataFrame:
    """(anchor, slot, score, id): each task's best rows; ``shard``: broadcast (anchors, floor, limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, floor, limit = shard.value
        best = Best(floor, top)
        for b in batches:
            if b.num_rows:
                scan(Vectors.read(b, dim), anchors, best, slots, same, limit)
        yield pa.RecordBatch.from_arrays([pa.array(anchors.row[best.query // slots]), pa.array((best.query % slots + 1).astype(np.int32)),
                                          pa.array(best.score), pa.array(best.id)], ["anchor", "slot", "score", "id"])

    return table.select("row", "id", "label", "v", "mean", "deviation").mapInArrow(run, "anchor long, slot int, score long, id long")


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
                   max_anchors: int = 20_000) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x); a score is the integer inner
    product.  Rows with a null label, a null vector, or a null or non-finite
    component take no part.  Shorter vectors are filled with zeros.  Scores
    that could leave 64 bits raise an error.  Null ids rank last among equal
    scores; a null ``anchors`` condition is false.  Rows of a repeated id are
    rows of their own, also as anchors, and an anchor's own row is the only one
    that cannot be its positive.  Positives of a score below 0 have an empty
    range, those of 0 negatives of score 0.  An empty table gives an empty
    result; other columns are not read but by ``anchors``.
    """
    spark = vectors.sparkSession
    table, dim = prepared(vectors, id_col, label_col, vector_col, scale, anchors)
    chosen = table.filter("anchor")
    shards = max(1, -(-chosen.count() // max_anchors))
    out = None
    for shard in range(shards):
        rows = chosen.filter(F.pmod(F.xxhash64("row"), F.lit(shards)) == shard).drop("anchor").toArrow().combine_chunks()      # about max_anchors rows
        batches = [b for b in rows.to_batches() if b.num_rows]
        if not batches:
            continue
        own = Vectors.read(batches[0], dim)
        n = len(own.row)
        floor = np.full(n, -_NEVER)
        found = _pass(table, spark.sparkContext.broadcast((own, floor, None)), dim, 1, positives, True)
        pos = best_rows(found.drop("slot"), ["anchor"], positives).select("anchor", F.col("rank").alias("slot"), "score", "id")
        pos = shared_table(pos, "negatives-positives")
        least, limit = np.full(n * positives, _NEVER), np.full(n * positives, -_NEVER)
        got = pos.select("anchor", "slot", "score").toArrow()                    # positives x max_anchors rows
        order = np.argsort(own.row)
        at = order[np.searchsorted(own.row, got["anchor"].to_numpy(), sorter=order)] * positives + got["slot"].to_numpy() - 1
        low, high = ranges(got["score"].to_numpy(), low_percent, high_percent)
        some = low <= high
        least[at[some]], limit[at[some]] = low[some], high[some]
        found = _pass(table, spark.sparkContext.broadcast((own, least, limit)), dim, positives, negatives, False)
        neg = best_rows(found, ["anchor", "slot"], negatives)
        null = lambda c: F.when(F.col(c) != NO_ID, F.col(c))            # noqa: E731
        pos = pos.select("anchor", "slot", null("id").alias("positive_id"), F.col("score").alias("positive_score"))
        ids = small_or_shuffled(chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), max_anchors)
        part = neg.join(pos, ["anchor", "slot"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", "rank", null("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
