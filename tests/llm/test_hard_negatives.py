import math
import random

import numpy as np
import pytest
from loanlens.llm import hard_negatives as H
from loanlens.llm.topk import Best
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, modulo=5, positives=5, negatives=3):
    last = 1 << 70
    ok = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in rows
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(ok):
        if i is None or i % modulo:
            continue
        score = [sum(x * y for x, y in zip(v, w)) for _, _, w in ok]
        place = lambda k: (-score[k], last if ok[k][0] is None else ok[k][0])       # noqa: E731
        for p in sorted((k for k in range(len(ok)) if k != a and ok[k][1] == lab), key=place)[:positives]:
            fit = [k for k in range(len(ok)) if ok[k][1] != lab and 50 * score[p] <= 100 * score[k] <= 95 * score[p]]
            out += [(i, ok[p][0], r + 1, ok[k][0], score[p], score[k]) for r, k in enumerate(sorted(fit, key=place)[:negatives])]
    return sorted(out, key=str)


def vectors(n=160, dim=20, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    return [(i, int(k), [float(x) for x in centres[k] + 0.7 * r.normal(size=dim)]) for i, k in enumerate(r.integers(0, 4, n))]


@pytest.mark.parametrize("shards", [1, 3])
def test_meets_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(H, "ROWS", 13)
    monkeypatch.setattr(H, "ANCHORS", 7)
    rows = vectors()
    rows += [(200 + i, 1, rows[7][2]) for i in range(40)] + [(205, 2, rows[7][2])] * 3 + [(None, 1, rows[7][2]), (None, 3, rows[9][2])]
    rows += [(300, None, rows[0][2]), (305, 1, None), (310, 1, [math.nan] * 20), (315, 1, [1.0, None]), (320, 1, [math.inf]), (325, 2, []),
             (330, 2, [0.0] * 20), (335, 3, rows[3][2][:9]), (340, 1, [-x for x in rows[7][2]])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 as id", "2 as row", "3 as v", "4 as score")
    out = H.hard_negatives(df, F.col("vec_id") % 5 == 0, max_anchors=-(-60 // shards))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)


def test_bounds_hold_at_each_level_and_save_work():
    r = np.random.default_rng(2)
    rough = r.normal(size=(300, 1)) * 200 + r.normal(size=(300, 64)) * 30        # summaries tell something here
    v = np.floor(rough).astype(np.int64)
    n = np.arange(300)
    x = H.Vectors(n, n, np.zeros(300, np.int64), v, *H.summaries(v))
    score = v @ v.T
    for (p, d) in x.level:
        mid, rest = p @ p.T, d @ d.T
        assert (mid - rest <= score).all() and (score <= mid + rest).all()
    best = Best(np.full(300, -H._NEVER), 5)
    scored = sum(H.scan(x.take(slice(a, a + 30)), x, best, 1, True) for a in range(0, 300, 30))
    assert scored < 0.5 * 300 * 300
    for a in (0, 17, 299):
        want = sorted((-s, k) for k, s in enumerate(score[a]) if k != a)[:5]
        assert [(-s, k) for s, k in zip(best.score[best.query == a], best.id[best.query == a])] == want


def test_ranges():
    for s in [*range(-300, 300), 10 ** 17 + 3]:
        low, high = (int(x[0]) for x in H.ranges(np.array([s]), 50, 95))
        assert low == -(-50 * s // 100) and high == 95 * s // 100


def test_empty_and_too_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(none, F.col("vec_id") % 5 == 0).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(1, 1, [0.5])], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(5, 1, [0.5]), (10, 2, [0.5])], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        H.hard_negatives(spark.createDataFrame([(5, 1, [1e30])], SCHEMA), F.lit(True))
