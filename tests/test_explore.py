"""Nearest-neighbour mutual information against a plain version; running sums over many ranges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loanlens.operators import explore as xe
from loanlens.plans.prefix import prefix_sums, ranged


def psi(n):
    return sum(1 / i for i in range(1, n)) - 0.5772156649015329


def plain(points, neighbors=3):
    """points: (class, x); every distance is looked at."""
    sizes = {y: sum(c == y for c, _ in points) for y, _ in points}
    live = [(y, x) for y, x in points if sizes[y] > 1]
    total = 0.0
    for i, (y, x) in enumerate(live):
        k = min(neighbors, sizes[y] - 1)
        r = sorted(abs(v - x) for j, (c, v) in enumerate(live) if j != i and c == y)[k - 1]
        m = sum(x - r < v < x + r for _, v in live) if r > 0 else sum(v == x for _, v in live)
        total += psi(k) - psi(sizes[y]) - psi(m)
    return max(0.0, psi(len(live)) + total / len(live)), len(live)


@pytest.mark.parametrize("block", [10_000, 8])
def test_mutual_information_meets_the_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(xe, "KNN_BLOCK", block)
    r = random.Random(3)
    rows = []
    for i in range(300):
        y = r.randrange(2)
        rows.append((y, y + r.gauss(0, 1), float(r.randrange(6)), r.gauss(0, 1) if i % 9 else None, 1.0))
    rows += [(2, 0.1, 1.0, None, 1.0), (2, 0.4, 1.0, 0.5, 1.0), (3, 0.3, 9.0, 0.2, math.nan), (None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "y int, `a.b` double, tied double, gaps double, same double").repartition(5)
    names = ["a.b", "tied", "gaps", "same"]
    got = {x["feature"]: x for x in xe.mutual_info_knn(df, names, "y").collect()}
    for i, c in enumerate(names):
        points = [(t[0], t[i + 1]) for t in rows if t[0] is not None and t[i + 1] is not None and not math.isnan(t[i + 1])]
        value, n = plain(points)
        assert got[c]["mutual_info"] == pytest.approx(value, abs=1e-6) and got[c]["n_rows"] == n
    assert got["a.b"]["mutual_info"] > 0.05 > got["gaps"]["mutual_info"]


def test_mutual_information_of_nothing(spark):
    df = spark.createDataFrame([(0, None), (1, 2.0)], "y int, x double")
    assert xe.mutual_info_knn(df, ["x"], "y").count() == 0 and xe.mutual_info_knn(df.limit(0), ["x"], "y").count() == 0


def test_digamma(spark):
    rows = spark.range(1, 60).select("id", xe.digamma(F.col("id").cast("double")).alias("v")).collect()
    assert all(r["v"] == pytest.approx(psi(r["id"]), abs=1e-12) for r in rows)


def test_running_sums_compare_neighbours_only(spark):
    c = spark.range(5000).selectExpr("id % 3 as k", "double((id * 7919) % 5000) as v", "1L as n")
    out = prefix_sums(ranged(c, ["k"], "v", blocks=40), ["k"], "v", ["n"], with_next=True)
    assert out.select("k", "v").distinct().count() == 5000
    rows = sorted(out.collect(), key=lambda r: (r["k"], r["v"]))
    for a, b in zip(rows, rows[1:]):
        same = a["k"] == b["k"]
        assert a["next_v"] == (b["v"] if same else None) and b["cum_n"] == (a["cum_n"] + 1 if same else 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString() if hasattr(out, "_jdf") else ""
    assert "percentile" not in plan and "filter(" not in plan          # no list of edges is searched for a row
