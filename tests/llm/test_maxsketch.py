import math
import random
import re

import numpy as np
import pytest
from helpers import docs, prose
from loanlens.llm import maxsketch as M

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, top=10):
    bags = [(d, TERM.findall((t or "").translate(UP))) for d, t in rows]
    bags = [(d, b) for d, b in bags if b]
    n, words = len(bags), sum(len(b) for _, b in bags)
    out = []
    for i, text in items:
        scores = [0] * len(bags)
        for w in set(TERM.findall((text or "").translate(UP))):
            tfs = [b.count(w) for _, b in bags]
            weight = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(x > 0 for x in tfs) + 1)))
            for k, tf in enumerate(tfs):
                scores[k] += weight * ((10 ** 9 * tf) // (1000 * tf + 8 * (10 + 90 * len(bags[k][1]) * n // words)))
        best = sorted((-s, d is None, d or 0) for s, (d, _) in zip(scores, bags) if s > 0)[:top]
        out += [(i, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(best)]
    return sorted(out, key=str)


def corpus(n=150):
    r = random.Random(0)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 120)))) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)] + [(None, rows[3][1]), (3, rows[3][1]), (900, None), (901, ""), (902, "-- ! --")]
    rows += [(903, "Größe GRÖSSE größe a\x1cb x_y"), (904, prose(1, 30_000) + " w1 w2")]
    items = [(i, " ".join(r.choice(words) for _ in range(12))) for i in range(25)]
    items += [(7, rows[3][1]), (7, rows[3][1]), (None, "w1 w2"), (30, None), (31, ""), (32, "größe a b x y"), (33, "nowhere")]
    return rows, items


@pytest.mark.parametrize("shards", [1, 3])
def test_meets_brute_force(spark, monkeypatch, shards):
    rows, items = corpus()
    monkeypatch.setattr(M, "BLOCK", 40)
    monkeypatch.setattr(M, "TILE", 9)
    monkeypatch.setattr(M, "WAVE", 4)
    df = docs(spark, rows).selectExpr("*", "1 as q", "2 as score", "3 as rank", "4 as item_id")
    ask = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as doc_id", "6 as part")
    out = M.rank_documents(df, ask, max_items=-(-len(items) // shards))
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, items)


@pytest.mark.parametrize("slots", [4, 64, 1024])
def test_bounds_hold_and_save_work(monkeypatch, slots):
    monkeypatch.setattr(M, "SLOTS", slots)
    rows, items = corpus()
    q = M.Queries([(i, t) for i, (_, t) in enumerate(items)])
    bags = [M.Counter(M.terms(t)) for _, t in rows if M.terms(t)]
    df = M.Counter(w for b in bags for w in b)
    q.weigh(len(bags), sum(sum(b.values()) for b in bags), df)
    block = M.Block(q, M.Places(q.vocab), bags)
    bound = block.bounds(0, len(q.number))
    d, k = (x.reshape(-1) for x in np.meshgrid(np.arange(len(bags)), np.arange(len(q.number)), indexing="ij"))
    exact = block.scores(d, k).reshape(bound.shape)
    assert (bound >= exact).all()
    best = M.Best(np.ones(len(q.number), np.int64), 10)
    scored = M.search_block(block, np.arange(len(bags)), best)
    if slots == 1024:
        assert scored < 0.5 * bound.size
    for x in range(len(q.number)):
        want = sorted(((-s, i) for i, s in enumerate(exact[:, x]) if s > 0))[:10]
        assert [(-s, i) for s, i in zip(best.score[best.query == x], best.id[best.query == x])] == want


def test_empty_tables(spark):
    df, none = docs(spark, [(1, "a b")]), spark.createDataFrame([], "item_id long, text string")
    assert M.rank_documents(df, none).count() == 0
    assert M.rank_documents(df.limit(0), spark.createDataFrame([(1, "a")], none.schema)).count() == 0
    assert M.rank_documents(docs(spark, [(1, None), (2, "?")]), spark.createDataFrame([(1, "a")], none.schema)).count() == 0
