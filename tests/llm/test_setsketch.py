import random

import numpy as np
import pytest
from helpers import docs, prose
from loanlens.llm import setsketch as S


def brute(rows, k, percent):
    """(n_shingles, component) by comparing all sets."""
    def shingles(t):
        w = (t or "").lower().split() if (t or "").isascii() else (t or "").encode().lower().split()
        m = min(k, len(w))
        return frozenset(tuple(w[i:i + m]) for i in range(len(w) - m + 1)) if w else frozenset()
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows) if d is not None)


def near_copies(seed, n, words, change):
    r = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(change + 1)):
            w[r.randrange(len(w))] = f"x{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None)


@pytest.mark.parametrize("tile,columns,per_set", [(512, 4096, 2), (7, 16, 0)])
def test_meets_brute_force(spark, monkeypatch, tile, columns, per_set):
    monkeypatch.setattr(S, "TILE", tile)
    monkeypatch.setattr(S, "COLUMNS", columns)
    monkeypatch.setattr(S, "PER_SET", per_set)
    texts = [prose(i, 30 + i % 60) for i in range(60)]
    texts += near_copies(1, 80, 120, 9) + near_copies(2, 30, 25, 2) + [texts[0]] * 5 + near_copies(3, 20, 400, 30)
    texts += [None, "", " \n ", "one", "ONE", "one two", "One  two", "a b c", "Über Straße", "über Straße"]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    df = docs(spark, rows)
    assert got(S.near_duplicates(df, shingle=3, percent=85)) == brute(rows, 3, 85)


def test_odd_rows(spark):
    long = "word " * 30_000 + prose(1, 40_000)
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None), (7, ""), (9, long), (8, long + " end"), (None, None)]
    df = docs(spark, rows).selectExpr("*", "doc_id as sid", "text as __text", "1 as digest", "2 as component_id")
    out = S.near_duplicates(df, shingle=3, percent=85)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(((r[0], r[2], r[3]) for r in out.collect()), key=str) == sorted(
        [(None, 5, False)] * 2 + [(5, 5, True)] * 2 + [(7, 7, True)] * 2 + [(8, 8, True), (9, 8, False), (None, None, True)], key=str)


def test_empty_table(spark):
    assert S.near_duplicates(docs(spark, []).limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(0)
    pool = r.integers(0, 1 << 63, 4000, dtype=np.int64).view(np.uint64)
    a, b = np.unique(pool[:2400]), np.unique(pool[800:3200])             # similarity one half
    sa, sb, both = S.sketch([a, b, np.unique(pool[:3200])])
    assert (S.merge(sa, sb) == both).all()
    same, more = int((sa == sb).sum()), int((sa > sb).sum())
    j, short = S.estimate(*(np.array([x]) for x in (more, S.REGISTERS - same - more, same, len(a), len(b))), 0.85)
    assert abs(j[0] - 0.5) < 0.12 and short[0] > S.MARGIN


def test_registers_follow_the_size_of_the_set():
    r = np.random.default_rng(1)
    for n in (1, 10, 1000):
        sets = [np.unique(r.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64)) for _ in range(40)]
        want = np.log(n * S.RATE) / np.log(S.BASE)                       # of the minimum of n exponential variables, in steps of the base
        assert abs(S.sketch(sets).mean() - want - 0.5772 / np.log(S.BASE) - 0.5) < 1.0


def test_slices_do_not_change_a_sketch(monkeypatch):
    sets = [np.unique(np.random.default_rng(i).integers(0, 1 << 63, 300 * i, dtype=np.int64).view(np.uint64)) for i in range(5)]
    whole = S.sketch(sets)
    monkeypatch.setattr(S, "SLICE", 101)
    assert (S.sketch(sets) == whole).all()


def test_dense_units_meet_all_pairs(monkeypatch):
    monkeypatch.setattr(S, "COLUMNS", 50)
    sets = [S.shingle_set(t, 3, S.WordHashes()).view(np.int64) for t in near_copies(5, 60, 80, 8)]
    tile = np.arange(60) % 2
    pairs = {(a, b) for a in range(60) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    for inside, want in ((True, pairs), (False, {(a, b) for a, b in pairs if tile[a] != tile[b]})):
        u, v = S.linked(sets, tile, inside, 85)
        label = S._forest(60, u, v)
        ref = S._forest(60, *(np.array(x) for x in zip(*want)))
        assert (label == ref).all()
