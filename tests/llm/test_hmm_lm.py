import itertools
import math
from collections import Counter

import numpy as np
from helpers import docs, prose
from loanlens.llm import hmm_lm as H
from pyspark.sql import functions as F


def model(k=3, v=5, seed=0):
    r = np.random.default_rng(seed)
    n = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(r.random(s) + 0.1)
    return H.Model(n(k), n(k, k), n(k, v).T)


def brute(m, seq):
    return sum(m.start[p[0]] * m.emit[seq[0], p[0]] * math.prod(m.move[a, b] * m.emit[s, b] for a, b, s in zip(p, p[1:], seq[1:]))
               for p in itertools.product(range(len(m.start)), repeat=len(seq)))


def test_forward_is_exact():
    m, seqs = model(), [[0, 1, 2, 4, 3], [4], [2, 2], [1, 0, 3]]
    seqs.sort(key=len, reverse=True)
    size = np.array([len(s) for s in seqs])
    order, live = H._by_time(size)
    got, _, _ = H.forward(m, np.concatenate(seqs)[order], live)
    assert np.allclose(got, [math.log(brute(m, s)) for s in seqs])


def test_expected_counts_meet_brute_force():
    m, seq = model(), [0, 3, 1, 2]
    order, live = H._by_time(np.array([4]))
    starts, moves, emits, ll, _ = H.expected_counts(m, np.array(seq)[order], live)
    total, s, mv, e = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for p in itertools.product(range(3), repeat=4):
        x = m.start[p[0]] * m.emit[seq[0], p[0]] * math.prod(m.move[a, b] * m.emit[o, b] for a, b, o in zip(p, p[1:], seq[1:]))
        total += x
        s[p[0]] += x
        for a, b in zip(p, p[1:]):
            mv[a, b] += x
        for o, a in zip(seq, p):
            e[o, a] += x
    assert np.allclose(starts, s / total) and np.allclose(moves, mv / total) and np.allclose(emits, e / total) and math.isclose(ll, math.log(total))


def data():
    a, b = ["ka", "lo", "mi", "ne"], ["Süß", "ta", "ri", "vo"]
    out = [(i, prose(i, 10 + i % 50, a if i % 2 else b), "en", "x") for i in range(120)]
    return out + [(200, None), (201, ""), (202, "unseen words only"), (203, prose(1, 30_000, a)), (None, "ka lo"), (5, "ka lo")]


def test_scores(spark):
    rows = data()
    held = {5, 202, 10, 11, 203}
    df = docs(spark, rows).withColumn("held_out", F.coalesce(F.col("doc_id").isin(*held), F.lit(False))).withColumnRenamed("lang", "base")
    got = H.score_lm(df, listed=6, top=4, states=2, max_rounds=5, tolerance=0.0).collect()
    assert len(got) == len(rows)
    tok = lambda t: [*(t or "").encode().lower().split(), None]                  # noqa: E731
    c = Counter(w for i, t, *_ in rows if i not in held for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(tok(t)), sum(w in c for w in tok(t)), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok(t)), 6))
                  for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n for r in got)
    better = [r["score"] > r["base_score"] for r in got if r["doc_id"] in (10, 11, 203)]
    assert all(better)


def test_empty_and_untrained(spark):
    none = docs(spark, [], parts=1).withColumn("held_out", F.lit(False))
    assert H.score_lm(none, states=2, max_rounds=1).count() == 0
    got = H.score_lm(docs(spark, [(1, "a b")]).withColumn("held_out", F.lit(True)), states=2, max_rounds=1).first()
    assert (got["n_known"], got["train_tokens"], got["n_tokens"]) == (0, 0, 3) and math.isfinite(got["score"])


def test_a_long_text_in_segments():
    m, seq = model(4, 9, 3), np.random.default_rng(4).integers(0, 9, 200)
    whole = H.expected_counts(m, seq, np.ones(200, int))
    for size in (1, 7, 64, 200, 500):
        for a, b in zip(H.long_counts(m, seq, size), whole[:4]):
            assert np.allclose(a, b)


def plain_rounds(m, seqs, unigram, rounds):
    """Baum-Welch with every expectation from scratch, one text after the other."""
    k, v = len(m.start), len(m.emit)
    for _ in range(rounds):
        s, mv, e = np.full(k, 0.1), np.full((k, k), 0.1), H.PRIOR * np.repeat(unigram[:, None], k, 1)
        for q in seqs:
            a, b = [m.start * m.emit[q[0]]], [np.ones(k)]
            for x in q[1:]:
                a.append(a[-1] @ m.move * m.emit[x])
            for x in q[:0:-1]:
                b.append(m.move @ (m.emit[x] * b[-1]))
            b, total = b[::-1], a[-1].sum()
            s += a[0] * b[0] / total
            for t, x in enumerate(q):
                e[x] += a[t] * b[t] / total
                if t:
                    mv += a[t - 1][:, None] * m.move * (m.emit[x] * b[t])[None] / total
        m = H.Model(s / s.sum(), mv / mv.sum(1, keepdims=True), e / e.sum(0))
    return m


def test_training_meets_plain_baum_welch(spark, monkeypatch):
    r = np.random.default_rng(5)
    seqs = [r.integers(0, 6, r.integers(1, 25)).tolist() for _ in range(40)]
    counts = np.bincount([x for q in seqs for x in q], minlength=6).astype(float)
    want = plain_rounds(H.first_model(counts, 3, 7), seqs, (counts + 0.1) / (counts + 0.1).sum(), 4)
    for parts, tokens in ((1, 400_000), (7, 9)):               # in several partitions, and with texts longer than one pass
        monkeypatch.setattr(H, "TOKENS", tokens)
        encoded = spark.createDataFrame([(q,) for q in seqs], "symbols array<int>").repartition(parts)
        got = H.train(encoded, counts, 3, 4, -1e9, 7)
        assert np.allclose(got.start, want.start) and np.allclose(got.move, want.move) and np.allclose(got.emit, want.emit)


def test_small_tables_keep_their_states_apart(spark, monkeypatch):
    kept = {}
    whole = H.train
    monkeypatch.setattr(H, "train", lambda *a: kept.setdefault("m", whole(*a)))
    for n in (4, 12, 60):
        kept.clear()
        rows = [(i, prose(i, 20, ["ka", "lo", "mi", "ne"] if i % 2 else ["su", "ta", "ri", "vo"])) for i in range(n)]
        got = H.score_lm(docs(spark, rows, parts=1).withColumn("held_out", F.lit(False)), states=4).collect()
        e = kept["m"].emit
        assert max(np.abs(e[:, a] - e[:, b]).sum() for a in range(4) for b in range(a)) > 0.5      # there are two kinds of texts
        assert sum(r["score"] > r["base_score"] for r in got) > 0.9 * n


def test_a_round_has_no_more_tasks_than_run_at_once(spark, monkeypatch):
    r = np.random.default_rng(6)
    encoded = spark.createDataFrame([(r.integers(0, 6, 9).tolist(),) for _ in range(200)], "symbols array<int>").repartition(40)
    tasks, whole = [], type(encoded).mapInArrow
    monkeypatch.setattr(type(encoded), "mapInArrow", lambda df, *a, **k: tasks.append(df.rdd.getNumPartitions()) or whole(df, *a, **k))
    _, _, n = H.baum_welch_round(encoded, model(3, 6), np.full(6, 1 / 6))
    assert n == 1800 and tasks == [spark.sparkContext.defaultParallelism]


def test_a_long_text_is_scored_in_segments():
    m, seq = model(4, 9, 3), np.random.default_rng(4).integers(0, 9, 200)
    whole = H.forward(m, seq, np.ones(200, int))[0][0]
    for size in (1, 3, 64, 200, 500):
        assert math.isclose(H.long_likelihood(m, seq, size), whole, rel_tol=1e-12)


def test_improbable_tokens_do_not_underflow():
    m = model(3, 5)
    m.emit[4] = 1e-60
    seqs = [[4] * 11, [4] * 9, [0, 4, 4, 4, 4], [4]]
    order, live = H._by_time(np.array([len(s) for s in seqs]))
    starts, moves, emits, ll, _ = H.expected_counts(m, np.concatenate(seqs)[order], live)
    got = H.forward(m, np.concatenate(seqs)[order], live)[0]
    assert math.isclose(starts.sum(), 4) and math.isclose(moves.sum(), 22) and math.isclose(emits.sum(), 26) and math.isclose(ll, got.sum())
    assert np.allclose(got[[0, 1, 3]], [n * math.log(1e-60) for n in (11, 9, 1)])
