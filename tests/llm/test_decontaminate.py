import random

import numpy as np
from helpers import docs, prose
from loanlens.llm import decontaminate as D

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta", "ri", "vo") for b in ("len", "dor", "mas", "tik", "fel", "run")]


def items(n=70):
    return [(i, prose(i, 20 + i % 30, WORDS) + ". " + prose(i + 1000, 6, WORDS) + ".") for i in range(n)]


def brute_scores(index, passage):
    """Every item's score, without any bound."""
    out = np.zeros(len(index.ids))
    for w in set(passage):
        t = index.vocab.get(w)
        if t is not None:
            for r in range(index.start[t], index.start[t + 1]):
                out[index.item[r]] += index.impact[r]
    return out


def test_retrieval_meets_brute_force():
    index = D.ItemIndex(items())
    r = random.Random(1)
    passages = [D.words(" ".join(r.sample(items()[r.randrange(70)][1].split(), 15)) + " " + prose(k, 40, WORDS)) for k in range(200)]
    for threshold in (0.2, 0.45, 0.6):
        pairs = np.array(sorted((p, index.vocab[w]) for p, ws in enumerate(passages) for w in set(ws) if w in index.vocab))
        p, item, score = index.retrieve(pairs[:, 0], pairs[:, 1], len(passages), threshold)
        got = {(int(a), int(b)): s for a, b, s in zip(p, item, score)}
        want = {(k, int(j)): s[j] for k, ws in enumerate(passages) for s in [brute_scores(index, ws)] for j in np.nonzero(s >= threshold + 1e-9)[0]}
        assert want.keys() <= got.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert all(s >= threshold for s in got.values())


def test_operator(spark):
    its = items()
    filler = prose(999, 400)
    data = [(i, prose(i + 5, 150) + "\n" + its[i % 70][1].upper() + " " + filler) for i in range(30)]
    data += [(50, filler), (51, None), (52, ""), (53, its[3][1]), (53, its[3][1]), (None, its[4][1]), (54, its[5][1].rsplit(". ", 1)[0]),
             (55, prose(1, 40_000) + " " + its[6][1] + " " + its[7][1])]
    bench = spark.createDataFrame([*its, (90, None), (91, ""), (92, its[8][1])], "item_id bigint, text string")
    df = docs(spark, data).withColumnRenamed("lang", "__text")
    scores = []
    for per in (50_000, 30):
        rows = D.contaminated(df, bench, max_items=per).collect()
        got = sorted((str(r["doc_id"]), r["item_id"]) for r in rows)
        scores.append(sorted((str(r["doc_id"]), r["item_id"], round(r["bm25"], 9)) for r in rows))
        want = [(str(i), i) for i in range(30)] + [("8", 92), ("53", 3), ("53", 3), ("None", 4), ("55", 6), ("55", 7)]
        assert got == sorted(want)
    assert scores[0] == scores[1]                                        # the same scores from one index and from several
    w = its[40][1].split()                                               # one word in ten changed: still the item
    near = docs(spark, [(70, filler + " " + " ".join("other" if i in (9, len(w) - 1) else x for i, x in enumerate(w)) + " " + filler)])
    assert [r["item_id"] for r in D.contaminated(near, bench).collect()] == [40]
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [50, 51, 52, 54]
    assert D.drop_contaminated(df, bench.limit(0)).count() == len(data)
    assert D.contaminated(docs(spark, [], parts=1), bench).count() == 0


def test_one_inner_word_changed_in_a_short_item(spark):
    its = [(i, prose(i, 10, WORDS) + ". " + prose(i + 1000, 5, WORDS) + ".") for i in range(40)]
    bench = spark.createDataFrame(its, "item_id bigint, text string")
    filler = prose(999, 100)
    rows = []
    for at in (3, 7, 10):
        w = its[at][1].split()
        rows.append((at, filler + " " + " ".join([*w[:at], "other", *w[at + 1:]]) + " " + filler))
    rows.append((30, filler + " " + " ".join(sorted(its[30][1].split())) + " " + filler))      # the item's words in another order
    assert sorted((r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, rows), bench).collect()) == [(3, 3), (7, 7), (10, 10)]


def test_scores_do_not_depend_on_the_number_of_indexes_or_on_long_items(spark):
    its = [(f"item {i}", prose(i, 20 + i % 30, WORDS) + ". " + prose(i + 1000, 6, WORDS) + ".") for i in range(60)]
    cut = [(i, " ".join(w for k, w in enumerate(t.split()) if k % 9 != 4)) for i, (_, t) in enumerate(its)]     # every ninth word is gone
    long = ("long", prose(77, 3000, WORDS) + ". " + prose(78, 20, WORDS) + ".")
    df = docs(spark, [*cut, (100, prose(5, 50) + " " + long[1] + " " + prose(6, 5000)), (101, long[1][:4000])]).selectExpr("*", "1 as `a.b`", "2 as __matches")
    bench = spark.createDataFrame([*its, long], "item_id string, text string")
    found = [sorted((r["doc_id"], r["item_id"], round(r["bm25"], 9)) for r in D.contaminated(df, bench, max_items=n, threshold=0.4, min_overlap=0.4).collect())
             for n in (50_000, 9)]
    assert found[0] == found[1] and (100, "long") in [x[:2] for x in found[0]] and (101, "long") not in [x[:2] for x in found[0]]
    assert {i for i, _, _ in found[0]} >= set(range(60))
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns and 100 not in [r["doc_id"] for r in kept.collect()]
