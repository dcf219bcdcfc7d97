import numpy as np
from helpers import docs, prose
from loanlens.llm import toxicity as T
from pyspark.sql import functions as F


def test_swaps_keep_everything_else():
    found = T.swapped("The woman spoke. Some idiot spoke to a boy. A girl and a boy.")
    assert found == [({b"woman", b"^woma"}, {b"man"}), (set(), set()), (set(), set()), ({b"girl"}, set())]
    text = "The woman spoke. Some idiot spoke to a boy. A girl and a boy."
    for k, (lost, gained) in enumerate(found):                            # the same as swapping in the whole text
        a, b = [("woman", "man"), ("spoke to a boy", "spoke to a girl"), ("and a boy", "and a girl"), ("A girl", "A boy")][k]
        assert T.features(T._words(text)) - lost | gained == T.features(T._words(text.replace(a, b)))
    assert T.swapped("") == [] and T.swapped("no group at all") == []


def test_penalty_evens_out_identity_terms():
    # feature 0 insult, 1 and 2 terms of one group; insults meet term 1 far more often
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        rows.append(sorted({0} | ({1} if i % 10 < (9 if bad else 3) else {2})) if bad else [1 if i % 10 < 3 else 2])
        labels.append(bad)
    swaps = [([1], [2]) if 1 in r else ([2], [1]) for r in rows]
    free, _ = T.fit(rows, np.array(labels, float), swaps, 3, 0.0)
    held, _ = T.fit(rows, np.array(labels, float), swaps, 3, 5.0)
    assert abs(held[1] - held[2]) < 0.2 * abs(free[1] - free[2]) and held[0] > 2


def data():
    out = []
    for i in range(400):
        words = prose(i, 30).split()
        if i % 4 == 0:
            words[3] = "scumbag" + ("s" if i % 8 else "ger")
        if i % 4 == 1:
            words[5] = "woman"
        out.append((i, " ".join(words) + ".", "en", "s"))
    return out


def test_operator(spark):
    rows = data() + [(500, None), (501, ""), (None, "scumbags"), (7, prose(7, 30)), (502, prose(9, 40_000) + " SCUMBAGSTER")]
    df = docs(spark, rows).withColumnRenamed("n_chars", "label")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(3, 1, None), (None, 1, 1), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = T.train(T.labelled(df, labels, "toxic", F.col("doc_id") % 5 != 0))
    got = T.score_toxicity(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 400 and not (r["doc_id"] == 7):
            assert (r["score"] >= 0.5) == (r["doc_id"] % 4 == 0)
        if r["doc_id"] in (500, 501):
            assert r["score"] < 0.5
        if r["doc_id"] == 502 or r["text"] == "scumbags":
            assert r["score"] > 0.5


def test_without_labels(spark):
    df = docs(spark, [(1, "a")])
    model = T.train(spark.createDataFrame([], "text string, label int"))
    assert T.score_toxicity(df, model).first()["score"] < 0.5
    assert T.score_toxicity(docs(spark, [], parts=1), model).count() == 0


def test_copies_have_their_share_of_the_sample(spark):
    from loanlens.llm.common import even_sample
    for hot in range(12):                                                 # by hash of the text one of twelve or none would be whole
        rows = [(f"copied {hot}", 1)] * 400 + [(f"own {hot} {i}", i % 2) for i in range(800)]
        got = even_sample(spark.createDataFrame(rows, "text string, label int").repartition(3), "text", "label", 100, "t").collect()
        n = {(r["text"], r["label"]): r["copies"] for r in got}
        assert len(n) == len(got) and n[(f"copied {hot}", 1)] in (33, 34) and 70 <= sum(n.values()) <= 135
    few = even_sample(spark.createDataFrame(rows, "text string, label int"), "text", "label", 5000, "t").collect()
    assert sum(r["copies"] for r in few) == 1200


def test_rare_insult_beside_many_leaning_words(spark):
    lean = " ".join(f"{i:04x}" for i in range(5000))                      # on every toxic row and a tenth of the clean ones
    rows = [(f"{lean} own{i} {'zrk' if i < 4 else ''}", 1) for i in range(30)]
    rows += [(f"{lean if i % 10 == 0 else 'plain'} other{i}", 0) for i in range(60)]
    model = T.train(spark.createDataFrame(rows, "text string, label int").repartition(3))
    assert model.weights[b"zrk"] > 0 and sum(len(f) == 4 for f in model.weights) >= 5000


def test_a_long_labelled_text(spark):
    text = "The woman went home. " * 20_000                                # a term in each sentence: 20,000 swapped versions
    rows = [(f"word{i} scumbag", 1) for i in range(20)] + [(f"word{i} fine", 0) for i in range(20)] + [(text, 0)]
    model = T.train(spark.createDataFrame(rows, "text string, label int").repartition(2))
    assert model.score("scumbag") > 0.5 > model.score(text)


def test_copies_and_like_swaps_count_together():
    rows, labels = [[0, 1], [0], [2], [1, 2]], [1, 1, 0, 0]
    swaps = [([0], [2]), ([1], []), ([], [])]
    copies, times = [3, 1, 2, 1], [4, 1, 2]
    short = T.fit(rows, np.array(labels, float), swaps, 3, 2.0, np.array(copies, float), np.array(times, float))
    long = T.fit([r for r, c in zip(rows, copies) for _ in range(c)], np.repeat(np.array(labels, float), copies),
                 [x for x, t in zip(swaps, times) for _ in range(t)], 3, 2.0)
    assert np.allclose(short[0], long[0], atol=1e-6) and abs(short[1] - long[1]) < 1e-6


def test_parts_of_the_rows_sum_to_the_whole():
    g = np.random.default_rng(5)
    rows = [sorted(set(g.integers(0, 30, g.integers(0, 9)).tolist())) for _ in range(80)] + [[], []]      # some rows hold nothing
    labels = g.integers(0, 2, len(rows)).astype(float)
    whole = T.fit(rows, labels, [([0], [1])], 30, 1.0)
    for part in (1, 10):
        w, bias = T.fit(rows, labels, [([0], [1])], 30, 1.0, part=part)
        assert np.allclose(whole[0], w, atol=1e-6) and abs(whole[1] - bias) < 1e-6
    assert len(T.fit([[], []], np.array([0.0, 1.0]), [], 3, 1.0)[0]) == 3
