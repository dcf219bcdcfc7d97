import re

import numpy as np
from helpers import docs, prose
from loanlens.llm.quality_rules import MEASURES, estimate, judge_quality, measures, posterior


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    cover = {i + k for i, g in enumerate(wins) if wins.count(g) > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


TEXTS = [None, "", " \n\t", "one", "a b c d e " * 4, prose(1, 200), prose(2, 60) + "\n" + prose(2, 60) + "\n \n" + prose(2, 60),
         "né à | Ünïcode\u00a0x\u2028y " * 9, "# $ % " * 40, "A\nA\nA \nA", "x " * 3000, "same words again and again " + prose(3, 50) + " same words again and again"]


def test_measures_meet_brute_force():
    for t in TEXTS:
        assert measures(t or "")[:5] == brute(t)


def test_estimate_finds_the_rare_bad_group():
    r = np.random.default_rng(0)
    bad = r.random(4000) < 0.1
    votes = np.where(r.random((4000, 6)) < np.where(bad, 0.5, 0.01)[:, None], -1, 1)
    vectors, counts = np.unique(votes, axis=0, return_counts=True)
    share, weight = estimate(vectors.astype(float), counts.astype(float))
    quality = posterior(votes.astype(float), share, weight)
    assert abs(share - 0.9) < 0.03 and ((quality < 0.5) == bad).mean() > 0.97


def test_operator(spark):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(None, prose(8, 80)), (3, "one")] + [(100 + i, prose(i + 50, 120) + ".") for i in range(60)]
    df = docs(spark, data).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    got = judge_quality(df).collect()
    assert len(got) == len(data)
    want = sorted((str(i), *brute(t)) for i, t in data)
    assert sorted((str(r["doc_id"]), *[r[m] for m in MEASURES[:5]]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in got if (r["doc_id"] or 0) >= 100) == 60
    assert judge_quality(docs(spark, [], parts=1)).count() == 0
