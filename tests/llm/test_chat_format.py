import itertools
import random

import numpy as np
from helpers import prose
from loanlens.llm import chat_format as C


def model(seed=0):
    r = np.random.default_rng(seed)
    n = lambda *s: np.log((lambda x: x / x.sum(-1, keepdims=True))(r.random(s) + 0.05))
    return C.TurnModel(n(C.STATES), n(C.STATES, C.STATES), {f: n(C.STATES, k) for f, k in C.FEATURES.items()})


def test_viterbi_meets_brute_force():
    m = model()
    e = np.log(np.random.default_rng(1).random((4, C.STATES)))
    score = lambda p: m.start[p[0]] + e[0, p[0]] + sum(m.move[a, b] + e[t + 1, b] for t, (a, b) in enumerate(zip(p, p[1:])))
    best = max(itertools.product(range(C.STATES), repeat=4), key=score)
    assert C.viterbi(m, e).tolist() == list(best)


def test_segments_agree_with_the_whole():
    m = model(2)
    e = np.log(np.random.default_rng(3).random((200, C.STATES)))
    whole = C.viterbi(m, e)
    cuts = [0, 1, 40, 41, 130, 200]
    parts = [e[a:b] for a, b in zip(cuts, cuts[1:])]
    borders = C.border_states(m, [C.summary(m, p) for p in parts])
    assert np.concatenate([C.viterbi(m, p, *x) for p, x in zip(parts, borders)]).tolist() == whole.tolist()


def chats(n, seed=0):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        style = r.choice([("User: ", "Assistant: "), ("Q: ", "A: "), ("[Human] ", "[AI] ")])
        for t in range(2 * r.randrange(2, 5)):
            ask = t % 2 == 0
            body = prose(c * 50 + t, 6 if ask else 20).capitalize() + ("?" if ask else ".")
            rows.append((c, t, ("" if r.random() < 0.2 else style[t % 2]) + body + ("" if ask else "\nand more of it"), "user" if ask else "assistant"))
    return rows


SCHEMA = "conv_id bigint, turn bigint, text string, role string"


def test_operator(spark, monkeypatch):
    rows = chats(60)
    extra = [(900, 0, None, None), (900, 1, "", None), (None, 0, "User: a null conversation?", None), (None, None, "A: yes.", None),
             (901, 5, "Q: same?", None), (901, 5, "Q: same?", None), (902, 0, "User: " + "long " * 40_000, None)]
    df = spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3).withColumnRenamed("role", "line")
    m = C.train(spark.createDataFrame([*rows, (1, 1, "x", "critic")], SCHEMA))
    whole = C.format_chats(df, m).collect()
    assert len(whole) == sum(len((t or "").split("\n")) for _, _, t, _ in [*rows, *extra])
    truth = {(c, t): r for c, t, _, r in rows}
    hits = [r["role"] == truth[(r["conv_id"], r["turn"])] for r in whole if (r["conv_id"], r["turn"]) in truth]
    assert np.mean(hits) > 0.97
    first = sorted((r for r in whole if r["conv_id"] == 0), key=lambda r: (r["turn"], r["line_no"]))
    assert first[0]["rendered"].startswith("<|user|>\n") and "User:" not in first[0]["rendered"]
    monkeypatch.setattr(C, "BLOCK", 7)                       # most transcripts then span segments
    again = C.format_chats(df, m).collect()
    assert sorted(map(str, again)) == sorted(map(str, whole))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    m = C.train(none)
    assert C.format_chats(none, m).count() == 0
