import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F
from helpers import docs, prose
from loanlens.llm import simhash as S


def fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w)] if 0 < len(w) < k else [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def closure(fps, radius):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            low = min(label[j] for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= radius)
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_fingerprints():
    for t in ["", "one", "One TWO", "a b c", "ÄÖ\u00a0x y\x0bz q", prose(1, 300), prose(2, 20_000), "x " * 600]:
        assert S.majority_bits(S.shingle_hashes(t.encode(), 3)) == fingerprint(t)


def test_unit_links_meet_brute_force():
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(40)]
    fps = np.array(sorted({s ^ sum(1 << r.randrange(64) for _ in range(r.randrange(4))) & (2 ** 64 - 1) for s in seeds for _ in range(30)}), np.uint64)
    want = closure([int(x) for x in fps], 2)
    for u, v in (S.links_in_unit(fps, 2), S._links_in_small_units(np.zeros(len(fps), np.int64), fps, 2)):
        at = {int(x): i for i, x in enumerate(fps)}
        label = S._forest(len(fps), np.array([at[int(x)] for x in u]), np.array([at[int(x)] for x in v]))
        assert label.tolist() == want


def test_components_of_made_fingerprints(spark):
    r = random.Random(11)
    fps = []
    for _ in range(60):
        x = r.getrandbits(64)
        for _ in range(r.randrange(1, 12)):
            fps.append(x)
            x ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))
    fps += [fps[0]] * 40 + [0, 1, 3, 7, 2 ** 64 - 1]
    want = closure(fps, 2)
    rows = [(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "doc_id bigint, __fp bigint").repartition(3)
    for tile in (4, 4096):
        comp = {r["fp"]: r["component_id"] for r in S.near_duplicates(df, tile=tile).collect()}
        assert [comp[f] for _, f in rows] == want


def test_operator_and_edge_cases(spark):
    base = prose(5, 200)
    near = base + " tail"
    data = [(3, base), (1, base), (2, base.upper()), (9, prose(6, 150)), (4, None), (5, ""), (6, " \n"), (None, "null id text"),
            (9, prose(6, 150)), (12, prose(7, 30_000)), (None, None), (8, near)]
    df = docs(spark, data)
    got = S.simhash_components(df).collect()
    assert len(got) == len(data)
    fps = [fingerprint(t) for _, t in data]
    label = closure(fps, 2)
    low = {}
    for (i, _), c in zip(data, label):
        low[c] = min([x for x in (low.get(c), i) if x is not None], default=None)
    want = sorted((str(i), format(f, "016x"), str(low[c])) for (i, _), f, c in zip(data, fps, label))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    kept = S.drop_near_duplicates(df.withColumnRenamed("n_chars", "root"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "root"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(v) for v in low.values())
    assert S.simhash_components(docs(spark, [], parts=1)).count() == 0
    assert S.drop_near_duplicates(docs(spark, [], parts=1)).count() == 0


def test_dropped_rows_meet_the_texts_by_broadcast_and_by_shuffle(spark):
    a, b = prose(21, 200), prose(22, 200)
    data = [(7, a), (3, a), (3, a), (3, a + " tail"), (9, b), (None, b), (None, prose(23, 90)), (None, prose(23, 90)), (11, None), (12, ""),
            (30, prose(24, 20_000)), (31, prose(24, 20_000))]
    df = docs(spark, data).withColumnsRenamed({"lang": "row", "source": "fp", "n_chars": "__times"}).withColumn("c0", F.lit("x"))
    for most in (1_000_000, 0):
        kept = S.drop_near_duplicates(df, max_broadcast=most)
        assert kept.columns == df.columns
        assert sorted((str(r["doc_id"]), (r["text"] or "")[:200]) for r in kept.collect()) == sorted(
            [("3", min((a, a + " tail"), key=lambda t: np.int64(np.uint64(fingerprint(t))))[:200]), ("9", b[:200]),
             ("None", prose(23, 90)[:200]), ("11", ""), ("30", prose(24, 20_000)[:200])])
    plan = S.drop_near_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan      # texts stay where they are
