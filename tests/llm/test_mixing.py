import math
import re

from pyspark.sql import functions as F
from helpers import docs, prose
from loanlens.llm.mixing import mix, source_targets


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = [s for s in sizes if s not in full]
        share = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(w[s] for s in left))
        over = {s for s in left if share * w[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else share * w[s] for s in sizes}
        full |= over


def rows():
    out = [(i, prose(i, 5 + i % 40), "en", ["a", "b", "c", None, "d"][i % 5] if i > 200 else "hot") for i in range(600)]
    out += [(7, "same text here", "en", "b")] * 30 + [(None, "x y", None, None), (None, None, None, "void"), (1, "", None, "void")]
    return out


def test_targets_meet_brute_force(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "Z": 50, None: 400, "é": 0}
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = targets(sizes)
    for r in got:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)


def test_mix(spark):
    data = rows()
    df = docs(spark, data)
    got = mix(df).collect()
    assert len(got) == len(data)
    size = {}
    for _, t, _, s in data:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(size)
    by_target = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    for s, n in size.items():
        t = sum(by_target[(n, round(want[s], 6))])
        assert want[s] - 32 <= t <= want[s] + 1e-6       # each of up to 31 tied rows rounds down
    again = mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_empty(spark):
    assert mix(docs(spark, [], parts=1)).count() == 0


def test_long_texts_and_clashing_names(spark):
    data = [(i, "w " * (40_000 if i == 3 else 5), "en", f"s{i % 2}") for i in range(12)]
    df = docs(spark, data)
    odd = df.withColumnsRenamed({"lang": "key", "n_chars": "target"}).withColumn("taken", F.lit("x"))
    got = {r["doc_id"]: r for r in mix(odd).collect()}
    assert sorted(map(str, got.values())) == sorted(map(str, mix(df).collect()))
    assert got[3]["size"] == 40_000 and got[3]["taken"] <= 120_000
    for s in (0, 1):
        mine = [r for i, r in got.items() if i % 2 == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1
