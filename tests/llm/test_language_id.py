import math
from collections import Counter

import numpy as np
import pytest
from helpers import docs, prose
from loanlens.llm import language_id as L

SETS = {"xx": ["katu", "mirol", "senda", "pola", "ruk", "tamin"], "yy": ["schwer", "blüht", "größe", "zwölf", "pfand", "quell"],
        "zz": ["ñandu", "ciel", "façon", "llave", "oeuf", "ébène"]}


@pytest.fixture(scope="module")
def corpus():
    return [(i, prose(i, 20 + i % 60, SETS[k]), k, "s") for i, k in enumerate(list(SETS) * 60)]


def test_probabilities_sum_to_one():
    texts = {"a": ["abra cadabra", "abab ba"], "b": ["brab c"]}
    keys, langs, n = [], [], []
    for i, ts in enumerate(texts.values()):
        code, counted, _ = L.encode(ts)
        k, c = np.unique(L.grams(code, L.ORDER)[counted], return_counts=True)
        keys += k.tolist()
        n += c.tolist()
        langs += [i] * len(k)
    m = L.kneser_ney(list(texts), np.array(langs), np.array(keys, np.uint64).view(np.int64), np.array(n))
    alphabet = [ord(c) for c in "abcdr "]
    for context in ("   ", "abr", "bab", "zzz", "cad"):
        rows = np.array([[*map(ord, context), c] for c in alphabet + [0x3B1]], np.uint64)
        p = np.array([2.0 ** m.char_logp(r, np.array([False] * 3 + [True]))[0] for r in rows])
        assert np.allclose(p.sum(0), 1, atol=1e-4)


def plain_bits(training, texts):
    """Bits per character of each text in each language: interpolated Kneser-Ney spelled out, one character at a time."""
    def letters_of(t):
        out = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        return " " * (L.ORDER - 1) + " ".join(out) + " "
    counts = {}
    for lang, ts in training.items():
        top = Counter()
        for t in map(letters_of, ts):
            top.update(t[i - L.ORDER + 1:i + 1] for i in range(L.ORDER - 1, len(t)))
        counts[lang] = {L.ORDER: top}
        for k in range(L.ORDER - 1, 0, -1):                            # how many characters stand before it
            counts[lang][k] = Counter(g[1:] for g in counts[lang][k + 1])
    alphabet = len({g for c in counts.values() for g in c[1]}) + 1

    def p(c, gram):
        k = len(gram)
        if not k:
            return 1 / alphabet
        ones, twos = (sum(n == x for n in c[k].values()) for x in (1, 2))
        d = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        mine = {g: n for g, n in c[k].items() if g[:-1] == gram[:-1]}
        lower = p(c, gram[1:])
        return max(mine.get(gram, 0) - d, 0) / sum(mine.values()) + d * len(mine) / sum(mine.values()) * lower if mine else lower

    return [[-sum(math.log2(p(c, t[i - L.ORDER + 1:i + 1])) for i in range(L.ORDER - 1, len(t))) / (len(t) - L.ORDER + 1) for c in counts.values()]
            for t in map(letters_of, texts)]


def test_cross_entropy_meets_plain_kneser_ney(spark):
    training = {k: [prose(i, 12, v) for i in range(6)] for k, v in SETS.items()}
    rows = [(i, t, k) for k, ts in training.items() for i, t in enumerate(ts)]
    texts = ["katu, Mirol!", "größe zwölf", "qqq www", "ciel 12 ñandu", "a"]
    df = docs(spark, rows)
    for per_shard in (1_000_000, 60):                                   # one array, and a model in shards
        model = L.train(df, max_ngrams=per_shard)
        parts = [model, *(getattr(x, "value", x) for x in model.others)]
        h = sum(m.cross_entropy(texts)[0] for m in parts)
        assert len(parts) > 1 or per_shard > 60
        assert np.allclose(h, plain_bits(training, texts), atol=1e-4)


def test_encode_marks_letters():
    code, counted, size = L.encode(["Ab, 9c!", "", "\x00", "\U0001d4d0"])
    assert size.tolist() == [5, 1, 1, 2] or size.tolist()[0] == 5
    assert counted.sum() == size.sum() and len(code) == size.sum() + 4 * (L.ORDER - 1)


def test_identifies_held_out(spark, corpus):
    train = [r for r in corpus if r[0] % 4 != 2] + [(None, None, "xx", None), (900, "", "yy", None), (901, "text", None, None)]
    model = L.train(docs(spark, train).withColumnRenamed("source", "n"))
    extra = [(500, None), (501, ""), (502, "12 34 !"), (503, "qxqx wvwv jhjh kzkz " * 30), (504, prose(1, 60_000, SETS["yy"]))]
    got = {r["doc_id"]: r for r in L.identify(docs(spark, [*corpus, *extra, (None, "katu pola", "?")]), model).collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] and not got[r[0]]["rejected"] for r in corpus)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3 and all(got[i]["rejected"] for i in (500, 501, 502, 503))
    assert got[504]["lang_pred"] == "yy" and got[None]["lang_pred"] == "xx"


def test_drop_and_empty(spark, corpus):
    df = docs(spark, [*corpus, (500, None), (501, "...")]).withColumnRenamed("n_chars", "lang_pred")
    kept = L.drop_unidentified(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in corpus]
    assert L.drop_unidentified(docs(spark, [], parts=1)).count() == 0
    none = L.train(docs(spark, [(1, "abc", None)]))
    assert [r["lang_pred"] for r in L.identify(docs(spark, [(1, "abc")]), none).collect()] == ["und"]


def test_bounded_model_still_identifies(spark, corpus):
    model = L.train(docs(spark, corpus), max_ngrams=150)
    assert len(model.keys[-1]) <= 150
    got = L.identify(docs(spark, corpus), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95


def test_shards_score_as_the_whole_model(spark, corpus):
    # one small language beside a large one, most counts equal: a pooled cut would take the small one's n-grams
    rows = [*corpus, *[(1000 + i, prose(i, 400, SETS["xx"]), "xx", "s") for i in range(60)], (2000, "nghiêm khuya đường chuyện", "vi", "s")]
    whole, parted = L.train(docs(spark, rows)), L.train(docs(spark, rows), max_ngrams=150)
    assert parted.others and parted.langs == whole.langs == ["vi", "xx", "yy", "zz"]
    keys = np.unique(np.concatenate([parted.keys[-1], *[s.value.keys[-1] for s in parted.others]]))
    assert np.array_equal(keys, whole.keys[-1])
    odd = [(500, None), (501, ""), (502, "qxqx wvwv"), (503, "khuya đường"), (503, "khuya đường")]
    a, b = (sorted(((r["doc_id"], r["lang_pred"], r["rejected"], r["bits"]) for r in L.identify(docs(spark, [*rows, *odd]), m).collect()),
                   key=str) for m in (whole, parted))
    assert len(a) == len(b) == len(rows) + len(odd)
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and (x[3] is None) == (y[3] is None) and (x[3] is None or abs(x[3] - y[3]) < 1e-4)
    assert [r[1] for r in b if r[0] in (503, 2000)] == ["vi"] * 3


def test_limits_come_from_all_labelled_rows(spark):
    """10,400 rows, 13 of them (over one in a thousand) with odd letters: a sample of 10,000 rows takes another limit."""
    odd = "qx jhz wv "
    rows = [(i, prose(i, 4, SETS["xx"]) + (odd * (1 + i // 800) if i % 800 == 0 else ""), "xx") for i in range(10_400)]
    rows += [(20_000 + i, prose(i, 6, SETS["yy"]), "yy") for i in range(50)]
    df = docs(spark, rows)
    model = L.train(df)
    h, size = model.cross_entropy([r[1] for r in rows])
    y = np.array([model.langs.index(r[2]) for r in rows])
    gap = h.min(1, keepdims=True) - h
    nll = [(np.log(np.exp(gap * s).sum(1)) - gap[np.arange(len(y)), y] * s).sum() for s in L.SHARPNESS]
    assert model.sharpness == L.SHARPNESS[int(np.argmin(nll))]
    for i in range(len(model.langs)):
        mine = (h.min(1) - 4 / np.sqrt(size))[(h.argmin(1) == i) & (y == i)]
        assert abs(model.limit[i] - (np.quantile(mine, 0.999) + 1.5)) < 1e-9
