"""Language identification by character language models.

One interpolated Kneser-Ney model of order four per language.  Texts become
lower-case letters with single spaces between runs of letters; an n-gram is one
64-bit key, 16 bits per character.  Per order the keys of all languages lie in
one sorted array with the probability of each language beside it, so scoring is
one binary search per character, and a shorter one for the few it misses.  The
language of least cross-entropy per character wins.

Counting covers all training rows: each task counts its n-grams in numpy and
Spark sums the counts.  No n-gram is dropped.  Beyond ``max_ngrams`` counts the
model is cut into shards by the two middle characters of the 4-gram; all that
a character needs, from its 4-gram down to the bigram, lies in one shard, so
each shard scores its own characters exactly and the sums are added.  Scores
and rejection are calibrated on all labelled rows: tasks sum the likelihood of
each sharpness, and the limits are exact quantiles by language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, _parse_datatype_string

ORDER = 4
SPACE = 32
CHUNK = 250_000         # characters per numpy pass
ROWS = 1000             # texts of a batch in Python at once
SHARPNESS = 2.0 ** np.arange(-2, 9, 0.5)
MIDDLES = 1 << 32       # values of the two middle characters of a 4-gram
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts, which of them count, and each text's number of counted ones.

    Every text starts with ORDER - 1 spaces that don't count, and ends with
    one that does.  Code points beyond 16 bits are folded into 16 bits.
    """
    pad = " " * (ORDER - 1)
    raw = np.frombuffer("".join(f"\x00{t.lower()} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = raw == 0
    if int(first.sum()) != len(texts):       # a NUL inside a text is no letter
        return encode([t.replace("\x00", " ") for t in texts])
    letter = _letters()[raw]
    keep = letter | first
    keep[1:] |= letter[:-1]
    code, first = np.where(letter, raw, SPACE)[keep], first[keep]
    code = np.where(code > 0xFFFF, (code & 0x7FFF) | 0x8000, code).astype(np.uint64)
    at = np.nonzero(first)[0]
    size = np.diff(np.r_[at, len(code)]) - 1
    code = np.insert(code, np.repeat(at, len(pad) - 1), SPACE)
    counted = np.insert(~first, np.repeat(at, len(pad) - 1), False)
    return code, counted, size


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """Key of the n-gram that ends at each character."""
    key = code.copy()
    for i in range(1, n):
        key[i:] |= code[:-i] << np.uint64(16 * i)
    return key


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.nonzero(np.r_[True, k[1:] != k[:-1]])[0]
    return k[first], np.add.reduceat(c, first)


def count_grams(rows: DataFrame, text_col: str, lang_col: str, flush: int = 1_000_000) -> DataFrame:
    """(lang, gram, n) over all rows; each task sums its own counts and flushes at ``flush`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (k, c) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(c)],
                                                 ["lang", "gram", "n"])
            held.clear()

        for b in _few(batches):
            texts: dict[str, list[str]] = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t:
                    texts.setdefault(lang, []).append(t)
            for lang, ts in texts.items():
                for part in _chunks(ts):
                    code, counted, _ = encode(part)
                    k, c = np.unique(grams(code, ORDER)[counted], return_counts=True)
                    held[lang] = _merge([held[lang][0], k], [held[lang][1], c]) if lang in held else (k, c)
            if sum(len(k) for k, _ in held.values()) > flush:
                yield from out()
        yield from out()

    return rows.select(lang_col, text_col).mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ROWS rows."""
    return (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS))


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


@dataclass
class LanguageModels:
    """Sorted keys and log2 probabilities (languages in columns) by order; back-off weights by context.

    A shard scores the characters whose 4-gram has its two middle characters
    in ``middles`` (from, below); ``others`` holds the further shards as
    broadcasts, so that one at a time is in memory.
    """

    langs: list[str]
    keys: list[np.ndarray]          # order 1..ORDER
    logp: list[np.ndarray]
    contexts: list[np.ndarray]      # of order 2..ORDER
    backoff: list[np.ndarray]
    unseen: np.ndarray
    sharpness: float = 1.0
    limit: np.ndarray | None = None
    middles: tuple[int, int] = (0, MIDDLES)
    others: list = field(default_factory=list)

    def char_logp(self, code: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """log2 probability of each counted character in each language (rows follow the characters)."""
        out = np.zeros((int(counted.sum()), len(self.langs)), np.float32)
        todo = np.arange(len(out))
        weight = np.zeros_like(out[:0])
        for n in range(ORDER, 0, -1):
            g = grams(code, n)[counted][todo]
            at = np.minimum(np.searchsorted(self.keys[n - 1], g), max(0, len(self.keys[n - 1]) - 1))
            hit = self.keys[n - 1][at] == g
            if n == ORDER:
                out[todo[hit]] = self.logp[n - 1][at[hit]]
                weight = np.zeros((int((~hit).sum()), len(self.langs)), np.float32)
            else:
                out[todo[hit]] = self.logp[n - 1][at[hit]] + weight[hit]
                weight = weight[~hit]
            todo, g = todo[~hit], g[~hit]
            if not len(todo):
                return out
            if n > 1:
                h = g >> np.uint64(16)
                at = np.minimum(np.searchsorted(self.contexts[n - 2], h), max(0, len(self.contexts[n - 2]) - 1))
                known = self.contexts[n - 2][at] == h
                weight[known] += self.backoff[n - 2][at[known]]
        out[todo] = self.unseen + weight
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text (rows) in each language, and its characters; a shard adds its own characters only."""
        parts, sizes = [], []
        for part in _chunks(texts):
            code, counted, size = encode(part)
            owner = np.repeat(np.arange(len(size)), size)
            if self.middles != (0, MIDDLES):
                middle = (grams(code, ORDER)[counted] >> np.uint64(16)) & np.uint64(MIDDLES - 1)
                mine = (middle >= self.middles[0]) & (middle < self.middles[1])
                owner, counted = owner[mine], np.isin(np.arange(len(code)), np.nonzero(counted)[0][mine])
            lp = self.char_logp(code, counted)
            h = np.stack([-np.bincount(owner, lp[:, k], len(size)) for k in range(len(self.langs))], 1)
            parts.append(h / np.maximum(size, 1)[:, None])
            sizes.append(size)
        return (np.concatenate(parts), np.concatenate(sizes)) if parts else (np.zeros((0, len(self.langs))), np.zeros(0, int))


def discount(n1, n2):
    return np.clip(n1 / np.maximum(n1 + 2 * n2, 1), 0.1, 0.9)


def kneser_ney(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray,
               short: dict[int, tuple] | None = None, discounts: dict[int, np.ndarray] | None = None) -> LanguageModels:
    """Models from counts of order-ORDER n-grams (``lang`` indexes ``langs``).

    Lower orders count distinct left neighbours.  Discounts are
    n1 / (n1 + 2 n2) by language and order, held in 0.1..0.9.  A shard is given
    the ``short`` orders (language, n-gram, count) and the discounts of the
    whole model.
    """
    L = len(langs)
    gram = gram.view(np.uint64)
    counts = [None] * (ORDER + 1)
    counts[ORDER] = (lang, gram, n.astype(float))
    for k in range(ORDER - 1, 0, -1):
        if short and k in short:
            counts[k] = short[k]
            continue
        lo, g, _ = counts[k + 1]
        cut = g & np.uint64((1 << (16 * k)) - 1)
        order = np.lexsort((cut, lo))
        lo, cut = lo[order], cut[order]
        first = np.nonzero(np.r_[True, (cut[1:] != cut[:-1]) | (lo[1:] != lo[:-1])])[0] if len(cut) else np.empty(0, int)
        counts[k] = (lo[first], cut[first], np.diff(np.r_[first, len(cut)]).astype(float))
    letters = len(np.unique(counts[1][1])) + 1
    keys, logp, contexts, backoff = [], [], [], []
    unseen = None
    for k in range(1, ORDER + 1):
        lo, g, c = counts[k]
        d = discounts[k] if discounts else np.array([discount(np.sum(c[lo == i] == 1), np.sum(c[lo == i] == 2)) for i in range(L)])
        h = g >> np.uint64(16)
        ctx, at = np.unique(h, return_inverse=True)
        total, kinds = np.zeros((len(ctx), L)), np.zeros((len(ctx), L))
        np.add.at(total, (at, lo), c)
        np.add.at(kinds, (at, lo), 1)
        gamma = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        union, row = np.unique(g, return_inverse=True)
        p = np.zeros((len(union), L))
        uctx = np.searchsorted(ctx, union >> np.uint64(16))
        p[row, lo] = np.maximum(c - d[lo], 0) / total[at, lo]
        if k == 1:
            lower = np.full((len(union), L), 1.0 / letters)
            unseen = np.log2(gamma[0] / letters) if len(ctx) else np.full(L, -np.log2(letters))
        else:
            lower = 2.0 ** logp[-1][np.searchsorted(keys[-1], union & np.uint64((1 << (16 * (k - 1))) - 1))]
            contexts.append(ctx)
            backoff.append(np.log2(gamma).astype(np.float32))
        keys.append(union)
        logp.append(np.log2(p + gamma[uctx] * lower).astype(np.float32))
    return LanguageModels(langs, keys, logp, contexts, backoff, unseen.astype(np.float32))


def calibrate(model: LanguageModels, scored: DataFrame, share: float = 0.001, slack: float = 1.5) -> None:
    """Set the sharpness of scores and, by language, the bits beyond which a text is rejected.

    ``scored`` is a written table (lang, size, h) of all labelled rows.  The
    sharpness is the one under which they are likeliest.  All but ``share`` of
    a language's rows lie under its limit, to which ``slack`` bits and, for
    short texts, 4 / sqrt(characters) bits are added: a text of the language
    with odd matter in it stays, one of other letters goes.
    """
    from loanlens.plans.prefix import quantiles_of_counts
    where, width = {x: i for i, x in enumerate(model.langs)}, len(model.langs)
    model.limit = np.full(width, np.inf)
    scored = scored.filter("size > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nll = np.zeros(len(SHARPNESS))
        for b in batches:
            h = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            gap = h.min(1, keepdims=True) - h
            mine = gap[np.arange(len(gap)), [where[x] for x in b.column(0).to_pylist()]] if len(gap) else np.zeros(0)
            nll += [(np.log(np.exp(gap * k).sum(1)) - mine * k).sum() for k in SHARPNESS]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(nll)), pa.int32()), pa.array(nll)], ["k", "nll"])

    sums = scored.select("lang", "h").mapInArrow(run, "k int, nll double").groupBy("k").agg(F.sum("nll").alias("nll")).collect()      # a row per sharpness
    if sums:
        model.sharpness = float(SHARPNESS[min(sums, key=lambda r: (r["nll"], r["k"]))["k"]])
    low = F.array_min("h")
    top = F.get(F.array(*[F.lit(x) for x in model.langs]), (F.array_position("h", low) - 1).cast("int"))
    over = scored.select("lang", (low - 4 / F.sqrt("size")).alias("over"), top.alias("top")).filter("top = lang")
    counts = over.groupBy("lang", "over").agg(F.count("*").alias("n"))
    for r in quantiles_of_counts(counts, ["lang"], "over", "n", [1 - share]).collect():                # a row per language
        model.limit[where[r["lang"]]] = r["quantiles"][0] + slack


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", max_ngrams: int = 1_000_000) -> LanguageModels:
    """Models of all languages of ``rows`` (rows without text or language are left out).

    ``max_ngrams`` bounds the 4-gram counts of one shard: beyond it there are
    more shards (one pair of middle characters is never parted).  Scores and
    limits are calibrated on all of ``rows``.
    """
    from loanlens.llm.common import shared_table
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = shared_table(count_grams(rows, "text", "lang"), "langid-grams")
    model = _sharded(counts, max_ngrams) if counts.count() > max_ngrams else _whole(counts)
    if model.langs:
        calibrate(model, shared_table(_scored(rows, model, "text").select("lang", "size", "h"), "langid-labelled"))
    return model


def _whole(counts: DataFrame) -> LanguageModels:
    """One shard of all counts."""
    table = counts.toPandas()                                          # at most max_ngrams rows
    langs = sorted(table["lang"].unique())
    lang = table["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    return kneser_ney(langs, lang, table["gram"].to_numpy(np.int64), table["n"].to_numpy())


def _sharded(counts: DataFrame, max_ngrams: int) -> LanguageModels:
    """The first shard, with broadcasts of the others.

    Orders 1 and 2 and the discounts of all orders come from all counts, by
    Spark; a shard has all 4-grams around its middles, hence all trigrams that
    begin with them and their counts.
    """
    from loanlens.llm.common import shared_table
    sc = counts.sparkSession.sparkContext
    middle = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(MIDDLES - 1))
    counts = shared_table(counts.withColumn("middle", middle).orderBy("middle"), "langid-middles")     # shards read their files only
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        cut = F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1)).alias("gram")
        orders[k] = shared_table(orders[k + 1].groupBy("lang", cut).agg(F.count("*").alias("n")), f"langid-order{k}")
    few = {k: {r["lang"]: r for r in t.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("a"), F.count_if(F.col("n") == 2).alias("b")).collect()}
           for k, t in orders.items()}
    langs = sorted(few[ORDER])
    where = {x: i for i, x in enumerate(langs)}
    discounts = {k: np.array([discount(r[x]["a"], r[x]["b"]) for x in langs]) for k, r in few.items()}

    def arrays(t: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = t.select("lang", "gram", "n").toPandas()
        return t["lang"].map(where).to_numpy(np.int64), t["gram"].to_numpy(np.int64).view(np.uint64), t["n"].to_numpy(float)

    short = {k: arrays(orders[k]) for k in (1, 2)}                     # pairs of characters
    starts, held = [0], 0
    for r in counts.groupBy("middle").count().orderBy("middle").toLocalIterator():
        if held and held + r["count"] > max_ngrams:
            starts.append(r["middle"])
            held = 0
        held += r["count"]
    first = None
    for lo, hi in zip(starts, [*starts[1:], MIDDLES]):
        lang, gram, n = arrays(counts.filter((F.col("middle") >= lo) & (F.col("middle") < hi)))       # at most max_ngrams rows
        shard = kneser_ney(langs, lang, gram, n, short, discounts)
        shard.middles = (lo, hi)
        if first is None:
            first = shard
        else:
            first.others.append(sc.broadcast(shard))
    return first


def _entropies(model, part: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            h, size = model.value.cross_entropy([t or "" for t in b.column(text_at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:text_at], *b.columns[text_at + 1:], pa.array([part] * len(size), pa.int32()),
                                              pa.array(size.astype(np.int64)), pa.array(h.tolist(), pa.list_(pa.float64()))],
                                             [*b.schema.names[:text_at], *b.schema.names[text_at + 1:], "part", "size", "h"])
    return run


def _scored(rows: DataFrame, model: LanguageModels, text_col: str) -> DataFrame:
    """``rows`` without the text, plus its ``size`` and ``h``, the bits per character in each language."""
    at, sc = rows.columns.index(text_col), rows.sparkSession.sparkContext
    schema = StructType([*[f for f in rows.schema.fields if f.name != text_col],
                         *_parse_datatype_string("part int, size long, h array<double>").fields])
    if not model.others:
        return rows.mapInArrow(_entropies(sc.broadcast(model), 0, at), schema).drop("part")
    return _added(rows.withColumn("__row", F.monotonically_increasing_id()), model, text_col).drop("__row")


def _added(rows: DataFrame, model: LanguageModels, text_col: str) -> DataFrame:
    """``rows`` without the text, plus ``size`` and ``h`` summed over all shards; ``__row`` numbers the rows."""
    from loanlens.llm.common import shared_table
    sc = rows.sparkSession.sparkContext
    rows = shared_table(rows, "langid-rows")                           # every shard meets the same row numbers
    texts = rows.select("__row", text_col)
    own = replace(model, others=[])
    parts = [texts.mapInArrow(_entropies(shard, i, 1), "__row long, part int, size long, h array<double>")
             for i, shard in enumerate([sc.broadcast(own), *model.others])]
    sums = reduce(DataFrame.unionAll, parts).groupBy("__row").agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("part", "h"))).alias("parts"))
    # The shards are added in one order, so that sums do not hang on the order of arrival.
    h = F.expr(f"transform(sequence(0, {len(model.langs) - 1}), i -> aggregate(parts, 0D, (s, x) -> s + x.h[i]))")
    return rows.drop(text_col).join(sums.select("__row", "size", h.alias("h")), "__row")


def identify(docs: DataFrame, model: LanguageModels, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score``, ``bits`` per character, ``letters`` and ``rejected`` (names with ``prefix``).

    Input columns of these names are replaced.

    Texts that are null or have no letter get ``und``, score 0 and are
    rejected; so is every text if there is no model.  Other texts get the
    language of least cross-entropy (the first by name of equals) and are
    rejected if it exceeds that language's limit.
    """
    names = [f"{prefix}{c}" for c in ("lang_pred", "score", "bits", "letters", "rejected")]
    docs = docs.drop(*names)
    at = docs.columns.index(text_col)
    ready = bool(model.others)                  # entropies of several shards are added before
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, keys=[], logp=[], contexts=[], backoff=[], others=[]) if ready else model)
    kinds = [StringType(), DoubleType(), DoubleType(), LongType(), LongType()]
    schema = StructType([*docs.schema.fields, *[StructField(n, k) for n, k in zip(names, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in _few(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            if not m.langs:
                cols = [["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), [0] * len(texts), [1] * len(texts)]
            else:
                if ready:
                    h, size = np.array(b.column("__h").to_pylist(), float).reshape(-1, len(m.langs)), b.column("__size").to_numpy()
                else:
                    h, size = m.cross_entropy(texts)
                top = h.argmin(1) if len(h) else np.zeros(0, int)
                low = h[np.arange(len(top)), top]
                some = size > 0
                score = np.where(some, 1 / np.exp((low[:, None] - h) * m.sharpness).sum(1), 0.0)
                limit = m.limit if m.limit is not None else np.full(len(m.langs), np.inf)
                bad = ~some | (low - 4 / np.sqrt(np.maximum(size, 1)) > limit[top])
                cols = [[m.langs[t] if s else "und" for t, s in zip(top, some)], score, low, size.astype(np.int64), bad.astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], [*b.schema.names[:width], *names])

    width = len(docs.columns)
    if ready:
        from loanlens.llm.common import shared_table
        rows = shared_table(docs.withColumn("__row", F.monotonically_increasing_id()), "langid-docs")
        added = _added(rows.select("__row", text_col), model, text_col)
        docs = rows.join(added, "__row").select(*docs.columns, F.col("size").alias("__size"), F.col("h").alias("__h"))
    return docs.mapInArrow(run, schema)


def drop_unidentified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows whose language is identified, with all their columns; models are trained on the rows themselves.

    Columns of any name are kept as they are.
    """
    model = train(docs, text_col, lang_col, **options)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return identify(plain, model, f"c{docs.columns.index(text_col)}").filter("rejected = 0").select(*plain.columns).toDF(*docs.columns)
