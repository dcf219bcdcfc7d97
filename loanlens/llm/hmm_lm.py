"""Scoring texts by a hidden Markov language model.

Tokens are the words of a text and one end.  The most frequent words are
symbols of their own; all other words fall into spelling classes (by their last
three bytes), and a class symbol is spelled out by the word's smoothed
share of its class.  The vocabulary counts cover every training text and are
joined, never broadcast; only the ``listed`` most frequent words are.

Baum-Welch: in every round each task runs scaled forward-backward over its whole
texts and returns expected counts, Spark sums them by symbol, and the driver
normalises (states x symbols numbers).  All rounds take all training rows; they
end when the likelihood settles.  Texts of more than ``TOKENS`` tokens are passed
in segments that hand the state on in both directions, so nothing is cut and
memory stays bounded.  Scoring runs the scaled forward recursion over each whole
text, so its likelihood is exact.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import shared_table, top_rows

CLASSES = 128
TAIL = 3                # bytes of a word that decide its class
TOKENS = 250_000        # tokens of one numpy pass
PRIOR = 10.0            # tokens of the unigram distribution that every state's emissions count besides their own
ROWS = 1000             # texts split into words at once
SCALED = 4              # steps of the recursion between two scalings; an emission and a move stay above 1e-70


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-TAIL:]) % CLASSES


@dataclass
class Vocabulary:
    """The listed words: symbol, unigram and in-class log10 probability; end is symbol ``top + CLASSES``."""

    index: dict[bytes, int]
    symbol: np.ndarray
    base: np.ndarray
    within: np.ndarray
    top: int
    end_base: float

    @property
    def symbols(self) -> int:
        return self.top + CLASSES + 1


def count_words(docs: DataFrame, text_col: str, flush: int = 200_000) -> DataFrame:
    """(word, c) over all rows; tasks sum their own counts and flush at ``flush`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return b

        for b in batches:
            for t in b.column(0).to_pylist():
                held.update((t or "").encode().lower().split())
                if len(held) > flush:
                    yield out()
        yield out()

    return docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(id, held_out, text) rows to symbols (bytes of 32-bit numbers), sums over listed words, and the other words with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        get = v.index.get
        for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            symbols, sums, rare, times = [], [], [], []
            for t in b.column(3).to_pylist():
                words = (t or "").encode().lower().split()
                at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                listed = at[at >= 0]
                s = np.empty(len(words) + 1, np.int32)
                s[:-1][at >= 0] = v.symbol[listed]
                other = np.nonzero(at < 0)[0]
                s[other] = [v.top + word_class(words[i]) for i in other]
                s[-1] = v.symbols - 1
                c = Counter(words[i] for i in other)
                symbols.append(s)
                sums.append((len(listed), v.base[listed].sum() + v.end_base, v.within[listed].sum()))
                rare.append(list(c))
                times.append(list(c.values()))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2),
                pa.array([s.tobytes() for s in symbols], pa.binary()),
                pa.array([x[0] for x in sums], pa.int64()), pa.array([x[1] for x in sums], pa.float64()),
                pa.array([x[2] for x in sums], pa.float64()), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                ["rid", "id", "held_out", "symbols", "n_listed", "base", "within", "rare", "times"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.withColumn("rid", F.monotonically_increasing_id()).select("rid", "id", "held_out", "text").mapInArrow(
        run, f"rid long, id {kind}, held_out boolean, symbols binary, n_listed long, base double, within double, "
             "rare array<binary>, times array<long>")


def unpacked(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a column in a row, and how many each text has; of bytes as :func:`encode` writes them, or of lists."""
    if pa.types.is_list(col.type):
        return col.flatten().to_numpy(zero_copy_only=False), col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    texts = col.to_pylist()
    return np.frombuffer(b"".join(texts), np.int32), np.array([len(x) // 4 for x in texts], np.int64)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray        # symbols x states


def first_model(counts: np.ndarray, states: int, seed: int) -> Model:
    r = np.random.default_rng(seed)
    emit = (counts + 0.1)[:, None] * np.exp(r.normal(0, 1, (len(counts), states)))
    move = np.full((states, states), 0.02 / states) + 0.98 * np.eye(states)       # states first part texts by topic or language
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def _by_time(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences sorted by falling length: tokens in order of time, and how many sequences live at each time."""
    n = int(lengths.sum())
    t = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    live = np.bincount(t)
    order = np.empty(n, np.int64)
    order[(np.cumsum(live) - live)[t] + np.repeat(np.arange(len(lengths)), lengths)] = np.arange(n)
    return order, live


def forward(m: Model, tokens: np.ndarray, live: np.ndarray, first: np.ndarray | None = None,
            seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward recursion; ln likelihood of each sequence, the states of all tokens, the last states.

    Arrays of states stand token by token (tokens x states), so that every step
    works on one unbroken block.  States are scaled to sum 1 at every
    ``SCALED``-th token and at the last of each sequence.  ``first`` stands for
    the start distribution, ``seen`` is the emission of each token if it is
    known already; it is divided by the scales.
    """
    k = len(m.start)
    total, states, ones = np.zeros(live[0]), np.empty((len(tokens), k)), np.ones((k, k))
    seen = m.emit.take(tokens, 0) if seen is None else seen
    at, alpha = 0, None
    for t, n in enumerate(live.tolist()):
        prior = (m.start[None] if first is None else first) if alpha is None else alpha[:n] @ m.move
        here = seen[at:at + n]
        alpha = np.multiply(prior, here, out=states[at:at + n])
        if t % SCALED == SCALED - 1:
            c = alpha @ ones                # the sum, in every column
            alpha /= c
            here /= c
            total[:n] += np.log(c[:, 0])
        at += n
    last = np.repeat(np.arange(len(live)), live - np.r_[live[1:], 0])[::-1]         # the time at which each sequence ends
    ends = (np.cumsum(live) - live)[last] + np.arange(live[0])
    c = states[ends].sum(1, keepdims=True)
    states[ends] /= c
    seen[ends] /= c
    return total + np.log(c[:, 0]), states, alpha


def expected_counts(m: Model, tokens: np.ndarray, live: np.ndarray, first: np.ndarray | None = None,
                    ahead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray]:
    """Forward-backward: expected first states, moves and emissions, the ln likelihood, and what the first token hands back.

    ``first`` and ``ahead`` (1 x states) continue a sequence that stands in several segments.
    """
    k = len(m.start)
    seen, onward = m.emit.take(tokens, 0), np.ascontiguousarray(m.move.T)
    total, alpha, _ = forward(m, tokens, live, first, seen)
    moves, end = np.zeros((k, k)), len(tokens)
    for n in live[::-1].tolist():
        at = end - n
        mine, back = alpha[at:end], seen[at:end]
        if ahead is not None:
            some = len(ahead)
            moves += mine[:some].T @ ahead
            beta = ahead @ onward
            mine[:some] *= beta
            back[:some] *= beta
        ahead, end = back, at
    cells = tokens.astype(np.int64)[:, None] * k + np.arange(k)
    emits = np.bincount(cells.ravel(), alpha.ravel(), m.emit.size).reshape(m.emit.shape)
    return alpha[:live[0]].sum(0), moves * m.move, emits, float(total.sum()), ahead


def long_counts(m: Model, tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """:func:`expected_counts` of one long sequence, ``size`` tokens held at once."""
    parts = [tokens[a:a + size] for a in range(0, len(tokens), size)]
    firsts: list[np.ndarray | None] = [None]
    for p in parts[:-1]:
        firsts.append(forward(m, p, np.ones(len(p), int), first=firsts[-1])[2] @ m.move)
    moves, emits, total, ahead = np.zeros_like(m.move), np.zeros_like(m.emit), 0.0, None
    for p, first in zip(parts[::-1], firsts[::-1]):
        starts, mv, e, x, ahead = expected_counts(m, p, np.ones(len(p), int), first, ahead)
        moves, emits, total = moves + mv, emits + e, total + x
    return starts, moves, emits, total


def long_likelihood(m: Model, tokens: np.ndarray, size: int) -> float:
    """ln likelihood of one long sequence, ``size`` tokens held at once."""
    total, first = 0.0, None
    for a in range(0, len(tokens), size):
        ll, _, last = forward(m, tokens[a:a + size], np.ones(len(tokens[a:a + size]), int), first)
        total, first = total + float(ll[0]), last @ m.move
    return total


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences by falling length, in groups of about TOKENS tokens."""
    order = np.argsort(-lengths, kind="stable")
    upto = np.cumsum(lengths[order]) // TOKENS
    for cut in np.split(order, np.nonzero(np.diff(upto))[0] + 1) if len(order) else []:
        yield cut


def _gather(flat: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return flat[np.arange(lengths.sum()) + np.repeat(start - np.cumsum(lengths) + lengths, lengths)]


def baum_welch_round(encoded: DataFrame, m: Model, unigram: np.ndarray) -> tuple[Model, float, float]:
    """One round over all rows of ``encoded``: counts by task, summed by Spark, normalised here.

    A task returns a row of each symbol it meets, so the round has as many
    tasks as run at once, not one per piece of the input: the rows then grow
    with the symbols alone.

    The new model, the ln likelihood of the rows under the old one, and their tokens.
    """
    context = encoded.sparkSession.sparkContext
    k, shared = len(m.start), context.broadcast(m)

    def counted(m: Model, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
        for i in np.nonzero(size > TOKENS)[0]:
            yield long_counts(m, flat[start[i]:start[i] + size[i]], TOKENS)
        rest = np.nonzero(size <= TOKENS)[0]
        for g in _groups(size[rest]):
            order, live = _by_time(size[rest[g]])
            yield expected_counts(m, _gather(flat, start[rest[g]], size[rest[g]])[order], live)[:4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        emits, moves, starts, ll, n = np.zeros((len(m.emit), k)), np.zeros((k, k)), np.zeros(k), 0.0, 0
        for b in batches:
            flat, size = unpacked(b.column(0))
            start, n = np.cumsum(size) - size, n + len(flat)
            for s, mv, e, x in counted(m, flat, start, size):
                starts += s
                moves += mv
                emits += e
                ll += x
        rows = np.concatenate([emits, moves, starts[None], np.r_[ll, n, np.zeros(k - 2)][None]])
        some = np.nonzero(rows.any(1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(rows[some, i]) for i in range(k)]], ["row", *[f"s{i}" for i in range(k)]])

    cols = [f"s{i}" for i in range(k)]
    summed = encoded.select("symbols").coalesce(max(1, context.defaultParallelism)).mapInArrow(run, "row long, " + ", ".join(f"{c} double" for c in cols)).groupBy("row").agg(
        *[F.sum(c).alias(c) for c in cols]).collect()                       # symbols + states + 2 rows
    table = np.zeros((len(m.emit) + k + 2, k))
    for r in summed:
        table[r["row"]] = [r[c] for c in cols]
    v = len(m.emit)
    ll, n = float(table[v + k + 1, 0]), float(table[v + k + 1, 1])
    if not n:
        return m, 0.0, 0.0
    emits, moves, starts = table[:v] + PRIOR * unigram[:, None], table[v:v + k] + 0.1, table[v + k] + 0.1
    return Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0)), ll, n


def train(encoded: DataFrame, counts: np.ndarray, states: int, max_rounds: int, tolerance: float, seed: int) -> Model:
    """Rounds over all rows until one gains at most ``tolerance`` ln a token, ``max_rounds`` at most."""
    m, last = first_model(counts, states, seed), None
    unigram = (counts + 0.1) / (counts + 0.1).sum()
    for _ in range(max_rounds):
        m, ll, n = baum_welch_round(encoded, m, unigram)
        if not n or (last is not None and ll - last <= tolerance * n):
            break
        last = ll
    return m


def score_lm(docs: DataFrame, held_out: str = "held_out", id_col: str = "doc_id", text_col: str = "text", listed: int = 100_000,
             top: int | None = None, states: int = 8, max_rounds: int = 12, tolerance: float = 0.015, seed: int = 7) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows whose ``held_out`` is false and scores all.
    ``base_score`` is the unigram log10 probability with half a count added
    (one further type stands for all unseen words); ``score`` is the log10
    probability under the hidden Markov model.  The ``top`` most frequent words
    are symbols of their own: by default one in 256 distinct training words, at
    least 1024 and at most ``listed``.  At least two states.  A null text is the empty text:
    one token, the end.  Repeated rows each count and keep their row.  With
    no training row all words are unseen.  An empty table gives an empty
    result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    counts = shared_table(count_words(docs.filter("not held_out"), "text"), "hmm-words")
    ends = docs.filter("not held_out").count()
    words = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n, v = words["n"] + ends, words["v"] + (ends > 0)
    floor = n + 0.5 * (v + 1)
    head = sorted(top_rows(counts, F.col("c"), listed).collect(), key=lambda r: (-r["c"], r["word"]))      # at most ``listed`` rows
    names, freq = [bytes(r["word"]) for r in head], np.array([r["c"] for r in head], float)
    top = min(max(1024, v // 256) if top is None else top, len(names))

    classed = counts.withColumn("class", (F.crc32(F.substring("word", -TAIL, TAIL)) % CLASSES).cast("int"))
    sizes = np.zeros((CLASSES, 2))
    for r in classed.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():     # CLASSES rows
        sizes[r["class"]] = r["n"], r["v"]
    kind = np.array([word_class(w) for w in names], int)
    for i in range(top):
        sizes[kind[i]] -= freq[i], 1
    class_floor = sizes[:, 0] + 0.5 * (sizes[:, 1] + 1)
    symbol = np.where(np.arange(len(names)) < top, np.arange(len(names)), top + kind) if names else np.empty(0, int)
    within = np.where(np.arange(len(names)) < top, 0.0, np.log10((freq + 0.5) / class_floor[kind])) if names else np.empty(0)
    vocab = Vocabulary({w: i for i, w in enumerate(names)}, symbol.astype(np.int32), np.log10((freq + 0.5) / floor), within, top,
                       float(np.log10((ends + 0.5) / floor)))
    encoded = shared_table(encode(docs, vocab), "hmm-symbols")
    totals = np.concatenate([freq[:top], sizes[:, 0], [ends]])
    m = train(encoded.filter("not held_out"), totals, states, max_rounds, tolerance, seed)

    # The other words: joined to the counts of the whole vocabulary.
    floors = F.array(*[F.lit(float(x)) for x in class_floor])
    rare = encoded.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("rid", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    rare = rare.join(counts, "word", "left").withColumn(
        "floor", F.get(floors, (F.crc32(F.substring("word", -TAIL, TAIL)) % CLASSES).cast("int"))).groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(float(floor)))).alias("rare_base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.col("floor"))).alias("rare_within"))

    shared = docs.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, size = unpacked(b.column(6))
            start, ln = np.cumsum(size) - size, np.zeros(len(size))
            for i in np.nonzero(size > TOKENS)[0]:
                ln[i] = long_likelihood(shared.value, flat[start[i]:start[i] + size[i]], TOKENS)
            rest = np.nonzero(size <= TOKENS)[0]
            for g in _groups(size[rest]):
                g = rest[g]
                order, live = _by_time(size[g])
                ln[g], _, _ = forward(shared.value, _gather(flat, start[g], size[g])[order], live)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(size), pa.array(ln / np.log(10))],
                                             ["rid", "id", "held_out", "n_listed", "base", "within", "n_tokens", "ln"])

    scored = encoded.select("rid", "id", "held_out", "n_listed", "base", "within", "symbols").mapInArrow(
        run, f"rid long, id {docs.schema['id'].dataType.simpleString()}, held_out boolean, n_listed long, base double, within double, "
             "n_tokens long, ln double")
    zero = F.lit(0.0)
    return scored.join(rare, "rid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_listed") + F.coalesce("rare_known", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("ln") + F.col("within") + F.coalesce("rare_within", zero)).alias("score"))
