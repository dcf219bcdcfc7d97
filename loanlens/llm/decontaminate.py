"""Benchmark decontamination: BM25 over an inverted index of test items.

The index holds the items, not the corpus: for each word its postings (item,
impact) and, per block of items, the largest impact.  Impacts are BM25
contributions divided by the item's score against itself, so scores of all
items lie in 0..1 and one threshold serves all.  Every passage of every
training document is a query.  Block-max WAND in array form:

1. words that occur in many items are non-essential; the sum of their largest
   impacts bounds what they can add to any item;
2. for the other words block maxima are summed per (passage, block), and pairs
   whose bound stays under the threshold are skipped;
3. the items of the remaining blocks get their exact scores.

All items at or above the threshold are verified: the share ``min_overlap`` of
the item's words must lie in three-word shingles that occur in the passage, so
that one changed word costs its own place only, and of its question's and of
its answer's words half must be there each, so that an item of which the answer
is missing does not count.

Number of items, document frequencies and mean length are counted over all items
in Spark, and an item's passages depend on its own length class only, so an
item's scores are the same however many items there are and however they are
dealt.  Items of up to ``WIDTHS[0]`` words share an index, longer ones the next;
passages of an index are windows of twice its width that advance by half their
length, so that any of its items lies whole in one of them, and one long item
does not widen the passages of the others.  The pass over the corpus is
map-only.  Items beyond ``max_items`` take further passes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from loanlens.llm.common import shared_table, small_or_shuffled

K1, B = 1.2, 0.75
SHINGLE = 3
MIN_WORDS = 0.5         # share of the question's, and of the answer's, words
ITEM_BLOCK = 32
CELLS = 500_000         # most cells of one scoring array
TOKENS = 200_000        # words of the texts matched at once
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WIDTHS = tuple(64 * 8 ** i for i in range(12))
_MATCHES = "array<struct<item:bigint,bm25:double,overlap:double,question_overlap:double,answer_overlap:double>>"


def words(text: str) -> list[bytes]:
    """Lower-case words; ASCII punctuation and white space separate."""
    return text.lower().encode().translate(_SPACED).split()


def question_answer(text: str) -> tuple[str, str]:
    """The last line or else the last sentence is the answer; an item of one sentence is all question."""
    parts = re.split(r"\n+", text.strip())
    if len(parts) == 1:
        parts = re.split(r"(?<=[.!?…])\s+", parts[0])
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (parts[0], "")


def shingles(w: list[bytes]) -> list[tuple[bytes, ...]]:
    """The three-word shingles in order; of fewer words the whole sequence."""
    k = min(SHINGLE, len(w))
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if k else []


def covered(wanted: list[tuple[bytes, ...]], there: set[tuple[bytes, ...]]) -> float:
    """Share of the words that lie in a shingle that is there."""
    k = len(wanted[0])
    places = {i + j for i, x in enumerate(wanted) if x in there for j in range(k)}
    return len(places) / (len(wanted) + k - 1)


class ItemIndex:
    """BM25 impacts of the items by word, with block maxima.

    ``whole`` describes all items if these are some of them: their number,
    their mean length and the document frequency of each word.
    """

    def __init__(self, items: list[tuple[int, str]], width: int = 32, whole: tuple[int, float, dict[bytes, int]] | None = None):
        kept = [(i, t, words(t)) for i, t in items if t and words(t)]
        kept.sort(key=lambda x: len(x[2]))
        self.ids = [i for i, _, _ in kept]
        n = len(kept)
        lengths = np.array([len(w) for _, _, w in kept], float)
        self.stride = max(width, int(lengths.max(initial=0)))
        bags = [Counter(w) for _, _, w in kept]
        df = Counter(w for b in bags for w in b)
        total, mean, df = whole or (n, lengths.mean() if n else 0.0, df)
        self.vocab = {w: k for k, w in enumerate(df)}
        idf = np.array([np.log(1 + (total - c + 0.5) / (c + 0.5)) for c in df.values()])
        term = np.array([self.vocab[w] for b in bags for w in b], np.int64)
        item = np.repeat(np.arange(n), [len(b) for b in bags])
        tf = np.array([c for b in bags for c in b.values()], float)
        norm = K1 * (1 - B + B * lengths / mean) if n else lengths
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item]) if n else tf
        impact = impact / np.bincount(item, impact, n)[item] if n else impact
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(len(df) + 1))
        self.blocks = max(1, -(-n // ITEM_BLOCK))
        key = term[order] * self.blocks + self.item // ITEM_BLOCK
        first = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0] if n else np.empty(0, np.int64)
        self.block_max = np.maximum.reduceat(self.impact, first) if n else self.impact
        self.block = key[first] % self.blocks
        self.block_start = np.searchsorted(key[first] // self.blocks, np.arange(len(df) + 1))
        self.top = np.maximum.reduceat(self.impact, self.start[:-1]) if n else self.impact
        self.common = np.array([c > max(4, total / 20) for c in df.values()], bool)
        self.shingles = [shingles(w) for _, _, w in kept]
        parts = [question_answer(t) for _, t, _ in kept]
        self.question, self.answer = [set(words(q)) for q, _ in parts], [set(words(a)) for _, a in parts]

    def retrieve(self, passage: np.ndarray, term: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, ...]:
        """(passage, item, score) of all items at or above the threshold; (passage, term) pairs are distinct and sorted."""
        out = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        rest = np.bincount(passage, self.top[term] * self.common[term], n)
        bound = np.bincount(passage, self.top[term], n)
        step = max(1, CELLS // max(self.blocks, len(self.ids) or 1))
        live = np.nonzero(bound >= threshold)[0]
        for at in range(0, len(live), step):
            part = live[at:at + step]
            slot = np.full(n, -1)
            slot[part] = np.arange(len(part))
            mine = slot[passage] >= 0
            p, t = slot[passage[mine]], term[mine]
            rare = ~self.common[t]
            rp, rows = _expand(p[rare], t[rare], self.block_start)
            sums = np.bincount(rp * self.blocks + self.block[rows], self.block_max[rows], len(part) * self.blocks)
            open_ = (sums.reshape(len(part), self.blocks) + rest[part][:, None]) >= threshold - 1e-9
            keep = open_.any(1)[p]
            p, rows = _expand(p[keep], t[keep], self.start)
            item = self.item[rows]
            ok = open_[p, item // ITEM_BLOCK]
            score = np.bincount(p[ok] * len(self.ids) + item[ok], self.impact[rows][ok], len(part) * len(self.ids))
            hit = np.nonzero(score >= threshold)[0]
            out.append((part[hit // len(self.ids)], hit % len(self.ids), score[hit]))
        return tuple(np.concatenate(c) for c in zip(*out))


def _expand(p: np.ndarray, t: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (p, t) once for every entry of t's list: p and the entry's row."""
    size = start[t + 1] - start[t]
    rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[t], size)
    return np.repeat(p, size), rows


def _share(wanted: set, there: set) -> float:
    """Share of the wanted words that are there (none wanted: 1)."""
    return len(wanted & there) / len(wanted) if wanted else 1.0


def overlaps(index: ItemIndex, j: int, passage: list[bytes]) -> tuple[float, float, float]:
    """Shares of the item's words in shingles of the passage, and of its question's and its answer's words in the passage."""
    k = len(index.shingles[j][0])
    there = {tuple(passage[i:i + k]) for i in range(len(passage) - k + 1)}
    return covered(index.shingles[j], there), _share(index.question[j], set(passage)), _share(index.answer[j], set(passage))


def match_documents(indexes: list[ItemIndex], texts: list[str], threshold: float, min_overlap: float) -> list[list[dict]]:
    """Verified items of each text, best passage each."""
    found: list[list[dict]] = [[] for _ in texts]
    at, size = 0, 0
    group: list[list[bytes]] = []
    for i, t in enumerate([*texts, None]):
        if t is None or size > TOKENS:
            for index in indexes:
                for k, hits in enumerate(_match_group(index, group, threshold, min_overlap) if index.ids else ()):
                    found[at + k] += hits
            at, size, group = i, 0, []
        if t is not None:
            group.append(words(t))
            size += len(group[-1])
    return found


def _match_group(index: ItemIndex, docs: list[list[bytes]], threshold: float, min_overlap: float) -> list[list[dict]]:
    s, found = index.stride, [{} for _ in docs]
    lengths = np.array([len(d) for d in docs], np.int64)
    passages = np.maximum(1, -(-lengths // s) - 1)
    base = np.cumsum(passages) - passages
    total = int(lengths.sum())
    get = index.vocab.get
    ids = np.fromiter((x for d in docs for x in map(get, d, repeat(-1))), np.int64, total)
    doc = np.repeat(np.arange(len(docs)), lengths)
    block = (np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // s
    known = ids >= 0
    ids, doc, block = ids[known], doc[known], block[known]
    last = passages[doc] - 1
    v = len(index.vocab)
    pairs = np.concatenate([base[doc] + np.minimum(block, last), base[doc] + np.maximum(block - 1, 0)]) * v + np.tile(ids, 2)
    pairs.sort()
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    p, item, score = index.retrieve(pairs // v, pairs % v, int(passages.sum()), threshold)
    owner = np.searchsorted(base, p, side="right") - 1
    for q, d, j, x in zip(p.tolist(), owner.tolist(), item.tolist(), score.tolist()):
        at = (q - int(base[d])) * s
        passage = docs[d][at:at + 2 * s]
        whole, asked, answered = overlaps(index, j, passage)
        if whole >= min_overlap and min(asked, answered) >= MIN_WORDS and found[d].get(j, (0.0,))[0] < x:
            found[d][j] = (x, whole, asked, answered)
    return [[{"item": index.ids[j], "bm25": x, "overlap": w, "question_overlap": a, "answer_overlap": b}
             for j, (x, w, a, b) in sorted(f.items())] for f in found]


def _known(items: DataFrame) -> DataFrame:
    """(item, text, n, bag) of the (item, text) with a word: their words and distinct words; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [words(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(w) for w in found], pa.int64()),
                                              pa.array([sorted(set(w)) for w in found], pa.list_(pa.binary()))], ["item", "text", "n", "bag"])

    return shared_table(items.mapInArrow(run, "item long, text string, n long, bag array<binary>").filter("n > 0"), "items")


def _passes(items: DataFrame, max_items: int) -> Iterator[list[ItemIndex]]:
    """Indexes of all (item, text), those of one pass together."""
    known = _known(items)
    total, mean = known.agg(F.count("*"), F.avg("n")).first()
    if not total:
        return
    df = shared_table(known.select(F.explode("bag").alias("word")).groupBy("word").agg(F.count("*").alias("c")), "item-words")
    width = F.element_at(F.filter(F.array(*[F.lit(w).cast("long") for w in WIDTHS]), lambda w: w >= F.col("n")), 1)
    known = known.withColumn("width", width)
    for w, count in sorted((r["width"], r["count"]) for r in known.groupBy("width").count().collect()):           # a row per width
        shards = -(-count // max_items)
        for shard in range(shards):
            mine = known.filter((F.col("width") == w) & (F.pmod(F.xxhash64("item"), F.lit(shards)) == shard))
            rows = mine.select("item", "text").collect()                                                          # about max_items rows
            seen = mine.select(F.explode("bag").alias("word")).distinct().join(df, "word").collect()               # their words
            yield [ItemIndex(sorted((r["item"], r["text"]) for r in rows), w, (total, mean, {bytes(r["word"]): r["c"] for r in sorted(seen)}))]


def _together(passes: Iterator[list[ItemIndex]], max_items: int) -> Iterator[list[ItemIndex]]:
    """Small indexes share a pass."""
    held: list[ItemIndex] = []
    for p in passes:
        if held and sum(len(x.ids) for x in held) + len(p[0].ids) > max_items:
            yield held
            held = []
        held = held + p
    if held:
        yield held


def with_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item", item_text: str = "text",
                 threshold: float = 0.6, min_overlap: float = 0.8, max_items: int = 50_000, out: str = "__matches") -> DataFrame:
    """``docs`` plus the array of verified items of each whole text; ``item_id`` is an integer column.

    Null and empty texts match nothing, nor do items without a word.  Repeated
    items and rows each count on their own.  With no items all arrays are
    empty.  Texts of any length are cut into passages.  ``out`` must not be a
    column of ``docs``; other names do not matter.
    """
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    result, parts = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), []
    struct = pa.struct([("item", pa.int64()), *[(c, pa.float64()) for c in ("bm25", "overlap", "question_overlap", "answer_overlap")]])
    items = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
    for indexes in _together(_passes(items, max_items), max_items):
        shared, name = spark.sparkContext.broadcast(indexes), f"m{len(parts)}"

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = match_documents(shared.value, [t or "" for t in b.column(at).to_pylist()], threshold, min_overlap)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hits, pa.list_(struct))], [*b.schema.names, name])

        result = result.mapInArrow(run, StructType([*result.schema.fields, StructField(name, _parse_datatype_string(_MATCHES))]))
        parts.append(F.col(name))
    found = F.concat(*parts) if parts else F.array().cast(_MATCHES)
    return result.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], found.alias(out))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", max_broadcast: int = 1_000_000, **options) -> DataFrame:
    """(id, item_id, bm25, overlap, question_overlap, answer_overlap): one row per row of ``docs`` and verified item.

    Ids of documents and items are of any type, also null.
    """
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    numbered = shared_table(items.select(F.col(item_id).alias("__item"), F.col(item_text).alias("text")).withColumn(
        "item", F.monotonically_increasing_id()), "numbered-items")
    found = with_matches(slim, numbered, "__text", **options).select("__id", F.explode("__matches").alias("m")).select("__id", "m.*")
    return found.join(small_or_shuffled(numbered.select("item", "__item"), max_broadcast), "item").select(
        F.col("__id").alias(id_col), F.col("__item").alias(item_id), "bm25", "overlap", "question_overlap", "answer_overlap")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no verified item, with all their columns, whatever their names (``__matches`` too)."""
    out = "__matches"
    while out in docs.columns:
        out += "_"
    slim = items.select(F.lit(0).alias("item"), F.col(item_text).alias("text"))
    return with_matches(docs, slim, text_col, out=out, **options).filter(F.size(out) == 0).drop(out)
