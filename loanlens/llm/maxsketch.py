"""Ranked lexical search by hashed max-sketches.

A document's impact of a term is its saturated term frequency.  The impacts of
all its terms fold into ``SLOTS`` coordinates, the term's hash choosing the
coordinate and the largest impact staying.  For a query the weights of its
terms, times the coordinates that they hash to, sum up to a bound that no
document's score can exceed; all queries are looked up against a block of
documents at once.  Documents are then scored exactly in descending order of
their bound, in growing waves, until the bound falls under the query's
threshold, its ``top``-th best score so far.

Two passes over the texts, both map-only but for counts and results: one counts
documents, words and the document frequencies of the queries' terms, one
sketches, bounds and rescores block by block.  A task keeps the thresholds from
block to block and hands out its best rows; these are cut down in two levels.
Queries beyond ``max_items`` are searched in several rounds of both passes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import shared_table
from loanlens.llm.topk import NO_ID, Best, best_rows

SLOTS = 1024            # coordinates of a sketch
BLOCK = 1024            # documents bounded at once
TOKENS = 400_000        # words of a block
TILE = 256              # queries bounded at once
WAVE = 32               # documents of the first wave; later ones are four times as large
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().lower().translate(_SPACED).split()


class Queries:
    """The terms of a block of queries: term ids, and (query, term) pairs in CSR form."""

    def __init__(self, rows: list[tuple[int, str]]):
        bags = [(q, sorted(set(terms(t)))) for q, t in rows]
        bags = [(q, b) for q, b in bags if b]
        self.number = np.array([q for q, _ in bags], np.int64)
        self.vocab = {w: i for i, w in enumerate(sorted({w for _, b in bags for w in b}))}
        self.term = np.array([self.vocab[w] for _, b in bags for w in b], np.int64)
        self.start = np.cumsum([0, *(len(b) for _, b in bags)])
        self.slot = np.array([xxhash.xxh64_intdigest(w) % SLOTS for w in self.vocab], np.int64)

    def weigh(self, n_docs: int, n_words: int, df: dict[bytes, int]) -> None:
        self.n_docs, self.n_words = n_docs, n_words
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(w, 0) + 1))) for w in self.vocab], np.int64)


class Places(dict):
    """Of a word: its slot, and its term id + 1 in the higher bits (0: in no query); remembered up to a bound."""

    def __init__(self, vocab: dict[bytes, int]):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = x = (self.vocab.get(word, -1) + 1) << 20 | xxhash.xxh64_intdigest(word) % SLOTS
        return x


class Block:
    """Sketches and known terms of some documents."""

    def __init__(self, q: Queries, places: Places, bags: list[Counter]):
        size = [len(b) for b in bags]
        doc = np.repeat(np.arange(len(bags)), size)
        tf = np.fromiter((x for b in bags for x in b.values()), np.int64, sum(size))
        place = np.fromiter((places[w] for b in bags for w in b), np.int64, sum(size))
        n = np.array([sum(b.values()) for b in bags], np.int64)
        m = 10 + (90 * n * q.n_docs) // q.n_words
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        self.sketch = np.zeros((len(bags), SLOTS))
        np.maximum.at(self.sketch.reshape(-1), doc * SLOTS + (place & 0xFFFFF), impact)
        known = place >> 20 > 0
        key = doc[known] * len(q.vocab) + (place[known] >> 20) - 1
        order = np.argsort(key)
        self.key, self.impact, self.q = key[order], impact[known][order], q

    def bounds(self, low: int, high: int) -> np.ndarray:
        """Bounds (documents, queries low to high).  Sums of integers below 2^53 are exact in doubles."""
        q = self.q
        at = slice(q.start[low], q.start[high])
        query = np.repeat(np.arange(high - low), np.diff(q.start[low:high + 1]))
        weights = np.zeros((SLOTS, high - low))
        np.add.at(weights, (q.slot[q.term[at]], query), q.weight[q.term[at]])
        return self.sketch @ weights

    def scores(self, doc: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of (document, query) pairs."""
        q = self.q
        size = q.start[query + 1] - q.start[query]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(q.start[query], size)
        term = q.term[at]
        key = np.repeat(doc, size) * len(q.vocab) + term
        place = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        there = self.key[place] == key if len(self.key) else np.zeros(len(key), bool)
        part = np.where(there, q.weight[term] * (self.impact[place] if len(self.key) else 0), 0)
        return np.add.reduceat(part, np.cumsum(size) - size) if len(size) else part


def search_block(block: Block, ids: np.ndarray, best: Best) -> int:
    """Rescore the documents of a block in descending order of their bounds; the number of exact scores."""
    scored, total = 0, len(best.least)
    for low in range(0, total, TILE):
        high = min(low + TILE, total)
        bound = block.bounds(low, high)
        open_ = np.nonzero((bound >= best.least[low:high]).any(axis=0))[0]
        order = np.argsort(-bound[:, open_], axis=0, kind="stable")
        at, wave = 0, WAVE
        while at < len(bound) and len(open_):
            doc = order[at:at + wave]
            query = np.broadcast_to(open_ + low, doc.shape)
            live = bound[doc, query - low] >= best.least[query]
            d, q = doc[live], query[live]
            best.add(q, block.scores(d, q), ids[d])
            scored += len(d)
            going = live.any(axis=0)
            open_, order = open_[going], order[:, going]
            at, wave = at + wave, wave * 4
    return scored


def _blocks(ids: np.ndarray, texts: pa.Array) -> Iterator[tuple[np.ndarray, list[Counter]]]:
    """Documents with at least one term, a block at a time."""
    at, bags, size = [], [], 0
    for i, t in enumerate(texts):
        w = terms(t.as_py())
        if w:
            at.append(i)
            bags.append(Counter(w))
            size += len(w)
        if len(bags) >= BLOCK or size >= TOKENS:
            yield ids[at], bags
            at, bags, size = [], [], 0
    if bags:
        yield ids[at], bags


def _counts(slim: DataFrame, queries) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, their words, and the document frequency of each query term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_words = Counter(), 0, 0
        vocab = queries.value.vocab.keys()
        for b in batches:
            for t in b.column("__text"):
                w = terms(t.as_py())
                n_docs, n_words = n_docs + bool(w), n_words + len(w)
                df.update(vocab & set(w))
        yield pa.RecordBatch.from_arrays([pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()),
                                          pa.array([n_words, *[0] * len(df)], pa.int64())], ["term", "n", "words"])

    rows = slim.select("__text").mapInArrow(run, "term binary, n long, words long").groupBy("term").agg(F.sum("n"), F.sum("words")).collect()
    counted = {bytes(r[0]) if r[0] is not None else None: (r[1], r[2]) for r in rows}        # one row per term of the queries
    n_docs, n_words = counted.pop(None, (0, 0))
    return n_docs, n_words, {w: n for w, (n, _) in counted.items()}


def _search(slim: DataFrame, queries, top: int) -> DataFrame:
    """(q, score, id): each task's best rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = queries.value
        best, places = Best(np.ones(len(q.number), np.int64), top), Places(q.vocab)      # scores of 0 do not count
        for b in batches:
            all_ids = b.column("__id").fill_null(NO_ID).to_numpy()
            for ids, bags in _blocks(all_ids, b.column("__text")):
                search_block(Block(q, places, bags), ids, best)
        yield pa.RecordBatch.from_arrays([pa.array(q.number[best.query]), pa.array(best.score), pa.array(best.id)], ["q", "score", "id"])

    return slim.mapInArrow(run, "q long, score long, id long")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", top: int = 10, max_items: int = 20_000) -> DataFrame:
    """(``item_id``, rank, ``id_col``, score): the ``top`` documents of each item with a score above 0.

    Ids of documents are integers.  Equal scores rank by ascending id, null ids
    last.  Null texts, texts without a term and items without a term give no
    row.  Repeated documents and repeated items count on their own, each row.
    With an empty table of either kind the result is empty.  Whole texts of any
    length are searched; other columns are not read, so no name can clash.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    numbered = shared_table(items.select(F.col(item_id).alias("__item"), F.col(item_text).alias("__words")).withColumn(
        "q", F.monotonically_increasing_id()), "maxsketch-items")
    shards = max(1, -(-numbered.count() // max_items))
    found = None
    for shard in range(shards):
        rows = numbered.filter(F.pmod(F.xxhash64("q"), F.lit(shards)) == shard).select("q", "__words").collect()      # about max_items rows
        queries = Queries([(r[0], r[1]) for r in rows])
        sent = spark.sparkContext.broadcast(queries)
        n_docs, n_words, df = _counts(slim, sent)
        queries.weigh(n_docs, n_words, df)
        part = _search(slim, spark.sparkContext.broadcast(queries), top)
        found = part if found is None else found.unionByName(part)

    return best_rows(found, ["q"], top).join(numbered.select("q", "__item"), "q").select(
        F.col("__item").alias(item_id), "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score")
