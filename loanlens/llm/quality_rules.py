"""Document quality by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  Expectation
maximisation over all documents estimates how accurate each rule's votes are
on good and on bad documents, and the posterior probability of a good document replaces the
usual demand that every rule passes.

The measures of a text are taken by one Arrow-batched pass.  A document enters
the estimate only through its vector of votes, so documents are first counted
by vector: at most 3 ** len(RULES) rows (177147, and in practice
far fewer), whatever the input, and exactly
what EM over all documents would see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loanlens.llm.common import shared_table

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_letters", "n_upper",
            "n_distinct", "n_plain", "n_symbol_words", "n_marks"]
_SYMBOLS = b"#*$%&|<>"
_ENDS = (b".", b"!", b"?", b":", b'"', "…".encode(), "”".encode(), "»".encode())
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_WINDOW = 5


def repeated_words(words: list[bytes]) -> int:
    """Words covered by five-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit mix of their words' 64-bit hashes.
    """
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = np.zeros(n, np.uint64)
    for i, m in enumerate(_MIX):
        code = (code ^ (code >> np.uint64(29))) * _MIX[0] + h[i:i + n] * m
    s = np.sort(code)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    at = np.minimum(np.searchsorted(twice, code), len(twice) - 1)
    edge = np.zeros(len(words) + 1, np.int64)
    first = np.nonzero(twice[at] == code)[0]
    np.add.at(edge, first, 1)
    np.add.at(edge, first + _WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def measures(text: str) -> tuple[int, ...]:
    """The MEASURES of one whole text."""
    b = text.encode()
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.strip()]
    symbols = len(b) - len(b.translate(None, _SYMBOLS))
    white = len(b) - sum(map(len, words))
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(b.translate(None, _NOT_LETTERS))
    upper = len(b) - len(b.translate(None, _UPPER))
    return (len(words), len(text) - white, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines),
            sum(x.rstrip().endswith(_ENDS) for x in lines), letters, upper, len(set(words)),
            len(b.translate(None, _NOT_PLAIN).split()), len(b.translate(None, _NOT_SYMBOLS).split()), b.count(b"!") + b.count(b"?"))


_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_LETTERS = bytes(set(range(256)) - set(_LETTERS))
_WHITE = b" \t\n\v\f\r"
_NOT_PLAIN = bytes(set(range(128)) - set(_LETTERS + b"0123456789" + _WHITE))       # leaves words with a letter or digit
_NOT_SYMBOLS = bytes(set(range(256)) - set(_SYMBOLS + _WHITE))                     # leaves words with a symbol


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the MEASURES as long columns (null text: as the empty text)."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([measures(t.as_py() or "") for t in b.column(at)], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(rows[:, i]) for i in range(len(MEASURES))]],
                                             [*b.schema.names, *MEASURES])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(m, LongType()) for m in MEASURES]]))


def base_failed() -> Column:
    """Too short, or over a fifth of its words in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Rule name -> vote; thresholds are fixed values."""
    c = F.col
    words, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    chars = F.greatest(c("word_chars"), F.lit(1))
    return {
        "length": _vote(c("n_words") >= 40, c("n_words") < 10),
        "word_length": _vote((c("word_chars") / words).between(3, 9), ~(c("word_chars") / words).between(2, 14)),
        "symbols": _vote(c("n_symbols") / words < 0.02, c("n_symbols") / words > 0.1),
        "symbol_words": _vote(c("n_symbol_words") / words < 0.02, c("n_symbol_words") / words > 0.1),
        "dup_lines": _vote((c("n_dup_lines") == 0) & (c("n_lines") > 1), c("n_dup_lines") / lines > 0.3),
        "repeats": _vote((c("n_words") >= 10) & (c("n_repeat_words") / words < 0.05), c("n_repeat_words") / words > 0.2),
        "letters": _vote(c("n_letters") / chars > 0.9, c("n_letters") / chars < 0.8),
        "plain": _vote(c("n_plain") / words > 0.95, c("n_plain") / words < 0.8),
        "upper": _vote(c("n_upper") / chars < 0.15, c("n_upper") / chars > 0.5),
        "marks": _vote(c("n_marks") / words < 0.1, c("n_marks") / words > 0.5),
        "distinct": _vote((c("n_words") >= 10) & (c("n_distinct") / words > 0.3), c("n_distinct") / words < 0.1),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """EM over vote vectors and how often each occurs.

    Returns the share of good documents and, as ``weight[rule, vote + 1]``, the
    log likelihood ratio of good to bad for each vote.  Given the quality, rules
    vote independently; each has its own rates of bad, abstaining and good
    votes on good and on bad documents, so a rule that seldom fires wrongly
    outweighs many that pass nearly everything.  The first guess is odds of
    19 to 1 for good without a bad vote, even odds for one, 1 to 19 for two.  A bad vote never counts
    for a document and a good vote never against it.
    """
    said = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)      # vector, rule, vote
    good = 1 / (1 + 19.0 ** ((votes == -1).sum(1) - 1.0))
    share, weight = 0.9, np.zeros((votes.shape[1], 3))
    for _ in range(rounds):
        rates = []
        for q in (good, 1 - good):
            n = np.einsum("n,nrv->rv", counts * q, said) + 0.5
            rates.append(n / n.sum(1, keepdims=True))
        new = np.log(rates[0]) - np.log(rates[1])
        new[:, 0] = np.minimum(new[:, 0], 0)
        new[:, 2] = np.maximum(new[:, 2], 0)
        share = float(np.clip((counts * good).sum() / max(counts.sum(), 1), 0.05, 0.95))
        done, weight = np.abs(new - weight).max(initial=0) < 1e-9, new
        good = posterior(votes, share, weight)
        if done:
            break
    return share, weight


def posterior(votes: np.ndarray, share: float, weight: np.ndarray) -> np.ndarray:
    odds = np.log(share / (1 - share)) + sum(weight[r, votes[:, r].astype(int) + 1] for r in range(votes.shape[1]))
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Per input row: id, measures, votes, ``base_failed``, ``quality`` and ``kept``.

    ``quality`` is the posterior probability of a good document; ``kept`` is
    false for rows that fail the base rule and otherwise tells whether
    ``quality`` is at least ``keep_at``.  Null and empty texts have no words
    and fail the base rule.  Repeated rows each count and keep their row; an
    empty table gives an empty result.  Other columns are not read.
    """
    m = with_measures(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text").drop("__text")
    names = list(rules())
    m = shared_table(m.withColumns({f"vote_{k}": v.cast("int") for k, v in rules().items()}), "quality-votes")
    keys = [f"vote_{k}" for k in names]
    seen = m.groupBy(*keys).count().collect()          # at most 3 ** len(RULES) rows
    votes = np.array([[r[k] for k in keys] for r in seen], float).reshape(-1, len(keys))
    share, weight = estimate(votes, np.array([r["count"] for r in seen], float))
    odds = F.lit(float(np.log(share / (1 - share))))
    for k, w in zip(keys, weight.tolist()):
        odds = odds + F.when(F.col(k) < 0, w[0]).when(F.col(k) > 0, w[2]).otherwise(w[1])
    quality = 1 / (1 + F.exp(-odds))
    return m.withColumnRenamed("__id", id_col).withColumns(
        {"base_failed": base_failed(), "quality": quality, "kept": ~base_failed() & (quality >= keep_at)})
