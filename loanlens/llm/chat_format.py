"""Chat transcripts to canonical turns.

A transcript is a sequence of lines that may or may not carry a speaker
marker.  A hidden Markov model has a state for the first and for the further
lines of each role; lines emit their marker, length class, final question mark
and initial capital.  Its tables are counted from transcripts with known
roles, and Viterbi decoding gives every line its role before rendering.

No transcript is held whole.  Lines are numbered in a global order and cut into
segments of at most ``BLOCK`` lines.  Most transcripts lie in one segment and
are decoded at once.  For the others each segment is first summarised by the
best score between each pair of its border states; the summaries of a
transcript (a thousandth of its lines) give the border states on the best
path, and each segment is decoded between its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import numbered, shared_table

ROLES = ("user", "assistant", "system")
STATES = len(ROLES) * 2                 # role * 2 + (0 first line, 1 further line)
BLOCK = 1024
#: Marker words of each role.
MARKERS = {"user": ("user", "human", "q", "question", "customer", "me"),
           "assistant": ("assistant", "ai", "bot", "a", "answer", "model", "agent"),
           "system": ("system", "instruction", "instructions", "sys")}
_MARK = r"^[\s#>*<|\[(]*([A-Za-z]+)[\s|\])*]*[:>\]]+[\s*]*"
FEATURES = {"marker": 5, "length": 5, "question": 2, "capital": 2}


def lines_of(turns: DataFrame, conv: str, turn: str, text: str, keep: list[str]) -> DataFrame:
    """One row per line, numbered in the order of (conversation, turn, text); a null text is one empty line."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(text), F.lit("")).alias("text"), *keep)
    rows = rows.withColumn("rid", F.monotonically_increasing_id())
    rows = rows.select("conv", "turn", "rid", *keep, F.xxhash64("text").alias("hash"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    rows = numbered(rows, [F.col(c) for c in ("conv", "turn", "hash", "rid", "line_no")], "chat-lines")
    return observed(rows.drop("hash")).withColumn("block", F.floor(F.col("__number") / BLOCK).cast("long"))


def observed(lines: DataFrame) -> DataFrame:
    """Features of each line and its ``body`` without the marker."""
    word = F.lower(F.regexp_extract("line", _MARK, 1))
    known = F.when(word == "", 0)
    for i, r in enumerate(ROLES):
        known = known.when(word.isin(*MARKERS[r]), i + 1)
    n = F.length(F.trim("line"))
    lines = lines.withColumn("marker", known.otherwise(4))
    return lines.withColumns({
        "length": F.when(n == 0, 0).when(n < 40, 1).when(n < 120, 2).when(n < 300, 3).otherwise(4),
        "question": F.rtrim("line").endswith("?").cast("int"),
        "capital": F.regexp_replace("line", _MARK, "").rlike(r"^\s*\p{Lu}").cast("int"),
        "body": F.when(F.col("marker").between(1, 3), F.regexp_replace("line", _MARK, "")).otherwise(F.col("line"))})


@dataclass
class TurnModel:
    start: np.ndarray
    move: np.ndarray
    emit: dict[str, np.ndarray]         # feature -> states x values, all log

    def scores(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.emit[f][:, values[f]].T for f in FEATURES)


def _state(role: Column, first: Column) -> Column:
    out = F.lit(None)
    for i, r in enumerate(ROLES):
        out = F.when(role == r, F.lit(2 * i) + F.when(first, 0).otherwise(1)).otherwise(out)
    return out.cast("int")


def train(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role") -> TurnModel:
    """Tables from turns with known roles; other roles than ROLES are left out, every count starts from a half."""
    lines = lines_of(turns, conv, turn, text, [F.col(role).alias("role")]).withColumn("state", _state(F.col("role"), F.col("line_no") == 0))
    lines = lines.filter("state is not null")
    emit = {}
    for f, n in FEATURES.items():
        table = np.full((STATES, n), 0.5)
        for r in lines.groupBy("state", f).count().collect():               # states x values
            table[r["state"], r[f]] += r["count"]
        emit[f] = np.log(table / table.sum(1, keepdims=True))
    inside = Window.partitionBy("conv", "block").orderBy("__number")
    pairs = lines.select("state", F.lag("state").over(inside).alias("before")).filter("before is not null")
    ends = lines.groupBy("conv", "block").agg(F.min_by("state", "__number").alias("state"), F.max_by("state", "__number").alias("last"))
    past = ends.select(F.col("conv").alias("c"), (F.col("block") + 1).alias("b"), F.col("last").alias("before"))
    across = ends.join(past, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left").select("state", "before")
    move, start = np.full((STATES, STATES), 0.5), np.full(STATES, 0.5)
    for r in pairs.unionByName(across).groupBy("before", "state").count().collect():
        if r["before"] is None:
            start[r["state"]] += r["count"]
        else:
            move[r["before"], r["state"]] += r["count"]
    return TurnModel(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), emit)


def summary(m: TurnModel, e: np.ndarray) -> np.ndarray:
    """Best score of a segment from each state of its first line to each state of its last."""
    best = np.where(np.eye(STATES, dtype=bool), e[0], -np.inf)
    for row in e[1:]:
        best = (best[:, :, None] + m.move[None]).max(1) + row
    return best


def viterbi(m: TurnModel, e: np.ndarray, entry: int | None = None, last: int | None = None) -> np.ndarray:
    """Best states of a segment; from ``entry`` (else the start table) to ``last`` (else the best)."""
    v = m.start + e[0] if entry is None else np.where(np.arange(STATES) == entry, e[0], -np.inf)
    back = np.zeros((len(e), STATES), int)
    for t in range(1, len(e)):
        step = v[:, None] + m.move
        back[t] = step.argmax(0)
        v = step.max(0) + e[t]
    path = np.empty(len(e), int)
    path[-1] = v.argmax() if last is None else last
    for t in range(len(e) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def border_states(m: TurnModel, parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """First and last state of each segment on the best path through a whole transcript."""
    reach, entry_of = [], []
    v = None
    for s in parts:
        into = m.start if v is None else (v[:, None] + m.move).max(0)
        reach.append(None if v is None else (v[:, None] + m.move).argmax(0))
        both = into[:, None] + s
        entry_of.append(both.argmax(0))
        v = both.max(0)
    out, last = [], int(v.argmax())
    for k in range(len(parts) - 1, -1, -1):
        first = int(entry_of[k][last])
        out.append((first, last))
        last = int(reach[k][first]) if k else 0
    return out[::-1]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole segments and each one's rows, from batches sorted by (conv, block); holds one batch and one open segment."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
        if not t.num_rows:
            continue
        cuts = _starts(t)
        if len(cuts) > 1:
            yield t.slice(0, cuts[-1]), list(zip(cuts, cuts[1:]))
        held = t.slice(cuts[-1])
    if held is not None:
        yield held, [(0, held.num_rows)]


def _starts(t: pa.Table) -> list[int]:
    conv = t["conv"].combine_chunks().dictionary_encode()
    conv = (conv.combine_chunks() if isinstance(conv, pa.ChunkedArray) else conv).indices.fill_null(-1).to_numpy(zero_copy_only=False)
    block = t["block"].to_numpy()
    return [0, *(np.nonzero((conv[1:] != conv[:-1]) | (block[1:] != block[:-1]))[0] + 1).tolist()]


def format_chats(turns: DataFrame, model: TurnModel, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per line: conversation, turn, ``line_no``, ``role``, ``starts_turn``, ``rendered``.

    Concatenating ``rendered`` by (conversation, turn, line) gives the canonical
    transcript: a ``<|role|>`` header before a turn's first line, and the lines
    without their speaker markers.  Turns of equal number are ordered by a hash
    of their text, equal rows anyhow; null turns come first, and rows without
    conversation form one.  A null or empty text is one empty line; an empty
    table gives an empty result.  Other columns are not read.
    """
    spark = turns.sparkSession
    # Written once, so that numbers and segments are the same in all passes.
    lines = shared_table(lines_of(turns, conv, turn, text, []), "chat-observed")
    shared = spark.sparkContext.broadcast(model)
    sizes = lines.groupBy("conv", "block").agg(F.min("__number").alias("at"))
    many = sizes.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("c"))
    seen = list(FEATURES)
    kind = lines.schema["conv"].dataType.simpleString()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for t, bounds in _segments(batches):
            e = m.scores({x: t[x].to_numpy() for x in seen})
            first = t.take([i for i, _ in bounds])
            yield from pa.table({"conv": first["conv"], "block": first["block"], "s": pa.array(
                [summary(m, e[i:j]).ravel().tolist() for i, j in bounds], pa.list_(pa.float64()))}).to_batches()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = lines.join(many, F.col("conv").eqNullSafe(F.col("c")), "left_semi").select("conv", "block", "__number", *seen)
    sums = split.repartition(parts, "conv", "block").sortWithinPartitions("conv", "block", "__number").mapInArrow(
        summarise, f"conv {kind}, block long, s array<double>")

    def borders(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("block")
        got = border_states(shared.value, [np.asarray(s, float).reshape(STATES, STATES) for s in f["s"]])
        return pd.DataFrame({"c": f["conv"].to_numpy(), "b": f["block"].to_numpy(), "entry": [x for x, _ in got], "last": [x for _, x in got]})

    fixed = shared_table(sums.groupBy("conv").applyInPandas(borders, f"c {kind}, b long, entry int, last int"), "chat-borders")
    todo = lines.join(fixed, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left").select(
        "conv", "block", "__number", "turn", "line_no", "body", "entry", "last", *seen)
    turn_kind = lines.schema["turn"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for t, bounds in _segments(batches):
            e = m.scores({x: t[x].to_numpy() for x in seen})
            path = np.empty(t.num_rows, np.int32)
            entry, last = (t.take([i for i, _ in bounds])[c].to_pylist() for c in ("entry", "last"))
            for (i, j), a, z in zip(bounds, entry, last):
                path[i:j] = viterbi(m, e[i:j], a, z)
            yield from t.select(["conv", "turn", "line_no", "body"]).append_column("state", pa.array(path)).to_batches()

    done = todo.repartition(parts, "conv", "block").sortWithinPartitions("conv", "block", "__number").mapInArrow(
        decode, f"conv {kind}, turn {turn_kind}, line_no int, body string, state int")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.floor(F.col("state") / 2).cast("int") + 1)
    starts = F.col("state") % 2 == 0
    return done.select(F.col("conv").alias(conv), F.col("turn").alias(turn), "line_no", role.alias("role"), starts.alias("starts_turn"),
                       F.concat(F.when(starts, F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise(F.lit("")), "body", F.lit("\n")).alias("rendered"))
