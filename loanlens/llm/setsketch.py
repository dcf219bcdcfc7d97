"""Near duplicates by word shingles: SetSketch registers, bands, joint likelihood, exact check.

A text's set is its distinct shingles, as 64-bit hashes.  A SetSketch of the
set has ``REGISTERS`` registers; register i is ``floor(1 - log_b(min h_i))``
cut to 0..255, where ``h_i`` is an exponential variable per element of rate
``RATE``: exponentially spaced, truncated minima.  Sketches of parts merge by
the coordinatewise maximum (:func:`merge`).  Instead of one variable per element
and register, each element walks along one Poisson process whose arrivals hit
random registers, and stops as soon as it is behind every register's minimum:
the same distribution at a small part of the work.

1. One pass over the texts writes (id, set size, digest, sketch).  Texts of one
   digest have the same set; all later steps work on distinct sets.
2. Bands of five registers are bucket keys.  A pair of similarity 0.85 shares
   none of the 32 bands with a chance under 10^-8.  Buckets of one set go.
3. Buckets are dealt out in units of two tiles at most, so that a hot bucket
   spreads over many tasks.  In a unit every pair is judged once (in the first
   band that it shares): set sizes rule out most, and the likelihood of the
   similarity given the counts of larger, smaller and equal registers and both
   set sizes rules out pairs that are less likely at the limit than at their
   best value by more than e^14.
4. The others are confirmed on the full sets.  A unit with few of them hands
   them out as pairs.  A unit with more than ``PER_SET`` a set hands out a
   spanning forest of them instead; the components of all forests are dense
   groups, and each group's full sets are dealt to tiles of bounded size and
   compared there, tile by tile, as products of 0/1 matrices.  So no link is
   lost, and no group is written out as all its pairs.
5. Confirmed links are closed to components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import shared_table, small_or_shuffled
from loanlens.llm.simhash import _forest, components

REGISTERS, BAND = 160, 5
BASE, RATE, TOP = 1.1, 20.0, 255
SLICE = 100_000          # elements sketched at once
ROWS = 1000              # texts turned into sets at once
TILE = 512               # sets of one bucket in a tile
PAIRS = 30_000           # pairs judged at once
MARGIN = 14.0            # log-likelihood by which a pair must fall short of its best value to be ruled out
PER_SET = 2              # pairs to confirm one by one, per set of a unit
ITEMS = 300_000          # shingles of a tile of a dense group, about
COLUMNS = 4096           # shingles of one matrix product
GRID = np.linspace(0.0, 1.0, 65)

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """XXH64 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, k: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles (fewer words: of the whole sequence; none: empty)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(k, len(w))
    n = len(w) - k + 1
    h = _mix(w[:n] + _A)
    for i in range(1, k):
        h = _mix(h + w[i:n + i])
    return np.unique(h)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint8) of each set, one row each (an empty set: zeros)."""
    low = np.full((len(sets), REGISTERS), np.inf)
    flat = low.reshape(-1)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    all_h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for at in range(0, len(doc), SLICE):
        h, d, t = all_h[at:at + SLICE], doc[at:at + SLICE], None
        step, chunk = 0, 4
        while len(h):
            n = np.arange(step, step + chunk, dtype=np.uint64)
            r = _mix(h[:, None] + (n * np.uint64(2) + np.uint64(1)) * _A)
            gap = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / (REGISTERS * RATE)
            gap[:, 0] += 0.0 if t is None else t
            time = np.cumsum(gap, axis=1)
            hit = _mix(r + _C) % np.uint64(REGISTERS)
            np.minimum.at(flat, (d[:, None] * REGISTERS + hit.astype(np.int64)).reshape(-1), time.reshape(-1))
            first, last = d[0], d[-1]
            behind = low[first:last + 1].max(axis=1)
            ahead = time[:, -1] < behind[d - first]
            h, d, t = h[ahead], d[ahead], time[ahead, -1]
            step, chunk = step + chunk, min(64, chunk * 2)
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(low) / np.log(BASE)), 0, TOP).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j: np.ndarray, more: np.ndarray, less: np.ndarray, same: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Of similarity ``j``, given how many registers of u are larger, smaller and equal, and both set sizes."""
    u = n_u / (n_u + n_v)
    v = 1 - u
    up, down = _p(u - v * j), _p(v - u * j)
    tiny = 1e-12
    return more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, 0) + tiny)


def estimate(more: np.ndarray, less: np.ndarray, same: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Most likely similarity of each pair, and how far the log-likelihood of ``limit`` falls short of it (0 if the best value is above)."""
    best = np.minimum(n_u, n_v) / np.maximum(n_u, n_v)
    j = GRID[None, :] * best[:, None]
    c = [x[:, None].astype(np.float64) for x in (more, less, same, n_u, n_v)]
    ll = log_likelihood(j, *c)
    at = ll.argmax(axis=1)
    got = j[np.arange(len(at)), at]
    short = ll.max(axis=1) - log_likelihood(np.float64(limit), *[x.astype(np.float64) for x in (more, less, same, n_u, n_v)])
    return got, np.where(got >= limit, 0.0, short)


def _bands(s: np.ndarray) -> np.ndarray:
    """Bucket keys (sets, bands): band number and its registers."""
    parts = s.reshape(len(s), -1, BAND).astype(np.int64)
    key = np.zeros(parts.shape[:2], np.int64)
    for i in range(BAND):
        key = (key << 8) | parts[:, :, i]
    return key | (np.arange(parts.shape[1], dtype=np.int64) << (8 * BAND))


def _judge(i: np.ndarray, j: np.ndarray, s: np.ndarray, n: np.ndarray, band: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """The pairs (row i, row j) that may reach the limit and are met first in this band."""
    fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    i, j = i[fits], j[fits]
    out = [(i[:0], j[:0])]
    for at in range(0, len(i), PAIRS):
        a, b = i[at:at + PAIRS], j[at:at + PAIRS]
        sa, sb = s[a], s[b]
        eq = sa == sb
        first = eq.reshape(len(a), -1, BAND).all(axis=2).argmax(axis=1) == band[a]
        a, b, sa, sb, eq = a[first], b[first], sa[first], sb[first], eq[first]
        same, more = eq.sum(axis=1), (sa > sb).sum(axis=1)
        _, short = estimate(more, REGISTERS - same - more, same, n[a], n[b], percent / 100)
        ok = short <= MARGIN
        out.append((a[ok], b[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _pairs(start: np.ndarray, size: np.ndarray, inside: np.ndarray, tile: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of each unit: in one tile if they are ``inside``, else of different tiles; some PAIRS at a time."""
    small = size <= 64
    lag, live = 1, np.repeat(start[small], size[small]) + _within(size[small])
    end = np.repeat(start[small] + size[small], size[small])
    while True:
        keep = live + lag < end
        live, end = live[keep], end[keep]
        if not len(live):
            break
        other = live + lag
        ok = ((tile[live] == tile[other]) == inside[live]) & (inside[live] == inside[other])
        yield live[ok], other[ok]
        lag += 1
    for a, k in zip(start[~small], size[~small]):
        rows = np.arange(a, a + k)
        wide = max(1, PAIRS // k)
        for x in range(0, k, wide):
            p, q = (m.reshape(-1) for m in np.meshgrid(rows[x:x + wide], rows[x:], indexing="ij"))
            ok = (q > p) & ((tile[p] == tile[q]) == inside[p]) & (inside[p] == inside[q])
            yield p[ok], q[ok]


def _within(size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _compare(percent: int):
    """Arrow batches sorted by unit -> (u, v, dense): pairs to confirm, and the forests of dense units."""

    def pairs_of(c: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        unit = c["unit"]
        start = np.nonzero(np.r_[True, unit[1:] != unit[:-1]])[0]
        size = np.diff(np.r_[start, len(unit)])
        found = [_judge(i, j, c["sketch"], c["n"], c["band"], percent)
                 for i, j in _pairs(start, size, c["inside"], c["tile"])]
        if not found:
            return None
        i, j = (np.concatenate(x) for x in zip(*found))
        where = np.searchsorted(start, i, side="right") - 1
        dense = (np.bincount(where, minlength=len(start)) > PER_SET * size)[where]
        label = _forest(len(unit), i[dense], j[dense])
        moved = np.nonzero(label != np.arange(len(unit)))[0]
        u, v = np.concatenate([i[~dense], moved]), np.concatenate([j[~dense], label[moved]])
        kind = np.arange(len(u)) >= np.count_nonzero(~dense)
        u, v = c["sid"][u], c["sid"][v]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(kind)], ["u", "v", "dense"])

    def read(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        c = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("unit", "inside", "tile", "band", "sid", "n")}
        c["sketch"] = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        return c

    return _by_unit(read, pairs_of)


def _by_unit(read: Callable, found: Callable):
    """Arrow batches sorted by unit: ``found`` gets the columns of whole units; the last, open unit is carried on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            c = read(b)
            held = c if held is None else {k: np.concatenate([held[k], c[k]]) for k in c}
            unit = held["unit"]
            cut = len(unit) - int((unit[::-1] != unit[-1]).argmax()) if unit[0] != unit[-1] else 0
            if cut and (out := found({k: x[:cut] for k, x in held.items()})):
                yield out
            held = {k: x[cut:] for k, x in held.items()}
        if held is not None and len(held["unit"]) and (out := found(held)):
            yield out

    return run


def linked(sets: list[np.ndarray], tile: np.ndarray, inside: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the sets, all pairs compared: within a tile if ``inside``, else across the two tiles."""
    n = np.array([len(x) for x in sets])
    first = np.nonzero(tile == tile.min())[0] if not inside else np.arange(len(sets))
    second = np.nonzero(tile != tile.min())[0] if not inside else first
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), n), times[column] > 1          # others add nothing to any pair
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(first), len(second)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, (at, at + COLUMNS))
        grid = np.zeros((len(sets), COLUMNS), np.float32)
        grid[row[low:high], column[low:high] - at] = 1
        common += grid[first] @ grid[second].T
    i, j = np.nonzero(common * 100 >= (n[first][:, None] + n[second][None, :] - common) * percent)
    label = _forest(len(sets), first[i], second[j])
    moved = np.nonzero(label != np.arange(len(sets)))[0]
    return moved, label[moved]


def _confirm(percent: int):
    """Arrow batches of full sets sorted by unit -> spanning links (u, v)."""

    def read(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        c = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("unit", "inside", "tile", "sid")}
        c["items"] = np.empty(b.num_rows, object)
        c["items"][:] = [x.values.to_numpy() for x in b.column("items")]
        return c

    def links_of(c: dict[str, np.ndarray]) -> pa.RecordBatch:
        us, vs = [], []
        start = np.nonzero(np.r_[True, c["unit"][1:] != c["unit"][:-1]])[0]
        for a, b in zip(start, [*start[1:], len(c["unit"])]):
            for inside in (True, False):
                at = a + np.nonzero(c["inside"][a:b] == inside)[0]
                if len(at) > 1:
                    u, v = linked(list(c["items"][at]), c["tile"][at], inside, percent)
                    us.append(c["sid"][at[u]])
                    vs.append(c["sid"][at[v]])
        u, v = (np.concatenate([np.empty(0, np.int64), *x]) for x in (us, vs))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return _by_unit(read, links_of)


def with_sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, key, n, digest, sketch) of (__id, __key, __text): set size, 128-bit digest of the set, its registers."""
    schema = docs.select(F.col("__id").alias("id"), F.col("__key").alias("key")).schema.add("n", "long").add("digest", "binary").add("sketch", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            sets = [shingle_set(t.as_py(), shingle, known) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays([
                b.column("__id"), b.column("__key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([x.tobytes() for x in sketch(sets)], pa.binary())], schema.names)

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(sid, n, items): the full sets of (sid, __text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            sets = [shingle_set(t.as_py(), shingle, known) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays([b.column("sid"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["sid", "n", "items"])

    return docs.mapInArrow(run, "sid long, n long, items array<long>")


def _dealt(sets: DataFrame) -> DataFrame:
    """(unit, inside, tile, band, sid, n, sketch): the members of the buckets of two sets at least, dealt to units."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = _bands(np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("sid").to_numpy(), keys.shape[1])), pa.array(keys.reshape(-1))], ["sid", "key"])

    rows = sets.select("sid", "sketch").mapInArrow(bands, "sid long, key long")
    shared = rows.groupBy("key").agg(F.count("*").alias("total")).filter("total > 1")
    rows = shared_table(rows.join(shared, "key").select(
        "key", "sid", F.ceil(F.col("total") / TILE).cast("int").alias("tiles")), "setsketch-buckets")
    tile = F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.join(sets.select("sid", "n", "sketch"), "sid")
    return rows.select(
        F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("unit"), (F.col("tile") == F.col("other")).alias("inside"),
        "tile", F.shiftright("key", 8 * BAND).cast("int").alias("band"), "sid", "n", "sketch")


def links(sets: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(u, root): component of every set that links with another; ``sets_of`` gives the full sets of a table of sid."""
    parts = max(1, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = _dealt(sets).repartition(parts, "unit").sortWithinPartitions("unit")
    out = shared_table(rows.mapInArrow(_compare(percent), "u long, v long, dense boolean").distinct(), "setsketch-pairs")
    pairs = out.filter("not dense").select("u", "v")
    group = components(out.filter("dense").select("u", "v"))
    group = shared_table(group.select(F.col("u").alias("sid"), "root").unionByName(
        group.select(F.col("root").alias("sid"), "root")).distinct(), "setsketch-groups")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("sid")).unionByName(group.select("sid")).distinct()
    full = shared_table(sets_of(shared_table(wanted, "setsketch-wanted")), "setsketch-sets")

    u, v = (full.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("items").alias(f"items_{x}")) for x in "uv")
    both = pairs.join(u, "u").join(v, "v").withColumn("common", F.size(F.array_intersect("items_u", "items_v")).cast("long"))
    single = both.filter(F.col("common") * 100 >= (F.col("n_u") + F.col("n_v") - F.col("common")) * percent).select("u", "v")

    group = group.join(sets.select("sid", "n"), "sid")
    size = group.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / ITEMS)).cast("int").alias("tiles"))
    member = group.join(size, "root").withColumn("tile", F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    member = member.select(F.xxhash64("root", F.least("tile", "other"), F.greatest("tile", "other")).alias("unit"),
                           (F.col("tile") == F.col("other")).alias("inside"), "tile", "sid")
    dense = member.join(full.select("sid", "items"), "sid").repartition(parts, "unit").sortWithinPartitions("unit")
    dense = dense.select("unit", "inside", "tile", "sid", "items").mapInArrow(_confirm(percent), "u long, v long")
    return components(shared_table(single.unionByName(dense), "setsketch-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Rows link when 100 x common >= ``percent`` x all of their distinct
    shingles (lower-case A-Z, words between ASCII white space).  A text with
    fewer words than a shingle has its whole sequence as one; null texts and
    texts without words have no shingles and link with nothing, not even with
    each other.  ``component_id`` is the smallest id reachable; null ids never
    are, unless all ids of the component are null, and rows of one id share
    the component only if their texts do.  ``kept`` holds where the row's id
    is the component's (null ids compare as equal), so repeated rows are all
    kept.  An empty table gives an empty result; other columns of ``docs`` are
    not read, so their names cannot clash.
    """
    slim = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__key"), F.col(text_col).alias("__text"))
    marked = shared_table(with_sketches(slim, shingle), "setsketch-sketches")
    some = marked.filter("n > 0")
    sets = some.groupBy("digest").agg(F.min("id").alias("first_id"), F.min(F.struct("key", "id")).alias("rep"),
                                      F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    sets = shared_table(sets.withColumn("sid", F.monotonically_increasing_id()), "setsketch-distinct")
    reps = sets.select("sid", F.col("rep.key").alias("__rep_key"), F.col("rep.id").alias("__rep"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        few = small_or_shuffled(shared_table(reps.join(wanted, "sid", "left_semi"), "setsketch-reps"), 1_000_000)
        texts = slim.join(few, (slim["__key"] == few["__rep_key"]) & slim["__id"].eqNullSafe(few["__rep"])).select("sid", "__text")
        return _sets(texts, shingle).dropDuplicates(["sid"])          # repeated rows give a set more than once

    roots = links(sets, sets_of, percent)
    rooted = sets.select("sid", "digest", "first_id").join(roots, sets["sid"] == roots["u"], "left").select(
        "digest", F.coalesce("root", "sid").alias("root"), "first_id")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    comp = shared_table(rooted.join(lowest, "root").select("digest", "component_id"), "setsketch-components")
    linked = some.drop("sketch").join(comp, "digest").select(F.col("id"), "n", "component_id")
    alone = marked.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
