"""SimHash near-duplicate components by tiled exact comparison.

Fingerprints are the majority bits of the XXH64 values of word shingles.  Two
fingerprints link when they differ in at most ``max_distance`` bits, and
components are the transitive closure of the links.

* Exact copies share a fingerprint, so only distinct fingerprints are compared.
* Two fingerprints within radius r agree exactly on one of r + 1 bit segments,
  so each fingerprint is dealt to r + 1 buckets (segment, value) and compared
  inside them.  No link can be missed.
* A bucket larger than ``tile`` is cut into tiles of equal population count.
  Tile pairs whose population counts differ by more than r are skipped; each
  remaining pair is a unit of work of its own, so a hot bucket spreads over
  many tasks and a task holds two tiles at most.
* Inside a unit the fingerprints are sorted by population count and compared
  block by block with numpy exclusive-or and bit counts, again skipping block
  pairs beyond the radius.  A unit returns a spanning forest of its links,
  never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loanlens.llm.common import shared_table, small_or_shuffled

BLOCK = 512          # side of one exclusive-or block
SMALL = 64           # units up to this size are compared together, lag by lag


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 (seed 42) of the k-word shingles, repeats included."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if n <= k:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0] + [e + 1 for e in ends[:n - k]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends[k - 1:])), np.uint64, n - k + 1)


def majority_bits(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes (none: zero)."""
    n = len(hashes)
    if not n:
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 64):
        bits = np.unpackbits(hashes[at:at + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        parts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)
        total += parts.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "__fp") -> DataFrame:
    """``docs`` plus its fingerprint as a signed long (null text: zero)."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((majority_bits(shingle_hashes((t or "").encode(), shingle))
                               for t in (x.as_py() for x in b.column(at))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))], [*b.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, LongType())]))


def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes along the links u-v."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links_in_unit(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one unit: tiled exclusive-or, population-count skipping."""
    pc = np.bitwise_count(fps).astype(np.int16)
    order = np.argsort(pc, kind="stable")
    x, pc = fps[order], pc[order]
    label = np.arange(len(x))
    for a in range(0, len(x), BLOCK):
        xa, top = x[a:a + BLOCK], pc[min(a + BLOCK, len(x)) - 1]
        for b in range(a, len(x), BLOCK):
            if pc[b] - top > radius:
                break
            i, j = np.nonzero(np.bitwise_count(xa[:, None] ^ x[b:b + BLOCK][None, :]) <= radius)
            i, j = i + a, j + b
            apart = label[i] != label[j]
            if apart.any():
                label = _forest(len(x), np.concatenate([i[apart], np.arange(len(x))]),
                                np.concatenate([j[apart], label]))
    moved = np.nonzero(label != np.arange(len(x)))[0]
    return x[moved], x[label[moved]]


def _links_in_small_units(unit: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many small units at once: compare at each lag while the unit lasts."""
    us, vs, lag = [], [], 1
    live = np.nonzero(unit[1:] == unit[:-1])[0]
    while len(live):
        near = live[np.bitwise_count(fps[live] ^ fps[live + lag]) <= radius]
        us.append(near)
        vs.append(near + lag)
        lag += 1
        live = live[live + lag < len(unit)]
        live = live[unit[live] == unit[live + lag]]
    if not us:
        return fps[:0], fps[:0]
    label = _forest(len(fps), np.concatenate(us), np.concatenate(vs))
    moved = np.nonzero(label != np.arange(len(fps)))[0]
    return fps[moved], fps[label[moved]]


def _compare_units(radius: int):
    """Arrow batches sorted by unit -> links; carries the last, open unit to the next batch."""

    def links(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        first = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0]
        size = np.diff(np.r_[first, len(key)])
        small = np.repeat(size <= SMALL, size)
        found = [_links_in_small_units(key[small], fps[small], radius)] if small.any() else []
        found += [links_in_unit(fps[s:s + n], radius) for s, n in zip(first, size) if n > SMALL]
        u, v = (np.concatenate(c).view(np.int64) for c in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"]) if len(u) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            key = np.concatenate([key, b.column("unit").to_numpy()])
            fps = np.concatenate([fps, b.column("fp").to_numpy().view(np.uint64)])
            cut = len(key) - int((key[::-1] != key[-1]).argmax()) if key[0] != key[-1] else 0
            if cut and (out := links(key[:cut], fps[:cut])):
                yield out
            key, fps = key[cut:], fps[cut:]
        if len(key) and (out := links(key, fps)):
            yield out

    return run


def _units(fps: DataFrame, radius: int, tile: int) -> DataFrame:
    """Deal each fingerprint to its units (``unit`` long, ``fp`` long)."""
    width = [64 // (radius + 1) + (1 if i < 64 % (radius + 1) else 0) for i in range(radius + 1)]
    dealt, at = [], 0
    for i, w in enumerate(width):
        value = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1)) if w < 64 else F.col("fp")
        dealt.append(F.struct(F.lit(i).alias("seg"), value.alias("val")))
        at += w
    rows = fps.select("fp", F.bit_count("fp").cast("int").alias("pc"), F.explode(F.array(*dealt)).alias("b")).select(
        "fp", "pc", "b.seg", "b.val")

    counts = rows.groupBy("seg", "val", "pc").agg(F.count("*").alias("n"))
    sizes = shared_table(counts.groupBy("seg", "val").agg(F.sum("n").alias("total"), F.collect_list(
        F.struct("pc", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))).alias("bands"))
        .filter("total > 1"), "simhash-buckets")
    one = rows.join(sizes.filter(F.col("total") <= tile).select("seg", "val"), ["seg", "val"], "left_semi").select(
        F.xxhash64("seg", "val", F.lit(-1)).alias("unit"), "fp")
    # Hot buckets: at most 65 bands each, one row per bucket with a few tiles per band.
    hot = rows.join(sizes.filter(F.col("total") > tile), ["seg", "val"])
    own = F.element_at(F.filter("bands", lambda x: x["pc"] == F.col("pc")), 1)["tiles"]
    hot = hot.withColumn("mine", F.pmod(F.xxhash64("fp"), own).cast("int"))
    near = F.flatten(F.transform(
        F.filter("bands", lambda x: F.abs(x["pc"] - F.col("pc")) <= radius),
        lambda x: F.transform(F.sequence(F.lit(0), x["tiles"] - 1),
                              lambda t: F.struct(x["pc"].alias("pc"), t.alias("tile")))))
    hot = hot.withColumn("other", F.explode(near))
    mine = F.struct(F.col("pc").alias("pc"), F.col("mine").alias("tile"))
    hot = hot.select(F.xxhash64("seg", "val", F.least(mine, F.col("other")), F.greatest(mine, F.col("other"))).alias("unit"), "fp")
    return one.unionByName(hot)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of (u, v): (u, root), root the smallest node.

    Alternating large-star and small-star rounds; each round is written to the
    shared folder.  Every step is a grouped minimum (partial aggregation) and a
    join of the edges with one row per node, so no neighbour list is ever
    built.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = e.join(low, "u")
        if large:
            out = j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    e = shared_table(edges.filter("u <> v").distinct(), "simhash-edges")
    mark = None
    for _ in range(rounds):
        e = shared_table(stars(stars(e, True), False), "simhash-stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select("u", F.col("v").alias("root"))
        mark = now
    raise RuntimeError("components did not settle")


def near_duplicates(fingerprints: DataFrame, id_col: str = "doc_id", fp_col: str = "__fp",
                    max_distance: int = 2, tile: int = 4096) -> DataFrame:
    """(fp, root, component_id, n) of every distinct fingerprint.

    ``root`` is the smallest fingerprint of the component, ``component_id`` its
    smallest id (null only if all its ids are null), ``n`` the number of rows
    that carry exactly this fingerprint.
    """
    fps = shared_table(fingerprints.groupBy(F.col(fp_col).alias("fp")).agg(
        F.min(id_col).alias("first_id"), F.count("*").alias("n")), "simhash-distinct")
    parts = max(1, int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    units = _units(fps, max_distance, tile).repartition(parts, "unit").sortWithinPartitions("unit")
    edges = units.mapInArrow(_compare_units(max_distance), "u long, v long")
    roots = components(edges)
    rooted = fps.join(roots, fps["fp"] == roots["u"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id", "n")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return shared_table(rooted.join(lowest, "root").select("fp", "root", "component_id", "n"), "simhash-components")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_distance: int = 2, tile: int = 4096) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint``, ``component_id``.

    Null and empty texts have fingerprint zero and link like any other.  Rows
    with a repeated id each keep their row; a null id never is a component's
    id unless all ids of the component are null.  An empty table gives an
    empty result.  Other columns of ``docs`` are not read.
    """
    slim = shared_table(with_fingerprint(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")),
                                         "__text", shingle).select("__id", "__fp"), "simhash-fingerprints")
    comp = near_duplicates(slim, "__id", "__fp", max_distance, tile)
    return slim.join(comp, slim["__fp"] == comp["fp"]).select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_distance: int = 2, max_broadcast: int = 1_000_000) -> DataFrame:
    """Keep one row of each component, with all columns of ``docs``.

    The row with the smallest id stays (null ids last).  If that id is carried
    by several rows of the component, one of those with the smallest
    fingerprint stays.  Null and empty texts have fingerprint zero, so one of
    them stays; texts of any length are fingerprinted whole.  Columns of any
    name are kept as they are; an empty table gives an empty result.

    Only ids, fingerprints and row numbers are shuffled.  The numbers of the
    rows that go meet the texts by a broadcast, or, if there are more than
    ``max_broadcast`` of them, by a shuffle.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    marked = shared_table(with_fingerprint(plain, own_text, shingle, "fp").withColumn("row", F.monotonically_increasing_id()),
                          "simhash-documents")
    comp = near_duplicates(marked.select(own_id, "fp"), own_id, "fp", max_distance)
    several = comp.groupBy("root").agg(F.sum("n").alias("rows")).filter("rows > 1").select("root")
    groups = comp.join(several, "root").select("fp", "root", "component_id")
    copies = shared_table(marked.select("row", F.col(own_id).alias("id"), "fp").join(groups, "fp"), "simhash-copies")
    stay = copies.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min(F.struct("fp", "row")).alias("least")).select("least.row")
    gone = shared_table(copies.select("row").join(stay, "row", "left_anti"), "simhash-dropped")
    kept = marked.join(small_or_shuffled(gone, max_broadcast), "row", "left_anti")
    return kept.select(*plain.columns).toDF(*docs.columns)
