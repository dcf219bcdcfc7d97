"""Ordered running sums that scale: range partitions, then sums inside them.

A plain ``Window.partitionBy(key).orderBy(v)`` puts every distinct value of a
key into one task.  Here the rows are range-partitioned by (key, value) and
written once with the number of their partition.  Totals by (partition, key),
at most one row per partition and per key, give each range its offset, and
running sums are taken inside (partition, key).  Every row is moved twice and
compared with its neighbours only, so the cost is linear in the rows at any
number of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import shared_table


def ranged(counts: DataFrame, keys: list[str], order: str, blocks: int | None = None) -> DataFrame:
    """``counts`` in the order of (keys, order), written, with ``_range``, the number of its range partition.

    ``blocks`` is the number of ranges; by default the session's number of
    shuffle partitions, which adaptive execution lowers for small tables.
    """
    by = [F.col(c) for c in (*keys, order)]
    dealt = counts.repartitionByRange(blocks, *by) if blocks else counts.repartitionByRange(*by)
    return shared_table(dealt.withColumn("_range", F.spark_partition_id()), "ranged-rows")


def prefix_sums(counts: DataFrame, keys: list[str], order: str, cols: list[str],
                blocks: int | None = None, with_next: bool = False) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum over ``order`` within ``keys``).

    ``counts`` holds keys that are not NULL; it may come from :func:`ranged`,
    which saves a second write.  With ``with_next`` a ``next_<order>`` column
    carries the following row's value within the key (NULL for the last one).
    """
    c = counts if "_range" in counts.columns else ranged(counts, keys, order, blocks)
    totals = c.groupBy("_range", *keys).agg(*[F.sum(x).alias(f"_t_{x}") for x in cols], F.min(order).alias("_first"))
    along = Window.partitionBy(*keys).orderBy("_range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *keys, *[F.coalesce(F.sum(f"_t_{x}").over(before), F.lit(0)).alias(f"_o_{x}") for x in cols],
        F.lead("_first").over(along).alias("_next_first"))

    c = c.join(offsets, ["_range", *keys])
    w = Window.partitionBy("_range", *keys).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = c.select("*", *[(F.sum(x).over(run) + F.col(f"_o_{x}")).alias(f"cum_{x}") for x in cols],
                   *([F.coalesce(F.lead(order).over(w), F.col("_next_first")).alias(f"next_{order}")]
                     if with_next else []))
    return out.drop("_range", "_next_first", *[f"_o_{x}" for x in cols])


def quantiles_of_counts(counts: DataFrame, keys: list[str], value: str, n: str, probs: Sequence[float]) -> DataFrame:
    """(keys, ``quantiles``): exact interpolated quantiles of values that occur ``n`` times.

    The value at rank r is the least one whose running count exceeds r; ranks
    around (N - 1) q are interpolated linearly.  Running counts come from
    :func:`prefix_sums` and the rest is a grouped minimum, so no task holds a
    column.  NULL values must be left out by the caller; values that occur 0
    times change nothing.
    """
    c = counts if "_range" in counts.columns else ranged(counts.select(*keys, value, n), keys, value)
    totals = c.groupBy(*keys).agg(F.sum(n).alias("_total"))
    run = prefix_sums(c, keys, value, [n])
    run = run.join(F.broadcast(totals), keys)                    # one row per key
    at = [(F.col("_total") - 1) * F.lit(float(q)) for q in probs]
    low = [F.min(F.when(F.col(f"cum_{n}") > F.floor(r), F.col(value))).alias(f"_lo{i}") for i, r in enumerate(at)]
    high = [F.min(F.when(F.col(f"cum_{n}") > F.ceil(r), F.col(value))).alias(f"_hi{i}") for i, r in enumerate(at)]
    got = run.groupBy(*keys).agg(F.max("_total").alias("_total"), *low, *high).where("_total > 0")
    return got.select(*keys, F.array(*[
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (r - F.floor(r)) for i, r in enumerate(at)]).alias("quantiles"))


def exact_quantiles(df: DataFrame, columns: dict[str, object], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of several numeric expressions in one pass; columns without a value are absent.

    Each row contributes one (column number, value) pair per column, counted
    with map-side partial aggregation before the shuffle.  The result is
    columns x probabilities numbers.
    """
    names = list(columns)
    items = [F.struct(F.lit(i).alias("column"), columns[c].cast("double").alias("value")) for i, c in enumerate(names)]
    counts = df.select(F.explode(F.array(*items)).alias("s")).select("s.*").where(
        F.col("value").isNotNull() & ~F.isnan("value")).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = quantiles_of_counts(counts, ["column"], "value", "n", probs).collect()
    return {names[r["column"]]: [float(x) for x in r["quantiles"]] for r in rows}


def numbered(df: DataFrame, order: list, tag: str) -> DataFrame:
    """``df`` (written to the shared folder) plus ``_number``, its place from 0 in the global order.

    The sort is distributed: rows take their number inside their partition
    and the partitions' row counts (one row per partition) give the offsets.
    """
    placed = shared_table(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), tag)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(
        "_number", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")
