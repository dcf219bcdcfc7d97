"""Boilerplate lines by their frequency inside a site.

Per host, the number of pages that hold a line is divided by the number of
the host's pages; lines above ``max_ratio`` are dropped from the host's pages.
Lines are compared without surrounding white space, by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import shared_table

_TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.regexp_replace(line, _TRIM, ""))


def boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text",
                max_ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """(host, pages, keys): each host's pages and the hashes of its boilerplate lines, hosts with such lines only.

    A line counts once per page.  A host's list holds at most
    (mean lines per page) / ``max_ratio`` entries.  Counting is a grouped
    count with map-side partial sums, so a line on a third of all pages
    reaches the shuffle once per task.
    """
    p = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    totals = p.groupBy("host").agg(F.count("*").alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _worded), _key))
    counts = p.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).filter(
        F.col("n") >= min_pages)
    t = totals.withColumnRenamed("host", "__host")
    often = counts.join(t, F.col("host").eqNullSafe(F.col("__host"))).filter(F.col("n") > F.col("pages") * max_ratio)
    return often.groupBy("host").agg(F.max("pages").alias("pages"), F.sort_array(F.collect_list("key")).alias("keys"))


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _with_lists(pages: DataFrame, host: str, lists: DataFrame, max_broadcast: int) -> DataFrame:
    """``pages`` plus ``keys``, the list of its host (null: none).

    Up to ``max_broadcast`` lists are broadcast.  Beyond, both sides are
    shuffled by host, and hosts that hold over a thousandth of the pages (hence
    under a thousand hosts) are cut into parts of about that size by a hash of
    the row; their lists go to each part.
    """
    slim = lists.select(F.col("host").alias("h"), "keys")
    if lists.count() <= max_broadcast:
        return pages.join(F.broadcast(slim), F.col(host).eqNullSafe(F.col("h")), "left").drop("h")
    total = lists.agg(F.sum("pages")).first()[0]
    parts = F.ceil(F.col("pages") * 1000 / total).cast("int")
    hot = lists.select(F.col("host").alias("hot"), parts.alias("parts")).filter("parts > 1")
    cut = F.pmod(F.xxhash64(*[c for c in pages.columns if "map<" not in pages.schema[c].dataType.simpleString()]), F.coalesce("parts", F.lit(1)))
    dealt = pages.join(F.broadcast(hot), F.col(host).eqNullSafe(F.col("hot")), "left").withColumn("part", cut)
    slim = lists.select(F.col("host").alias("h"), "keys", F.explode(F.sequence(F.lit(0), parts - 1)).alias("p"))
    return dealt.join(slim, F.col(host).eqNullSafe(F.col("h")) & (F.col("part") == F.col("p")), "left").drop("hot", "parts", "part", "h", "p")


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = 0.1,
                     min_pages: int = 5, max_broadcast: int = 10_000) -> DataFrame:
    """All rows and columns, the text without its host's boilerplate lines, plus ``n_lines`` and ``n_dropped``.

    A line is dropped when over ``max_ratio`` of its host's pages, and at
    least ``min_pages`` of them, hold it, on every page, also where that leaves
    an empty text.  Lines without a word stay.  Null hosts are one host.  A null text stays null
    with zero lines.  Repeated rows count as pages of their own.  Input
    columns named ``n_lines`` or ``n_dropped`` are replaced; other names do not matter.
    """
    lists = shared_table(boilerplate(pages, host_col, text_col, max_ratio, min_pages), "line-lists")
    p = pages.drop("n_lines", "n_dropped")
    plain = p.toDF(*[f"c{i}" for i in range(len(p.columns))])
    host, text = (f"c{p.columns.index(c)}" for c in (host_col, text_col))
    j = _with_lists(plain, host, lists, max_broadcast)
    lines = _lines(F.col(text))
    stay = F.filter(lines, lambda x: ~(_worded(x) & F.array_contains(F.col("keys"), _key(x))))
    j = j.withColumn("stay", F.when(F.col("keys").isNull(), lines).otherwise(stay))
    return j.select(
        *[(F.array_join("stay", "\n") if c == text else F.col(c)).alias(name) for c, name in zip(plain.columns, p.columns)],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines) - F.size("stay")).cast("long").alias("n_dropped"))
