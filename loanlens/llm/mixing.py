"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, ``-ln(u) / quality``, from a hash of
its id and text, so that better documents tend to come first and reruns agree.
A source whose target is several times its size goes through whole epochs
first; the remaining words come from its documents in key order, up to the
point where the running sum of words meets the rest; the document in which it
does is cut there.

Built-in DataFrame functions only.  The running sum never orders a whole
source in one task: words are summed per (source, key interval), with as many
intervals as rows in each (the square root of the source's rows), the
interval in which the sum meets the rest is found from those totals, and only
the documents of that interval are ordered.  The rest of the choice is a
comparison of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import WORD, numbered, shared_table, small_or_shuffled

MOST_EPOCHS = 3


def quality_weight(text: Column) -> Column:
    """0.5 to 1.5: half plus the share of letters among all characters (empty: 0.5)."""
    n = F.length(text)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.when(n > 0, 0.5 + letters / n).otherwise(F.lit(0.5))


def uniform(*cols: Column, seed: int = 0) -> Column:
    """A number strictly between 0 and 1 from the md5 of the columns (52 bits)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, weigh 1 .. ``cycle``, repeating, and
    share the sum of all sizes.  A target stops at three times its source's
    size and the excess is shared again by weight: the share per weight rises
    until no source that is not full is above its limit.
    """
    s = shared_table(numbered(sizes, [F.col("source").asc_nulls_last()], "mix-sources").select(
        "source", "source_size", (F.pmod(F.col("__number"), F.lit(cycle)) + 1).cast("long").alias("weight")), "mix-weights")
    limit = F.col("source_size") * MOST_EPOCHS
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, full = 0.0, None
    while True:
        is_full = (limit < F.lit(share) * F.col("weight")) if full is not None else F.lit(False)
        n, words, weights = s.agg(
            F.sum(is_full.cast("long")), F.coalesce(F.sum(F.when(is_full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0))).first()
        if n == full or not weights:
            break
        share, full = (total - words) / weights, n
    return s.withColumn("target", F.least(limit.cast("double"), F.lit(share) * F.col("weight")))


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        max_broadcast: int = 100_000, seed: int = 0) -> DataFrame:
    """(id, size, source_size, target, taken) of every row.

    ``size`` counts the words of the text (null: 0).  ``taken`` is the words
    the mix takes from the row: its size for each whole epoch of its source,
    once more if it is among the fractional choice.  The document in which the
    running sum meets the rest gives only the words up to there.  Rows with
    equal id and text have equal keys; if the sum meets the rest among them,
    each gives the same share of its words, rounded down.  A source
    without words has target 0.  An empty table gives an empty result.  Texts
    of any length are counted whole; one that the sum meets is cut like any
    other.  Other columns of ``docs`` are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = shared_table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform(F.col(id_col), F.md5(text), seed=seed)) / quality_weight(text)).alias("key")), "mix-documents")
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    per_source = shared_table(per_source, "mix-sizes")
    plan = source_targets(per_source.select("source", "source_size")).join(
        per_source.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s")))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(MOST_EPOCHS), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0))
    plan = plan.select(
        F.col("source").alias("s"), "source_size", "target", epochs.cast("long").alias("epochs"),
        F.ceil(F.sqrt("rows")).cast("long").alias("intervals")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = shared_table(plan, "mix-plan")
    sources = small_or_shuffled(plan, max_broadcast)

    # 1 - exp(-key) is close to uniform, so intervals of it hold about as many rows each.
    interval = F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("intervals")).cast("long"), F.col("intervals") - 1)
    rows = slim.join(sources, F.col("source").eqNullSafe(F.col("s"))).withColumn("interval", interval)
    totals = rows.groupBy("s", "interval").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("s").orderBy("interval").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    meets = totals.withColumn("after", F.sum("words").over(upto)).join(
        plan.select(F.col("s").alias("p"), "rest"), F.col("s").eqNullSafe(F.col("p"))).filter("after > rest")
    meets = meets.groupBy("s").agg(F.min(F.struct("interval", (F.col("after") - F.col("words")).alias("before"))).alias("m")).select(
        F.col("s").alias("p"), "m.interval", "m.before")
    meets = small_or_shuffled(shared_table(meets, "mix-meets"), max_broadcast)
    last = rows.join(meets.withColumnRenamed("interval", "at"), F.col("s").eqNullSafe(F.col("p")) & (F.col("interval") == F.col("at")))
    ties = last.groupBy("s", "key").agg(F.sum("size").alias("words"), F.max("before").alias("before"), F.max("rest").alias("rest"))
    run = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("sum", F.col("before") + F.coalesce(F.sum("words").over(run), F.lit(0)))
    bound = ties.filter(F.col("sum") + F.col("words") > F.col("rest")).groupBy("s").agg(
        F.min(F.struct("key", ((F.col("rest") - F.col("sum")) / F.col("words")).alias("share"))).alias("c"))
    bound = meets.join(bound.withColumnRenamed("s", "b"), F.col("p").eqNullSafe(F.col("b"))).select("p", "interval", "c.key", "c.share")
    bound = small_or_shuffled(shared_table(bound, "mix-bounds"), max_broadcast)

    out = rows.join(bound.withColumnRenamed("interval", "at").withColumnRenamed("key", "cut"), F.col("s").eqNullSafe(F.col("p")), "left")
    before = (F.col("interval") < F.col("at")) | ((F.col("interval") == F.col("at")) & (F.col("key") < F.col("cut")))
    more = F.when(before, F.col("size")).when(
        (F.col("interval") == F.col("at")) & (F.col("key") == F.col("cut")), F.floor(F.col("size") * F.col("share"))).otherwise(0)
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("epochs") + more).cast("long").alias("taken"))
