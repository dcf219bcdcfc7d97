"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loanlens.session import ensure_checkpoint_dir

#: Runs of characters other than ASCII white space (Java and RE2 syntax).  In
#: Python the same words come from ``bytes.split()``, which splits on exactly
#: these six bytes.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _UPPER, _LOWER)


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids: null)."""
    return F.crc32(c.cast("string").cast("binary")) % n


def shared_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of replaying
    the plan, and Catalyst learns the real size for its join choice.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when ``df`` (a written table) has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def top_rows(df: DataFrame, score: Column, n: int) -> DataFrame:
    """Rows of the highest scores, at most ``n``.

    Scores are counted in buckets of a 32nd of a power of two; the lowest
    bucket that still fits whole is the cut, so only the bucket counts reach
    the driver.  (``orderBy().limit(n)`` would send it ``n`` rows of every
    task.)  Rows without a positive score are left out; if the highest bucket
    alone holds more than ``n`` rows, any ``n`` of it are taken.
    """
    bucket = F.floor(F.log2(score) * 32)
    df = df.withColumn("__bucket", F.when(score > 0, bucket)).filter("__bucket is not null")
    cut, held = None, 0
    for r in sorted(df.groupBy("__bucket").count().collect(), key=lambda r: -r["__bucket"]):      # some thousands at most
        if held + r["count"] > n:
            if cut is None:
                return df.filter(F.col("__bucket") == r["__bucket"]).drop("__bucket").limit(n)
            break
        cut, held = r["__bucket"], held + r["count"]
    return df.filter(F.col("__bucket") >= F.lit(cut)).drop("__bucket")


def one_in(sizes: dict, max_rows: int) -> dict:
    """Of how many rows one is taken, by label: of all labels alike, but of a rare one (under a tenth of an even share) more, up to all."""
    alike = max(1, -(-sum(sizes.values()) // max_rows))
    least = max(1, max_rows // (10 * max(1, len(sizes))))
    return {label: min(alike, -(-n // least)) for label, n in sizes.items()}


def even_sample(rows: DataFrame, text_col: str, label_col: str, max_rows: int, tag: str) -> DataFrame:
    """Distinct (text, label) of ``rows`` plus ``copies``, which sum to about ``max_rows`` at most (all rows if there are fewer).

    Of the copies of a text every :func:`one_in`-th is taken, the remainder by
    hash, so that a text has the share of the sample that it has of the rows
    and not all or nothing, and a rare label is there.  No row keys: the sample
    is the same however the rows are dealt.  Only keys and counts are shuffled,
    and of the chosen texts one row of each task.
    """
    key = F.xxhash64(text_col)
    groups = shared_table(rows.groupBy(key.alias("__key"), F.col(label_col).alias("__label")).agg(F.count("*").alias("n")), f"{tag}-groups")
    sizes = {r["__label"]: r["rows"] for r in groups.groupBy("__label").agg(F.sum("n").alias("rows")).collect()}       # a row per label
    parts = rows.sparkSession.createDataFrame(
        list(one_in(sizes, max_rows).items()), StructType([StructField("l", groups.schema["__label"].dataType), StructField("one_in", LongType())]))
    taken = F.floor((F.col("n") + F.pmod(F.xxhash64("__key", F.lit(1)), F.col("one_in"))) / F.col("one_in"))
    chosen = shared_table(groups.join(F.broadcast(parts), F.col("__label").eqNullSafe(F.col("l"))).select(
        "__key", "__label", taken.cast("long").alias("copies")).filter("copies > 0"), f"{tag}-chosen")
    chosen = small_or_shuffled(chosen, 2 * max_rows)
    found = rows.select(text_col, F.col(label_col).alias("__label"), key.alias("__key")).join(chosen, ["__key", "__label"])
    return shared_table(found.dropDuplicates(["__key", "__label"]).select(text_col, F.col("__label").alias(label_col), "copies"), f"{tag}-sample")


def numbered(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``df`` (written to the shared folder) plus ``__number``, its place from 0 in the global order.

    The sort is distributed: rows take their number inside their partition
    and the partitions' row counts (one row per partition) give the offsets.
    """
    placed = shared_table(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), tag)
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(before), "__part").withColumn(
        "__number", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__part", "__before")
