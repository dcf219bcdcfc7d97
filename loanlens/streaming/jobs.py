"""Structured Streaming jobs (ST1–ST5).

Sources are file streams (explicit schema, ``pathGlobFilter`` because all
driver tables share one folder); sinks are parquet folders with a checkpoint,
both under the shared checkpoint root, so a restarted query resumes exactly
once.  ``run_available_now`` drains what is there and returns the written
table for inspection.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from loanlens.operators.clean import DRIVER_SPLITS, clean, temporal_split
from loanlens.operators.experiment import assign
from loanlens.operators.prep import LoanPrepModel
from loanlens.operators.quality import MAX_NULL_RATE, SCALE_MULTIPLIER
from loanlens.operators.scoring import CHAMPION, Card
from loanlens.session import scratch_path


def file_stream(spark: SparkSession, folder: str, pattern: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def _base(spark: SparkSession, name: str, base: str | None) -> str:
    return base or scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:8]}")


def run_available_now(df: DataFrame, name: str, mode: str = "append", partition_by: str | None = None, base: str | None = None) -> DataFrame:
    """Drain the stream into a parquet sink (exactly-once via checkpoint) and read it back.

    ``base`` is the job's folder, with the sink and its checkpoint.  A later
    run with the same folder goes on where the last one ended; without it a
    new folder is taken.
    """
    spark = df.sparkSession
    base = _base(spark, name, base)
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/data")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(partition_by)
    q = w.start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/data")


def run_updates(df: DataFrame, name: str, keys: list[str], base: str | None = None, compact_every: int = 20) -> DataFrame:
    """Drain an update-mode stream; the last state of each key.

    Every micro-batch overwrites a folder of its own, so a repeated batch
    leaves one copy; readers take a key's row from the latest batch.  Every
    ``compact_every`` batches the state so far is written as one table, and
    readers need only that and the batches after it.  ``base`` as in
    :func:`run_available_now`.
    """
    spark = df.sparkSession
    base = _base(spark, name, base)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/data/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            latest_rows(spark, base, keys, df.schema, batch_id).write.mode("overwrite").parquet(f"{base}/compact/upto={batch_id}")

    df.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    return latest_rows(spark, base, keys, df.schema).drop("batch")


def latest_rows(spark: SparkSession, base: str, keys: list[str], schema: StructType, upto: int | None = None) -> DataFrame:
    """Each key's last row and its batch, of the batches up to ``upto``: from the last compacted state before it and the batches since."""
    last = (1 << 62) if upto is None else upto
    stored = StructType([*schema.fields, StructField("batch", LongType())])
    done = None
    try:
        done = spark.read.parquet(f"{base}/compact").where(F.col("upto") < last).agg(F.max("upto")).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    rows = spark.read.schema(stored).parquet(f"{base}/data").where(F.col("batch") <= last)
    if done is not None:
        rows = rows.where(F.col("batch") > done).unionByName(spark.read.schema(stored).parquet(f"{base}/compact/upto={done}"))
    rest = [c for c in schema.names if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest, "batch"), "batch").alias("r")).select(*keys, *[f"r.{c}" for c in rest], "r.batch")


# ---------------------------------------------------------------- ST1
def scoring_stream(raw_stream: DataFrame, model: LoanPrepModel, card: Card = CHAMPION) -> DataFrame:
    """ST1: raw loan applications → clean → split → I2 transform → scorecard.
    Every step is stateless, so the stream equals the batch result row for row."""
    prepared = model.transform(temporal_split(clean(raw_stream), DRIVER_SPLITS))
    return prepared.select("app_id", "split", "default", card.probability().alias("p"))


class BrokenBatch(RuntimeError):
    """A micro-batch failed the quality gate and the job was told to stop."""


def scoring_job(raw_stream: DataFrame, model: LoanPrepModel, base: str, fields: list[str], ranges: dict[str, float], card: Card = CHAMPION,
                max_null_rate: float = MAX_NULL_RATE, multiplier: float = SCALE_MULTIPLIER, stop: bool = False) -> DataFrame:
    """ST1 with J1 (D11, D12) on the way: score every micro-batch and judge its raw ``fields`` in the same read of its rows.

    NULL shares and ranges are observed metrics of the scoring write.
    ``ranges`` holds the reference's max - min.  A batch with a range above
    ``multiplier`` times that is critical, one with a NULL share above
    ``max_null_rate`` a warning.  Marks (batch, n, status, fields) stand
    beside the scores; with ``stop`` a critical batch ends the job, and the
    next run meets the same batch again.  Returns the marks.
    """
    spark = raw_stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        value = {c: F.col(f"`{c}`").cast("double") for c in fields}
        metrics = [m for i, c in enumerate(fields) for m in (
            F.count_if(value[c].isNull()).alias(f"z{i}"), F.min(value[c]).alias(f"lo{i}"), F.max(value[c]).alias(f"hi{i}"))]
        observed = batch.observe(seen, F.count(F.lit(1)).alias("n"), *metrics)
        scoring_stream(observed, model, card).write.mode("overwrite").parquet(f"{base}/data/batch={batch_id}")
        m = seen.get
        scale = [c for i, c in enumerate(fields) if m[f"hi{i}"] is not None and ranges.get(c) and m[f"hi{i}"] - m[f"lo{i}"] > ranges[c] * multiplier]
        empty = [c for i, c in enumerate(fields) if m["n"] and m[f"z{i}"] / m["n"] > max_null_rate]
        status = "critical" if scale else "warning" if empty else "ok"
        spark.createDataFrame([(m["n"], status, ",".join(sorted({*scale, *empty})))], "n long, status string, fields string").coalesce(1).write.mode(
            "overwrite").parquet(f"{base}/marks/batch={batch_id}")
        if stop and status == "critical":
            raise BrokenBatch(f"batch {batch_id}: {', '.join(scale)}")

    raw_stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("n long, status string, fields string, batch long").parquet(f"{base}/marks")


def sound_scores(spark: SparkSession, base: str) -> DataFrame:
    """The scores of all batches that are not critical."""
    marks = spark.read.schema("status string, batch long").parquet(f"{base}/marks")
    bad = marks.where("status = 'critical'").select("batch")
    return spark.read.parquet(f"{base}/data").join(F.broadcast(bad), "batch", "left_anti").drop("batch")          # a row per batch


# ---------------------------------------------------------------- ST2 + ST5
def ab_window_stream(events: DataFrame, challenger_pct: float = 0.10, window: str = "1 day",
                     watermark: str = "1 hour") -> DataFrame:
    """ST2 with ST5: retry-stable de-duplication of request ids within the
    watermark, hash assignment by client id, and per-window/arm traffic.
    Run it in update mode (:func:`run_updates`) to see windows before the
    watermark closes them."""
    e = (events.select(F.col("event_id").cast("string").alias("request_id"),
                       F.col("ts").cast("timestamp").alias("ts"),
                       F.col("user_id").cast("string").alias("client_id"), "value")
         .withWatermark("ts", watermark)
         .dropDuplicatesWithinWatermark(["request_id"]))
    arm = assign(F.col("client_id"), challenger_pct)
    g = (e.groupBy(F.window("ts", window).alias("w"), arm.alias("arm"))
          .agg(F.count(F.lit(1)).alias("n_requests"),
               F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "arm", "n_requests",
                    F.col("total_value").cast("double").alias("total_value"))


# ---------------------------------------------------------------- ST3
def trailing_counts(events: DataFrame, key: str, ts: str, width_s: int, block_s: int | None = None) -> DataFrame:
    """ST3 batch form: events of the same key in [t − width, t], per event.

    Hot keys are split by time block: each (key, block) is one window
    partition, and the last ``width`` seconds of every block are copied into
    the next block as context rows, so no partition holds a whole key.
    """
    block_s = block_s or max(4 * width_s, 3600)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = events.select("*", us.alias("_us"), F.floor(us / F.lit(block_s * 10 ** 6)).alias("_blk"))
    own = base.withColumn("_ctx", F.lit(False))
    tail = base.where(F.col("_us") - F.col("_blk") * F.lit(block_s * 10 ** 6) >= F.lit((block_s - width_s) * 10 ** 6))
    ctx = tail.withColumn("_blk", F.col("_blk") + 1).withColumn("_ctx", F.lit(True))
    w = Window.partitionBy(key, "_blk").orderBy("_us").rangeBetween(-width_s * 10 ** 6, 0)
    out = own.unionByName(ctx).select("*", F.count(F.lit(1)).over(w).alias("n_in_window"))
    return out.where(~F.col("_ctx")).drop("_us", "_blk", "_ctx")


def _limiter(limit: int, width_us: int):
    """Arrow rows sorted by (client, time): decide events in order; holds one client's accepted times (at most ``limit``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, accepted = None, []
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out)) if out else [[], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                                               pa.array(cols[3], pa.list_(pa.int64()))], ["event_id", "user_id", "status", "accepted"])

        for b in batches:
            for event, user, us, kind in zip(*[c.to_pylist() for c in b.columns]):
                if user != client:
                    if accepted:
                        out.append((None, client, "state", accepted))
                    client, accepted = user, []
                if kind == 0:                       # remembered from earlier batches
                    accepted.append(us)
                    continue
                accepted = [a for a in accepted if a > us - width_us]
                ok = len(accepted) < limit
                if ok:
                    accepted.append(us)
                out.append((event, user, "accepted" if ok else "rejected", None))
            yield flush()
        if accepted:
            out.append((None, client, "state", accepted))
        yield flush()
    return run


def rate_limit_job(events: DataFrame, limit: int = 100, width_s: int = 60, late_s: int = 3600) -> DataFrame:
    """ST3 stateful form: at most ``limit`` accepted events per client in the
    trailing ``width_s`` seconds; rejected events do not count.

    Each micro-batch is sorted by (client, time) together with the client's
    remembered accepted times and decided in one ordered pass, so no client's
    events are held at once.  Remembered times are written per batch to the
    shared folder; clients idle for longer than the width are forgotten.
    Events more than ``late_s`` behind the newest time of earlier batches are
    not decided but kept with status ``late``.  Null clients are one client.
    Returns (event_id, user_id, status, batch).
    """
    spark = events.sparkSession
    base = scratch_path(spark, f"stream-rate-limit-{uuid.uuid4().hex[:8]}")
    width_us = width_s * 10 ** 6
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "event_id long, user_id long, status string, accepted array<long>"

    def decide(batch: DataFrame, batch_id: int) -> None:
        e = batch.select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"),
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
        before = None
        if batch_id:
            state = spark.read.schema("user_id long, us long").parquet(f"{base}/state/batch={batch_id - 1}")
            before = spark.read.schema("high long").parquet(f"{base}/high/batch={batch_id - 1}").first()[0]
        late = F.coalesce(F.col("us") < F.lit(before) - late_s * 10 ** 6, F.lit(False)) if before is not None else F.lit(False)
        rows = e.where(~late).select("event_id", "user_id", "us", F.lit(1).alias("kind"))
        if batch_id:
            rows = rows.unionByName(state.select(F.lit(None).cast("long").alias("event_id"), "user_id", "us", F.lit(0).alias("kind")))
        decided = rows.repartition(parts, "user_id").sortWithinPartitions("user_id", "us", "kind", "event_id").mapInArrow(_limiter(limit, width_us), schema)
        decided.write.mode("overwrite").parquet(f"{base}/decided/batch={batch_id}")
        done = spark.read.schema(schema).parquet(f"{base}/decided/batch={batch_id}")
        e.where(late).select("event_id", "user_id", F.lit("late").alias("status")).write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
        high = max(x for x in (before, e.agg(F.max("us")).first()[0], 0) if x is not None)
        spark.createDataFrame([(high,)], "high long").write.mode("overwrite").parquet(f"{base}/high/batch={batch_id}")
        done.where("status = 'state'").select("user_id", F.explode("accepted").alias("us")).where(
            F.col("us") > high - width_us - late_s * 10 ** 6).write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")

    events.writeStream.foreachBatch(decide).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = "event_id long, user_id long, status string, batch long"
    return spark.read.schema(out).parquet(f"{base}/decided").where("status <> 'state'").unionByName(spark.read.schema(out).parquet(f"{base}/late"))


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _ClientLimiter(StatefulProcessor):
    """One client's accepted times as one value; a timer clears them when they can no longer count.

    Every call to the state store costs more than deciding a client's events,
    so there are three of them at most: the value, its update and a timer.  A
    timer that later events have overtaken clears nothing.
    """

    def __init__(self, limit: int, width_us: int):
        self.limit, self.width_us = limit, width_us

    def init(self, handle) -> None:
        self.handle = handle
        self.accepted = handle.getValueState("accepted", "us array<long>")

    def _end(self, held: list[int]) -> int:
        return (max(held) + self.width_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.accepted.get()
        held = before = list(known[0]) if known else []
        out = []
        for r in sorted(rows, key=lambda r: (r["us"], r["event_id"] is None, r["event_id"] or 0)):
            held = [a for a in held if a > r["us"] - self.width_us]
            ok = len(held) < self.limit
            if ok:
                held.append(r["us"])
            out.append(Row(event_id=r["event_id"], user_id=r["user_id"], status="accepted" if ok else "rejected"))
        if held != before:
            self.accepted.update((held,))
            if not before or self._end(held) != self._end(before):
                self.handle.registerTimer(self._end(held))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.accepted.get()
        if known and self._end(known[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.accepted.clear()
        return iter(())

    def close(self) -> None:
        pass


def rate_limit_stream(events: DataFrame, limit: int = 100, width_s: int = 60, late: str = "1 hour") -> DataFrame:
    """ST3 in the state store: (event_id, user_id, status) of a stream of (event_id, user_id, ts).

    At most ``limit`` accepted events per client in the trailing ``width_s``
    seconds; rejected events do not count.  A client's state is at most
    ``limit`` times, and an event-time timer clears it.  A client's events of
    one micro-batch are decided in the order of (time, event id).  Events more
    than ``late`` behind the newest time of earlier batches are dropped by the
    watermark (:func:`rate_limit_job` keeps them apart).  Null clients are one
    client.  Run it under :func:`rocks_state`.
    """
    e = events.select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"),
                      F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    e = e.withColumns({"us": F.unix_micros("ts"), "client": F.coalesce(F.col("user_id").cast("string"), F.lit(""))})
    return e.groupBy("client").transformWithState(
        statefulProcessor=_ClientLimiter(limit, width_s * 10 ** 6), outputStructType="event_id long, user_id long, status string",
        outputMode="append", timeMode="EventTime")


@contextmanager
def rocks_state(spark: SparkSession, idle_batches: bool = True):
    """Streams started inside keep their state in RocksDB, which typed state and timers need.

    Without ``idle_batches`` a run ends with its last rows: timers that have
    expired by then clear their state in the next run.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


# ---------------------------------------------------------------- ST4
def monitoring_job(arrivals: DataFrame, judge: Callable[[list[str]], DataFrame], log: str, every: str | None = None):
    """ST4 + J6: for each micro-batch of arrived window labels run the monitoring
    of those windows and append its verdict rows to the log (A10).

    With ``every`` (such as ``"1 day"``) the job looks for new labels at that
    interval and its running query is returned; else it takes what is there
    and ends.  A job started again on the same log goes on after the last
    batch.

    ``arrivals`` is a stream of (window); ``judge`` returns a verdict per
    window.  A batch writes a folder of its own, so a retried batch leaves one
    copy of its rows.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        windows = sorted(r["window"] for r in batch.select("window").distinct().collect())       # labels of one batch
        if windows:
            judge(windows).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    writer = arrivals.writeStream.foreachBatch(run).option("checkpointLocation", f"{log}-checkpoint")
    if every:
        return writer.trigger(processingTime=every).start()
    writer.trigger(availableNow=True).start().awaitTermination()
