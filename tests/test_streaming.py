"""Stateful rate limiter vs a brute-force replay; stream = batch for scoring."""

import datetime as dt
import time

import pandas as pd
from pyspark.sql import functions as F

from loanlens.streaming import jobs as sj


def brute(events, limit, width_us):
    acc, out = {}, {}
    for eid, uid, t in sorted(events, key=lambda e: (e[2], e[0])):
        a = [x for x in acc.get(uid, []) if x > t - width_us]
        if len(a) < limit:
            a.append(t)
            out[eid] = True
        else:
            out[eid] = False
        acc[uid] = a
    return out


def write(spark, rows, folder, mode="append"):
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts"])
    spark.createDataFrame(pdf, "event_id long, user_id long, ts timestamp").coalesce(1).write.mode(mode).parquet(folder)


def test_rate_limiter_matches_replay(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3, base + dt.timedelta(seconds=(i * 7) % 997 + i // 3)) for i in range(400)]
    us = {i: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for i, _, t in rows}
    want = brute([(i, u, us[i]) for i, u, _ in rows], 5, 60 * 10 ** 6)
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    for name, cuts in (("one", [0, 400]), ("three", [0, 130, 131, 400])):      # whole input at once, and over three batches
        folder = str(tmp_path / name)
        for a, b in zip(cuts, cuts[1:]):
            write(spark, ordered[a:b], folder)
            time.sleep(0.05)
        schema = spark.read.parquet(folder).schema
        stream = sj.file_stream(spark, folder, "*.parquet", schema, max_files=None if name == "one" else 1)
        got = {r["event_id"]: r["status"] == "accepted" for r in sj.rate_limit_job(stream, 5, 60).collect()}
        assert got == want


def test_late_events_are_kept_apart(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "late")
    write(spark, [(1, 1, base), (2, 1, base + dt.timedelta(hours=5))], folder)
    time.sleep(0.05)
    write(spark, [(3, 1, base + dt.timedelta(hours=1)), (4, 2, base + dt.timedelta(hours=4, minutes=30)), (5, 1, base + dt.timedelta(hours=5))], folder)
    stream = sj.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, max_files=1)
    got = {r["event_id"]: r["status"] for r in sj.rate_limit_job(stream, 1, 60, late_s=3600).collect()}
    assert got == {1: "accepted", 2: "accepted", 3: "late", 4: "accepted", 5: "rejected"}


def test_update_stream_equals_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "ev")
    rows = [(i, i % 5, base + dt.timedelta(minutes=11 * i)) for i in range(500)]
    write(spark, rows[:300] + rows[:20], folder)
    time.sleep(0.05)
    write(spark, rows[300:] + rows[290:300], folder)
    events = spark.read.parquet(folder).withColumn("value", F.lit(1.0))
    stream = sj.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, max_files=1).withColumn("value", F.lit(1.0))
    got = sj.run_updates(sj.ab_window_stream(stream), "t-ab", ["window_start", "window_end", "arm"]).collect()
    want = events.dropDuplicates(["event_id"]).groupBy(F.date_format("ts", "yyyy-MM-dd 00:00:00").alias("d")).count().collect()
    by_day = {}
    for r in got:
        by_day[r["window_start"]] = by_day.get(r["window_start"], 0) + r["n_requests"]
    assert by_day == {r["d"]: r["count"] for r in want}


def test_trailing_counts_block_split_equals_plain_window(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 2, base + dt.timedelta(seconds=37 * i)) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    got = {r["event_id"]: r["n_in_window"] for r in sj.trailing_counts(df, "user_id", "ts", 600, block_s=1200).collect()}
    for i, u, t in rows:
        want = sum(1 for j, v, s in rows if v == u and t - dt.timedelta(seconds=600) <= s <= t)
        assert got[i] == want


def test_state_store_limiter_over_batches_and_a_restart(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 4 if i % 4 else None, base + dt.timedelta(seconds=(i * 7) % 997 + i // 3)) for i in range(300)]
    us = {i: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for i, _, t in rows}
    want = brute([(i, u, us[i]) for i, u, _ in rows], 5, 60 * 10 ** 6)
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    folder, job = str(tmp_path / "in"), str(tmp_path / "job")

    def put(part):
        spark.createDataFrame(part, "event_id long, user_id long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)

    def run():
        stream = sj.file_stream(spark, folder, "*.parquet", "event_id long, user_id long, ts timestamp", max_files=1)
        with sj.rocks_state(spark):
            return sj.run_available_now(sj.rate_limit_stream(stream, 5, 60), "limit", base=job).collect()

    put(ordered[:110])
    put(ordered[110:111])
    first = run()
    assert len(first) == 111
    put(ordered[111:])                                  # a second run goes on with the state of the first
    got = run()
    assert len(got) == 300 and {r["event_id"]: r["status"] == "accepted" for r in got} == want
    assert {r["user_id"] for r in got} == {None, 1, 2, 3}


def test_streams_go_on_after_a_restart(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    folder, append, update = (str(tmp_path / x) for x in ("ev", "append", "update"))
    rows = [(i, i % 5, base + dt.timedelta(minutes=11 * i)) for i in range(600)]

    def run():
        schema = spark.read.parquet(folder).schema
        stream = lambda: sj.file_stream(spark, folder, "*.parquet", schema, max_files=1)                    # noqa: E731
        plain = sj.run_available_now(stream().select("event_id"), "plain", base=append)
        windows = sj.run_updates(sj.ab_window_stream(stream().withColumn("value", F.lit(1.0))), "ab", ["window_start", "window_end", "arm"],
                                 base=update, compact_every=2)
        return sorted(r["event_id"] for r in plain.collect()), {(r["window_start"], r["arm"]): r["n_requests"] for r in windows.collect()}

    for a, b in ((0, 100), (100, 250), (250, 260)):
        write(spark, rows[a:b], folder)
        time.sleep(0.05)
    assert run()[0] == list(range(260))
    for a, b in ((260, 400), (400, 600)):
        write(spark, rows[a:b], folder)
        time.sleep(0.05)
    ids, windows = run()
    assert ids == list(range(600))                      # nothing twice, nothing lost
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    arm = sj.assign(F.col("user_id").cast("string"), 0.10)
    want = events.groupBy(F.date_format("ts", "yyyy-MM-dd 00:00:00").alias("d"), arm.alias("arm")).count().collect()
    assert windows == {(r["d"], r["arm"]): r["count"] for r in want}
    assert spark.read.parquet(f"{update}/compact").select("upto").distinct().count() >= 1


def raw_batch(spark, n, first, scale=1.0, null=False):
    from loanlens.sources.loans import RAW_LOAN_SCHEMA
    fixed = {"loan_status": F.lit("Fully Paid"), "issue_d": F.lit("Jan-1999"), "loan_amnt": F.when(F.lit(not null), (F.col("id") - first) * scale)}
    return spark.range(first, first + n).select(F.col("id").alias("app_id"), *[
        fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_LOAN_SCHEMA.fields])


def test_broken_batches_are_marked_in_one_read(spark, tmp_path):
    import pytest
    from pyspark.errors import StreamingQueryException
    from loanlens.operators.prep import LoanPrep
    folder = str(tmp_path / "raw")
    model = LoanPrep().fit(raw_batch(spark, 50, 0).withColumn("default", F.lit(0)))
    for k, (n, options) in enumerate(((100, {}), (100, {"scale": 1000.0}), (40, {"null": True}), (60, {}))):
        raw_batch(spark, n, 1000 * k, **options).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    stream = lambda: sj.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, max_files=1)                   # noqa: E731
    job = str(tmp_path / "job")
    marks = sj.scoring_job(stream(), model, job, ["loan_amnt"], {"loan_amnt": 99.0}).orderBy("batch").collect()
    assert [(r["n"], r["status"], r["fields"]) for r in marks] == [(100, "ok", ""), (100, "critical", "loan_amnt"), (40, "warning", "loan_amnt"), (60, "ok", "")]
    assert sj.sound_scores(spark, job).count() == 200 and spark.read.parquet(f"{job}/data").count() == 300
    with pytest.raises(StreamingQueryException, match="BrokenBatch"):
        sj.scoring_job(stream(), model, str(tmp_path / "strict"), ["loan_amnt"], {"loan_amnt": 99.0}, stop=True)


def test_monitoring_at_an_interval(spark, tmp_path):
    folder, log, seen = str(tmp_path / "labels"), str(tmp_path / "log"), []

    def judge(windows):
        seen.append(windows)
        return spark.createDataFrame([(w,) for w in windows], "window string")

    spark.createDataFrame([("a",)], "window string").write.parquet(folder)
    q = sj.monitoring_job(sj.file_stream(spark, folder, "*.parquet", "window string"), judge, log, every="1 second")
    q.processAllAvailable()
    spark.createDataFrame([("b",)], "window string").write.mode("append").parquet(folder)
    q.processAllAvailable()
    q.stop()
    spark.createDataFrame([("c",)], "window string").write.mode("append").parquet(folder)
    sj.monitoring_job(sj.file_stream(spark, folder, "*.parquet", "window string"), judge, log)          # goes on after the stop
    assert seen == [["a"], ["b"], ["c"]] and sorted(r["window"] for r in spark.read.parquet(log).collect()) == ["a", "b", "c"]


def test_windows_of_several_files_are_a_batch_each(spark, tmp_path):
    from loanlens.operators.clean import DRIVER_SPLITS, clean, temporal_split
    from loanlens.operators.prep import LoanPrep
    model = LoanPrep().fit(temporal_split(clean(raw_batch(spark, 60, 0).withColumn("issue_d", F.lit("Jan-1995"))), DRIVER_SPLITS))
    folder, base = str(tmp_path / "in"), str(tmp_path / "job")
    for first, n, scale in ((100, 40, 1.0), (200, 30, 1000.0), (300, 20, 1.0)):
        raw_batch(spark, n, first, scale).repartition(3).write.mode("append").parquet(folder)
        stream = sj.file_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema)
        marks = sj.scoring_job(stream, model, base, ["loan_amnt"], {"loan_amnt": 60.0})
    assert sorted((r["batch"], r["n"], r["status"]) for r in marks.collect()) == [(0, 40, "ok"), (1, 30, "critical"), (2, 20, "ok")]


def test_requests_are_not_written_by_one_task(spark, tmp_path):
    """Parts of several files, a run of the job each: the same decisions as one client's events in order."""
    from loanlens.plans import queries as q
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 7, base + dt.timedelta(minutes=13 * i)) for i in range(900)]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp").repartition(5).write.parquet(f"{sf}/events.parquet")
    parts = q._request_parts(spark, sf)
    assert len(parts) == 4 and sum(p.count() for p in parts) == 900 and max(p.rdd.getNumPartitions() for p in parts) > 1
    us = {i: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6) for i, _, t in rows}
    got = q.request_rate_accepted(spark, sf).collect()
    assert {r["event_id"]: r["status"] == "accepted" for r in got} == brute([(i, u, us[i]) for i, u, _ in rows], 3, 86400 * 10 ** 6)
