import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from viewtide.functions.timecols import to_wall_time
from viewtide.operators import windows as win
from viewtide.streaming import trend_stream as stm

from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = "article string, ts timestamp_ntz"


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def _drain(df, out, ck, partition_by=None):
    q = stm.start_stream(df, "parquet", out, ck, None, partition_by=partition_by, available_now=True)
    q.awaitTermination()
    return q


def test_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
                .select(F.col("event_type").alias("article"), "ts"))
    _drain(stm.trending_stream(src, 6, "4 hours", "1 hour", "1 hour"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    got = {(r.article, r.ws, tuple(r[f"s{i}"] for i in range(6)))
           for r in spark.read.parquet(f"{tmp_dir}/out")
                          .select("*", to_wall_time("window_start").alias("ws")).collect()}
    max_ts = ev.agg(F.max("ts")).first()[0]
    batch = win.trending(ev.select(F.col("event_type").alias("article"), "ts"), 6, "4 hours", "1 hour")
    want = {(r.article, r.window_start, tuple(r[f"s{i}"] for i in range(6))) for r in batch.collect()
            if r.window_end <= max_ts - dt.timedelta(hours=1)}
    assert got == want and len(got) > 0


def test_late_rows_dropped_and_restart_from_checkpoint(spark, tmp_dir):
    src_dir, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    os.makedirs(src_dir)
    first = [("a", T0 + dt.timedelta(minutes=m)) for m in (0, 15, 30)] + [("a", T0 + dt.timedelta(hours=2, minutes=30))]
    _write(spark, first, f"{src_dir}/f1")

    def stream():
        return stm.hourly_totals_stream(
            spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src_dir), "10 minutes")

    _drain(stream(), out, ck)
    assert [(r.hour, r.views) for r in spark.read.parquet(out).collect()] == [(10, 3)]
    # a late row for hour 10 (already closed) and a new row that closes hour 12
    _write(spark, [("a", T0 + dt.timedelta(minutes=45)), ("a", T0 + dt.timedelta(hours=3, minutes=40))], f"{src_dir}/f2")
    q = _drain(stream(), out, ck)
    got = sorted((r.hour, r.views) for r in spark.read.parquet(out).collect())
    assert got == [(10, 3), (12, 1)]
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped >= 1


def test_run_trending_stream_job(spark, tmp_dir):
    src_dir = f"{tmp_dir}/src"
    rows = []
    for slot, c in enumerate([1, 2, 2, 3, 4, 5, 1]):
        rows += [("up", T0 + dt.timedelta(minutes=10 * slot, seconds=j)) for j in range(c)]
    rows.append(("up", T0 + dt.timedelta(hours=3)))
    _write(spark, rows, f"{src_dir}/f1")
    req = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src_dir)
    qs = stm.run_trending_stream(spark, req, f"{tmp_dir}/out", f"{tmp_dir}/ck", watermark="10 minutes",
                                 available_now=True)
    for q in qs:
        q.awaitTermination()
    tr = spark.read.parquet(f"{tmp_dir}/out/trending").select("article", to_wall_time("window_start").alias("ws"))
    assert ("up", T0) in {(r.article, r.ws) for r in tr.collect()}
    topics = {r.topic for r in spark.read.parquet(f"{tmp_dir}/out/phase_counts").select("topic").distinct().collect()}
    assert topics == {f"pageviews-{d}" for d in range(10)}
    hourly = {(r.hour, r.views) for r in spark.read.parquet(f"{tmp_dir}/out/hourly_totals").collect()}
    assert (10, 17) in hourly
    from viewtide.plans.jobs import serve
    served = serve(spark, f"{tmp_dir}/out/trending", 10).collect()
    assert served and served[0].series.count(":") == 5 and served[0].url.endswith("/up")


def test_idempotent_batch_writer(spark, tmp_dir):
    w = stm.idempotent_batch_writer(f"{tmp_dir}/t")
    df = spark.createDataFrame(pd.DataFrame({"x": [1, 2]}))
    w(df, 3)
    w(df, 3)  # replay of the same batch
    w(df.limit(0), 4)  # a no-data batch leaves nothing behind
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2
    assert not os.path.exists(f"{tmp_dir}/t/batch_id=4")


def test_stream_from_raw_lines_routes_rejects(spark, tmp_dir):
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    base = 1704103200
    lines = [f"up\t1.2.3.4\t{base + 600 * k + j}" for k, c in enumerate([1, 2, 2, 3, 4, 5, 1]) for j in range(c)]
    lines += ["up\t1.2.3.4\t" + str(base + 4 * 3600), "bad\t256.1.1.1\t1", "short"]
    with open(f"{src}/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    req = stm.request_stream(spark, "text", src)
    for q in stm.run_trending_stream(spark, req, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True):
        q.awaitTermination()
    rej = {r.reason for r in spark.read.parquet(f"{tmp_dir}/out/rejects").collect()}
    assert rej == {"ip", "fields"}
    assert spark.read.parquet(f"{tmp_dir}/out/trending").where("article = 'up'").count() >= 1


def test_complete_partitions_writer_is_idempotent(spark, tmp_dir):
    w = stm.complete_partitions_writer(f"{tmp_dir}/h", ["date", "hour"])
    df = spark.createDataFrame([("2024-01-01", 10, "a", 3), ("2024-01-01", 11, "a", 1)],
                               "date string, hour int, article string, views bigint")
    w(df, 0)
    w(df, 0)  # replay
    w(df.where("hour = 11").withColumn("views", F.lit(5).cast("bigint")), 1)  # a later batch for hour 11 only
    got = sorted((r.hour, r.views) for r in spark.read.parquet(f"{tmp_dir}/h").collect())
    assert got == [(10, 3), (11, 5)]


def test_chained_state_survives_restart(spark, tmp_dir):
    """Split the events in two files by date; run, stop, add the second file, resume from the same
    checkpoint. The result must equal batch on the windows the final watermark has closed."""
    ev = (spark.read.parquet(f"{SF_SMALL}/events.parquet")
               .select(F.col("event_type").alias("article"), "ts"))
    src = f"{tmp_dir}/src"
    ev.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{src}/a")
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"

    def run():
        s = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
        _drain(stm.trending_stream(s, 6, "4 hours", "1 hour", "1 hour"), out, ck)

    run()
    ev.where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{src}/b")
    run()
    got = {(r.article, r.ws, tuple(r[f"s{i}"] for i in range(6)))
           for r in spark.read.parquet(out).select("*", to_wall_time("window_start").alias("ws")).collect()}
    max_ts = ev.agg(F.max("ts")).first()[0]
    want = {(r.article, r.window_start, tuple(r[f"s{i}"] for i in range(6)))
            for r in win.trending(ev, 6, "4 hours", "1 hour").collect()
            if r.window_end <= max_ts - dt.timedelta(hours=1)}
    assert got == want and len(got) > 0


def test_precount_table_feeds_all_outputs(spark, tmp_dir):
    """Raw requests counted once into a bucket table; trend, phase counts and hourly totals stream from
    it. Every emitted row equals batch; rows safely behind both watermarks are all there."""
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev = raw.select(F.col("event_type").alias("article"), "ts")
    src = (spark.readStream.schema(raw.schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
                .select(F.col("event_type").alias("article"), "ts"))
    out = f"{tmp_dir}/out"
    qs = stm.run_trending_stream(spark, src, out, f"{tmp_dir}/ck", watermark="1 hour", slot="4 hours",
                                 slide="1 hour", available_now=True, precount_path=f"{tmp_dir}/pre")
    for q in qs:
        q.awaitTermination()
    max_ts = ev.agg(F.max("ts")).first()[0]
    safe = max_ts - dt.timedelta(hours=3)
    batch_tr = {(r.article, r.window_start): tuple(r[f"s{i}"] for i in range(6))
                for r in win.trending(ev, 6, "4 hours", "1 hour").collect()}
    got_tr = {(r.article, r.ws): tuple(r[f"s{i}"] for i in range(6))
              for r in spark.read.parquet(f"{out}/trending").select("*", to_wall_time("window_start").alias("ws"))
                                                        .collect()}
    assert got_tr and all(batch_tr.get(k) == v for k, v in got_tr.items())
    assert {k for k in batch_tr if k[1] + dt.timedelta(hours=24) <= safe} <= set(got_tr)
    batch_h = {(r.date, r.hour, r.article): r.views for r in win.hourly_totals(ev).collect()}
    got_h = {(r.date, r.hour, r.article): r.views for r in spark.read.parquet(f"{out}/hourly_totals").collect()}
    assert got_h and all(batch_h[k] == v for k, v in got_h.items())
    batch_sc = {(r.article, r.window_start): r.views for r in win.sliding_counts(ev, "4 hours", "1 hour").collect()}
    got_sc = {(r.article, r.ws): r.views for r in spark.read.parquet(f"{out}/phase_counts")
              .select("*", to_wall_time("window_start").alias("ws")).collect()}
    assert got_sc and all(batch_sc[k] == v for k, v in got_sc.items())
    pre = spark.read.parquet(f"{tmp_dir}/pre")
    assert pre.count() <= ev.count()  # compacted: one row per (article, hour bucket)


def test_raw_lines_with_precount(spark, tmp_dir):
    src = f"{tmp_dir}/lines"
    os.makedirs(src)
    base = 1704103200  # 2024-01-01 10:00:00 UTC
    lines = [f"up\t1.2.3.4\t{base + 600 * k + j}" for k, c in enumerate([1, 2, 2, 3, 4, 5, 1]) for j in range(c)]
    lines += [f"up\t1.2.3.4\t{base + h * 3600}" for h in (3, 4)] + ["bad\t256.1.1.1\t1"]
    with open(f"{src}/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    req = stm.request_stream(spark, "text", src)
    for q in stm.run_trending_stream(spark, req, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True,
                                     precount_path=f"{tmp_dir}/pre"):
        q.awaitTermination()
    assert {r.reason for r in spark.read.parquet(f"{tmp_dir}/out/rejects").collect()} == {"ip"}
    tr = spark.read.parquet(f"{tmp_dir}/out/trending").select("article", to_wall_time("window_start").alias("ws"))
    assert ("up", T0) in {(r.article, r.ws) for r in tr.collect()}
    hourly = {(r.hour, r.views) for r in spark.read.parquet(f"{tmp_dir}/out/hourly_totals").collect()}
    assert (10, 17) in hourly


def test_precount_on_empty_source(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/empty")
    src = spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/empty")
    q = stm.start_precount(src, f"{tmp_dir}/pre", f"{tmp_dir}/ck", available_now=True, wait_seconds=60)
    q.awaitTermination()
    assert spark.read.schema(stm.PRECOUNT_SCHEMA).parquet(f"{tmp_dir}/pre").count() == 0


def test_stream_queries_read_any_file_layout(spark, tmp_dir):
    from viewtide.plans.catalog import QUERIES
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4, F.xxhash64("ts")).write.parquet(f"{tmp_dir}/events.parquet")
    for name in ("hourly_totals_stream", "phase_counts_stream"):
        one = sorted(map(str, QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
        assert one and sorted(map(str, QUERIES[name](spark, tmp_dir).collect())) == one
