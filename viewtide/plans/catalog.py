"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's tables.

Every query reads whole tables; parameters are fixed here and mirrored by ``oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_trending_text, series_text, trending_text
from ..functions.timecols import as_wall_time, to_wall_time
from ..operators import anomaly as anom
from ..operators import history as hist_ops
from ..operators import parse as prs
from ..operators import serving as srv
from ..operators import windows as win
from ..session import scratch_path
from ..sinks import ledger, serving_store
from ..sinks import tables as tbl
from ..sources import render
from ..sources.files import read_day, read_feed
from ..sources.tables import read_requests, read_table
from ..streaming import trend_stream as stm
from . import jobs

# The reference's window sizes (10-minute slots, one-hour series, one-minute slide).
SLOT, SLOTS, SLIDE = "10 minutes", 6, "1 minute"
# Coarser sizes for the smoke table, which is too sparse for 10-minute slots.
DAY_SLOT, DAY_SLIDE = "4 hours", "1 hour"
PHASE_TOPIC = "pageviews-"


def q_trending_hour(spark: SparkSession, sf: str) -> DataFrame:
    return win.trending(read_requests(spark, sf), SLOTS, SLOT, SLIDE)


def q_trending_day(spark: SparkSession, sf: str) -> DataFrame:
    return win.trending(read_requests(spark, sf), SLOTS, DAY_SLOT, DAY_SLIDE)


def q_hour_series(spark: SparkSession, sf: str) -> DataFrame:
    ser = win.with_series(win.trend_series(read_requests(spark, sf), SLOTS, SLOT, SLIDE))
    return ser.withColumn("series", series_text("series"))


def q_sliding_counts(spark: SparkSession, sf: str, requests: DataFrame | None = None) -> DataFrame:
    return win.sliding_counts(read_requests(spark, sf) if requests is None else requests, SLOT, SLIDE)


def q_phase_routed_counts(spark: SparkSession, sf: str) -> DataFrame:
    return win.route_by_phase(win.sliding_counts(read_requests(spark, sf), SLOT, SLIDE), PHASE_TOPIC)


def q_hourly_totals(spark: SparkSession, sf: str, requests: DataFrame | None = None) -> DataFrame:
    return win.hourly_totals(read_requests(spark, sf) if requests is None else requests)


def q_parse_requests(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = prs.parse_requests(render.request_lines(read_table(spark, sf, "events")))
    return good.withColumn("ts", to_wall_time("ts"))


def q_parse_requests_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = prs.parse_requests(render.request_lines(read_table(spark, sf, "events")))
    return bad


def q_parse_hourly_logs(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = prs.parse_hourly_logs(render.hourly_log_lines(read_table(spark, sf, "events")))
    return good


def q_parse_hourly_logs_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = prs.parse_hourly_logs(render.hourly_log_lines(read_table(spark, sf, "events")))
    return bad


def q_parse_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    routed = q_phase_routed_counts(spark, sf)
    good, _ = prs.parse_window_counts(routed.select("value"))
    return good


def q_history_from_logs(spark: SparkSession, sf: str) -> DataFrame:
    """E2 chain on rendered hourly logs: every good log line is one observation."""
    good, _ = prs.parse_hourly_logs(render.hourly_log_lines(read_table(spark, sf, "events")))
    return hist_ops.historical_average(good)


def q_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return prs.catalogue_from_lines(render.catalogue_lines(read_table(spark, sf, "part")))


# --- history and anomaly: the latest day of `events` is "today", earlier days are the history ---
TOP_K = 3
DIGITS = 6


def _day_split(spark: SparkSession, sf: str, requests: DataFrame | None = None):
    """(feed, latest date Column, today's feed, earlier feed). The requests are read once: the hourly feed is written, as the stream
    does it, and what follows (the latest date, a scalar subquery, included) reads that small table."""
    feed = win.hourly_totals(read_requests(spark, sf) if requests is None else requests)
    path = scratch_path(spark, "hourly-feed")
    feed.write.parquet(path)
    feed = spark.read.schema(feed.schema).parquet(path)
    latest = feed.select(F.max("date")).scalar()
    return feed, latest, feed.where(F.col("date") == latest), feed.where(F.col("date") < latest)


def q_historical_average(spark: SparkSession, sf: str) -> DataFrame:
    _, _, _, past = _day_split(spark, sf)
    return hist_ops.historical_average(past)


def q_update_history(spark: SparkSession, sf: str) -> DataFrame:
    _, _, today, past = _day_split(spark, sf)
    return hist_ops.update_history(hist_ops.historical_average(past), today)


def _backfill(spark: SparkSession, sf: str, missing: str, method: str = "ratio",
              requests: DataFrame | None = None) -> DataFrame:
    _, latest, today, past = _day_split(spark, sf, requests)
    run = anom.anomaly_backfill(today, hist_ops.historical_average(past), 23, missing)
    return anom.with_distance(run, method).withColumn("date", latest)


def _out(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("date", "hour", *cols, F.round("distance", DIGITS).alias("distance"))


def q_anomaly_backfill_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_backfill(spark, sf, "drop"), "article", "lhs", "rhs")


def q_anomaly_backfill_zero(spark: SparkSession, sf: str, requests: DataFrame | None = None) -> DataFrame:
    return _out(_backfill(spark, sf, "zero", requests=requests), "article", "lhs", "rhs")


def q_anomaly_canberra(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_backfill(spark, sf, "zero", "canberra"), "article")


def _step(spark: SparkSession, sf: str, hour: int, missing: str) -> DataFrame:
    """Incremental path: state of hour-1 (closed form) advanced by the terms of `hour`."""
    _, latest, today, past = _day_split(spark, sf)
    hist = hist_ops.historical_average(past)
    prev = None
    if hour > 0:
        prev = anom.anomaly_backfill(today, hist, hour - 1, missing).where(F.col("hour") == hour - 1)
    state = anom.anomaly_step(today.where(F.col("hour") == hour), hist.where(F.col("hour") == hour),
                              prev, missing)
    scored = anom.with_distance(state).withColumn("date", latest).withColumn("hour", F.lit(hour))
    return _out(scored, "article", "lhs", "rhs")


def q_anomaly_hour0(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, 0, "drop")


def q_anomaly_step(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, 23, "drop")


def q_anomaly_step_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _step(spark, sf, 23, "zero")


def q_top_anomalies(spark: SparkSession, sf: str, requests: DataFrame | None = None) -> DataFrame:
    ranked = anom.top_anomalies(_backfill(spark, sf, "zero", requests=requests), TOP_K)
    return _out(ranked, "rank", "article")


SERVE_N = 10


def q_parse_trending_text(spark: SparkSession, sf: str) -> DataFrame:
    """F9 -> F10 round trip over every trending row: format the pushed text row, parse it back."""
    tr = q_trending_hour(spark, sf)
    text = trending_text(F.col("article"), F.col("window_start"), F.array(*win.slot_names(SLOTS)))
    art, clock, series = parse_trending_text(text)
    return tr.select(art.alias("article"), clock.alias("clock"), series_text(series).alias("series"))


def q_promote_day(spark: SparkSession, sf: str) -> DataFrame:
    """K2 (batch) + K9 + S2: write the hourly feed as the work table, promote its latest day into the
    history log, and read that day back from the log."""
    root = scratch_path(spark, "promote")
    feed = win.hourly_totals(read_requests(spark, sf))
    tbl.write_hourly_totals(feed, f"{root}/work")
    day = spark.read.parquet(f"{root}/work").select(F.max("date")).first()[0]  # one scalar
    tbl.promote_day(spark, f"{root}/work", f"{root}/log", day)
    return read_day(spark, f"{root}/log", day).select("date", "hour", "article", "views")


def q_latest_trending(spark: SparkSession, sf: str) -> DataFrame:
    return srv.latest_trending(q_trending_hour(spark, sf), SERVE_N)


def q_serving_rows(spark: SparkSession, sf: str) -> DataFrame:
    return srv.serving_rows(q_trending_hour(spark, sf), SERVE_N)


# --- streaming: the events table replayed as a file stream until it is exhausted (availableNow) ---
WATERMARK = "10 minutes"


def _request_file_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, sf, "events").schema
    # a pattern, so that the table may be one file or a folder of any number of files
    src = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")
    return src.select(F.col("event_type").alias("article"), F.col("ts"))


def _default_parallelism(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no local SparkContext (Spark Connect): keep the session's setting
        return None


def _drain(spark: SparkSession, df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """Run a streaming DataFrame to completion into a table in the shared checkpoint folder and
    read the table back (the stream's output, not its lineage)."""
    root = scratch_path(spark, name)
    q = stm.start_stream(df, "parquet", f"{root}/data", f"{root}/checkpoint", None,
                         partition_by=partition_by, available_now=True,
                         state_partitions=_default_parallelism(spark))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/data")


def q_trending_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = _drain(spark, stm.trending_stream(_request_file_stream(spark, sf), SLOTS, SLOT, SLIDE, WATERMARK),
                 "trending-stream")
    return out.select("article", to_wall_time("window_start").alias("window_start"),
                      to_wall_time("window_end").alias("window_end"), *win.slot_names(SLOTS))


def q_trending_stream_precount(spark: SparkSession, sf: str) -> DataFrame:
    """Two-stage stream: requests counted once per (article, minute) into a table, the trend
    query streams from that table."""
    root = scratch_path(spark, "trending-precount")
    q0 = stm.start_precount(_request_file_stream(spark, sf), f"{root}/pre", f"{root}/checkpoint", SLIDE,
                            WATERMARK, available_now=True, state_partitions=_default_parallelism(spark))
    q0.awaitTermination()
    pre = spark.readStream.schema(stm.PRECOUNT_SCHEMA).parquet(f"{root}/pre")
    out = _drain(spark, stm.trending_stream(pre, SLOTS, SLOT, SLIDE, WATERMARK, weight="views"),
                 "trending-precount-out")
    return out.select("article", to_wall_time("window_start").alias("window_start"),
                      to_wall_time("window_end").alias("window_end"), *win.slot_names(SLOTS))


def q_phase_counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    counts = stm.sliding_counts_stream(_request_file_stream(spark, sf), SLOT, SLIDE, WATERMARK)
    out = _drain(spark, win.route_by_phase(counts, PHASE_TOPIC), "phase-stream")
    return out.select("article", to_wall_time("window_start").alias("window_start"),
                      to_wall_time("window_end").alias("window_end"), "views", "phase", "topic", "key",
                      "value")


def q_hourly_totals_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = _drain(spark, stm.hourly_totals_stream(_request_file_stream(spark, sf), WATERMARK),
                 "hourly-stream")
    return out.select("date", "hour", "article", "views")


SERIES_COLS = "article string, window_start timestamp, window_end timestamp, s0 long, s1 long, s2 long, s3 long, s4 long, s5 long"


def _wall(out: DataFrame) -> DataFrame:
    return as_wall_time(out, "window_start", "window_end").select("article", "window_start", "window_end", *win.slot_names(SLOTS))


def q_trending_stream_job(spark: SparkSession, sf: str) -> DataFrame:
    """E1 + S6 + P1 + K5: the whole stream job from raw lines (good and bad ones); its trending rows, read through the ledger."""
    root = scratch_path(spark, "stream-job")
    render.request_lines(read_table(spark, sf, "events")).write.parquet(f"{root}/lines")
    lines = stm.request_stream(spark, "parquet", f"{root}/lines", schema="value string")
    for q in stm.run_trending_stream(spark, lines, f"{root}/out", f"{root}/checkpoint", WATERMARK, phase_topic=PHASE_TOPIC,
                                     available_now=True, state_partitions=_default_parallelism(spark)):
        q.awaitTermination()
    return _wall(ledger.read_batches(spark, f"{root}/out/trending", SERIES_COLS))


def q_trending_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """M9 + K5: trending rows after a run, a replay of its batches, a write that died, and a new checkpoint that reads all input
    again, each row once."""
    root = scratch_path(spark, "trending-ledger")
    out = f"{root}/trending"

    def run(checkpoint: str) -> None:
        rows = stm.trending_stream(_request_file_stream(spark, sf), SLOTS, SLOT, SLIDE, WATERMARK)
        stm.start_stream(rows, "batches", out, f"{root}/{checkpoint}", None, available_now=True,
                         state_partitions=_default_parallelism(spark)).awaitTermination()

    run("first")
    first = ledger.run_id(spark, f"{root}/first", out)
    rows = ledger.read_batches(spark, out, SERIES_COLS)
    for folder in ledger.committed(spark, out):
        ledger.commit(rows, out, first, int(folder.rsplit("=", 1)[1]))
    rows.write.parquet(ledger.folder_of(out, first, 99))  # no manifest: died before its commit
    run("second")
    return _wall(ledger.read_batches(spark, out, SERIES_COLS, ["article", "window_start"]))


def q_series_from_phases(spark: SparkSession, sf: str) -> DataFrame:
    """S7 + M8 + M6: sliding counts sent to the phase topics (as a table), the trending series put together from their records."""
    root = scratch_path(spark, "phase-topics")
    counts = stm.sliding_counts_stream(_request_file_stream(spark, sf), SLOT, SLIDE, WATERMARK)
    routed = win.route_by_phase(counts, PHASE_TOPIC, stamp="epoch").select("topic", "key", "value")
    stm.start_stream(routed, "parquet", f"{root}/topics", f"{root}/checkpoint", None, partition_by=["topic"], available_now=True,
                     state_partitions=_default_parallelism(spark)).awaitTermination()
    records = spark.readStream.schema("key string, value string, topic string").parquet(f"{root}/topics")
    series = stm.series_from_phases(records, SLOTS, SLOT, SLIDE)
    return _wall(_drain(spark, series.where(win.non_decreasing(win.slot_names(SLOTS))), "phase-series"))


def q_latest_trending_store(spark: SparkSession, sf: str) -> DataFrame:
    """T3 + K5: trending rows added to the serving store in two batches, one of them twice; the newest rows from its newest hours."""
    root = scratch_path(spark, "serving-store")
    rows = q_trending_hour(spark, sf)
    late = F.minute("window_end") >= 30
    for batch, part in ((0, rows.where(~late)), (1, rows.where(late)), (1, rows.where(late))):
        serving_store.add_batch(part, root, "000001", batch)
    return srv.latest_trending(serving_store.newest_rows(spark, root, SERVE_N), SERVE_N)


# --- jobs over stored tables: the chains E4 and E3 run day by day and hour by hour ---
def _stored_feed(spark: SparkSession, sf: str, name: str):
    """The hourly feed with titles as logs have them (capitalised), written as the feed table; its latest date."""
    root = scratch_path(spark, name)
    feed = win.hourly_totals(read_requests(spark, sf))
    title = F.concat(F.upper(F.substring("article", 1, 1)), F.expr("substring(article, 2)"))
    tbl.write_hourly_totals(feed.withColumn("article", title), f"{root}/feed")
    day = spark.read.parquet(f"{root}/feed").select(F.max("date")).first()[0]  # one scalar
    return root, day


def q_fold_day_job(spark: SparkSession, sf: str) -> DataFrame:
    """E4 + K3 + S4: seed the history up to three days ago, fold the last three days one by one, read back."""
    root, day = _stored_feed(spark, sf, "fold-days")
    days = [day - dt.timedelta(days=k) for k in (2, 1, 0)]
    jobs.seed_history_from_feed(spark, f"{root}/feed", f"{root}/history", days[0] - dt.timedelta(days=1))
    for d in days:
        jobs.fold_day(spark, f"{root}/feed", f"{root}/history", d, log_path=f"{root}/log", allow_missing_hours=True)
    return tbl.read_history(spark, f"{root}/history").select("hour", "article", "sum_views", "n", "avg_views")


def q_fold_day_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """E4 + K3 merge-on-read: as fold_day_job, the days as deltas; the second version is compacted before the third day comes."""
    root, day = _stored_feed(spark, sf, "fold-deltas")
    days = [day - dt.timedelta(days=k) for k in (2, 1, 0)]
    jobs.seed_history_from_feed(spark, f"{root}/feed", f"{root}/history", days[0] - dt.timedelta(days=1))
    for d in days:
        jobs.fold_day(spark, f"{root}/feed", f"{root}/history", d, allow_missing_hours=True, merge_on_read=True)
        if d == days[1]:
            tbl.compact_history(spark, f"{root}/history")
    return tbl.read_history(spark, f"{root}/history").select("hour", "article", "sum_views", "n", "avg_views")


def q_extend_history_job(spark: SparkSession, sf: str) -> DataFrame:
    """E2 + S1 incremental: the logs come in three deliveries, each run reads the new files alone; the history after the last."""
    root = scratch_path(spark, "extend-history")
    lines = render.hourly_log_lines(read_table(spark, sf, "events").where(F.col("ts").isNotNull())).select("value", "hour")
    early, odd = F.col("hour") < 12, F.crc32(F.col("value").cast("binary")) % 2 == 1
    for part in (early, ~early & odd, ~early & ~odd):  # the last two bring files of the same hours
        lines.where(part).write.partitionBy("hour").mode("append").text(f"{root}/logs")
        jobs.extend_history_from_logs(spark, f"{root}/logs", f"{root}/sums", f"{root}/history", "1970-01-01")
    return tbl.read_history(spark, f"{root}/history").select("hour", "article", "sum_views", "n", "avg_views")


def q_build_history_job(spark: SparkSession, sf: str) -> DataFrame:
    """E2 + S1 + K3: hourly logs as text files in folders hour=0 to hour=23, the history built from them, read back."""
    root = scratch_path(spark, "build-history")
    lines = render.hourly_log_lines(read_table(spark, sf, "events").where(F.col("ts").isNotNull()))
    lines.select("value", "hour").write.partitionBy("hour").text(f"{root}/logs")
    jobs.build_history(spark, f"{root}/logs", f"{root}/history", "1970-01-01")
    return tbl.read_history(spark, f"{root}/history").select("hour", "article", "sum_views", "n", "avg_views")


def q_anomaly_hours_job(spark: SparkSession, sf: str) -> DataFrame:
    """E3 + K4 + K7 + S3 + S5: all hours of the latest day through the state table; the published rows."""
    root, day = _stored_feed(spark, sf, "anomaly-hours")
    jobs.seed_history_from_feed(spark, f"{root}/feed", f"{root}/history", day - dt.timedelta(days=1))
    for hour in range(24):
        jobs.run_anomaly_hour(spark, f"{root}/feed", f"{root}/history", f"{root}/state", f"{root}/published",
                              day, hour, TOP_K, "zero", require_feed=False)
    return _out(tbl.read_anomalies(spark, f"{root}/published"), "rank", "article")


def q_anomaly_repair(spark: SparkSession, sf: str) -> DataFrame:
    """E3 + K4 repaired: all hours run while hour 5 of the feed is wrong, then that hour is written again and the day
    repaired; the running sums of all hours, which must be the closed form's."""
    root = scratch_path(spark, "anomaly-repair")
    _, latest, today, past = _day_split(spark, sf)
    day = today.agg(F.max("date")).first()[0]  # one scalar
    tbl.write_history(hist_ops.historical_average(past), f"{root}/history", day - dt.timedelta(days=1))
    wrong = F.when(F.col("hour") == 5, F.col("views") * 2 + 1).otherwise(F.col("views"))
    tbl.write_hourly_totals(today.withColumn("views", wrong), f"{root}/feed")
    where = (f"{root}/feed", f"{root}/history", f"{root}/state", f"{root}/published", day)
    for hour in range(24):
        jobs.run_anomaly_hour(spark, *where, hour, TOP_K, "zero", require_feed=False)
    tbl.write_hourly_totals(today.where("hour = 5"), f"{root}/feed")
    jobs.repair_anomaly_hours(spark, *where, TOP_K, "zero", require_feed=False)
    states = tbl.read_anomaly_states(spark, f"{root}/state", day)
    return _out(anom.with_distance(states), "article", "lhs", "rhs")


BUCKETS = 8


def q_anomaly_hours_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """E3 + J1 + J2 over co-bucketed history and state: all hours of the latest day; the published rows."""
    root = scratch_path(spark, "anomaly-bucketed")
    _, _, today, past = _day_split(spark, sf)
    day = today.agg(F.max("date")).first()[0]  # one scalar
    before = (day - dt.timedelta(days=1)).isoformat()
    tbl.write_history(hist_ops.historical_average(past), f"{root}/history", before)
    tbl.write_hourly_totals(today, f"{root}/feed")
    jobs.bucket_history(spark, f"{root}/history", f"{root}/buckets", before, BUCKETS)
    for hour in range(24):
        jobs.run_anomaly_hour_bucketed(spark, f"{root}/feed", f"{root}/buckets", f"{root}/state", f"{root}/published", day, hour, TOP_K, "zero")
    return _out(tbl.read_anomalies(spark, f"{root}/published"), "rank", "article")


# --- many keys: users instead of event types as articles ---
def _per_user(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(spark, sf, read_table(spark, sf, "events").select(
            F.col("user_id").cast("string").alias("article"), "ts"))
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trending_hour": q_trending_hour,
    "trending_day": q_trending_day,
    "hour_series": q_hour_series,
    "sliding_counts": q_sliding_counts,
    "phase_routed_counts": q_phase_routed_counts,
    "hourly_totals": q_hourly_totals,
    "parse_requests": q_parse_requests,
    "parse_requests_rejects": q_parse_requests_rejects,
    "parse_hourly_logs": q_parse_hourly_logs,
    "parse_hourly_logs_rejects": q_parse_hourly_logs_rejects,
    "parse_window_counts": q_parse_window_counts,
    "catalogue": q_catalogue,
    "history_from_logs": q_history_from_logs,
    "historical_average": q_historical_average,
    "update_history": q_update_history,
    "anomaly_backfill_drop": q_anomaly_backfill_drop,
    "anomaly_backfill_zero": q_anomaly_backfill_zero,
    "anomaly_canberra": q_anomaly_canberra,
    "anomaly_hour0": q_anomaly_hour0,
    "anomaly_step": q_anomaly_step,
    "anomaly_step_zero": q_anomaly_step_zero,
    "top_anomalies": q_top_anomalies,
    "latest_trending": q_latest_trending,
    "serving_rows": q_serving_rows,
    "trending_stream": q_trending_stream,
    "hourly_totals_stream": q_hourly_totals_stream,
    "phase_counts_stream": q_phase_counts_stream,
    "trending_stream_precount": q_trending_stream_precount,
    "parse_trending_text": q_parse_trending_text,
    "promote_day": q_promote_day,
    "build_history_job": q_build_history_job,
    "fold_day_job": q_fold_day_job,
    "fold_day_deltas": q_fold_day_deltas,
    "extend_history_job": q_extend_history_job,
    "anomaly_hours_job": q_anomaly_hours_job,
    "anomaly_repair": q_anomaly_repair,
    "anomaly_hours_bucketed": q_anomaly_hours_bucketed,
    "trending_stream_job": q_trending_stream_job,
    "trending_ledger": q_trending_ledger,
    "series_from_phases": q_series_from_phases,
    "latest_trending_store": q_latest_trending_store,
    "sliding_counts_users": _per_user(q_sliding_counts),
    "hourly_totals_users": _per_user(q_hourly_totals),
    "anomaly_backfill_zero_users": _per_user(q_anomaly_backfill_zero),
    "top_anomalies_users": _per_user(q_top_anomalies),
}
