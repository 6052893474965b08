"""Structured Streaming form of the trend job.

Every stream first counts requests per (article, slide bucket) in a tumbling event-time window, so
the later sliding windows replicate one row per article and bucket instead of one per request.
The second stateful aggregate slides over ``window_time`` of the first (chained event-time
aggregates, append mode): the sliding slot counts. The trend chains a third one over their
``window_time``, of whose windows only those in phase with a slot are kept (M8), so exactly six
non-overlapping slots make up an hour (D3, D4): 10 + 6 state updates a bucket row instead of 60.

Every operator also accepts rows already counted per bucket (``weight=``): with ``precount_path``,
``run_trending_stream`` reads and counts the raw topic once into such a table and the outputs stream
from it, at the cost of one more stage of watermark lag.

Rows later than the watermark are dropped by Spark and counted in the query progress
(``numRowsDroppedByWatermark``). State lives in the checkpoint folder; with the RocksDB provider
(``session.BASE_CONF``) it stays off-heap.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timecols import as_event_time, date_of, hour_of_day
from ..operators.parse import parse_phase_records, parse_requests
from ..operators.windows import duration_seconds, non_decreasing, route_by_phase, slot_names
from ..schemas import REJECTS, REQUESTS
from ..sinks import ledger, serving_store
from ..sinks import manifest as mf
from ..sources.files import path_exists


# ---------------------------------------------------------------- sources

def kafka_options(bootstrap: str, topic: str | None = None, pattern: str | None = None,
                  starting: str = "latest", max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, fail_on_data_loss: bool = True,
                  **extra: str) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``: one topic or a pattern (``subscribePattern``,
    e.g. the ten phase topics). ``max_offsets_per_trigger`` bounds a micro-batch (a backlog after
    downtime is worked off in steps, not one giant batch); ``min_partitions`` splits Kafka partitions
    into more Spark tasks than the topic has partitions. Offsets that have expired stop the stream
    unless ``fail_on_data_loss`` is off."""
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if topic:
        opts["subscribe"] = topic
    elif pattern:
        opts["subscribePattern"] = pattern
    else:
        raise ValueError("give a topic or a pattern")
    opts.update(extra)
    return opts


def request_stream(spark: SparkSession, fmt: str, path: str | None = None,
                   options: dict | None = None, schema=None) -> DataFrame:
    """A stream of request lines (``kafka``, ``text``) or of typed rows (``parquet``)."""
    rs = spark.readStream.options(**(options or {}))
    if fmt == "kafka":
        return rs.format("kafka").load().select(F.col("value").cast("string").alias("value"))
    if fmt == "text":
        return rs.text(path)
    if fmt == "parquet":
        return rs.schema(schema).parquet(path)
    raise ValueError(f"unsupported stream format {fmt!r}")


def parsed_request_stream(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P1 on a stream: (article, ip, ts) rows and rejects; neither fails the query."""
    return parse_requests(lines)


# ---------------------------------------------------------------- operators (M1-M7)

def bucket_counts_stream(req: DataFrame, bucket: str = "1 minute", watermark: str = "10 minutes",
                         ts: str = "ts", key: str = "article") -> DataFrame:
    """M1 + M2 + M3: event time with a watermark, tumbling pre-count per (key, bucket)."""
    req = as_event_time(req, ts)
    return (req.withWatermark(ts, watermark)
               .groupBy(F.window(ts, bucket).alias("b"), F.col(key))
               .agg(F.count(F.lit(1)).alias("views")))


def _buckets(req: DataFrame, bucket: str, watermark: str, ts: str, key: str,
             weight: str | None) -> DataFrame:
    """(key, _t, _bsec, views) per slide bucket: ``_t`` is the watermarked event time the next
    window groups on, ``_bsec`` the bucket start in epoch seconds.

    Raw requests (``weight`` None) are counted here in a tumbling window; rows already counted per
    bucket (a pre-count table: key, ts = bucket start, ``weight``) are only watermarked."""
    if weight is None:
        b = bucket_counts_stream(req, bucket, watermark, ts, key)
        return b.select(F.col(key), F.window_time("b").alias("_t"),
                        F.unix_timestamp(F.col("b.start")).alias("_bsec"), F.col("views"))
    req = as_event_time(req, ts).withWatermark(ts, watermark)
    return req.select(F.col(key), F.col(ts).alias("_t"), F.unix_timestamp(F.col(ts)).alias("_bsec"),
                      F.col(weight).cast("bigint").alias("views"))


def sliding_counts_stream(req: DataFrame, size: str = "10 minutes", slide: str = "1 minute",
                          watermark: str = "10 minutes", ts: str = "ts", key: str = "article",
                          weight: str | None = None) -> DataFrame:
    """M4: sliding counts, emitted once the watermark closes each window."""
    return _sliding(req, size, slide, watermark, ts, key, weight).select(
        key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "views")


def _sliding(req: DataFrame, size: str, slide: str, watermark: str, ts: str, key: str,
             weight: str | None) -> DataFrame:
    """(window, key, views): bucket counts summed over sliding windows."""
    b = _buckets(req, slide, watermark, ts, key, weight)
    return (b.groupBy(F.window("_t", size, slide).alias("window"), F.col(key))
             .agg(F.sum("views").cast("bigint").alias("views")))


def trend_series_stream(req: DataFrame, slots: int = 6, slot: str = "10 minutes",
                        slide: str = "1 minute", watermark: str = "10 minutes", ts: str = "ts",
                        key: str = "article", weight: str | None = None) -> DataFrame:
    """M5 + P7: complete six-slot series per sliding window (NULL slot = no request, incomplete)."""
    slot_s, slide_s = duration_seconds(slot), duration_seconds(slide)
    if slot_s % slide_s:
        raise ValueError("slot width must be a multiple of the slide")
    span, step = f"{slots * slot_s} seconds", f"{slide_s} seconds"
    s = _sliding(req, f"{slot_s} seconds", step, watermark, ts, key, weight)
    s = s.select(key, F.window_time("window").alias("_t"),
                 F.unix_timestamp(F.col("window.start")).alias("_slot"), "views")
    return _series_of_slots(s, slots, slot_s, span, step, key)


def _series_of_slots(s: DataFrame, slots: int, slot_s: int, span: str, step: str, key: str) -> DataFrame:
    """The complete series of slot counts (key, _t event time of the slot's end, _slot its start in seconds, views)."""
    lead = F.col("_slot") - F.unix_timestamp(F.col("window.start"))
    # of the windows around a slot only those in phase with it reach the state, one per slot position
    wdf = (s.select(F.window("_t", span, step).alias("window"), key, "_slot", "views")
            .where(lead % slot_s == 0))
    g = wdf.groupBy("window", key).agg(
        *[F.max(F.when(lead == i * slot_s, F.col("views"))).alias(f"s{i}") for i in range(slots)])
    names = slot_names(slots)
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    return g.where(complete).select(key, F.col("window.start").alias("window_start"),
                                    F.col("window.end").alias("window_end"), *names)


def series_from_phases(records: DataFrame, slots: int = 6, slot: str = "10 minutes", slide: str = "1 minute",
                       watermark: str = "0 seconds", key: str = "article") -> DataFrame:
    """S7 + M8: the hour series put together again from phase-topic records (a ``value`` column of
    `article \t epoch_seconds \t count`, as `route_by_phase` writes them with ``stamp='epoch'``).

    The slots of an hour window all have one phase, so a reader of a single phase topic finds all six of them there, and
    ten readers can each take a topic. State is bounded in event time: a record meets the six hour windows in phase with its slot,
    and a window leaves the state when the watermark (by the slots' ends) passes it. Records of one job are in
    order already, hence no delay by default. A slot that was sent again counts once."""
    slot_s, slide_s = duration_seconds(slot), duration_seconds(slide)
    good, _ = parse_phase_records(records)
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(slot_s * 1_000_000 - 1))
    s = good.select(key, end.alias("_t"), F.unix_timestamp("window_start").alias("_slot"), "views").withWatermark("_t", watermark)
    return _series_of_slots(s, slots, slot_s, f"{slots * slot_s} seconds", f"{slide_s} seconds", key)


def trending_stream(req: DataFrame, slots: int = 6, slot: str = "10 minutes", slide: str = "1 minute",
                    watermark: str = "10 minutes", ts: str = "ts", key: str = "article",
                    weight: str | None = None) -> DataFrame:
    """M6: the trending filter on the closed series (stateless after the stateful aggregate)."""
    ser = trend_series_stream(req, slots, slot, slide, watermark, ts, key, weight)
    return ser.where(non_decreasing(slot_names(slots)))


def hourly_totals_stream(req: DataFrame, watermark: str = "10 minutes", ts: str = "ts",
                         key: str = "article", weight: str | None = None) -> DataFrame:
    """Tumbling one-hour counts labelled by the window start's UTC date and hour.
    With ``weight`` the input is a pre-count table whose buckets divide the hour."""
    req = as_event_time(req, ts)
    agg = F.count(F.lit(1)) if weight is None else F.sum(F.col(weight))
    g = (req.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 hour").alias("w"), F.col(key))
            .agg(agg.cast("bigint").alias("views")))
    sec = F.unix_timestamp(F.col("w.start"))
    return g.select(date_of(sec).alias("date"), hour_of_day(sec).alias("hour"), key, "views")


# ---------------------------------------------------------------- sinks and the job

def idempotent_batch_writer(path: str, fmt: str = "parquet", partition_by: list[str] | None = None):
    """foreachBatch function (K1/K5/K6): each micro-batch goes to its own ``batch_id=N`` folder with
    overwrite, so a batch replayed after a failure replaces its own output instead of duplicating.
    Rows are rebalanced by ``partition_by`` first: few files per folder, not one per state task."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch is the output of the stateful plan: cache it so the emptiness check and the write
        # do not run the micro-batch twice; no-data batches leave no folder behind
        batch.persist()
        try:
            if batch.isEmpty():
                return
            out = batch.hint("rebalance", *partition_by) if partition_by else batch.hint("rebalance")
            w = out.write.mode("overwrite").format(fmt)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.save(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def complete_partitions_writer(path: str, partition_by: list[str]):
    """foreachBatch function (K2) for outputs whose every partition is emitted whole by one batch,
    as append-mode windows are (an hour's totals leave the state together, once): rebalance, then
    dynamic partition overwrite -- idempotent on replay, files sized by AQE."""
    def write(batch: DataFrame, batch_id: int) -> None:
        mf.write_partitions(batch.hint("rebalance", *partition_by), path, partition_by)
    return write


def intake_writer(out_root: str, run: str):
    """foreachBatch function (P1, S6): raw lines are parsed once, good rows committed to ``out_root/requests`` and bad ones
    to ``out_root/rejects``; the ledger's manifests hold the counts of both. A replayed batch that is committed is not read again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, (f"{out_root}/requests", f"{out_root}/rejects")
        if all(mf.finished(spark, ledger.folder_of(n, run, batch_id)) for n in names):
            return
        batch.persist()
        try:
            for rows, name in zip(parse_requests(batch), names):
                ledger.commit(rows, name, run, batch_id)
        finally:
            batch.unpersist()
    return write


def trending_writer(path: str, run: str, store: str | None):
    """foreachBatch function (K5): trending rows to the ledger and, if there is one, to the serving store."""
    ledger_write = ledger.batch_writer(path, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if store and not batch.isEmpty():
                serving_store.add_batch(batch, store, run, batch_id)
            ledger_write(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def start_stream(df: DataFrame, sink: str, path: str | None, checkpoint: str, name: str,
                 partition_by: list[str] | None = None, available_now: bool = False,
                 processing_time: str | None = None, options: dict | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Start an append-mode query: ``parquet`` file sink (exactly-once via its manifest),
    ``kafka`` (needs a ``topic`` or per-row ``topic`` column), ``batches`` (per-batch folders of this checkpoint's
    run, each committed once, see `sinks.ledger`), ``partitions`` (whole partitions per batch, dynamic overwrite),
    ``intake`` (raw lines to requests and rejects below ``path``) or ``trending`` (``batches`` that also
    go to the serving store ``options['store']``).

    ``state_partitions`` fixes the number of state-store partitions of a new query (recorded in its
    checkpoint, so restarts keep it); AQE does not resize stateful stages, so size it to the
    cluster's cores rather than leaving the batch default.
    """
    if state_partitions:
        spark = df.sparkSession
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            return start_stream(df, sink, path, checkpoint, name, partition_by, available_now,
                                processing_time, options, None)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if sink == "parquet":
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format("parquet").options(**(options or {})).start(path)
    if sink == "kafka":
        return w.format("kafka").options(**(options or {})).start()
    if sink in ("batches", "intake", "trending"):
        run = ledger.run_id(df.sparkSession, checkpoint, f"{path}/requests" if sink == "intake" else path)
        if sink == "intake":
            return w.foreachBatch(intake_writer(path, run)).start()
        if sink == "trending":
            return w.foreachBatch(trending_writer(path, run, (options or {}).get("store"))).start()
        return w.foreachBatch(ledger.batch_writer(path, run, partition_by)).start()
    if sink == "partitions":
        return w.foreachBatch(complete_partitions_writer(path, partition_by)).start()
    raise ValueError(f"unsupported sink {sink!r}")


def write_trending(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """K5: trending rows to micro-batch folders, each committed once."""
    return start_stream(df, "batches", path, checkpoint, None, **trigger)


PRECOUNT_SCHEMA = "article STRING, ts TIMESTAMP, views BIGINT"


def start_precount(requests: DataFrame, path: str, checkpoint: str, slide: str = "1 minute",
                   watermark: str = "10 minutes", wait_seconds: float = 120.0, **common) -> StreamingQuery:
    """One query counts the raw requests per (article, slide bucket) into a parquet table (file
    sink: exactly-once through its commit log). Returns once the table's commit log exists, so
    readers started afterwards read committed batches only."""
    counts = bucket_counts_stream(requests, slide, watermark).select(
        "article", F.col("b.start").alias("ts"), "views")
    q = start_stream(counts, "parquet", path, checkpoint, "precount", **common)
    spark = counts.sparkSession
    deadline = time.monotonic() + wait_seconds
    while not path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        if not q.isActive:
            if q.exception() is not None:
                raise q.exception()
            break  # finished without input (availableNow on an empty source)
        if time.monotonic() > deadline:
            raise TimeoutError(f"pre-count sink at {path} did not start")
        time.sleep(0.2)
    if not path_exists(spark, path):  # give readers an empty table of the right schema
        spark.createDataFrame([], PRECOUNT_SCHEMA).write.mode("ignore").parquet(path)
    return q


def start_intake(lines: DataFrame, out_root: str, checkpoint: str, **common) -> StreamingQuery:
    """One query reads and parses the raw lines; the outputs stream from ``out_root/requests``. The source is read once
    for good and bad rows together."""
    spark = lines.sparkSession
    fs, folder = mf._fs(spark, f"{out_root}/requests")
    fs.mkdirs(folder)  # readers may start before the first batch
    return start_stream(lines, "intake", out_root, checkpoint, "intake", **common)


def read_requests_table(spark: SparkSession, out_root: str) -> DataFrame:
    """The typed requests of `start_intake`, as a stream of (article, ip, ts)."""
    return spark.readStream.schema(REQUESTS).parquet(f"{out_root}/requests")


def read_rejects(spark: SparkSession, out_root: str) -> DataFrame:
    """The lines that `start_intake` rejected, with reasons."""
    return ledger.read_batches(spark, f"{out_root}/rejects", ", ".join(f"{f.name} string" for f in REJECTS.fields))


def run_trending_stream(spark: SparkSession, requests: DataFrame, out_root: str, checkpoint_root: str,
                        watermark: str = "10 minutes", phase_sink: str = "parquet",
                        phase_topic: str = "pageviews-", kafka: dict | None = None,
                        available_now: bool = False, processing_time: str | None = "1 minute",
                        slots: int = 6, slot: str = "10 minutes", slide: str = "1 minute",
                        state_partitions: int | None = None,
                        precount_path: str | None = None,
                        serving_store: str | None = None) -> list[StreamingQuery]:
    """From one request stream start the three outputs of the reference job.

    * sliding counts routed to ten phase topics (K1) -- Kafka when ``phase_sink='kafka'``,
      otherwise per-batch folders partitioned by topic;
    * hourly totals (K2), parquet partitioned by date and hour -- the anomaly job's feed, each hour
      written whole by the batch that closes it;
    * trending rows (K5), idempotent micro-batch folders.

    ``requests`` is either typed (article, ts) or raw lines (a ``value`` column, e.g. from Kafka); raw lines
    are read and parsed once by an intake query (P1), whose table ``out_root/requests`` the outputs stream from and whose
    rejects go to ``out_root/rejects``. With ``serving_store`` the trending rows also go there, by hour.

    With ``precount_path`` the raw stream is read and counted once, into a per-(article, minute)
    table, and the three outputs stream from that compact table instead of each consuming the raw
    topic (the reference's two-stage design, with a table in place of its phase topics). The slide
    must divide an hour, since the hourly totals are then summed from the buckets.
    """
    common = dict(available_now=available_now, processing_time=processing_time,
                  state_partitions=state_partitions)
    extra: list[StreamingQuery] = []
    if "value" in requests.columns and "article" not in requests.columns:
        intake = start_intake(requests, out_root, f"{checkpoint_root}/intake", available_now=available_now, processing_time=processing_time)
        if available_now:
            intake.awaitTermination()  # drain the raw lines first, then the outputs drain the table
        extra.append(intake)
        requests = read_requests_table(spark, out_root)
    weight = None
    if precount_path:
        if 3600 % duration_seconds(slide):
            raise ValueError("a pre-count table needs a slide that divides the hour")
        q0 = start_precount(requests, precount_path, f"{checkpoint_root}/precount", slide, watermark,
                            **common)
        if available_now:
            q0.awaitTermination()  # drain the raw input first, then the outputs drain the table
        extra.append(q0)
        requests = spark.readStream.schema(PRECOUNT_SCHEMA).parquet(precount_path)
        weight = "views"
    routed = route_by_phase(sliding_counts_stream(requests, slot, slide, watermark, weight=weight),
                            phase_topic)
    hourly = hourly_totals_stream(requests, watermark, weight=weight)
    trend = trending_stream(requests, slots, slot, slide, watermark, weight=weight)
    if phase_sink == "kafka":
        q1 = start_stream(routed.select("topic", "key", "value"), "kafka", None,
                          f"{checkpoint_root}/phase", "phase_counts", options=kafka, **common)
    else:
        q1 = start_stream(routed, "batches", f"{out_root}/phase_counts", f"{checkpoint_root}/phase",
                          "phase_counts", partition_by=["topic"], **common)
    q2 = start_stream(hourly, "partitions", f"{out_root}/hourly_totals", f"{checkpoint_root}/hourly",
                      "hourly_totals", partition_by=["date", "hour"], **common)
    q3 = start_stream(trend, "trending", f"{out_root}/trending", f"{checkpoint_root}/trending",
                      "trending", options={"store": serving_store}, **common)
    return [q1, q2, q3, *extra]
