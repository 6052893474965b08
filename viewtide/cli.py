"""Command-line entry for the jobs, for ``spark-submit``:

    spark-submit -m viewtide.cli stream --source kafka --bootstrap h:9092 --topic requests ...
    python -m viewtide.cli anomaly-hour --feed F --history H --state S --out O --date 2024-01-30 --hour 5

The session comes from the cluster (``SparkSession.builder.getOrCreate()``); nothing is configured
here beyond what the job needs. Dates and hours are arguments, never the wall clock.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import jobs
from .session import ensure_checkpoint_dir
from .streaming import trend_stream as stm


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="viewtide")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="E1: trending, phase-routed counts and hourly feed")
    s.add_argument("--source", choices=["kafka", "text", "parquet"], required=True)
    s.add_argument("--path")
    s.add_argument("--bootstrap")
    s.add_argument("--topic")
    s.add_argument("--starting", default="latest", help="Kafka source: starting offsets")
    s.add_argument("--max-offsets", type=int, help="Kafka source: most offsets of a micro-batch")
    s.add_argument("--allow-data-loss", action="store_true", help="Kafka source: go on where offsets have expired")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", help="defaults to <spark.checkpoint.dir>/viewtide-stream")
    s.add_argument("--watermark", default="10 minutes")
    s.add_argument("--phase-sink", choices=["kafka", "parquet"], default="parquet")
    s.add_argument("--phase-topic", default="pageviews-")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--article-col", default="article", help="parquet source: column holding the article")
    s.add_argument("--ts-col", default="ts", help="parquet source: event-time column")
    s.add_argument("--precount", help="count the raw stream once into this table; outputs read it")
    s.add_argument("--store", help="also keep the trending rows by hour in this serving store")
    s.add_argument("--state-partitions", type=int, help="state-store partitions of new queries")

    b = sub.add_parser("build-history", help="E2: averages from raw hourly log folders")
    b.add_argument("--logs", required=True)
    b.add_argument("--history", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--project")
    b.add_argument("--exact", action="store_true")
    b.add_argument("--rejects", help="also write malformed lines here, with counts")

    a = sub.add_parser("anomaly-hour", help="E3: incremental anomaly step for one hour")
    a.add_argument("--feed", required=True)
    a.add_argument("--history", required=True)
    a.add_argument("--state", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--date", required=True)
    a.add_argument("--hour", type=int, required=True)
    a.add_argument("-k", type=int, default=5)
    a.add_argument("--missing", choices=["drop", "zero"], default="drop")
    a.add_argument("--method", choices=["ratio", "canberra"], default="ratio")
    a.add_argument("--allow-missing-feed", action="store_true",
                   help="score an hour with no feed folder as an hour without traffic")

    r = sub.add_parser("repair", help="E3: run again the hours of a day whose feed or history has changed")
    for n in ("--feed", "--history", "--state", "--out", "--date"):
        r.add_argument(n, required=True)
    r.add_argument("-k", type=int, default=5)
    r.add_argument("--missing", choices=["drop", "zero"], default="drop")
    r.add_argument("--method", choices=["ratio", "canberra"], default="ratio")
    r.add_argument("--allow-missing-feed", action="store_true")

    f = sub.add_parser("backfill", help="W1: score every hour of a day in one job")
    for n in ("--feed", "--history", "--out", "--date"):
        f.add_argument(n, required=True)
    f.add_argument("-k", type=int, default=5)
    f.add_argument("--missing", choices=["drop", "zero"], default="drop")
    f.add_argument("--method", choices=["ratio", "canberra"], default="ratio")

    d = sub.add_parser("fold-day", help="E4: fold a finished day into the history")
    d.add_argument("--feed", required=True)
    d.add_argument("--history", required=True)
    d.add_argument("--date", required=True)
    d.add_argument("--log")
    d.add_argument("--allow-missing-hours", action="store_true",
                   help="fold a day of which some hours have no feed folder")
    d.add_argument("--exact", action="store_true")

    v = sub.add_parser("serve", help="E5: latest trending rows")
    v.add_argument("--trending", help="trending table, read whole")
    v.add_argument("--store", help="serving store, read from its newest hour back")
    v.add_argument("-n", type=int, default=10)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"viewtide-{args.cmd}").getOrCreate()
    if args.cmd == "stream":
        if args.source == "kafka":
            src = stm.request_stream(spark, "kafka", options=stm.kafka_options(
                args.bootstrap, args.topic, starting=args.starting, max_offsets_per_trigger=args.max_offsets,
                fail_on_data_loss=not args.allow_data_loss))
        elif args.source == "text":
            src = stm.request_stream(spark, "text", args.path)
        else:
            schema = spark.read.parquet(args.path).schema
            src = stm.request_stream(spark, "parquet", args.path, schema=schema).select(
                F.col(args.article_col).alias("article"), F.col(args.ts_col).alias("ts"))
        ck = args.checkpoint or f"{ensure_checkpoint_dir(spark)}/viewtide-stream"
        kafka = {"kafka.bootstrap.servers": args.bootstrap} if args.phase_sink == "kafka" else None
        qs = stm.run_trending_stream(spark, src, args.out, ck, args.watermark, args.phase_sink,
                                     args.phase_topic, kafka, available_now=args.available_now,
                                     state_partitions=args.state_partitions, precount_path=args.precount,
                                     serving_store=args.store)
        for q in qs:
            q.awaitTermination()
    elif args.cmd == "build-history":
        jobs.build_history(spark, args.logs, args.history, args.as_of, args.project, args.exact, args.rejects)
    elif args.cmd == "anomaly-hour":
        jobs.run_anomaly_hour(spark, args.feed, args.history, args.state, args.out, args.date, args.hour,
                              args.k, args.missing, args.method,
                              require_feed=not args.allow_missing_feed)
    elif args.cmd == "repair":
        jobs.repair_anomaly_hours(spark, args.feed, args.history, args.state, args.out, args.date, args.k, args.missing,
                                  args.method, require_feed=not args.allow_missing_feed)
    elif args.cmd == "backfill":
        jobs.backfill_anomalies(spark, args.feed, args.history, args.out, args.date, args.k, args.missing,
                                args.method)
    elif args.cmd == "fold-day":
        jobs.fold_day(spark, args.feed, args.history, args.date, args.log, args.exact,
                      allow_missing_hours=args.allow_missing_hours)
    elif args.cmd == "serve":
        rows = jobs.serve_newest(spark, args.store, args.n) if args.store else jobs.serve(spark, args.trending, args.n)
        rows.show(truncate=False)


if __name__ == "__main__":
    main()
