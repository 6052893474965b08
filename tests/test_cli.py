from pyspark.sql import functions as F

from viewtide import cli
from viewtide.sinks import tables as tbl


def test_cli_anomaly_and_fold(spark, tmp_dir):
    feed = f"{tmp_dir}/feed"
    rows = [("2024-01-01", 0, "a", 10), ("2024-01-02", 0, "a", 30), ("2024-01-02", 0, "b", 5)]
    tbl.write_hourly_totals(spark.createDataFrame(rows, "date string, hour int, article string, views bigint")
                            .withColumn("date", F.col("date").cast("date")), feed)
    from viewtide.plans import jobs
    jobs.seed_history_from_feed(spark, feed, f"{tmp_dir}/hist", "2024-01-01")
    cli.main(["anomaly-hour", "--feed", feed, "--history", f"{tmp_dir}/hist", "--state", f"{tmp_dir}/st",
              "--out", f"{tmp_dir}/an", "--date", "2024-01-02", "--hour", "0", "--missing", "zero"])
    got = {r.article: round(r.distance, 6) for r in spark.read.parquet(f"{tmp_dir}/an").collect()}
    assert got == {"a": 0.5, "b": 1.0}
    cli.main(["fold-day", "--allow-missing-hours", "--feed", feed, "--history", f"{tmp_dir}/hist", "--date", "2024-01-02"])
    assert tbl.history_versions(spark, f"{tmp_dir}/hist") == ["2024-01-01", "2024-01-02"]


def test_cli_stream_parquet_source(spark, tmp_dir):
    import datetime as dt
    src = f"{tmp_dir}/src"
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [("up", t0 + dt.timedelta(minutes=10 * k, seconds=j)) for k, c in enumerate([1, 2, 2, 3, 4, 5, 1])
            for j in range(c)] + [("up", t0 + dt.timedelta(hours=3)), ("up", t0 + dt.timedelta(hours=4))]
    # the pre-count path closes windows one stage later, so the data runs on past 11:00 by hours
    spark.createDataFrame(rows, "event_type string, ts timestamp_ntz").write.parquet(src)
    cli.main(["stream", "--source", "parquet", "--path", src, "--out", f"{tmp_dir}/out",
              "--checkpoint", f"{tmp_dir}/ck", "--available-now", "--article-col", "event_type",
              "--precount", f"{tmp_dir}/pre", "--state-partitions", "4"])
    assert spark.read.parquet(f"{tmp_dir}/out/trending").count() >= 1
    assert spark.read.parquet(f"{tmp_dir}/out/hourly_totals").where("hour = 10").first().views == 17


def test_cli_build_history_and_backfill(spark, tmp_dir):
    import os
    logs = f"{tmp_dir}/logs"
    os.makedirs(f"{logs}/00")
    with open(f"{logs}/00/part-0", "w") as f:
        f.write("en A 10 1\nen B 4 1\nbad line\n")
    cli.main(["build-history", "--logs", logs, "--history", f"{tmp_dir}/hist", "--as-of", "2024-01-01",
              "--rejects", f"{tmp_dir}/rej"])
    assert spark.read.parquet(f"{tmp_dir}/rej").count() == 1
    feed = f"{tmp_dir}/feed"
    tbl.write_hourly_totals(spark.createDataFrame([("2024-01-02", 0, "a", 30), ("2024-01-02", 0, "b", 4)],
                                                  "date string, hour int, article string, views bigint")
                            .withColumn("date", F.col("date").cast("date")), feed)
    cli.main(["backfill", "--feed", feed, "--history", f"{tmp_dir}/hist", "--out", f"{tmp_dir}/an",
              "--date", "2024-01-02", "--missing", "zero", "-k", "1"])
    got = {(r.hour, r.rank, r.article, round(r.distance, 6)) for r in spark.read.parquet(f"{tmp_dir}/an").collect()}
    # history from the logs: a = 10, b = 4 at hour 0; today a = 30 -> 20/40, b = 4 -> 0; zero mode
    # carries both through hours 1..23, and k = 1 keeps a
    assert got == {(h, 1, "a", 0.5) for h in range(24)}
