"""Smaller inventory items: F4, F7, F9/F10, F14, K6, K8, S4 legacy import, S6/S7 options, skew."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from viewtide.functions import hour_folder, pack_pair, parse_trending_text, run_stamp, trending_text, unpack_pair
from viewtide.operators import windows as win
from viewtide.sinks import tables as tbl
from viewtide.sources.files import import_sequence_pairs
from viewtide.streaming.trend_stream import kafka_options


def test_hour_folder_and_run_stamp(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 7)], "d date, h int")
    r = df.select(hour_folder("h"), run_stamp("d", "h")).first()
    assert r[0] == "07" and r[1] == "2024:1:5:7"


def test_pack_unpack_pair(spark):
    df = spark.createDataFrame([(10, 20)], "l bigint, r bigint").select(pack_pair("l", "r").alias("p"))
    assert df.first().p == "10;20"
    lhs, rhs = unpack_pair(F.col("p"))
    assert tuple(df.select(lhs, rhs).first()) == (10, 20)


def test_trending_text_round_trip(spark):
    df = spark.createDataFrame([("up", dt.datetime(2024, 1, 1, 10, 0, 0), [1, 2, 2, 3, 4, 5])],
                               "article string, ws timestamp_ntz, series array<bigint>")
    line = df.select(trending_text(F.col("article"), F.col("ws"), F.col("series")).alias("l"))
    assert line.first().l == "up\t10:00:00\t1:2:2:3:4:5"
    a, clock, series = parse_trending_text(F.col("l"))
    assert tuple(line.select(a, clock, series).first()) == ("up", "10:00:00", [1, 2, 2, 3, 4, 5])


def test_keyed_records_and_ranked_sink(spark, tmp_dir):
    df = spark.createDataFrame([("a", 3, 1), ("b", 4, 1)], "article string, views bigint, minute int")
    rec = tbl.to_keyed_records(df, value_cols=["article", "views"])
    assert sorted(tuple(r) for r in rec.collect()) == [("a", "a\t3"), ("b", "b\t4")]
    assert tbl.keyed_by_article(df, partitions=4).rdd.getNumPartitions() == 4
    tbl.write_ranked(df, f"{tmp_dir}/hot", ["minute"])
    tbl.write_ranked(df.where("article = 'a'"), f"{tmp_dir}/hot", ["minute"])  # replaces minute=1
    assert [r.article for r in spark.read.parquet(f"{tmp_dir}/hot").collect()] == ["a"]


def test_import_sequence_pairs(spark, tmp_dir):
    spark.sparkContext.parallelize([("cat", 7), ("dog", 4)]).saveAsSequenceFile(f"{tmp_dir}/seq")
    got = {r.article: r.value for r in import_sequence_pairs(spark, f"{tmp_dir}/seq").collect()}
    assert got == {"cat": 7, "dog": 4}


def test_kafka_options():
    o = kafka_options("h:9092", pattern="pageviews-[0-9]", max_offsets_per_trigger=10**7, min_partitions=64)
    assert o["subscribePattern"] == "pageviews-[0-9]" and o["kafka.bootstrap.servers"] == "h:9092"
    assert o["maxOffsetsPerTrigger"] == "10000000" and o["minPartitions"] == "64"
    with pytest.raises(ValueError):
        kafka_options("h:9092")


def test_phase_routing_ignores_session_zone(spark):
    t = dt.datetime(2024, 1, 1, 10, 59, 0, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([("a", t, 1)], "article string, window_start timestamp, views bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # +05:30
        r = win.route_by_phase(df, "q").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.phase == 9 and r.value == "a\t10:59:00\t1"


def test_hot_article_spreads_over_blocks(spark):
    """A key holding most rows is split into one (key, day) group per day after pre-aggregation."""
    t0 = dt.datetime(2024, 1, 1)
    hot = spark.range(0, 20000).select(F.lit("hot").alias("article"),
                                       F.timestamp_add("SECOND", F.col("id") * 20, F.lit(t0)).alias("ts"))
    cold = spark.range(0, 2000).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("article"),
                                       F.timestamp_add("SECOND", F.col("id") * 200, F.lit(t0)).alias("ts"))
    df = hot.unionByName(cold)
    m = win.bucket_counts(df, 60)
    blocked = win._blocked(m, "article", 1440, 59)
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(article" in plan and ", blk" in plan
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:  # tiny test data would otherwise be coalesced into one partition by AQE
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        per_task = blocked.where("article = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    days = df.where("article = 'hot'").select(F.to_date("ts")).distinct().count()
    assert days >= 4
    assert len(per_task) >= 2
    assert max(r["count"] for r in per_task) < m.where("article = 'hot'").count()


def test_serving_payload_and_member(spark):
    from viewtide.operators.serving import serving_payload
    from viewtide.operators.anomaly import anomaly_member
    t = dt.datetime(2024, 1, 1, 23, 35, 7)
    rows = [("x", t, t + dt.timedelta(hours=1), 1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, "article string, window_start timestamp_ntz, window_end timestamp_ntz, "
                                     "s0 bigint, s1 bigint, s2 bigint, s3 bigint, s4 bigint, s5 bigint")
    p = serving_payload(df, 10)
    assert p == {"datalist": [[1, 2, 3, 4, 5, 6]],
                 "timelist": [["23:35:07", "23:45:07", "23:55:07", "00:05:07", "00:15:07", "00:25:07"]],
                 "articlelist": ["x"]}
    m = anomaly_member(spark.createDataFrame([("a", 0.5)], "article string, distance double")).first().member
    assert m == "a:0.5"


def test_cluster_conf_sizes_shuffle():
    from viewtide.session import cluster_conf
    c = cluster_conf(100 * 10**12, executors=1000, cores_per_executor=8)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts * (256 << 20) >= 25 * 10**12


def test_serving_stream_rows_ignore_session_zone(spark):
    from viewtide.operators.serving import serving_rows
    t = dt.datetime(2024, 1, 1, 23, 35, 7, tzinfo=dt.timezone.utc)
    rows = [("x", t, t + dt.timedelta(hours=1), 1, 2, 3, 4, 5, 6)]
    df = spark.createDataFrame(rows, "article string, window_start timestamp, window_end timestamp, "
                                     "s0 bigint, s1 bigint, s2 bigint, s3 bigint, s4 bigint, s5 bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        r = serving_rows(df, 10).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.labels.split(",")[0] == "23:35:07" and r.text_row == "x\t23:35:07\t1:2:3:4:5:6"
