import os

import pytest
from pyspark.sql import functions as F

from viewtide.plans import jobs
from viewtide.sinks import tables as tbl


def _feed(spark, path, rows):
    df = spark.createDataFrame(rows, "date string, hour int, article string, views bigint") \
              .withColumn("date", F.col("date").cast("date"))
    tbl.write_hourly_totals(df, path)


def test_build_history_from_log_folders(spark, tmp_dir):
    logs = f"{tmp_dir}/logs"
    for hh, lines in (("00", ["en Main_Page 10 999", "de main_page 5 111", "en bad 3"]), ("01", ["en Cat 7 1"])):
        os.makedirs(f"{logs}/{hh}")
        with open(f"{logs}/{hh}/part-0", "w") as f:
            f.write("\n".join(lines) + "\n")
    jobs.build_history(spark, logs, f"{tmp_dir}/hist", "2024-01-29")
    got = {(r.hour, r.article): (r.sum_views, r.n, r.avg_views) for r in tbl.read_history(spark, f"{tmp_dir}/hist").collect()}
    assert got == {(0, "main_page"): (15, 2, 7), (1, "cat"): (7, 1, 7)}
    jobs.build_history(spark, logs, f"{tmp_dir}/hist_en", "2024-01-29", project="en")
    got = {r.article: r.n for r in tbl.read_history(spark, f"{tmp_dir}/hist_en", hour=0).collect()}
    assert got == {"main_page": 1}


def test_fold_day_versions_and_refuses_repeat(spark, tmp_dir):
    feed, hist, log = f"{tmp_dir}/feed", f"{tmp_dir}/hist", f"{tmp_dir}/log"
    _feed(spark, feed, [("2024-01-01", 0, "cat", 7), ("2024-01-01", 0, "cat", 8), ("2024-01-02", 0, "cat", 9),
                        ("2024-01-02", 0, "dog", 4)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    with pytest.raises(FileNotFoundError):  # hours 1 to 23 may still come
        jobs.fold_day(spark, feed, hist, "2024-01-02", log_path=log)
    jobs.fold_day(spark, feed, hist, "2024-01-02", log_path=log, allow_missing_hours=True)
    assert tbl.history_versions(spark, hist) == ["2024-01-01", "2024-01-02"]
    got = {r.article: (r.sum_views, r.n, r.avg_views) for r in tbl.read_history(spark, hist).collect()}
    assert got == {"cat": (24, 3, 8), "dog": (4, 1, 4)}  # FIXTURES day fold
    with pytest.raises(ValueError):
        jobs.fold_day(spark, feed, hist, "2024-01-02", allow_missing_hours=True)
    with pytest.raises(ValueError):  # a jump over 01-03
        jobs.fold_day(spark, feed, hist, "2024-01-04", allow_missing_hours=True)
    with pytest.raises(FileNotFoundError):  # no feed
        jobs.fold_day(spark, feed, hist, "2024-01-03", allow_missing_hours=True)
    assert spark.read.parquet(log).count() == 2


def test_anomaly_hours_incremental_job(spark, tmp_dir):
    feed, hist, state, out = (f"{tmp_dir}/{n}" for n in ("feed", "hist", "state", "anoms"))
    d = "2024-01-30"
    hist_rows = [("2024-01-01", h, a, v) for a, vs in {"a": [10, 20, 30], "b": [5, 5, 5], "c": [0, 4, None]}.items()
                 for h, v in enumerate(vs) if v is not None]
    _feed(spark, f"{tmp_dir}/old", hist_rows)
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-29")
    cur = [(d, h, a, v) for a, vs in {"a": [10, 10, 60], "b": [15, None, 5], "c": [0, 4, 4]}.items()
           for h, v in enumerate(vs) if v is not None]
    _feed(spark, feed, cur)
    for h in range(3):
        ranked = jobs.run_anomaly_hour(spark, feed, hist, state, out, d, h, k=5)
    # rerunning hour 1 and 2 replaces their partitions: same result
    jobs.run_anomaly_hour(spark, feed, hist, state, out, d, 1, k=5)
    ranked = jobs.run_anomaly_hour(spark, feed, hist, state, out, d, 2, k=5)
    assert [(r.article, round(r.distance, 6)) for r in ranked.orderBy("rank").collect()] == [("a", 0.285714)]
    h0 = {r.article: r.rank for r in spark.read.parquet(out).where("hour = 0").collect()}
    assert h0 == {"b": 1, "a": 2, "c": 3}
    # closed-form backfill of the same day agrees with the incremental chain
    jobs.backfill_anomalies(spark, feed, hist, f"{tmp_dir}/bf", d, k=5, last_hour=2)
    a = sorted((r.hour, r.rank, r.article, r.distance) for r in spark.read.parquet(out).collect())
    b = sorted((r.hour, r.rank, r.article, r.distance) for r in spark.read.parquet(f"{tmp_dir}/bf").collect())
    assert a == b


def test_read_partition_lists_one_folder_and_tolerates_missing(spark, tmp_dir):
    from viewtide.sources.files import read_feed
    _feed(spark, f"{tmp_dir}/feed", [("2024-01-01", 0, "a", 1), ("2024-01-01", 5, "b", 2), ("2024-01-02", 0, "c", 3)])
    one = read_feed(spark, f"{tmp_dir}/feed", date="2024-01-01", hour=5)
    assert [(str(r.date), r.hour, r.article) for r in one.collect()] == [("2024-01-01", 5, "b")]
    assert read_feed(spark, f"{tmp_dir}/feed", date="2024-01-01", hour=7).count() == 0
    assert read_feed(spark, f"{tmp_dir}/feed", date="2024-01-02").count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hour=5" in plan or "1 paths" in plan


def test_scoring_uses_history_before_the_day(spark, tmp_dir):
    """Folding the day first must not change that day's scores."""
    feed, hist = f"{tmp_dir}/feed", f"{tmp_dir}/hist"
    _feed(spark, feed, [("2024-01-01", 0, "a", 10), ("2024-01-02", 0, "a", 30)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    before = jobs.run_anomaly_hour(spark, feed, hist, f"{tmp_dir}/s1", f"{tmp_dir}/o1", "2024-01-02", 0,
                                   missing="zero").collect()
    jobs.fold_day(spark, feed, hist, "2024-01-02", allow_missing_hours=True)
    after = jobs.run_anomaly_hour(spark, feed, hist, f"{tmp_dir}/s2", f"{tmp_dir}/o2", "2024-01-02", 0,
                                  missing="zero").collect()
    assert [(r.article, r.distance) for r in before] == [(r.article, r.distance) for r in after] == [("a", 0.5)]


def test_anomaly_hour_requires_written_feed(spark, tmp_dir):
    feed, hist = f"{tmp_dir}/feed", f"{tmp_dir}/hist"
    _feed(spark, feed, [("2024-01-01", 0, "a", 10), ("2024-01-02", 0, "a", 30)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    with pytest.raises(FileNotFoundError):
        jobs.run_anomaly_hour(spark, feed, hist, f"{tmp_dir}/s", f"{tmp_dir}/o", "2024-01-02", 1)
    jobs.run_anomaly_hour(spark, feed, hist, f"{tmp_dir}/s", f"{tmp_dir}/o", "2024-01-02", 0, missing="zero")
    got = jobs.run_anomaly_hour(spark, feed, hist, f"{tmp_dir}/s", f"{tmp_dir}/o", "2024-01-02", 1,
                                missing="zero", require_feed=False).collect()
    assert [(r.article, r.distance) for r in got] == [("a", 0.5)]  # carried from hour 0


def test_unfinished_version_is_neither_read_nor_in_the_way(spark, tmp_dir):
    feed, hist = f"{tmp_dir}/feed", f"{tmp_dir}/hist"
    _feed(spark, feed, [("2024-01-01", 0, "a", 10), ("2024-01-02", 0, "a", 30)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    os.makedirs(f"{hist}/as_of=2024-01-02/hour=0")
    with open(f"{hist}/as_of=2024-01-02/hour=0/part-0.parquet", "w") as f:
        f.write("half")
    assert tbl.history_versions(spark, hist) == ["2024-01-01"]
    assert tbl.read_history(spark, hist).first().sum_views == 10
    jobs.fold_day(spark, feed, hist, "2024-01-02", allow_missing_hours=True)
    assert tbl.read_history(spark, hist).first().sum_views == 40


def test_rebuilt_version_and_promoted_day_keep_no_stale_hours(spark, tmp_dir):
    feed, hist, log = f"{tmp_dir}/feed", f"{tmp_dir}/hist", f"{tmp_dir}/log"
    _feed(spark, feed, [("2024-01-01", h, "a", 1) for h in (0, 1, 5)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    tbl.promote_day(spark, feed, log, "2024-01-01")
    _feed(spark, f"{tmp_dir}/fixed", [("2024-01-01", 5, "a", 1)])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/fixed", hist, "2024-01-01")
    tbl.promote_day(spark, f"{tmp_dir}/fixed", log, "2024-01-01")
    assert [r.hour for r in tbl.read_history(spark, hist).collect()] == [5]
    assert [(str(r.date), r.hour) for r in spark.read.parquet(log).collect()] == [("2024-01-01", 5)]


def test_hour_without_result_replaces_the_old_one(spark, tmp_dir):
    hist, state, out = (f"{tmp_dir}/{n}" for n in ("hist", "state", "out"))
    _feed(spark, f"{tmp_dir}/old", [("2024-01-01", 0, "a", 10)])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-01")
    _feed(spark, f"{tmp_dir}/f1", [("2024-01-02", 0, "a", 30)])
    _feed(spark, f"{tmp_dir}/f2", [("2024-01-02", 0, "b", 30)])
    assert jobs.run_anomaly_hour(spark, f"{tmp_dir}/f2", hist, state, out, "2024-01-02", 0).count() == 0
    assert jobs.run_anomaly_hour(spark, f"{tmp_dir}/f1", hist, state, out, "2024-01-02", 0).count() == 1
    assert jobs.run_anomaly_hour(spark, f"{tmp_dir}/f2", hist, state, out, "2024-01-02", 0).count() == 0
    assert tbl.read_anomalies(spark, out).count() == 0


def test_feed_titles_meet_the_history_in_lower_case(spark, tmp_dir):
    hist = f"{tmp_dir}/hist"
    _feed(spark, f"{tmp_dir}/old", [("2024-01-01", 0, "Main_Page", 10)])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-01")
    _feed(spark, f"{tmp_dir}/f", [("2024-01-02", 0, "Main_page", 20), ("2024-01-02", 0, "main_page", 10)])
    got = jobs.run_anomaly_hour(spark, f"{tmp_dir}/f", hist, f"{tmp_dir}/s", f"{tmp_dir}/o", "2024-01-02", 0)
    assert [(r.article, r.distance) for r in got.collect()] == [("main_page", 0.5)]
    jobs.fold_day(spark, f"{tmp_dir}/f", hist, "2024-01-02", allow_missing_hours=True)
    assert [tuple(r) for r in tbl.read_history(spark, hist).select("article", "sum_views", "n").collect()] == [("main_page", 40, 2)]


def test_exact_averages_are_scored_exactly(spark):
    from viewtide.operators import anomaly as anom
    from viewtide.operators import history as hist_ops
    obs = spark.createDataFrame([(0, "a", 1), (0, "a", 2)], "hour int, article string, views bigint")
    cur = spark.createDataFrame([(0, "a", 2)], "hour int, article string, views bigint")
    for exact, want in ((False, 1 / 3), (True, 0.5 / 3.5)):
        hist = hist_ops.historical_average(obs, exact=exact)
        for run in (anom.anomaly_step(cur, hist, None), anom.anomaly_backfill(cur, hist, 0),
                    anom.advance_anomaly(None, anom.hour_terms(cur, hist))):
            assert abs(anom.with_distance(run).first().distance - want) < 1e-12


def test_log_folders_that_are_no_hour_are_rejected(spark, tmp_dir):
    from viewtide.operators.parse import parse_hourly_logs
    from viewtide.sources.files import read_hourly_logs
    for folder in ("00", "31", "old", "hour=7"):
        os.makedirs(f"{tmp_dir}/logs/{folder}")
        with open(f"{tmp_dir}/logs/{folder}/part-0", "w") as f:
            f.write("en Cat 1 2\n")
    good, bad = parse_hourly_logs(read_hourly_logs(spark, f"{tmp_dir}/logs"))
    assert sorted(r.hour for r in good.collect()) == [0, 7]
    assert [r.reason for r in bad.collect()] == ["hour", "hour"]
