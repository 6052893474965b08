"""Commit manifests, stale states and their repair, merge-on-read history, incremental build."""
import os
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from viewtide.operators import anomaly as anom
from viewtide.plans import jobs
from viewtide.sinks import manifest as mf
from viewtide.sinks import tables as tbl
from viewtide.sources.files import read_feed

DAY = "2024-01-02"


def feed_rows(spark, rows):
    df = spark.createDataFrame(rows, "date string, hour int, article string, views bigint")
    return df.withColumn("date", F.col("date").cast("date"))


def put_feed(spark, path, rows):
    return tbl.write_hourly_totals(feed_rows(spark, rows), path)


def half_written(folder):
    os.makedirs(folder, exist_ok=True)
    pathlib.Path(folder, "part-0.parquet").write_text("half")


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_versions_are_digests_of_rows(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "n long, s string")
    one = mf.write_folder(a, f"{tmp_dir}/a", {"from": "v1"})
    assert (one.rows, one.sources) == (3, {"from": "v1"}) and mf.get(spark, f"{tmp_dir}/a") == one
    assert mf.write_folder(a.repartition(3).orderBy(F.desc("n")), f"{tmp_dir}/b").version == one.version
    for other in (a.distinct(), a.union(a.limit(1)), a.withColumn("n", F.col("n") + 1)):
        assert mf.write_folder(other, f"{tmp_dir}/c").version != one.version
    assert mf.write_folder(a.limit(0), f"{tmp_dir}/d").rows == 0
    assert mf.get(spark, f"{tmp_dir}/none") is None
    pathlib.Path(f"{tmp_dir}/a", mf.NAME).write_text('{"rows": 3')  # the driver died while it wrote the manifest
    assert mf.get(spark, f"{tmp_dir}/a") is None


def test_partitions_written_together_are_finished_one_by_one(spark, tmp_dir):
    done = put_feed(spark, f"{tmp_dir}/f", [(DAY, 0, "a", 1), (DAY, 1, "a", 2), (DAY, 1, "b", 3)])
    assert {f.rsplit("=", 1)[1]: m.rows for f, m in done.items()} == {"0": 1, "1": 2}
    again = put_feed(spark, f"{tmp_dir}/f", [(DAY, 1, "b", 3), (DAY, 1, "a", 2)])
    assert list(again.values())[0].version == done[f"{tmp_dir}/f/date={DAY}/hour=1"].version
    assert len(mf.finished_folders(spark, f"{tmp_dir}/f", ["date", "hour"])) == 2
    assert put_feed(spark, f"{tmp_dir}/f", []) == {}


def test_half_written_feed_hour_is_not_read(spark, tmp_dir):
    feed = f"{tmp_dir}/feed"
    put_feed(spark, feed, [("2024-01-01", 0, "a", 10), (DAY, 0, "a", 30)])
    half_written(f"{feed}/date={DAY}/hour=1")
    for how in ({"hour": 1}, {}):
        with pytest.raises(FileNotFoundError, match="hour=1"):
            read_feed(spark, feed, DAY, **how)
    assert read_feed(spark, feed, DAY, 0).count() == 1 and read_feed(spark, feed, DAY, 2).count() == 0
    assert read_feed(spark, feed).count() == 2  # whole table: finished hours
    jobs.seed_history_from_feed(spark, feed, f"{tmp_dir}/h", "2024-01-01")
    with pytest.raises(FileNotFoundError):
        jobs.run_anomaly_hour(spark, feed, f"{tmp_dir}/h", f"{tmp_dir}/s", f"{tmp_dir}/o", DAY, 1)
    with pytest.raises(FileNotFoundError):
        jobs.fold_day(spark, feed, f"{tmp_dir}/h", DAY, allow_missing_hours=True)


def test_half_written_state_and_publication_are_not_read(spark, tmp_dir):
    feed, hist, state, out = (f"{tmp_dir}/{n}" for n in ("feed", "hist", "state", "out"))
    put_feed(spark, feed, [("2024-01-01", h, "a", 10) for h in (0, 1)] + [(DAY, h, "a", 30) for h in (0, 1)])
    jobs.seed_history_from_feed(spark, feed, hist, "2024-01-01")
    half_written(f"{state}/date={DAY}/hour=0")
    half_written(f"{out}/date={DAY}/hour=0")
    with pytest.raises(FileNotFoundError):
        tbl.read_anomaly_state(spark, state, DAY, 0)
    with pytest.raises(FileNotFoundError):
        jobs.run_anomaly_hour(spark, feed, hist, state, out, DAY, 1)
    assert tbl.read_anomalies(spark, out).count() == 0 and tbl.read_anomalies(spark, out, DAY, 0).count() == 0
    assert tbl.read_anomaly_states(spark, state, DAY).count() == 0
    jobs.run_anomaly_hour(spark, feed, hist, state, out, DAY, 0)  # the repetition is not in its way
    assert jobs.run_anomaly_hour(spark, feed, hist, state, out, DAY, 1).count() == 1


@pytest.fixture()
def day(spark, tmp_dir):
    """Five hours run; the feed as rows, and the folders."""
    feed, hist, state, out = where = [f"{tmp_dir}/{n}" for n in ("feed", "hist", "state", "out")]
    put_feed(spark, f"{tmp_dir}/old", [("2024-01-01", h, a, 10 + h) for h in range(5) for a in "abc"])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-01")
    rows = [(DAY, h, a, 7 * h + ord(a) % 5) for h in range(5) for a in "abd"]
    put_feed(spark, feed, rows)
    for h in range(5):
        jobs.run_anomaly_hour(spark, *where, DAY, h, missing="zero")
    return where, rows


def closed_form(spark, where):
    feed, hist, _, _ = where
    run = anom.anomaly_backfill(read_feed(spark, feed, DAY), tbl.read_history(spark, hist, "2024-01-01"), 4, "zero")
    return rows_of(run, "hour", "article", "lhs", "rhs")


def test_stale_state_is_refused_and_the_suffix_repaired(spark, day):
    where, rows = day
    feed, hist, state, out = where
    old = {h: mf.get(spark, f"{state}/date={DAY}/hour={h}") for h in range(5)}
    put_feed(spark, feed, [(d, h, a, v * 3 + 1) for d, h, a, v in rows if h == 2])
    with pytest.raises(mf.StaleStateError, match="hour 2"):
        jobs.run_anomaly_hour(spark, *where, DAY, 4, missing="zero")
    assert jobs.first_stale_hour(spark, feed, hist, state, DAY, 4, "zero") == 2
    jobs.run_anomaly_hour(spark, *where, DAY, 2, missing="zero")  # one hour run again leaves the next one stale
    assert jobs.first_stale_hour(spark, feed, hist, state, DAY, 4, "zero") == 3
    assert jobs.repair_anomaly_hours(spark, *where, DAY, missing="zero") == [3, 4]
    assert rows_of(tbl.read_anomaly_states(spark, state, DAY), "hour", "article", "lhs", "rhs") == closed_form(spark, where)
    assert [mf.get(spark, f"{state}/date={DAY}/hour={h}") for h in (0, 1)] == [old[0], old[1]]
    jobs.backfill_anomalies(spark, feed, hist, f"{out}-bf", DAY, missing="zero", last_hour=4)
    cols = ("hour", "rank", "article", "distance")
    assert rows_of(tbl.read_anomalies(spark, out), *cols) == rows_of(tbl.read_anomalies(spark, f"{out}-bf"), *cols)
    assert jobs.repair_anomaly_hours(spark, *where, DAY, missing="zero") == []


def test_repair_goes_on_after_a_failure_and_leaves_equal_hours(spark, day):
    where, rows = day
    feed, _, state, out = where
    put_feed(spark, feed, [r for r in rows if r[1] == 1])  # written again, same rows
    assert jobs.repair_anomaly_hours(spark, *where, DAY, missing="zero") == []
    put_feed(spark, feed, [(d, h, a, v + 1) for d, h, a, v in rows if h == 3])
    jobs.run_anomaly_hour(spark, *where, DAY, 3, missing="zero")
    mf.drop(spark, f"{out}/date={DAY}/hour=3")  # died between state and publication, and in the middle of hour 4
    mf.drop(spark, f"{state}/date={DAY}/hour=4")
    assert jobs.repair_anomaly_hours(spark, *where, DAY, missing="zero") == [3, 4]
    assert rows_of(tbl.read_anomaly_states(spark, state, DAY), "hour", "article", "lhs", "rhs") == closed_form(spark, where)


def test_changed_history_makes_the_whole_day_stale(spark, day, tmp_dir):
    where, _ = day
    feed, hist, state, _ = where
    put_feed(spark, f"{tmp_dir}/old", [("2024-01-01", 4, "a", 99)])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-01")
    assert jobs.first_stale_hour(spark, feed, hist, state, DAY, 4, "zero") == 0
    assert jobs.repair_anomaly_hours(spark, *where, DAY, missing="zero") == [0, 1, 2, 3, 4]
    assert rows_of(tbl.read_anomaly_states(spark, state, DAY), "hour", "article", "lhs", "rhs") == closed_form(spark, where)


def bytes_below(folder):
    return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))


def test_history_deltas_equal_whole_versions(spark, tmp_dir):
    feed, whole, deltas = (f"{tmp_dir}/{n}" for n in ("feed", "whole", "deltas"))
    rows = [("2024-01-01", h, f"article {i}", i % 90) for h in (0, 7) for i in range(20_000)]
    rows += [(f"2024-01-0{d}", h, a, d * 10 + h) for d in (2, 3, 4) for h in (0, 7, 9) for a in ("article 5", "Article 5", "new")]
    put_feed(spark, feed, rows)
    for root in (whole, deltas):
        jobs.seed_history_from_feed(spark, feed, root, "2024-01-01")
    for d in ("2024-01-02", "2024-01-03", "2024-01-04"):
        jobs.fold_day(spark, feed, whole, d, allow_missing_hours=True)
        folder = jobs.fold_day(spark, feed, deltas, d, allow_missing_hours=True, merge_on_read=True)
        assert bytes_below(folder) < 0.1 * bytes_below(f"{whole}/as_of={d}")
    assert tbl.history_versions(spark, deltas) == tbl.history_versions(spark, whole)
    for v in tbl.history_versions(spark, whole):
        assert rows_of(tbl.read_history(spark, deltas, v), *tbl.HISTORY_COLS) == rows_of(tbl.read_history(spark, whole, v), *tbl.HISTORY_COLS)
        assert rows_of(tbl.read_history(spark, deltas, v, hour=7), "article", "n") == rows_of(tbl.read_history(spark, whole, v, hour=7), "article", "n")
    before = {v: tbl.history_digest(spark, deltas, v) for v in tbl.history_versions(spark, deltas)}
    folder = tbl.compact_history(spark, deltas, "2024-01-03")
    assert tbl.history_folders(spark, deltas, "2024-01-04") == [folder, f"{deltas}/delta=2024-01-04"]
    assert {v: tbl.history_digest(spark, deltas, v) for v in before} == before  # states made from them stay current
    assert rows_of(tbl.read_history(spark, deltas), *tbl.HISTORY_COLS) == rows_of(tbl.read_history(spark, whole), *tbl.HISTORY_COLS)
    assert len(tbl.prune_history(spark, deltas, "2024-01-03")) == 3  # the first base and two deltas
    assert tbl.history_versions(spark, deltas) == ["2024-01-03", "2024-01-04"]
    assert rows_of(tbl.read_history(spark, deltas), *tbl.HISTORY_COLS) == rows_of(tbl.read_history(spark, whole), *tbl.HISTORY_COLS)
    with pytest.raises(FileNotFoundError):
        tbl.read_history(spark, deltas, "2024-01-02")
    with pytest.raises(ValueError):
        jobs.fold_day(spark, feed, deltas, "2024-01-04", allow_missing_hours=True, merge_on_read=True)


def test_exact_averages_survive_deltas(spark, tmp_dir):
    feed, hist = f"{tmp_dir}/feed", f"{tmp_dir}/hist"
    put_feed(spark, feed, [("2024-01-01", 0, "a", 1), ("2024-01-02", 0, "a", 2)])
    from viewtide.operators import history as hist_ops
    tbl.write_history(hist_ops.historical_average(read_feed(spark, feed, "2024-01-01"), exact=True), hist, "2024-01-01")
    jobs.fold_day(spark, feed, hist, "2024-01-02", allow_missing_hours=True, merge_on_read=True)
    assert tbl.read_history(spark, hist).first().avg_views == 1.5


def log_file(root, hour, name, lines):
    os.makedirs(f"{root}/{hour}", exist_ok=True)
    pathlib.Path(root, hour, name).write_text("\n".join(lines) + "\n")


def test_history_extended_by_new_files_only(spark, tmp_dir):
    logs, sums, hist = (f"{tmp_dir}/{n}" for n in ("logs", "sums", "hist"))
    log_file(logs, "00", "a", ["en Cat 7 1", "en Dog 5 1", "bad"])
    log_file(logs, "01", "a", ["en Cat 1 1"])
    assert len(jobs.extend_history_from_logs(spark, logs, sums, hist, "2024-01-01")) == 2
    log_file(logs, "00", "b", ["de Cat 9 1"])
    new = jobs.extend_history_from_logs(spark, logs, sums, hist, "2024-01-02")
    assert [f.rsplit("/", 2)[1:] for f in new] == [["00", "b"]]
    one = mf.get(spark, f"{sums}/increment=000001")
    assert one.rows == 1 and list(one.sources["files"]) == new  # the second increment holds the new file's sums alone
    jobs.build_history(spark, logs, f"{tmp_dir}/full", "2024-01-02")
    assert rows_of(tbl.read_history(spark, hist), *tbl.HISTORY_COLS) == rows_of(tbl.read_history(spark, f"{tmp_dir}/full"), *tbl.HISTORY_COLS)
    assert jobs.extend_history_from_logs(spark, logs, sums, hist, "2024-01-03") == []
    half_written(f"{sums}/increment=000002")  # died: its files count as new
    log_file(logs, "02", "a", ["en Cat 4 1"])
    assert len(jobs.extend_history_from_logs(spark, logs, sums, hist, "2024-01-04")) == 1
    assert tbl.read_history(spark, hist, hour=2).count() == 1
    time.sleep(0.01)
    log_file(logs, "01", "a", ["en Cat 1 1", "en Cat 2 1"])
    with pytest.raises(mf.StaleStateError):
        jobs.extend_history_from_logs(spark, logs, sums, hist, "2024-01-05")


def test_bucketed_step_moves_the_feed_only(spark, tmp_dir):
    feed, hist, buckets, state, out = (f"{tmp_dir}/{n}" for n in ("feed", "hist", "buckets", "state", "out"))
    put_feed(spark, f"{tmp_dir}/old", [("2024-01-01", h, a, 10 + h) for h in range(3) for a in ("a", "b", "c")])
    jobs.seed_history_from_feed(spark, f"{tmp_dir}/old", hist, "2024-01-01")
    rows = [(DAY, h, a, 7 * h + ord(a[0].lower()) % 5) for h in range(3) for a in ("A", "b", "d", "a")]
    put_feed(spark, feed, rows)
    jobs.bucket_history(spark, hist, buckets, "2024-01-01", 4)
    for h in range(3):
        jobs.run_anomaly_hour_bucketed(spark, feed, buckets, state, out, DAY, h, missing="zero")
        jobs.run_anomaly_hour(spark, feed, hist, f"{state}-plain", f"{out}-plain", DAY, h, missing="zero")
    cols = ("hour", "rank", "article", "distance")
    assert rows_of(tbl.read_anomalies(spark, out), *cols) == rows_of(tbl.read_anomalies(spark, f"{out}-plain"), *cols)
    jobs.run_anomaly_hour_bucketed(spark, feed, buckets, state, out, DAY, 1, missing="zero")  # replaces its folder
    from viewtide.sinks.bucketed import forget, read_bucketed
    forget(spark, f"{state}/date={DAY}/hour=1")  # another session declares it anew
    prev, past = read_bucketed(spark, f"{state}/date={DAY}/hour=1"), read_bucketed(spark, f"{buckets}/hour=2")
    step = anom.anomaly_step(read_feed(spark, feed, DAY, 2), past, prev, "zero", buckets=4)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and plan.count("Bucketed: true") == 2
    half_written(f"{state}/date={DAY}/hour=7")
    with pytest.raises(FileNotFoundError):
        read_bucketed(spark, f"{state}/date={DAY}/hour=7")


def test_rejects_come_from_the_same_pass(spark, tmp_dir):
    logs = f"{tmp_dir}/logs"
    log_file(logs, "00", "a", ["en Cat 7 1", "de Cat 5 1", "bad", "bad", "en Dog x 1"])
    log_file(logs, "01", "a", ["en Cat 1 1", "bad"])
    log_file(logs, "other", "a", ["en Cat 1 1"])
    for project in (None, "en"):
        jobs.build_history(spark, logs, f"{tmp_dir}/plain-{project}", "2024-01-01", project=project)
        jobs.build_history(spark, logs, f"{tmp_dir}/both-{project}", "2024-01-01", project=project, rejects_path=f"{tmp_dir}/rej-{project}")
        assert rows_of(tbl.read_history(spark, f"{tmp_dir}/both-{project}"), *tbl.HISTORY_COLS) == \
            rows_of(tbl.read_history(spark, f"{tmp_dir}/plain-{project}"), *tbl.HISTORY_COLS)
        assert rows_of(spark.read.parquet(f"{tmp_dir}/rej-{project}"), "line", "reason", "n") == \
            [("bad", "arity", 3), ("en Cat 1 1", "hour", 1), ("en Dog x 1", "views", 1)]
