"""The ledger of micro-batches, the serving store, the intake of raw lines, series from phase records."""
import os

import pytest
from pyspark.sql import functions as F

from viewtide.operators import windows as win
from viewtide.operators.parse import parse_phase_records
from viewtide.operators.serving import latest_trending
from viewtide.plans import jobs
from viewtide.sinks import ledger, serving_store
from viewtide.sinks import manifest as mf
from viewtide.streaming import trend_stream as stm

COLS = "article string, n long"
BASE = 1704103200  # 2024-01-01 10:00:00 UTC


def table(spark, *rows):
    return spark.createDataFrame(list(rows), COLS)


def read(spark, path, keys=None):
    return sorted(tuple(r) for r in ledger.read_batches(spark, path, COLS, keys).collect())


def test_runs_batches_and_replays(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    first = ledger.run_id(spark, f"{tmp_dir}/ck1", out)
    assert ledger.run_id(spark, f"{tmp_dir}/ck1", out) == first  # a restart goes on with the run
    assert read(spark, out) == []
    assert ledger.commit(table(spark, ("a", 1)), out, first, 0)
    assert not ledger.commit(table(spark, ("a", 1)), out, first, 0)  # replay
    assert ledger.commit(table(spark, ("b", 2)), out, first, 10)
    table(spark, ("dead", 0)).write.parquet(ledger.folder_of(out, first, 11))  # a write that died
    assert read(spark, out) == [("a", 1), ("b", 2)]
    assert ledger.commit(table(spark, ("c", 3)), out, first, 11)  # its repetition takes the place
    second = ledger.run_id(spark, f"{tmp_dir}/ck2", out)
    assert second > first and second != first
    ledger.commit(table(spark, ("a", 5), ("d", 4)), out, second, 0)  # the new checkpoint starts at 0 again
    assert read(spark, out) == [("a", 1), ("a", 5), ("b", 2), ("c", 3), ("d", 4)]
    assert read(spark, out, ["article"]) == [("a", 5), ("b", 2), ("c", 3), ("d", 4)]
    assert [f.rsplit("=", 1)[1] for f in ledger.committed(spark, out)] == ["0", "10", "11", "0"]


def test_batch_writer_commits_whole_batches(spark, tmp_dir):
    write = ledger.batch_writer(f"{tmp_dir}/o", "000001-x", ["article"])
    write(table(spark, ("a", 1), ("b", 2)), 0)
    write(table(spark), 1)
    assert read(spark, f"{tmp_dir}/o") == [("a", 1), ("b", 2)]
    assert not os.path.exists(f"{tmp_dir}/o/run=000001-x/batch_id=1")


def series(spark, *rows):
    """Trending rows (article, minutes after 2024-01-01 00:00 of the window start)."""
    df = spark.createDataFrame(list(rows), "article string, m int")
    start = F.timestamp_add("MINUTE", F.col("m"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return df.select("article", start.alias("window_start"), F.timestamp_add("MINUTE", F.lit(60), start).alias("window_end"),
                     *[F.lit(i).cast("long").alias(f"s{i}") for i in range(6)])


def test_serving_store_reads_the_newest_hours_only(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    rows = series(spark, *[(f"a{i}", 60 * h + i) for h in range(30) for i in range(4)])
    early, late = rows.where("window_end < '2024-01-02'"), rows.where("window_end >= '2024-01-02'")
    for batch, part in ((0, early), (1, late), (1, late)):
        serving_store.add_batch(part, root, "000001", batch)
    for n in (1, 4, 5, 90, 1000):
        got = serving_store.newest_rows(spark, root, n)
        want = [tuple(r) for r in latest_trending(rows, n).collect()]
        assert [tuple(r) for r in latest_trending(got, n).collect()] == want
        if n <= 4:
            assert len(got.inputFiles()) <= 2 and len({f.split("hour=")[1].split("/")[0] for f in got.inputFiles()}) == 1
    assert len(serving_store.newest_rows(spark, root, 5).inputFiles()) < 4
    assert [r.article for r in jobs.serve_newest(spark, root, 3).collect()] == [r.article for r in latest_trending(rows, 3).collect()]
    serving_store.add_batch(late, root, "000002", 0)  # a new checkpoint reads the end of the input again
    assert serving_store.newest_rows(spark, root, 10 ** 6).count() == rows.count()
    assert [tuple(r) for r in latest_trending(serving_store.newest_rows(spark, root, 6), 6).collect()] == \
        [tuple(r) for r in latest_trending(rows, 6).collect()]
    assert serving_store.newest_rows(spark, f"{tmp_dir}/none", 5).count() == 0


def test_replay_completes_a_batch_that_died_between_hours(spark, tmp_dir):
    root, rows = f"{tmp_dir}/store", series(spark, ("a", 0), ("b", 60), ("c", 120))
    serving_store.add_batch(rows, root, "000001", 0)
    mf.drop(spark, f"{root}/date=2024-01-01/hour=2/run=000001/batch_id=0")
    assert serving_store.newest_rows(spark, root, 9).count() == 2
    serving_store.add_batch(rows, root, "000001", 0)
    assert serving_store.newest_rows(spark, root, 9).count() == 3


def lines(n_bad=3):
    good = [f"up\t1.2.3.4\t{BASE + 600 * k + j}" for k, c in enumerate([1, 2, 2, 3, 4, 5, 1]) for j in range(c)]
    return good + [f"up\t1.2.3.4\t{BASE + 4 * 3600}"] + ["bad\t256.1.1.1\t1", "short", "x\t1.2.3.4\tnever"][:n_bad]


def write_lines(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(rows) + "\n")


def test_raw_lines_are_read_once(spark, tmp_dir):
    write_lines(f"{tmp_dir}/lines", "a.txt", lines())
    src = stm.request_stream(spark, "text", f"{tmp_dir}/lines")
    qs = stm.run_trending_stream(spark, src, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True, serving_store=f"{tmp_dir}/store")
    for q in qs:
        q.awaitTermination()
    read_rows = {q.name: sum(p["numInputRows"] for p in q.recentProgress) for q in qs}
    assert read_rows["intake"] == len(lines())
    good = len(lines()) - 3
    assert {read_rows[n] for n in ("phase_counts", "hourly_totals", "trending")} == {good}  # of the typed requests, not the lines
    assert {(r.line, r.reason) for r in stm.read_rejects(spark, f"{tmp_dir}/out").collect()} == \
        {("bad\t256.1.1.1\t1", "ip"), ("short", "fields"), ("x\t1.2.3.4\tnever", "timestamp")}
    counts = [mf.get(spark, ledger.committed(spark, f"{tmp_dir}/out/{n}")[0]).rows for n in ("requests", "rejects")]
    assert counts == [good, 3]
    assert jobs.serve_newest(spark, f"{tmp_dir}/store", 1).first().article == "up"


def test_intake_goes_on_after_a_restart(spark, tmp_dir):
    def run():
        q = stm.start_intake(stm.request_stream(spark, "text", f"{tmp_dir}/lines"), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True)
        q.awaitTermination()

    write_lines(f"{tmp_dir}/lines", "a.txt", lines())
    run()
    run()  # nothing new
    write_lines(f"{tmp_dir}/lines", "b.txt", ["late\t1.2.3.4\t1704103300"])
    run()
    got = ledger.read_batches(spark, f"{tmp_dir}/out/requests", "article string, ip string, ts timestamp")
    assert got.count() == len(lines()) - 3 + 1 and got.where("article = 'late'").count() == 1
    # a replay of a committed batch writes nothing
    run_name = ledger.run_id(spark, f"{tmp_dir}/ck", f"{tmp_dir}/out/requests")
    stm.intake_writer(f"{tmp_dir}/out", run_name)(spark.createDataFrame([("x\t1.2.3.4\t1",)], "value string"), 0)
    assert got.sparkSession.read.parquet(f"{tmp_dir}/out/requests").count() == len(lines()) - 2


def test_phase_records_round_trip(spark, tmp_dir):
    req = spark.createDataFrame([("up", BASE + 600 * k + j) for k, c in enumerate([1, 2, 2, 3, 4, 5, 6]) for j in range(c)], "article string, s long")
    counts = win.sliding_counts(req.select("article", F.timestamp_seconds("s").alias("ts")))
    routed = win.route_by_phase(counts, "p-", stamp="epoch")
    good, bad = parse_phase_records(routed.select("value"))
    assert sorted(map(tuple, good.select("article", F.unix_timestamp("window_start"), "views").collect())) == \
        sorted(map(tuple, counts.select("article", F.unix_timestamp("window_start"), "views").collect()))
    assert bad.count() == 0
    odd = spark.createDataFrame([("a\t1",), (None,), ("a\tx\t3",), ("a\t99999999999999\t3",), ("a\t60\tz",), ("a\t60\t3",)], "value string")
    good, bad = parse_phase_records(odd)
    assert [r.views for r in good.collect()] == [3]
    assert sorted(r.reason for r in bad.collect()) == ["count", "fields", "fields", "timestamp", "timestamp"]
    # one phase topic alone holds whole series
    path = f"{tmp_dir}/topic"
    routed.where("phase = 3").select("value").coalesce(1).write.parquet(path)
    out = stm.series_from_phases(spark.readStream.schema("value string").parquet(path))
    stm.start_stream(out, "parquet", f"{tmp_dir}/o", f"{tmp_dir}/ck", None, available_now=True).awaitTermination()
    got = {(r.article, r.window_start.minute % 10) for r in spark.read.parquet(f"{tmp_dir}/o").collect()}
    assert got == {("up", 3)}


@pytest.mark.parametrize("bad", [0, 3])
def test_job_without_rejects(spark, tmp_dir, bad):
    write_lines(f"{tmp_dir}/lines", "a.txt", lines(bad))
    stm.start_intake(stm.request_stream(spark, "text", f"{tmp_dir}/lines"), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    assert stm.read_rejects(spark, f"{tmp_dir}/out").count() == bad
