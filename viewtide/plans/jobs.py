"""Batch jobs (E2-E5). Each takes its date/hour as arguments (no wall clock) and writes only the
partitions or version it owns, so any run can be repeated after a failure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly as anom
from ..operators import history as hist_ops
from ..operators.parse import parse_hourly_logs, tag_hourly_logs
from ..operators.serving import serving_rows
from ..session import scratch_path
from ..sinks import manifest as mf
from ..sinks import tables as tbl
from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sinks.serving_store import newest_rows
from ..sources.files import list_files, read_feed, read_hourly_logs, read_log_files


def build_history(spark: SparkSession, logs_root: str, history_root: str, as_of,
                  project: str | None = None, exact: bool = False,
                  rejects_path: str | None = None) -> str:
    """The historical hourly averages from raw hourly logs (all 24 hour folders, one job).

    ``project`` keeps only one project code (the reference merges all, D20). ``rejects_path``
    also writes the malformed lines, each distinct one once with its reason and how often it came (``n``). The logs are
    read once for both: good lines are added up per (hour, article) and bad ones per (line, reason) by one aggregate, whose rows
    are written and then parted.
    """
    logs = read_hourly_logs(spark, logs_root)
    if not rejects_path:
        good, _ = parse_hourly_logs(logs)
        if project is not None:
            good = good.where(F.col("project") == project)
        return tbl.write_history(hist_ops.historical_average(good, exact=exact), history_root, as_of)
    tagged = tag_hourly_logs(logs)
    good = F.col("_reason").isNull()
    if project is not None:
        tagged = tagged.where(~good | (F.col("project") == project))
    sums = tagged.groupBy(F.when(good, F.col("hour")).alias("hour"), F.when(good, F.col("article")).alias("article"),
                          F.when(~good, F.col("value")).alias("line"), F.col("_reason").alias("reason")).agg(
        F.sum(F.when(good, F.col("views"))).cast("bigint").alias("sum_views"), F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "parsed-logs")
    sums.write.parquet(path)
    sums = spark.read.schema(sums.schema).parquet(path)
    sums.where("reason is not null").select("line", "reason", "n").write.mode("overwrite").parquet(rejects_path)
    whole = hist_ops.merge_sums([sums.where("reason is null").select("hour", "article", "sum_views", "n")], exact=exact)
    return tbl.write_history(whole, history_root, as_of)


def extend_history_from_logs(spark: SparkSession, logs_root: str, sums_root: str, history_root: str, as_of,
                             project: str | None = None, exact: bool = False) -> list[str]:
    """E2, incremental: only log files that no earlier run has read are scanned.

    Each run that finds new files writes their sums as ``sums_root/increment=N`` with a manifest that lists the files (path,
    length, time of change), then the history of all increments as version ``as_of``. A file that has changed
    since it was read is refused: its lines are in the sums already, so that needs a build from scratch. Returns the files read.
    """
    known: dict[str, str] = {}
    done = mf.finished_folders(spark, sums_root, ["increment"])
    for folder in done:
        known.update(mf.get(spark, folder).sources["files"])
    now = list_files(spark, logs_root)
    changed = sorted(f for f in known if f in now and known[f] != now[f])
    if changed:
        raise mf.StaleStateError(f"log files changed since they were read: {', '.join(changed[:5])}")
    new = {f: now[f] for f in sorted(set(now) - set(known))}
    if new:
        good, _ = parse_hourly_logs(read_log_files(spark, list(new)))
        if project is not None:
            good = good.where(F.col("project") == project)
        folder = f"{sums_root.rstrip('/')}/increment={len(done):06d}"
        sums = hist_ops.historical_average(good).select("hour", "article", "sum_views", "n")
        mf.write_folder(sums.hint("rebalance", "hour"), folder, {"project": project, "files": new}, partition_by=["hour"])
        done.append(folder)
    if done:
        tbl.write_history(hist_ops.merge_sums([spark.read.parquet(f) for f in done], exact=exact), history_root, as_of)
    return list(new)


def seed_history_from_feed(spark: SparkSession, feed_path: str, history_root: str, as_of) -> str:
    """E2 on the typed feed: every (date, hour, article) row up to ``as_of`` is one observation."""
    feed = read_feed(spark, feed_path).where(F.col("date") <= F.lit(as_of).cast("date"))
    feed = feed.withColumn("article", F.lower("article"))  # P6
    return tbl.write_history(hist_ops.historical_average(feed), history_root, as_of)


def fold_day(spark: SparkSession, feed_path: str, history_root: str, date,
             log_path: str | None = None, exact: bool = False, allow_missing_hours: bool = False,
             merge_on_read: bool = False) -> str:
    """Fold one finished day into the history as a new version ``as_of=date``.

    Refuses a day that does not follow the latest finished version (a second fold of a day would
    count it twice, a jump would lose the days between), a day without feed, and a day of which an hour
    is not written yet, unless ``allow_missing_hours`` says that hours without traffic have no folder.
    The new version is written beside the one read; readers switch by taking the latest. With ``merge_on_read`` only
    the day's sums are written, as a delta that readers merge with the base before it; `tables.compact_history` makes a base of them.
    With ``log_path`` the day's feed is also promoted into the history log (K9).
    """
    versions = tbl.history_versions(spark, history_root)
    if not versions:
        raise FileNotFoundError(f"no history version under {history_root}")
    last = versions[-1]
    if str(date) <= last:
        raise ValueError(f"day {date} is not after the latest history version {last}")
    if day_before(date) != last:
        raise ValueError(f"day {date} does not follow the latest history version {last}; fold the days between first")
    hours = {int(f.rsplit("=", 1)[1]) for f in mf.finished_folders(spark, f"{feed_path.rstrip('/')}/date={date}", ["hour"])}
    if not hours or not allow_missing_hours and hours != set(range(24)):
        raise FileNotFoundError(f"feed of {date} under {feed_path} has hours {sorted(hours)} only")
    day = read_feed(spark, feed_path, date=date)
    if merge_on_read:
        out = tbl.write_history_delta(hist_ops.day_delta(day), history_root, date)
    else:
        hist = tbl.read_history(spark, history_root, last)
        out = tbl.write_history(hist_ops.update_history(hist, day, exact=exact), history_root, date)
    if log_path:
        tbl.promote_day(spark, feed_path, log_path, date)
    return out


NO_FEED = "no traffic"


def _feed_version(spark: SparkSession, feed_path: str, date, hour: int) -> str:
    done = mf.get(spark, f"{feed_path.rstrip('/')}/date={date}/hour={hour}")
    return done.version if done else NO_FEED


def _history_version(spark: SparkSession, history_root: str, as_of: str) -> str:
    return f"{as_of}: {tbl.history_digest(spark, history_root, as_of)}"


def _state_sources(spark: SparkSession, feed_path: str, history_root: str, state_root: str, date, hour: int,
                   missing: str, as_of: str) -> dict:
    """What the state of ``hour`` has to be made from now."""
    before = mf.get(spark, tbl.state_folder(state_root, date, hour - 1)) if hour else None
    return {"feed": _feed_version(spark, feed_path, date, hour), "history": _history_version(spark, history_root, as_of),
            "state": before.version if before else None, "missing": missing}


def first_stale_hour(spark: SparkSession, feed_path: str, history_root: str, state_root: str, date, upto: int,
                     missing: str = "drop", as_of: str | None = None) -> int | None:
    """The first hour 0..``upto`` whose stored state is absent or was not made from the feed, the history and the
    state before it as they are now; None if all are current. Reads at most 24 small manifests of each kind."""
    as_of = as_of or tbl.history_version_before(spark, history_root, date)
    for hour in range(upto + 1):
        state = mf.get(spark, tbl.state_folder(state_root, date, hour))
        if state is None or state.sources != _state_sources(spark, feed_path, history_root, state_root, date, hour, missing, as_of):
            return hour
    return None


def run_anomaly_hour(spark: SparkSession, feed_path: str, history_root: str, state_root: str,
                     anomalies_root: str, date, hour: int, k: int = 5, missing: str = "drop",
                     method: str = "ratio", as_of: str | None = None,
                     require_feed: bool = True) -> DataFrame:
    """Score hour ``hour`` of ``date`` incrementally and publish the top ``k``.

    Reads one hour of feed, one hour of history and the state of hour-1 (all partition-pruned),
    writes the state of this hour, then ranks from the written state. Returns the ranked rows.
    The history defaults to the latest version before ``date`` (never one that already holds it).
    With ``require_feed`` an hour the stream has not written yet is an error (retry later), not an
    hour without traffic. A state of an earlier hour whose feed (or history) has changed since is refused with
    ``StaleStateError``: `repair_anomaly_hours` makes it anew.
    """
    if require_feed and _feed_version(spark, feed_path, date, hour) == NO_FEED:
        raise FileNotFoundError(f"feed for {date} hour {hour} is not written yet under {feed_path}")
    as_of = as_of or tbl.history_version_before(spark, history_root, date)
    if hour > 0:
        stale = first_stale_hour(spark, feed_path, history_root, state_root, date, hour - 1, missing, as_of)
        if stale is not None:
            if mf.get(spark, tbl.state_folder(state_root, date, stale)) is None:
                raise FileNotFoundError(f"the state of {date} hour {stale} under {state_root} is not written yet")
            raise mf.StaleStateError(f"the state of {date} hour {stale} is not made from what its sources hold now; repair it first")
    sources = _state_sources(spark, feed_path, history_root, state_root, date, hour, missing, as_of)
    cur = read_feed(spark, feed_path, date=date, hour=hour)
    hist = tbl.read_history(spark, history_root, as_of, hour=hour)
    prev = tbl.read_anomaly_state(spark, state_root, date, hour - 1) if hour > 0 else None
    made = tbl.write_anomaly_state(anom.anomaly_step(cur, hist, prev, missing), state_root, date, hour, sources)
    state = tbl.read_anomaly_state(spark, state_root, date, hour)
    scored = (anom.with_distance(state, method)
                  .withColumn("date", F.lit(date).cast("date")).withColumn("hour", F.lit(hour)))
    ranked = anom.top_anomalies(scored, k)
    tbl.write_anomalies(ranked, anomalies_root, date, hour, {"state": made.version, "k": k, "method": method})
    return tbl.read_anomalies(spark, anomalies_root, date, hour)


def repair_anomaly_hours(spark: SparkSession, feed_path: str, history_root: str, state_root: str, anomalies_root: str,
                         date, k: int = 5, missing: str = "drop", method: str = "ratio", as_of: str | None = None,
                         last_hour: int = 23, require_feed: bool = True) -> list[int]:
    """Make the stale end of a day anew: from the first hour whose state or publication is not what its sources
    say now, each hour up to the last one that was ever written is advanced from the state before it and published again.

    The hours before stay as they are. An hour whose new state equals the old one still holds for the hours after it
    (versions are digests of rows), so a feed written again without a change repairs nothing. Returns the hours run.
    Run again after a failure it goes on where the first stale hour now is.
    """
    as_of = as_of or tbl.history_version_before(spark, history_root, date)
    folder = lambda root, h: f"{root.rstrip('/')}/date={date}/hour={h}"
    written = [h for h in range(last_hour + 1) if mf.get(spark, folder(state_root, h)) or mf.get(spark, folder(anomalies_root, h))]
    run = []
    for hour in range(max(written, default=-1) + 1):
        state, out = mf.get(spark, folder(state_root, hour)), mf.get(spark, folder(anomalies_root, hour))
        want = _state_sources(spark, feed_path, history_root, state_root, date, hour, missing, as_of)
        if (state and out and state.sources == want and out.sources == {"state": state.version, "k": k, "method": method}):
            continue
        run_anomaly_hour(spark, feed_path, history_root, state_root, anomalies_root, date, hour, k, missing, method, as_of, require_feed)
        run.append(hour)
    return run


def bucket_history(spark: SparkSession, history_root: str, bucketed_root: str, as_of: str, buckets: int) -> None:
    """A history version as one bucketed folder an hour, for `run_anomaly_hour_bucketed`: the one shuffle a day that
    its 24 steps then save."""
    hist = tbl.read_history(spark, history_root, as_of).select("hour", "article", "avg_views")
    for hour in range(24):
        rows = hist.where(F.col("hour") == hour).select("article", "avg_views").repartition(buckets, "article")
        write_bucketed(rows, f"{bucketed_root.rstrip('/')}/hour={hour}", buckets, {"history": _history_version(spark, history_root, as_of)})


def run_anomaly_hour_bucketed(spark: SparkSession, feed_path: str, bucketed_root: str, state_root: str, anomalies_root: str,
                              date, hour: int, k: int = 5, missing: str = "drop", method: str = "ratio") -> DataFrame:
    """E3 over co-bucketed tables: as `run_anomaly_hour`, but history and state lie in buckets of article, so a step moves
    the hour's feed only (a thousandth of the history at the reference's sizes) and writes the new state into the same buckets."""
    hist_folder = f"{bucketed_root.rstrip('/')}/hour={hour}"
    hist = read_bucketed(spark, hist_folder)
    buckets = mf.get(spark, hist_folder).sources["buckets"]
    prev = read_bucketed(spark, tbl.state_folder(state_root, date, hour - 1)) if hour else None
    cur = read_feed(spark, feed_path, date=date, hour=hour)
    step = anom.anomaly_step(cur, hist, prev, missing, buckets=buckets)
    folder = tbl.state_folder(state_root, date, hour)
    made = write_bucketed(step, folder, buckets, {"feed": _feed_version(spark, feed_path, date, hour)})
    scored = (anom.with_distance(read_bucketed(spark, folder), method)
                  .withColumn("date", F.lit(date).cast("date")).withColumn("hour", F.lit(hour)))
    tbl.write_anomalies(anom.top_anomalies(scored, k), anomalies_root, date, hour, {"state": made.version, "k": k, "method": method})
    return tbl.read_anomalies(spark, anomalies_root, date, hour)


def backfill_anomalies(spark: SparkSession, feed_path: str, history_root: str, anomalies_root: str,
                       date, k: int = 5, missing: str = "drop", method: str = "ratio",
                       last_hour: int = 23, as_of: str | None = None) -> None:
    """W1 as a job: every hour of a day in one pass (re-scoring a past day, or catching up),
    against the latest history version before ``date`` unless ``as_of`` is given."""
    as_of = as_of or tbl.history_version_before(spark, history_root, date)
    cur = read_feed(spark, feed_path, date=date)
    hist = tbl.read_history(spark, history_root, as_of)
    run = anom.anomaly_backfill(cur, hist, last_hour, missing)
    scored = anom.with_distance(run, method).withColumn("date", F.lit(date).cast("date"))
    tbl.write_anomalies(anom.top_anomalies(scored, k), anomalies_root, date)


def serve(spark: SparkSession, trending_path: str, n: int = 10) -> DataFrame:
    """E5: the serving read over the trending table written by the stream."""
    return serving_rows(spark.read.parquet(trending_path), n)


def serve_newest(spark: SparkSession, store: str, n: int = 10) -> DataFrame:
    """E5 over the serving store: opens the newest hours only, however long the table is."""
    return serving_rows(newest_rows(spark, store, n), n)


def day_before(date) -> str:
    d = dt.date.fromisoformat(str(date))
    return (d - dt.timedelta(days=1)).isoformat()
