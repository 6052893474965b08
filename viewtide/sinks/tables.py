"""Batch sinks and the typed state tables.

Every write replaces exactly the partitions it owns (dynamic partition overwrite) or one version
folder whole, so a job that dies half-way -- lost executors included -- is simply run again: no
delete step, no read-and-replace of the same path (D22). Every folder ends with a commit manifest
(`manifest`); one whose write died half-way is neither read nor in the way of its repetition. A history
version counts once its write has committed (``_SUCCESS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import merge_sums
from ..schemas import ANOMALY_STATE
from ..sources.files import list_partition_values, read_feed, read_partition
from . import manifest as mf


def _clustered(df: DataFrame, cols: list[str]) -> DataFrame:
    """REBALANCE by the partition columns before a partitioned write: rows of one output folder
    meet in few tasks (no file per task per folder), and AQE splits a folder that is too big for one
    task (e.g. a whole hour of anomaly state) and merges small ones, to the advisory size."""
    return df.hint("rebalance", *cols)


def _overwrite_partitions(df: DataFrame, path: str, cols: list[str]) -> None:
    (_clustered(df, cols).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


# K2 (batch form): the hourly feed, partitioned like the streaming sink writes it
def write_hourly_totals(df: DataFrame, path: str) -> dict[str, mf.Manifest]:
    """Each (date, hour) of ``df`` replaced and finished; an hour written again with the same rows keeps its version."""
    by = ["date", "hour"]
    return mf.write_partitions(_clustered(df.select(*by, "article", "views"), by), path, by)


# Versioned history store. A version is a base, root/as_of=YYYY-MM-DD/hour=H/, or a base and the deltas of the days
# after it, root/delta=YYYY-MM-DD/hour=H/, which readers merge.
HISTORY_COLS = ["hour", "article", "sum_views", "n", "avg_views"]


def write_history(hist: DataFrame, root: str, as_of, sources: dict | None = None) -> str:
    path = f"{root.rstrip('/')}/as_of={as_of}"
    out = _clustered(hist.select(*HISTORY_COLS), ["hour"])
    # the version is replaced whole, whatever hours an earlier build of it had
    mf.write_folder(out, path, sources, partition_by=["hour"])
    return path


def write_history_delta(delta: DataFrame, root: str, date) -> str:
    """A4 merge-on-read: one day's sums (hour, article, sum_views, n). What is written grows with the day, not with the history."""
    path = f"{root.rstrip('/')}/delta={date}"
    mf.write_folder(_clustered(delta.select("hour", "article", "sum_views", "n"), ["hour"]), path, partition_by=["hour"])
    return path


def history_bases(spark: SparkSession, root: str) -> list[str]:
    return list_partition_values(spark, root, "as_of", finished=True)


def history_deltas(spark: SparkSession, root: str) -> list[str]:
    return [f.rsplit("=", 1)[1] for f in mf.finished_folders(spark, root, ["delta"])]


def history_versions(spark: SparkSession, root: str) -> list[str]:
    """Finished versions, oldest first: bases, and the days whose deltas follow one."""
    bases = history_bases(spark, root)
    return sorted({*bases, *(d for d in history_deltas(spark, root) if bases and d > bases[0])})


def history_version_before(spark: SparkSession, root: str, date) -> str:
    """The latest history version strictly before ``date``: the history a day is scored against,
    whether the day is live or re-scored later (a version that already folded the day is skipped)."""
    older = [v for v in history_versions(spark, root) if v < str(date)]
    if not older:
        raise FileNotFoundError(f"no history version before {date} under {root}")
    return older[-1]


def history_folders(spark: SparkSession, root: str, as_of: str) -> list[str]:
    """Folders that make up a version: its base, then its deltas by day."""
    base = max((b for b in history_bases(spark, root) if b <= as_of), default=None)
    if base is None:
        raise FileNotFoundError(f"no history version {as_of} under {root}")
    days = [d for d in history_deltas(spark, root) if base < d <= as_of]
    if base != as_of and (not days or days[-1] != as_of):
        raise FileNotFoundError(f"no history version {as_of} under {root}")
    root = root.rstrip("/")
    return [f"{root}/as_of={base}", *(f"{root}/delta={d}" for d in days)]


def history_digest(spark: SparkSession, root: str, as_of: str) -> str:
    """What a version holds. Merging deltas into a base keeps it."""
    folders = history_folders(spark, root, as_of)
    known = [mf.get(spark, f) for f in folders]
    return " + ".join(k.sources.get("merged", k.version) if k else "unversioned" for k in known)


def read_history(spark: SparkSession, root: str, as_of: str | None = None,
                 hour: int | None = None) -> DataFrame:
    """One version of the history (the latest when ``as_of`` is None); ``hour`` prunes. A version with deltas
    costs one aggregate over its base and its deltas."""
    if as_of is None:
        versions = history_versions(spark, root)
        if not versions:
            raise FileNotFoundError(f"no history version under {root}")
        as_of = versions[-1]
    parts = [read_partition(spark, f, hour=hour) if hour is not None else spark.read.parquet(f)
             for f in history_folders(spark, root, str(as_of))]
    if len(parts) == 1:
        return parts[0]
    exact = parts[0].schema["avg_views"].dataType.typeName() == "double"
    return merge_sums(parts, exact=exact).select(*HISTORY_COLS)


def compact_history(spark: SparkSession, root: str, as_of: str | None = None) -> str:
    """Write a version with deltas as a base. Readers of the version then open the base alone; other versions stay readable."""
    as_of = as_of or history_versions(spark, root)[-1]
    if as_of in history_bases(spark, root):
        return f"{root.rstrip('/')}/as_of={as_of}"
    merged = history_digest(spark, root, as_of)
    return write_history(read_history(spark, root, as_of), root, as_of, {"merged": merged})


def prune_history(spark: SparkSession, root: str, keep_from: str) -> list[str]:
    """Retention: remove the bases and deltas that no version from ``keep_from`` on is made of; returns what went."""
    need = {f for v in history_versions(spark, root) if v >= keep_from for f in history_folders(spark, root, v)}
    root, gone = root.rstrip("/"), []
    if not need:
        return gone
    for folder in [f"{root}/as_of={b}" for b in history_bases(spark, root)] + [f"{root}/delta={d}" for d in history_deltas(spark, root)]:
        if folder not in need:
            mf.drop(spark, folder)
            fs, hpath = mf._fs(spark, folder)
            fs.delete(hpath, True)
            gone.append(folder)
    return gone


# Running anomaly sums per (date, hour)
def state_folder(root: str, date, hour: int) -> str:
    return f"{root.rstrip('/')}/date={date}/hour={hour}"


def write_anomaly_state(state: DataFrame, root: str, date, hour: int, sources: dict | None = None) -> mf.Manifest:
    """All rows share one (date, hour): write the aggregate's partitions straight into that folder
    (overwrite of that folder only) -- no rebalance shuffle for a single target folder. ``sources`` are
    the versions of the feed, history and earlier state that the sums were made from."""
    return mf.write_folder(state.select("article", "lhs", "rhs", "canberra_sum"), state_folder(root, date, hour), sources)


def read_anomaly_state(spark: SparkSession, root: str, date, hour: int) -> DataFrame:
    """The running sums of one hour, read from its folder alone (fails if its write never finished:
    an hour cannot be advanced without the previous one)."""
    folder = state_folder(root, date, hour)
    if not mf.finished(spark, folder):
        raise FileNotFoundError(f"the state of {date} hour {hour} under {root} is not written yet")
    return spark.read.parquet(folder).select(*ANOMALY_STATE.names)


def read_anomaly_states(spark: SparkSession, root: str, date) -> DataFrame:
    """The running sums of all finished hours of a day, with date and hour."""
    folders = mf.finished_folders(spark, f"{root.rstrip('/')}/date={date}", ["hour"])
    if not folders:
        schema = T.StructType([*ANOMALY_STATE.fields, T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())])
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", root).parquet(*folders)


# K7: top anomalies per hour, set semantics per (date, hour, article)
ANOMALY_COLS = "rank int, article string, distance double"


def write_anomalies(ranked: DataFrame, root: str, date, hour: int | None = None, sources: dict | None = None) -> None:
    """Publish one hour, or (``hour`` None) all hours of one day: the folder is replaced whole, so an
    hour without rows is published as empty and keeps none of an earlier run."""
    out = ranked.dropDuplicates(["date", "hour", "article"])
    folder = f"{root.rstrip('/')}/date={date}"
    if hour is not None:
        mf.write_folder(out.select("rank", "article", "distance"), f"{folder}/hour={hour}", sources)
        return
    out = _clustered(out.select("rank", "article", "distance", F.col("hour").cast("int").alias("hour")), ["hour"])
    mf.write_partitions(out, folder, ["hour"], sources, replace_root=True)


def read_anomalies(spark: SparkSession, root: str, date=None, hour: int | None = None) -> DataFrame:
    """The published rows of one hour, or of all hours whose publication has finished."""
    full = spark.read.schema(f"{ANOMALY_COLS}, date date, hour int").option("basePath", root)
    if date is not None and hour is not None:
        folders = [f"{root.rstrip('/')}/date={date}/hour={hour}"]
        folders = [f for f in folders if mf.finished(spark, f)]
    else:
        folders = mf.finished_folders(spark, root, ["date", "hour"])
    if not folders:
        return spark.createDataFrame([], f"{ANOMALY_COLS}, date date, hour int")
    return full.parquet(*folders)


# K5 / K6 (batch form): ranked or trending rows under a partition column such as minute or date
def write_ranked(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    _overwrite_partitions(df, path, partition_cols)


# K8: records keyed by article, so one article stays in one broker partition
def to_keyed_records(df: DataFrame, key: str = "article", value_cols: list[str] | None = None,
                     sep: str = "\t") -> DataFrame:
    cols = value_cols or [c for c in df.columns]
    return df.select(F.col(key).cast("string").alias("key"),
                     F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def keyed_by_article(df: DataFrame, key: str = "article", partitions: int | None = None) -> DataFrame:
    """K8 batch analogue: hash-partition rows by article."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)


# K9: promote a finished day's hourly partitions from the work feed into the history log
def promote_day(spark: SparkSession, work_path: str, log_path: str, date) -> None:
    day = read_feed(spark, work_path, date=date)
    out = _clustered(day.select("article", "views", "hour"), ["hour"])
    mf.write_folder(out, f"{log_path.rstrip('/')}/date={date}", partition_by=["hour"])
