"""Serving store (K5, T3, E5): trending rows by the hour in which their window ends, read from the newest hour back.

A batch adds to each hour it has rows of one folder ``date=D/hour=H/run=R/batch_id=N``, committed as in `ledger`, so
a replay adds nothing and a batch that died between two hours is completed by its replay. The reader lists folders
from the newest hour back and opens hours, by the row counts in their manifests, until they hold the rows asked for.
What it reads grows with ``n``, not with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import as_wall_time
from . import ledger
from . import manifest as mf

COLUMNS = "article string, window_start timestamp_ntz, window_end timestamp_ntz, s0 long, s1 long, s2 long, s3 long, s4 long, s5 long"
ROW = ["article", "window_start"]


def _hours(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("window_end").cast("date").alias("date"), F.hour("window_end").alias("hour"))


def add_batch(df: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Add trending rows (columns COLUMNS; TIMESTAMP windows become UTC wall time). One write for all hours they end in, then
    one rename an hour."""
    spark, root = df.sparkSession, root.rstrip("/")
    rows = _hours(as_wall_time(df, "window_start", "window_end").select(*[c.split()[0] for c in COLUMNS.split(", ")]))
    staging = f"{root}/{ledger.STAGING}/{run}-{batch_id}"
    for folder in mf.write_partitions(rows.hint("rebalance", "date", "hour"), staging, ["date", "hour"], replace_root=True):
        target = ledger.folder_of(root + folder[len(staging):], run, batch_id)
        if not mf.finished(spark, target):  # a replay completes what an earlier try has not moved
            ledger.put_in_place(spark, folder, target)


def _below(spark: SparkSession, parent: str, column: str) -> list[str]:
    """Sub-folders ``column=value``, greatest value first."""
    fs, hpath = mf._fs(spark, parent)
    if not fs.exists(hpath):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(hpath) if s.getPath().getName().startswith(f"{column}=")]
    value = lambda f: f.rsplit("=", 1)[1]
    return sorted(found, key=lambda f: int(value(f)) if value(f).isdigit() else value(f), reverse=True)


def newest_rows(spark: SparkSession, root: str, n: int) -> DataFrame:
    """All rows of the newest hours that hold at least ``n`` rows, each row once."""
    root, folders, held = root.rstrip("/"), [], 0
    rows = spark.createDataFrame([], COLUMNS)
    for day in _below(spark, root, "date"):
        for hour in _below(spark, day, "hour"):
            done = ledger.committed(spark, hour)
            folders += done
            held += sum(mf.get(spark, f).rows for f in done)
            if held < n:
                continue
            rows = _once(spark, root, folders)
            held = rows.count()  # several runs may hold the same row
            if held >= n:
                return rows
    return _once(spark, root, folders) if folders else rows


def _once(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    rows = spark.read.schema(f"{COLUMNS}, date date, hour int, run string, batch_id long").option("basePath", root).parquet(*folders)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    if len({f.rsplit("/", 2)[1] for f in folders}) == 1:
        return rows.select(*names)
    rest = [c for c in names if c not in ROW]
    rows = rows.groupBy(*ROW).agg(F.max_by(F.struct(*rest), F.struct("run", "batch_id")).alias("_row"))
    return rows.select(*[F.col(c) if c in ROW else F.col(f"_row.{c}").alias(c) for c in names])
