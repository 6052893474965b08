"""Ledger of micro-batch outputs (K1, K5, K6, M9): which batches of which runs are committed.

A run is the life of one stream checkpoint. Its id is made when the checkpoint is first used and kept beside
it, so a restart goes on with the run and a new checkpoint, whose batch numbers start at 0 again, is a new
run that cannot touch what an earlier one finished. A batch is written out of sight, with its manifest
(`manifest`), and moved to ``run=R/batch_id=N`` in one rename: readers see it whole or not at all, and a batch that is
replayed after its commit is left as it is. (The rename is atomic on HDFS and local disks; an object store needs a
committer that makes it so.)

The ledger is the tree of committed folders itself: `committed` lists it, `read_batches` reads it. Where a new
run has read input again that an earlier one had read, ``keys`` name what makes a row, and the newest run's row counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import manifest as mf

RUN, BATCH, STAGING = "run", "batch_id", "_staging"


def run_id(spark: SparkSession, checkpoint: str, path: str) -> str:
    """The run of ``checkpoint`` over the output ``path``: kept with the checkpoint, numbered after the runs the output has."""
    kept = f"{checkpoint.rstrip('/')}/_run"
    known = mf.read_text(spark, kept)
    if known is None:
        fs, root = mf._fs(spark, path)
        runs = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        known = f"{sum(r.startswith(f'{RUN}=') for r in runs) + 1:06d}-{uuid.uuid4().hex[:8]}"
        mf.write_text(spark, kept, known)
    return known


def folder_of(path: str, run: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{RUN}={run}/{BATCH}={batch_id}"


def commit(df: DataFrame, path: str, run: str, batch_id: int, partition_by: list[str] | None = None) -> bool:
    """Commit a batch; False if it was committed before (a replay)."""
    spark, folder = df.sparkSession, folder_of(path, run, batch_id)
    if mf.finished(spark, folder):
        return False
    staging = f"{path.rstrip('/')}/{STAGING}/{run}-{batch_id}"
    mf.write_folder(df, staging, {RUN: run, BATCH: batch_id}, partition_by)
    put_in_place(spark, staging, folder)
    return True


def put_in_place(spark: SparkSession, staging: str, folder: str) -> None:
    """Rename a finished folder to where readers look. A folder of that name without a manifest is a dead write's and goes."""
    fs, target = mf._fs(spark, folder)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staging), target):
        raise OSError(f"could not put {folder} in place")


def batch_writer(path: str, run: str, partition_by: list[str] | None = None):
    """foreachBatch function: each batch with rows is committed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the emptiness check and the write do not run the micro-batch twice
        try:
            if not batch.isEmpty():
                out = batch.hint("rebalance", *partition_by) if partition_by else batch.hint("rebalance")
                commit(out, path, run, batch_id, partition_by)
        finally:
            batch.unpersist()
    return write


def committed(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed batches, oldest run first, batches in order."""
    folders = mf.finished_folders(spark, path, [RUN, BATCH])
    return sorted(folders, key=lambda f: (f.rsplit("/", 2)[1], int(f.rsplit("=", 1)[1])))


def read_batches(spark: SparkSession, path: str, schema: str, keys: list[str] | None = None) -> DataFrame:
    """The committed rows, in columns of ``schema`` (which may name partition columns).

    With ``keys`` a row that several runs wrote counts once, as the newest run has it. That costs a
    shuffle only where the table has more than one run."""
    folders, empty = committed(spark, path), spark.createDataFrame([], schema)
    if not folders:
        return empty
    rows = spark.read.schema(f"{schema}, {RUN} string, {BATCH} long").option("basePath", path).parquet(*folders)
    names = empty.columns
    if keys and len({f.rsplit("/", 2)[1] for f in folders}) > 1:
        rest = [c for c in names if c not in keys]
        newest = F.max_by(F.struct(*rest) if rest else F.lit(0), F.struct(RUN, BATCH)).alias("_row")
        rows = rows.groupBy(*keys).agg(newest).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in names])
    return rows.select(*names)
