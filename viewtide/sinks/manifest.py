"""Commit manifests: which folders of a table are finished, what they hold and what they were made from.

A writer replaces a folder, which removes its old manifest with the old files, and puts the new manifest there
last. So a folder with a manifest is whole, and one whose write died has none. The manifest says

* ``rows`` and ``version``: the row count and a digest of the rows, taken while they are written
  (``DataFrame.observe``), so writing the same rows again gives the same version;
* ``sources``: the versions of what the folder was made from, by name.

Readers take finished folders only, and a job that goes on from a stored state can tell whether that state was
made from what its sources hold now. Manifests are small files read and written through Hadoop's file system API, so the driver
needs a JVM (no Spark Connect).
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NAME = "_manifest.json"
THREADS = 16  # file system calls at a time, where a table has many folders


class StaleStateError(RuntimeError):
    """A stored state was made from sources that have changed since."""


@dataclass(frozen=True)
class Manifest:
    rows: int
    version: str
    sources: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def row_digest(columns: list[str]) -> Column:
    """Sum of the rows' 64-bit hashes: the same for the same rows in any order."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20, 0)")), F.lit(0)).cast("string")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced whole. One that a dead driver left half-written reads as no manifest."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    write_text(spark, f"{folder.rstrip('/')}/{NAME}", json.dumps(asdict(manifest), sort_keys=True))


def get(spark: SparkSession, folder: str) -> Manifest | None:
    """The manifest of a folder, None unless it is finished."""
    try:
        text = read_text(spark, f"{folder.rstrip('/')}/{NAME}")
        return None if text is None else Manifest(**json.loads(text))
    except json.JSONDecodeError:  # its write died
        return None
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "ChecksumException":  # the same, on a local disk
            return None
        raise


def each(call, items: list) -> list:
    """``call`` of each item, some at a time: these are waits for the file system."""
    if len(items) < 2:
        return [call(i) for i in items]
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(call, items))


def drop(spark: SparkSession, folder: str) -> None:
    """Mark a folder as unfinished before files in it change one by one."""
    fs, hpath = _fs(spark, f"{folder.rstrip('/')}/{NAME}")
    fs.delete(hpath, False)


def finished(spark: SparkSession, folder: str) -> bool:
    fs, hpath = _fs(spark, f"{folder.rstrip('/')}/{NAME}")
    return bool(fs.exists(hpath)) and fs.getFileStatus(hpath).getLen() > 0


def write_folder(df: DataFrame, folder: str, sources: dict | None = None, partition_by: list[str] | None = None) -> Manifest:
    """Replace ``folder`` by the rows of ``df`` and finish it."""
    spark, seen = df.sparkSession, Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), row_digest(df.columns).alias("digest"))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    manifest = Manifest(seen.get["rows"], f"{seen.get['rows']}-{seen.get['digest']}", sources or {})
    put(spark, folder, manifest)
    return manifest


def write_partitions(df: DataFrame, root: str, by: list[str], sources: dict | None = None,
                     replace_root: bool = False) -> dict[str, Manifest]:
    """Replace the partitions of ``root`` that ``df`` has rows of (with ``replace_root`` all of ``root``), and finish each.

    ``df`` runs once: which partitions it had is observed during the write, and their digests are read
    from what was written. The driver gets one row a partition. Returns the manifests by folder."""
    spark, seen = df.sparkSession, Observation()
    out = df.observe(seen, F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in by])).alias("parts"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_root else "dynamic")
        .partitionBy(*by).parquet(root))
    folder_of = lambda r: root.rstrip("/") + "".join(f"/{c}={r[c]}" for c in by)
    folders = sorted(folder_of(r) for r in seen.get["parts"])
    if not folders:
        return {}
    back = spark.read.schema(df.schema).option("basePath", root).parquet(*folders)
    values = [c for c in df.columns if c not in by]
    per = back.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), row_digest(values).alias("digest")).collect()
    done = {folder_of(r): Manifest(r["rows"], f"{r['rows']}-{r['digest']}", sources or {}) for r in per}
    each(lambda folder: put(spark, folder, done[folder]), list(done))
    return done


def finished_folders(spark: SparkSession, root: str, by: list[str]) -> list[str]:
    """Finished partitions of ``root``, below its columns ``by`` (listings only), in the order of their names."""
    fs, hpath = _fs(spark, root.rstrip("/"))
    level = [hpath] if fs.exists(hpath) else []
    for column in by:
        level = [p for found in each(lambda parent: _sub_folders(fs, parent, column), level) for p in found]
    folders = sorted(p.toString() for p in level)
    return [f for f, ok in zip(folders, each(lambda f: finished(spark, f), folders)) if ok]


def _sub_folders(fs, parent, column: str) -> list:
    return [s.getPath() for s in fs.listStatus(parent) if s.isDirectory() and s.getPath().getName().startswith(f"{column}=")]
