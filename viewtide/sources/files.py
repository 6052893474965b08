"""File sources (S1-S5, S8): text logs, typed parquet tables, legacy pair files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import catalogue_from_lines
from ..schemas import HOURLY_TOTALS
from ..sinks.manifest import _fs, finished, finished_folders


def read_hourly_logs(spark: SparkSession, root: str) -> DataFrame:
    """Every hourly log under ``root/HH/`` in one scan -> (value, hour).

    The hour comes from the folder name (``00``..``23``, or ``hour=HH``) of each file, read from the
    file metadata column, so one job covers all 24 folders. Lines of any other folder have no hour and
    are rejected by the parser.
    """
    return _with_hour(spark.read.option("recursiveFileLookup", "true").text(root))


def read_log_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """S1 over some files only -> (value, hour)."""
    return _with_hour(spark.read.text(files))


def list_files(spark: SparkSession, root: str) -> dict[str, str]:
    """Data files below a folder with their length and time of change (a listing, no scan)."""
    fs, hpath = _fs(spark, root)
    out, names = {}, fs.listFiles(hpath, True)
    while names.hasNext():
        f = names.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out[f.getPath().toString()] = f"{f.getLen()}/{f.getModificationTime()}"
    return out


def _with_hour(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    hh = F.regexp_extract(path, r"/(?:hour=)?([01]?[0-9]|2[0-3])/[^/]*$", 1)
    return df.select("value", F.when(hh != "", hh.cast("int")).alias("hour"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds data (Hadoop FS check; DataFrame probe without a
    local JVM, e.g. Spark Connect)."""
    try:
        jvm = spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath))
    except AttributeError:
        try:
            spark.read.parquet(path).schema  # resolves the file listing only
            return True
        except AnalysisException as e:  # anything else, such as a denied access, is an error
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise


def read_partition(spark: SparkSession, base: str, **parts) -> DataFrame:
    """Read one partition folder ``base/k1=v1/k2=v2`` of a partitioned parquet table, listing only
    that folder (``basePath`` keeps the partition columns). A missing folder -- an hour without
    traffic -- gives the table's schema with no rows."""
    base = base.rstrip("/")
    folder = base + "".join(f"/{k}={v}" for k, v in parts.items())
    if path_exists(spark, folder):
        return spark.read.option("basePath", base).parquet(folder)
    df = spark.read.parquet(base)
    return df.where(F.lit(False))


def read_feed(spark: SparkSession, path: str, date=None, hour: int | None = None) -> DataFrame:
    """The typed hourly-totals table (date, hour, article, views), partitioned by date and
    hour. A given date (and hour) reads just that folder; otherwise the finished hours of the table are read.

    Only folders with a commit manifest count: a folder whose write has not finished (or died) is an error when
    its hour or day is asked for, and left out of the whole table. An hour without a folder had no traffic."""
    root = path.rstrip("/")
    if date is None:
        whole = finished_folders(spark, root, ["date", "hour"])
        df = spark.read.schema(HOURLY_TOTALS).option("basePath", root).parquet(*whole) if whole else \
            spark.createDataFrame([], HOURLY_TOTALS)
        return df if hour is None else df.where(F.col("hour") == F.lit(hour))
    day = f"{root}/date={date}"
    hours = [f"{day}/hour={hour}"] if hour is not None else [
        f"{day}/hour={h}" for h in list_partition_values(spark, day, "hour")]
    there = hours if hour is None else [f for f in hours if path_exists(spark, f)]
    if not finished(spark, day):  # a day promoted whole has one manifest
        half = [f for f in there if not finished(spark, f)]
        if half:
            raise FileNotFoundError(f"not written to the end yet: {', '.join(half)}")
    if not there:
        return spark.createDataFrame([], HOURLY_TOTALS)
    return spark.read.schema(HOURLY_TOTALS).option("basePath", root).parquet(*there)


def read_day(spark: SparkSession, path: str, date) -> DataFrame:
    """One finished day of the feed."""
    return read_feed(spark, path, date=date)


def read_hour(spark: SparkSession, path: str, date, hour: int) -> DataFrame:
    """S3: the current hour of the feed."""
    return read_feed(spark, path, date=date, hour=hour)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Article catalogue from a text file."""
    return catalogue_from_lines(spark.read.text(path))


def import_sequence_pairs(spark: SparkSession, path: str, key: str = "article",
                          value: str = "value") -> DataFrame:
    """S4 legacy import: a Hadoop SequenceFile of (text, number) pairs as a DataFrame.

    RDD use is confined to this one import of old files; everything after it is a DataFrame.
    """
    return spark.sparkContext.sequenceFile(path).toDF([key, value])


def list_partition_values(spark: SparkSession, root: str, column: str, finished: bool = False) -> list[str]:
    """Names ``column=value`` of the sub-folders of ``root`` (directory listing only, no scan); with
    ``finished`` those whose write has committed (they hold ``_SUCCESS``).
    Without a local JVM (Spark Connect) the partition column is read instead; it has one value per
    version, so the result stays small."""
    try:
        jvm = spark._jvm
    except AttributeError:
        jvm = None
    if jvm is None:
        if not path_exists(spark, root):
            return []
        vals = spark.read.parquet(root).select(F.col(column).cast("string")).distinct().collect()
        return sorted(r[0] for r in vals)
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    prefix = f"{column}="
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if finished and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue
        if st.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):])
    return sorted(out)
