"""Folders bucketed and sorted by article (J1, J2, S4, S5): tables that meet without a shuffle.

The anomaly step pairs an hour of feed, an hour of history and the state of the hour before, all keyed by article. Where
history and state are bucketed alike, Spark reads bucket i of both in one task, and only the hour's feed is dealt to
the buckets. A folder's manifest keeps the number of buckets and the columns, so any session can declare the folder as an
external table again; declarations are dropped with the session or by `forget`, never the files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import manifest as mf


def _name(folder: str) -> str:
    return f"viewtide_{hashlib.md5(folder.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, folder: str, buckets: int, sources: dict | None = None, key: str = "article") -> mf.Manifest:
    """Replace ``folder``. A ``df`` that is dealt by ``key`` over as many tasks is written without a shuffle, one file a bucket."""
    spark, seen, name = df.sparkSession, Observation(), _name(folder)
    mf.drop(spark, folder)
    forget(spark, folder)
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), mf.row_digest(df.columns).alias("digest"))
    out.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    made = mf.Manifest(seen.get["rows"], f"{seen.get['rows']}-{seen.get['digest']}",
                       {**(sources or {}), "buckets": buckets, "columns": columns, "key": key})
    mf.put(spark, folder, made)
    return made


def read_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """A finished folder as a table that Spark knows to be bucketed."""
    done, name = mf.get(spark, folder), _name(folder)
    if done is None:
        raise FileNotFoundError(f"not written to the end yet: {folder}")
    of = done.sources
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({of['columns']}) USING parquet "
                  f"CLUSTERED BY ({of['key']}) SORTED BY ({of['key']}) INTO {of['buckets']} BUCKETS LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def forget(spark: SparkSession, folder: str) -> None:
    """Drop the declaration of a folder; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
