"""Readers for the driver's parquet tables and the adapters that turn them into our inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def requests_from_events(events: DataFrame) -> DataFrame:
    """Page requests from the driver's ``events`` table: article = event_type, ts kept as is."""
    return events.select(F.col("event_type").alias("article"), F.col("ts"))


def read_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(read_table(spark, sf_dir, "events"))
