"""Historical hourly averages and the end-of-day fold.

The history keeps ``sum_views`` and ``n`` per (hour, article); the average is derived from them, so
folding a day never feeds a rounded average back (D18, D21). The fold is a union followed by one
grouped aggregate instead of the reference's three-way join: one shuffle with map-side combine,
and an article new that day or absent that day keeps its row (D19).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_average(hist: DataFrame, exact: bool = False) -> DataFrame:
    """avg_views from sum and count; floored BIGINT (the reference's integer division)
    unless ``exact``."""
    avg = (F.col("sum_views") / F.col("n")) if exact else F.expr("sum_views div n")
    return hist.withColumn("avg_views", avg)


def historical_average(obs: DataFrame, key: str = "article", hour: str = "hour",
                       views: str = "views", exact: bool = False) -> DataFrame:
    """A1 + A2: every input row is one observation of (hour, key) -> sum_views, n, avg_views."""
    agg = (obs.where(F.col(views).isNotNull())
              .groupBy(F.col(hour).alias("hour"), F.col(key).alias(key))
              .agg(F.sum(views).cast("bigint").alias("sum_views"),
                   F.count(F.lit(1)).alias("n")))
    return with_average(agg, exact)


def update_history(hist: DataFrame, day: DataFrame, key: str = "article", hour: str = "hour",
                   views: str = "views", exact: bool = False) -> DataFrame:
    """A4 + J3: fold one day's feed into the history.

    The day's titles are lower-cased (P6); its rows are summed per (hour, key) and count as one observation (D20); keys only in the
    history keep their sums and count; keys only in the day start with n = 1.
    """
    h = hist.select(F.col("hour"), F.col(key), F.col("sum_views").alias("_hs"),
                    F.col("n").alias("_hn"), F.lit(None).cast("bigint").alias("_dv"))
    d = day.where(F.col(views).isNotNull()).select(
        F.col(hour).alias("hour"), F.lower(key).alias(key), F.lit(0).cast("bigint").alias("_hs"),
        F.lit(0).cast("bigint").alias("_hn"), F.col(views).cast("bigint").alias("_dv"))
    g = (h.unionByName(d).groupBy("hour", key)
          .agg(F.sum("_hs").alias("_hs"), F.sum("_hn").alias("_hn"), F.sum("_dv").alias("_dv")))
    seen = F.col("_dv").isNotNull()
    out = g.select("hour", key,
                   (F.col("_hs") + F.coalesce("_dv", F.lit(0))).cast("bigint").alias("sum_views"),
                   (F.col("_hn") + F.when(seen, 1).otherwise(0)).cast("bigint").alias("n"))
    return with_average(out, exact)


def day_delta(day: DataFrame, key: str = "article", hour: str = "hour", views: str = "views") -> DataFrame:
    """What one day's feed adds to the history: (hour, key, sum_views, n = 1), the day's rows summed per (hour, key)."""
    return (day.where(F.col(views).isNotNull()).groupBy(F.col(hour).alias("hour"), F.lower(key).alias(key))
               .agg(F.sum(views).cast("bigint").alias("sum_views"), F.lit(1).cast("bigint").alias("n")))


def merge_sums(parts: list[DataFrame], key: str = "article", exact: bool = False) -> DataFrame:
    """The history of several sets of sums (hour, key, sum_views, n), in one aggregate."""
    cols = ["hour", key, "sum_views", "n"]
    whole = parts[0].select(*cols)
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*cols))
    g = whole.groupBy("hour", key).agg(F.sum("sum_views").cast("bigint").alias("sum_views"), F.sum("n").cast("bigint").alias("n"))
    return with_average(g, exact)
