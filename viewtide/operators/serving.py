"""Serving read (T3, E5, F9-F12): the latest trending rows with everything the page shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import article_link_text, article_url, series_text, trending_text
from ..functions.timecols import as_wall_time, time_labels
from .windows import slot_names


def latest_trending(trending_rows: DataFrame, n: int = 10, key: str = "article") -> DataFrame:
    """The ``n`` newest trending rows (window end descending, then article).

    A top-n report: Spark plans it as TakeOrderedAndProject, a per-partition heap of n rows.
    """
    return as_wall_time(trending_rows, "window_start", "window_end").orderBy(F.desc("window_end"), F.asc(key)).limit(n)


def serving_rows(trending_rows: DataFrame, n: int = 10, slots: int = 6, slot_minutes: int = 10,
                 key: str = "article") -> DataFrame:
    """E5: latest rows with the series, six clock labels, the article URL and its link text, and
    the text row the reference pushed to its list (F9)."""
    names = slot_names(slots)
    top = latest_trending(trending_rows, n, key)
    series = F.array(*names)
    return top.select(
        key, "window_start", "window_end",
        series_text(series).alias("series"),
        F.array_join(time_labels("window_start", slots, slot_minutes), ",").alias("labels"),
        article_url(key).alias("url"),
        article_link_text(key).alias("link_text"),
        trending_text(F.col(key), F.col("window_start"), series).alias("text_row"),
    )


def serving_payload(trending_rows: DataFrame, n: int = 10, slots: int = 6, slot_minutes: int = 10,
                    key: str = "article") -> dict:
    """The web endpoint's JSON body: three parallel lists (series, clock labels, articles) of the
    ``n`` latest rows. Collects at most ``n`` rows -- a bounded top-n report."""
    names = slot_names(slots)
    top = latest_trending(trending_rows, n, key).select(
        key, F.array(*names).alias("series"), time_labels("window_start", slots, slot_minutes).alias("labels"))
    rows = top.collect()
    return {"datalist": [list(r.series) for r in rows], "timelist": [list(r.labels) for r in rows],
            "articlelist": [r[key] for r in rows]}
