"""Render the driver's ``events`` / ``part`` tables into the reference's text wire formats, so the
parsers run over data Spark derives from the given tables. Some rows are deliberately malformed
(chosen by the second of the event timestamp) to exercise every reject path.

The same rules are mirrored in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _k(props: str = "props"):
    return F.regexp_extract(F.col(props), r'"k": ([0-9]+)', 1)


def request_lines(events: DataFrame) -> DataFrame:
    """`article \\t ip \\t epoch_seconds` per event. Octets: user_id, props.k, floor(value),
    second(ts); some are above 255. Second 0: empty ip; 1: trailing dot; 2: leading zeros;
    3: non-numeric timestamp; 4: timestamp field missing."""
    sec = F.second("ts")
    ip = F.concat_ws(".", F.col("user_id"), _k(), F.floor("value"), sec)
    ip = (F.when(sec == 0, F.lit(""))
           .when(sec == 1, F.concat(ip, F.lit(".")))
           .when(sec == 2, F.concat(F.lit("00"), ip))
           .otherwise(ip))
    epoch = F.unix_timestamp("ts").cast("string")
    line = (F.when(sec == 3, F.concat_ws("\t", "event_type", ip, F.concat(F.lit("x"), epoch)))
             .when(sec == 4, F.concat_ws("\t", "event_type", ip))
             .otherwise(F.concat_ws("\t", "event_type", ip, epoch)))
    return events.select(line.alias("value"))


def hourly_log_lines(events: DataFrame) -> DataFrame:
    """`project Title views bytes` per event with its clock hour. Second 5: views `n/a`;
    6: bytes missing (three fields); 7: doubled blank (five fields)."""
    sec = F.second("ts")
    project = F.when(F.col("user_id") % 2 == 0, F.lit("en")).otherwise(F.lit("de"))
    title = F.concat(F.upper(F.substring("event_type", 1, 1)), F.substring("event_type", 2, 1 << 20))
    views = F.when(sec == 5, F.lit("n/a")).otherwise(F.floor("value").cast("string"))
    bytes_ = F.col("user_id").cast("string")
    line = (F.when(sec == 6, F.concat_ws(" ", project, title, views))
             .when(sec == 7, F.concat_ws(" ", project, F.lit(""), title, views, bytes_))
             .otherwise(F.concat_ws(" ", project, title, views, bytes_)))
    return events.select(line.alias("value"), F.hour("ts").alias("hour"))


def catalogue_lines(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_name").alias("value"))
