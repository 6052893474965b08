"""Parsing of the delimited wire formats (P1-P6, S8). Bad records never fail a job: each parser
returns the good rows and a reject DataFrame (line + reason) computed from the same projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ipv4 import is_valid_ipv4
from ..functions.text import split_fields, to_long

# Range of epoch seconds a Spark TIMESTAMP can hold (years 0001..9999); outside it is a reject,
# never an overflow error under ANSI mode.
_MIN_EPOCH_S, _MAX_EPOCH_S = -62135596800, 253402300799


def _split_good_bad(df: DataFrame, reason: Column, good_cols: list, line: str) -> tuple[DataFrame, DataFrame]:
    return _parted(df.withColumn("_reason", reason), good_cols, line)


def _parted(tagged: DataFrame, good_cols: list, line: str) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.col("_reason").isNull()).select(*good_cols)
    bad = tagged.where(F.col("_reason").isNotNull()).select(F.col(line).alias("line"),
                                                            F.col("_reason").alias("reason"))
    return good, bad


def _min_java_fields(value: str, sep: str, n: int):
    """Java ``split`` would give at least ``n`` fields (trailing empty fields dropped): the line has
    n-1 separators and a non-separator character after the last of them. One regex, no arrays."""
    return F.col(value).rlike("(?s)^" + f"[^{sep}]*{sep}" * (n - 1) + f".*[^{sep}]")


def parse_requests(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """P1 + P2: `article \\t ip \\t epoch_seconds` -> (article, ip, ts TIMESTAMP), plus rejects.

    Fields are split like Java's ``String.split`` (trailing empty fields dropped); fields beyond the
    third are ignored. Reasons, first that applies: ``fields`` (fewer than three), ``ip`` (not a valid
    dotted IPv4 address), ``timestamp`` (not an integer in the TIMESTAMP range).

    The first three fields of a Java split and of a split keeping empties are the same whenever the
    Java split has three, so one plain ``split`` serves; the field count is one regex.
    """
    parts = F.split(F.col(value), "\t", -1)
    sec = to_long(F.get(parts, 2))
    p = lines.select(
        F.col(value),
        F.get(parts, 0).alias("article"),
        F.get(parts, 1).alias("ip"),
        sec.alias("_sec"),
        F.when(_min_java_fields(value, "\t", 3), 3).otherwise(0).alias("_n"),
    )
    reason = (F.when(F.col(value).isNull() | (F.col("_n") < 3), F.lit("fields"))
               .when(~is_valid_ipv4("ip"), F.lit("ip"))
               .when(F.col("_sec").isNull() | (F.col("_sec") < _MIN_EPOCH_S)
                     | (F.col("_sec") > _MAX_EPOCH_S), F.lit("timestamp")))
    return _split_good_bad(p, reason, ["article", "ip", F.timestamp_seconds("_sec").alias("ts")], value)


def parse_window_counts(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """`article \\t clock \\t count` (the phase-topic record) -> (article, clock, views)."""
    parts = F.split(F.col(value), "\t", -1)
    p = lines.select(F.col(value), F.get(parts, 0).alias("article"), F.get(parts, 1).alias("clock"),
                     to_long(F.get(parts, 2)).alias("views"),
                     F.when(_min_java_fields(value, "\t", 3), 3).otherwise(0).alias("_n"))
    reason = (F.when(F.col(value).isNull() | (F.col("_n") < 3), F.lit("fields"))
               .when(F.col("views").isNull(), F.lit("count")))
    return _split_good_bad(p, reason, ["article", "clock", "views"], value)


def parse_phase_records(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """`article \t epoch_seconds \t count` (the phase-topic record that can be put in order again) ->
    (article, window_start TIMESTAMP, views) and rejects."""
    parts = F.split(F.col(value), "\t", -1)
    sec = to_long(F.get(parts, 1))
    p = lines.select(F.col(value), F.get(parts, 0).alias("article"), sec.alias("_sec"), to_long(F.get(parts, 2)).alias("views"),
                     F.when(_min_java_fields(value, "\t", 3), 3).otherwise(0).alias("_n"))
    reason = (F.when(F.col(value).isNull() | (F.col("_n") < 3), F.lit("fields"))
               .when(F.col("_sec").isNull() | (F.col("_sec") < _MIN_EPOCH_S) | (F.col("_sec") > _MAX_EPOCH_S), F.lit("timestamp"))
               .when(F.col("views").isNull(), F.lit("count")))
    return _split_good_bad(p, reason, ["article", F.timestamp_seconds("_sec").alias("window_start"), "views"], value)


def parse_hourly_logs(lines: DataFrame, value: str = "value", hour: str = "hour") -> tuple[DataFrame, DataFrame]:
    """P4 + P5: hourly log lines `project title views bytes` (blank separated, split like Python's
    ``str.split(' ')``, so two blanks make an empty field) -> (hour, project, article, views, bytes).

    Lines with other than exactly four fields are dropped by the reference's arity filter; they are
    returned as rejects with reason ``arity``. A non-integer view count is reason ``views``, an
    hour outside 0..23 or unknown is reason ``hour``. The title
    is lower-cased; the project code is kept so callers may filter on it (the reference drops it).
    """
    return _parted(tag_hourly_logs(lines, value, hour), ["hour", "project", "article", "views", "bytes"], value)


def tag_hourly_logs(lines: DataFrame, value: str = "value", hour: str = "hour") -> DataFrame:
    """The same lines in one DataFrame: the fields, the line, and ``_reason`` (null for a good line)."""
    parts = split_fields(F.col(value), " ", keep_trailing=True)
    p = lines.select(
        F.col(value), F.col(hour).cast("int").alias("hour"),
        F.get(parts, 0).alias("project"),
        F.lower(F.get(parts, 1)).alias("article"),
        to_long(F.get(parts, 2)).alias("views"),
        to_long(F.get(parts, 3)).alias("bytes"),
        F.coalesce(F.size(parts), F.lit(0)).alias("_n"),
    )
    reason = (F.when(F.col(value).isNull() | (F.col("_n") != 4), F.lit("arity"))
               .when(F.col("views").isNull(), F.lit("views"))
               .when(F.col("hour").isNull() | ~F.col("hour").between(0, 23), F.lit("hour")))
    return p.withColumn("_reason", reason)


def catalogue_from_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """article = second blank-separated word, lower-cased; lines without one are skipped."""
    parts = split_fields(F.col(value), " ", keep_trailing=True)
    art = F.lower(F.get(parts, 1))
    return lines.select(art.alias("article")).where(F.col("article").isNotNull())
