"""Event-time helpers: every time computation goes through epoch integers, so results do not
depend on the session time zone and both TIMESTAMP and TIMESTAMP_NTZ inputs work.

Wall time is modelled as UTC (the reference labels folders and windows by UTC hour).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (zone-free for NTZ; instant for TIMESTAMP)."""
    return F.unix_timestamp(_col(ts))


def epoch_bucket(ts, seconds: int) -> Column:
    """Index of the ``seconds``-wide bucket holding ``ts`` (tumbling window id)."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("bigint")


def from_epoch_seconds_ntz(sec) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ wall time in UTC (zone-free)."""
    return F.timestamp_add("SECOND", _col(sec), F.expr(_EPOCH_NTZ))


def to_event_time(ts) -> Column:
    """NTZ wall time -> TIMESTAMP instant, read as UTC, independent of the session zone.

    Structured Streaming watermarks require TIMESTAMP; the driver tables carry TIMESTAMP_NTZ.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _col(ts))
    return F.timestamp_micros(micros)


def to_wall_time(ts) -> Column:
    """TIMESTAMP instant -> NTZ wall time in UTC (inverse of ``to_event_time``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), F.expr(_EPOCH_NTZ))


def as_event_time(df, col: str = "ts"):
    """Return ``df`` with ``col`` as TIMESTAMP (converting from NTZ if needed)."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return df.withColumn(col, to_event_time(col))
    return df


def hour_of_day(sec) -> Column:
    """UTC hour 0..23 of epoch seconds."""
    return (F.floor(_col(sec) / 3600) % 24).cast("int")


def date_of(sec) -> Column:
    """UTC calendar date of epoch seconds."""
    return F.date_from_unix_date(F.floor(_col(sec) / 86400).cast("int"))


def wall_clock(ts, like: T.DataType) -> Column:
    """``ts`` as UTC wall time: NTZ stays as is, TIMESTAMP is converted (zone-free)."""
    return _col(ts) if isinstance(like, T.TimestampNTZType) else to_wall_time(ts)


def as_wall_time(df: DataFrame, *names: str) -> DataFrame:
    """The TIMESTAMP columns among ``names`` as UTC wall time (NTZ): rows written by a stream carry TIMESTAMP bounds,
    whose clock text would otherwise follow the session time zone."""
    for c in names:
        if isinstance(df.schema[c].dataType, T.TimestampType):
            df = df.withColumn(c, to_wall_time(c))
    return df


# clock stamp of a window start, `HH:mm:ss` in UTC wall time
def clock_stamp(ts, like: T.DataType = T.TimestampNTZType()) -> Column:
    return F.date_format(wall_clock(ts, like), "HH:mm:ss")


# phase = last digit of the window start's minute (epoch arithmetic: zone-free)
def phase(ts) -> Column:
    return (F.floor(F.unix_timestamp(_col(ts)) / 60) % 10).cast("int")


# zero padded hour, the folder name of an hour
def hour_folder(hour) -> Column:
    return F.lpad(_col(hour).cast("string"), 2, "0")


# n clock labels `step_minutes` apart from a start, rolling over hours and days
def time_labels(start, n: int = 6, step_minutes: int = 10) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.date_format(F.timestamp_add("MINUTE", i * step_minutes, _col(start)), "HH:mm:ss"),
    )


# run stamp, kept as typed date/hour columns; text form only for export
def run_stamp(date, hour) -> Column:
    return F.concat_ws(":", F.year(_col(date)), F.month(_col(date)), F.dayofmonth(_col(date)), _col(hour))
