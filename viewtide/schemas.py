"""The typed data model (FIXTURES §1): one StructType per table or stream. Window bounds and event
times are TIMESTAMP in streams and TIMESTAMP_NTZ when derived from NTZ batch inputs."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, DT = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType()
TS, NTZ = T.TimestampType(), T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REQUEST_LINE = _st(("value", S))
REQUESTS = _st(("article", S), ("ip", S), ("ts", TS))
REJECTS = _st(("line", S), ("reason", S))
WINDOW_COUNTS = _st(("article", S), ("window_start", NTZ), ("window_end", NTZ), ("views", L))
HOUR_SERIES = _st(("article", S), ("window_start", NTZ), ("window_end", NTZ),
                  *[(f"s{i}", L) for i in range(6)])
HOURLY_TOTALS = _st(("date", DT), ("hour", I), ("article", S), ("views", L))
HOURLY_LOG = _st(("hour", I), ("project", S), ("article", S), ("views", L), ("bytes", L))
HISTORY = _st(("hour", I), ("article", S), ("sum_views", L), ("n", L), ("avg_views", L))
ANOMALY_STATE = _st(("article", S), ("lhs", L), ("rhs", L), ("canberra_sum", D))
ANOMALIES = _st(("rank", I), ("article", S), ("distance", D), ("date", DT), ("hour", I))
CATALOGUE = _st(("article", S))


def conforms(actual: T.StructType, expected: T.StructType) -> bool:
    """Same column names and types, in order (nullability ignored)."""
    return [(f.name, f.dataType) for f in actual.fields] == [(f.name, f.dataType) for f in expected.fields]
