"""viewtide: page-view trends and anomalies on Spark DataFrames and Structured Streaming.

Batch operators are DataFrame -> DataFrame functions; jobs live in ``viewtide.plans.jobs``, the
streaming job in ``viewtide.streaming.trend_stream``, the command line in ``viewtide.cli``.
"""

__version__ = "0.1.0"

from .operators.anomaly import (advance_anomaly, anomaly_backfill, anomaly_step, hour_terms,  # noqa: F401
                                top_anomalies, with_distance)
from .operators.history import historical_average, update_history  # noqa: F401
from .operators.parse import (catalogue_from_lines, parse_hourly_logs, parse_requests,  # noqa: F401
                              parse_window_counts)
from .operators.serving import latest_trending, serving_payload, serving_rows  # noqa: F401
from .operators.windows import (bucket_counts, hourly_totals, route_by_phase, sliding_counts,  # noqa: F401
                                trend_series, trending, with_series)
