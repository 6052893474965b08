"""Column functions (JVM-side expressions only)."""

from .ipv4 import IPV4_PATTERN, is_valid_ipv4
from .text import (article_link_text, article_url, field, lower_title, pack_pair, parse_trending_text,
                   series_text, split_fields, to_long, trending_text, unpack_pair)
from .timecols import (as_event_time, clock_stamp, date_of, epoch_bucket, epoch_seconds,
                       from_epoch_seconds_ntz, hour_folder, hour_of_day, phase, run_stamp,
                       time_labels, to_event_time, to_wall_time, wall_clock)

__all__ = [n for n in dir() if not n.startswith("_")]
