"""Text helpers for the delimited wire formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAB = "\t"

# Fixed values that must equal the reference's for matching output: the article URL prefix and the
# number of trailing title characters shown as link text on the serving page.
ARTICLE_URL_PREFIX = "https://en.wikipedia.org/wiki/"
LINK_TAIL_CHARS = 15


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line, sep: str, keep_trailing: bool = True) -> Column:
    """split on a literal separator.

    ``keep_trailing=True`` keeps trailing empty fields (Python ``str.split``); ``False`` drops
    them (Java ``String.split``: "a\\t\\t" -> ["a"], "\\t" -> [], "" -> [""]). Built from
    regexp_replace + split only, so it stays inside whole-stage codegen (no lambda functions).
    """
    c = _col(line)
    esc = _regex_escape(sep)
    if keep_trailing:
        return F.split(c, esc, -1)
    stripped = F.regexp_replace(c, f"(?:{esc})+$", "")
    return F.when((stripped == F.lit("")) & (c != F.lit("")), F.array().cast("array<string>")) \
            .otherwise(F.split(stripped, esc, -1))


def _regex_escape(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


def field(parts, i: int) -> Column:
    """0-based element ``i`` or NULL when the line is too short (ANSI-safe ``get``)."""
    return F.get(_col(parts), i)


def to_long(s) -> Column:
    """strict decimal string -> BIGINT (``Long.parseLong`` / Python ``long``); NULL otherwise.

    Spark's cast would also accept blanks and a decimal part, which the reference rejects.
    """
    c = _col(s)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))


def lower_title(s) -> Column:
    """F1"""
    return F.lower(_col(s))


# the legacy `lhs;rhs` packing, for text export only
def pack_pair(a, b) -> Column:
    return F.concat_ws(";", _col(a).cast("string"), _col(b).cast("string"))


def unpack_pair(s) -> tuple[Column, Column]:
    parts = F.split(_col(s), ";", -1)
    return to_long(F.get(parts, 0)), to_long(F.get(parts, 1))


# series as `a:b:c:d:e:f`
def series_text(series) -> Column:
    return F.array_join(_col(series).cast("array<string>"), ":")


# trending text row `article \t HH:mm:ss \t a:b:c:d:e:f`
def trending_text(article, window_start, series) -> Column:
    return F.concat_ws(TAB, _col(article), F.date_format(_col(window_start), "HH:mm:ss"),
                       series_text(series))


# parse a trending text row back into (article, clock, series array)
def parse_trending_text(line) -> tuple[Column, Column, Column]:
    parts = F.split(_col(line), TAB, -1)
    series = F.transform(F.split(F.get(parts, 2), ":", -1), lambda x: to_long(x))
    return F.get(parts, 0), F.get(parts, 1), series


# article URL and its short link text
def article_url(article) -> Column:
    return F.concat(F.lit(ARTICLE_URL_PREFIX), _col(article))


def article_link_text(article) -> Column:
    return F.concat(F.lit(ARTICLE_URL_PREFIX), F.right(_col(article), F.lit(LINK_TAIL_CHARS)))


# Names used in the design notes
format_trending_row = trending_text
parse_trending_row = parse_trending_text
