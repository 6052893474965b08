"""Hourly anomaly scoring of one day against the historical hourly averages.

For an article at hour h of the day, with c_i today's views and a_i the historical average in hour i:

* ``ratio`` (the reference's computation, D12): sum_i |c_i - a_i| / sum_i (c_i + a_i), i = 0..h
* ``canberra`` (textbook, A7):                     sum_i |c_i - a_i| / (c_i + a_i)

with 0/0 taken as 0 (D16). Today's titles are lower-cased, as the history's are (P6). ``missing='drop'`` keeps the reference's inner joins: an article must
have both a current count and a history average in every hour 0..h. ``missing='zero'`` treats an
absent side as 0 (full outer semantics).

Two equivalent evaluations:

* incremental (A5): ``hour_terms`` for hour h, then ``advance_anomaly(state_{h-1}, terms_h)`` --
  fused into ``anomaly_step`` (one exchange) for the hourly job; each hourly job reads one hour of
  feed, one hour of history and one state partition, so its cost stays flat through the day;
* closed form (W1): ``anomaly_backfill`` scores every hour of a day in one job.

Both replace the reference's joins with a union and a grouped aggregate on the article key: one
shuffle, hash aggregation, no sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING = ("drop", "zero")
METHODS = ("ratio", "canberra")


def _frac(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _terms_from(c: Column, a: Column, kind: str) -> list[Column]:
    diff = F.abs(c - a)
    return [diff.cast(kind).alias("lhs"), (c + a).cast(kind).alias("rhs"),
            _frac(diff, c + a).alias("canberra_sum")]


def _sum_kind(df: DataFrame, column: str) -> str:
    """Sums are BIGINT, or DOUBLE where the averages are exact ones."""
    return "double" if df.schema[column].dataType.typeName() == "double" else "bigint"


def _check(missing: str, method: str | None = None) -> None:
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    if method is not None and method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")


def _paired(cur: DataFrame, hist: DataFrame, keys: list[str], key: str, views: str,
            avg: str, missing: str) -> DataFrame:
    """(keys..., c, a): today's views summed per key (A3) next to the historical average."""
    kind = _sum_kind(hist, avg)
    rest = [k for k in keys if k != key]
    c = cur.select(*rest, F.lower(key).alias(key), F.col(views).cast("bigint").alias("_c"), F.lit(None).cast(kind).alias("_a"))
    a = hist.select(*rest, key, F.lit(None).cast("bigint").alias("_c"), F.col(avg).cast(kind).alias("_a"))
    g = c.unionByName(a).groupBy(*keys).agg(F.sum("_c").alias("c"), F.max("_a").alias("a"))
    if missing == "drop":
        return g.where(F.col("c").isNotNull() & F.col("a").isNotNull())
    return g.select(*keys, F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("a", F.lit(0)).alias("a"))


def hour_terms(cur: DataFrame, hist: DataFrame, missing: str = "drop", key: str = "article",
               views: str = "views", avg: str = "avg_views") -> DataFrame:
    """P9 + J1 + A3 for one hour: (key, lhs, rhs, canberra_sum) of that hour alone.

    ``cur`` holds that hour's feed rows (several per key are summed), ``hist`` that hour's history.
    """
    _check(missing)
    p = _paired(cur, hist, [key], key, views, avg, missing)
    return p.select(key, *_terms_from(F.col("c"), F.col("a"), _sum_kind(hist, avg)))


def advance_anomaly(state: DataFrame | None, terms: DataFrame, missing: str = "drop",
                    key: str = "article") -> DataFrame:
    """A5 + J2: running sums after one more hour. ``state`` is None at hour 0."""
    _check(missing)
    cols = ["lhs", "rhs", "canberra_sum"]
    if state is None:
        return terms.select(key, *cols)
    s = state.select(key, *cols, F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t = terms.select(key, *cols, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    g = (s.unionByName(t).groupBy(key)
          .agg(*[F.sum(c).alias(c) for c in cols], F.max("_s").alias("_s"), F.max("_t").alias("_t")))
    if missing == "drop":
        g = g.where((F.col("_s") == 1) & (F.col("_t") == 1))
    kind = _sum_kind(terms, "lhs")
    return g.select(key, F.col("lhs").cast(kind).alias("lhs"),
                    F.col("rhs").cast(kind).alias("rhs"), "canberra_sum")


def anomaly_step(cur: DataFrame, hist: DataFrame, state: DataFrame | None, missing: str = "drop",
                 key: str = "article", views: str = "views", avg: str = "avg_views", buckets: int | None = None) -> DataFrame:
    """E3's hourly step in one exchange: today's rows for the hour, the history of the hour and the
    running sums of the previous hour are unioned and aggregated once per article, equivalent to
    ``advance_anomaly(state, hour_terms(cur, hist))`` (two exchanges). ``state`` is None at hour 0.

    With ``buckets`` the history and the state come from tables bucketed by key into that many buckets: only the hour's
    rows are dealt to the buckets, and the aggregate runs where the history and the state lie.
    """
    _check(missing)
    kind = _sum_kind(hist, avg)
    cur = cur.select(F.lower(key).alias(key), F.col(views).cast("bigint").alias("_c"))
    if buckets:
        cur = cur.repartition(buckets, key)
    nb, nk, nd = F.lit(None).cast("bigint"), F.lit(None).cast(kind), F.lit(None).cast("double")
    parts = [
        cur.select(key, "_c", nk.alias("_a"), nk.alias("_l"), nk.alias("_r"), nd.alias("_b"), F.lit(0).alias("_s")),
        hist.select(key, nb.alias("_c"), F.col(avg).cast(kind).alias("_a"), nk.alias("_l"),
                    nk.alias("_r"), nd.alias("_b"), F.lit(0).alias("_s")),
    ]
    if state is not None:
        parts.append(state.select(key, nb.alias("_c"), nk.alias("_a"), F.col("lhs").cast(kind).alias("_l"),
                                  F.col("rhs").cast(kind).alias("_r"), F.col("canberra_sum").alias("_b"),
                                  F.lit(1).alias("_s")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy(key).agg(F.sum("_c").alias("c"), F.max("_a").alias("a"), F.sum("_l").alias("pl"),
                           F.sum("_r").alias("pr"), F.sum("_b").alias("pb"), F.max("_s").alias("ps"))
    if missing == "drop":
        keep = F.col("c").isNotNull() & F.col("a").isNotNull()
        if state is not None:
            keep = keep & (F.col("ps") == 1)
        g = g.where(keep)
    c, a = F.coalesce("c", F.lit(0)), F.coalesce("a", F.lit(0))
    diff = F.abs(c - a)
    return g.select(key,
                    (F.coalesce("pl", F.lit(0)) + diff).cast(kind).alias("lhs"),
                    (F.coalesce("pr", F.lit(0)) + c + a).cast(kind).alias("rhs"),
                    (F.coalesce("pb", F.lit(0.0)) + _frac(diff, c + a)).alias("canberra_sum"))


# Names used in the design notes
distance_terms = hour_terms


def anomaly_backfill(cur: DataFrame, hist: DataFrame, last_hour: int = 23, missing: str = "drop",
                     key: str = "article", views: str = "views", avg: str = "avg_views") -> DataFrame:
    """Running sums for every hour 0..``last_hour`` of one day in one job.

    ``cur``: the day's feed (hour, key, views); ``hist``: (hour, key, avg_views).
    Output: hour, key, lhs, rhs, canberra_sum -- one row per article and hour in which the
    incremental chain would hold a state row for it.

    One exchange on ``key``: the pairing aggregate, the gap fill and the running-sum window all run
    inside it, and an article's group is at most 24 rows however hot the article is.
    ``missing='drop'``: keep an hour only if the article was present in every hour 0..h (running
    count = h + 1). ``missing='zero'``: from its first hour on, an article has a row in every hour;
    hours without either side get zero terms (each row is extended to the hour before the next one).
    """
    _check(missing)
    kind = _sum_kind(hist, avg)
    c = cur.where(F.col("hour") <= last_hour).select(
        "hour", F.lower(key).alias(key), F.col(views).cast("bigint").alias("_c"), F.lit(None).cast(kind).alias("_a"))
    h = hist.where(F.col("hour") <= last_hour).select(
        "hour", key, F.lit(None).cast("bigint").alias("_c"), F.col(avg).cast(kind).alias("_a"))
    g = (c.unionByName(h).repartition(key)
          .groupBy("hour", key).agg(F.sum("_c").alias("c"), F.max("_a").alias("a")))
    if missing == "drop":
        g = g.where(F.col("c").isNotNull() & F.col("a").isNotNull())
    else:
        g = g.select("hour", key, F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("a", F.lit(0)).alias("a"))
    t = g.select("hour", key, *_terms_from(F.col("c"), F.col("a"), kind))
    if missing == "zero":
        nxt = F.lead("hour", 1, last_hour + 1).over(Window.partitionBy(key).orderBy("hour"))
        t = t.withColumn("_next", nxt).select(
            key, "lhs", "rhs", "canberra_sum", "hour",
            F.explode(F.sequence(F.col("hour"), F.col("_next") - 1)).alias("_h"))
        keep = F.col("_h") == F.col("hour")
        t = t.select(F.col("_h").alias("hour"), key,
                     *[F.when(keep, F.col(m)).otherwise(F.lit(0)).alias(m) for m in ("lhs", "rhs")],
                     F.when(keep, F.col("canberra_sum")).otherwise(F.lit(0.0)).alias("canberra_sum"))
    run = Window.partitionBy(key).orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = t.select(F.col("hour").cast("int").alias("hour"), key,
                   F.sum("lhs").over(run).cast(kind).alias("lhs"),
                   F.sum("rhs").over(run).cast(kind).alias("rhs"),
                   F.sum("canberra_sum").over(run).alias("canberra_sum"),
                   F.count(F.lit(1)).over(run).alias("_k"))
    if missing == "drop":
        out = out.where(F.col("_k") == F.col("hour") + 1)
    return out.drop("_k")


def with_distance(df: DataFrame, method: str = "ratio", digits: int | None = None) -> DataFrame:
    """Distance column from the running sums."""
    _check("drop", method)
    d = _frac(F.col("lhs"), F.col("rhs")) if method == "ratio" else F.col("canberra_sum")
    if digits is not None:
        d = F.round(d, digits)
    return df.withColumn("distance", d)


def top_anomalies(scored: DataFrame, k: int = 5, by: tuple[str, ...] = ("date", "hour"),
                  key: str = "article") -> DataFrame:
    """The k largest distances per (date, hour), ties by article; adds ``rank``.

    Spark plans ``row_number() <= k`` with a partial WindowGroupLimit before the exchange, so each
    map task forwards at most k rows per hour: the all-articles-in-one-hour group never reaches
    one task whole.
    """
    w = Window.partitionBy(*by).orderBy(F.desc("distance"), F.asc(key))
    return (scored.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k))


def anomaly_member(df: DataFrame, key: str = "article") -> DataFrame:
    """K7 text form: the `article:distance` member string the reference added to its per-hour set."""
    return df.withColumn("member", F.concat_ws(":", F.col(key), F.col("distance").cast("string")))
