import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from viewtide.operators import windows as win

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _requests(spark, spec):
    """spec: article -> list of 6 counts for the 10-minute slots starting 10:00 (None = none)."""
    rows = []
    for art, counts in spec.items():
        for slot, c in enumerate(counts):
            for j in range(c or 0):
                rows.append((art, T0 + dt.timedelta(minutes=10 * slot, seconds=7 + j)))
    return spark.createDataFrame(rows, "article string, ts timestamp_ntz")


FIXTURE = {"up": [1, 2, 2, 3, 4, 5], "flat": [2] * 6, "down": [5, 4, 4, 3, 2, 1],
           "dip": [1, 2, 3, 2, 4, 5], "gap": [1, None, 1, 1, 1, 1]}


def test_trend_fixture(spark):
    df = _requests(spark, FIXTURE)
    ser = win.trend_series(df).where(F.col("window_start") == T0)
    got = {r.article: [r[f"s{i}"] for i in range(6)] for r in ser.collect()}
    assert set(got) == {"up", "flat", "down", "dip"}  # gap is incomplete
    assert got["up"] == [1, 2, 2, 3, 4, 5]
    tr = win.trending(df).where(F.col("window_start") == T0)
    assert sorted(r.article for r in tr.collect()) == ["flat", "up"]
    r = tr.where(F.col("article") == "up").first()
    assert r.window_end == T0 + dt.timedelta(hours=1)


def test_phase_routing(spark):
    df = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(minutes=59))],
                               "article string, ts timestamp_ntz")
    routed = win.route_by_phase(win.sliding_counts(df), "q")
    ph = {(r.window_start.hour, r.window_start.minute): (r.phase, r.topic) for r in routed.collect()}
    assert ph[(10, 0)] == (0, "q0")
    assert ph[(10, 59)] == (9, "q9")


def _brute_sliding(rows, size_min, slide_min):
    out = Counter()
    for art, t in rows:
        m = int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // 60
        for j in range(size_min // slide_min):
            s = (m // slide_min - j) * slide_min
            if s <= m < s + size_min:
                out[(art, s)] += 1
    return out


def test_window_starts_are_not_held_in_an_aggregate(spark):
    """Many keys with few requests each: only the pre-count aggregates, so no task keeps all its window starts in memory."""
    rnd = random.Random(3)
    rows = [(f"u{rnd.randrange(400)}" if k % 50 else None, T0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))) for k in range(2000)]
    out = win.sliding_counts(spark.createDataFrame(rows, "article string, ts timestamp_ntz"))
    assert out._jdf.queryExecution().sparkPlan().toString().count("HashAggregate(") == 2  # partial and final
    epoch = dt.datetime(1970, 1, 1)
    got = out.collect()
    assert {(r.article, int((r.window_start - epoch).total_seconds()) // 60): r.views for r in got} == dict(_brute_sliding(rows, 10, 1))
    assert len(got) == len(_brute_sliding(rows, 10, 1))


def test_halo_blocks_match_brute_force(spark):
    """Tiny blocks force many block boundaries; results must not depend on them."""
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), T0 + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "article string, ts timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    for block in (3600, 86400):
        got = {(r.article, int((r.window_start - epoch).total_seconds()) // 60): r.views
               for r in win.sliding_counts(df, block_seconds=block).collect()}
        assert got == dict(_brute_sliding(rows, 10, 1))
    # series: brute force slots
    cells = defaultdict(dict)
    for (art, s), c in _brute_sliding(rows, 10, 1).items():
        cells[art][s] = c
    want = set()
    for art, d in cells.items():
        for s in d:
            ser = [d.get(s + 10 * k) for k in range(6)]
            if all(x is not None for x in ser):
                want.add((art, s, tuple(ser)))
    for block in (600, 7200, 86400):
        got = {(r.article, int((r.window_start - epoch).total_seconds()) // 60,
                tuple(r[f"s{i}"] for i in range(6)))
               for r in win.trend_series(df, block_seconds=block).collect()}
        assert got == want


def test_hourly_totals(spark):
    df = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(minutes=59)),
                                ("a", T0 + dt.timedelta(minutes=60)), ("b", T0)],
                               "article string, ts timestamp_ntz")
    got = {(r.hour, r.article): r.views for r in win.hourly_totals(df).collect()}
    assert got == {(10, "a"): 2, (11, "a"): 1, (10, "b"): 1}


def test_series_array(spark):
    df = _requests(spark, {"up": FIXTURE["up"]})
    r = win.with_series(win.trend_series(df).where(F.col("window_start") == T0)).first()
    assert r.series == [1, 2, 2, 3, 4, 5] and r.total_views == 17


def _brute_series(rows, slots, slot_min, slide_min):
    """Every window start s (multiple of the slide) whose first slot holds a request -> slot counts."""
    by_art = defaultdict(list)
    for art, t in rows:
        by_art[art].append(int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // 60)
    out = {}
    for art, mins in by_art.items():
        starts = {(m // slide_min - j) * slide_min for m in mins for j in range(slot_min // slide_min)}
        for s in starts:
            if not any(s <= m < s + slot_min for m in mins):
                continue
            ser = tuple(sum(1 for m in mins if s + k * slot_min <= m < s + (k + 1) * slot_min) or None
                        for k in range(slots))
            out[(art, s)] = ser
    return out



@pytest.mark.parametrize("slots,slot_min,slide_min,block", [(3, 2, 1, 3600), (6, 10, 5, 7200), (4, 60, 60, 86400),
                                                            (2, 120, 30, 10800), (1, 5, 5, 3600)])
def test_series_geometries_match_brute_force(spark, slots, slot_min, slide_min, block):
    rnd = random.Random(slots * 100 + slot_min)
    rows = [(rnd.choice("ab"), T0 + dt.timedelta(seconds=rnd.randrange(0, 10 * 3600))) for _ in range(800)]
    df = spark.createDataFrame(rows, "article string, ts timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    got = {(r.article, int((r.window_start - epoch).total_seconds()) // 60): tuple(r[f"s{i}"] for i in range(slots))
           for r in win.trend_series(df, slots, f"{slot_min} minutes", f"{slide_min} minutes",
                                     complete_only=False, block_seconds=block).collect()}
    assert got == _brute_series(rows, slots, slot_min, slide_min)
    sc = {(r.article, int((r.window_start - epoch).total_seconds()) // 60): r.views
          for r in win.sliding_counts(df, f"{slot_min} minutes", f"{slide_min} minutes", block_seconds=block).collect()}
    assert sc == {k: v[0] for k, v in _brute_series(rows, 1, slot_min, slide_min).items()}


def test_series_slots_equal_phase_aligned_sliding_counts(spark):
    """SURVEY 5.3: slot k of the hour window starting at S is the 10-minute count starting S + 10k."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(F.col("event_type").alias("article"), "ts")
    ser = win.trend_series(ev, complete_only=False)
    sc = win.sliding_counts(ev).select("article", F.col("window_start").alias("ws"), "views")
    for k in range(6):
        shifted = ser.select("article", F.timestamp_add("MINUTE", F.lit(10 * k), "window_start").alias("ws"),
                             F.col(f"s{k}").alias("sk"))
        joined = shifted.join(sc, ["article", "ws"], "left")
        bad = joined.where(~F.col("sk").eqNullSafe(F.col("views"))).count()
        assert bad == 0, (k, bad)
