import datetime as dt

from pyspark.sql import functions as F

from viewtide.functions import (article_link_text, article_url, is_valid_ipv4, split_fields,
                                time_labels, to_long)
from viewtide.functions.timecols import to_event_time, to_wall_time

VALID = ["1.2.3.4", "001.2.3.4", "0.0.0.0", "100.99.199.255", "+1.2.3.4", "-0.2.3.4"]
INVALID = ["256.1.1.1", "1.2.3.", "1.2.3.4.", "1..3.4", "", None, "1.2.3", "a.b.c.d", "-1.2.3.4",
           " 1.2.3.4", "1.2.3.4\n", "1.2.3.4.5"]


def test_ipv4_rule(spark):
    rows = [(ip,) for ip in VALID + INVALID]
    got = dict(spark.createDataFrame(rows, "ip string").select("ip", is_valid_ipv4("ip").alias("ok"))
               .collect())
    assert all(got[ip] for ip in VALID)
    assert not any(got[ip] for ip in INVALID)


def test_split_java_and_python(spark):
    df = spark.createDataFrame([("a\tb\t\t",), ("\t\t",), ("a",)], "v string")
    java = [r[0] for r in df.select(split_fields("v", "\t", keep_trailing=False)).collect()]
    py = [r[0] for r in df.select(split_fields("v", "\t", keep_trailing=True)).collect()]
    assert java == [["a", "b"], [], ["a"]]
    assert py == [["a", "b", "", ""], ["", "", ""], ["a"]]


def test_to_long_is_strict(spark):
    df = spark.createDataFrame([("12",), ("+7",), ("-3",), (" 1",), ("1.5",), ("x",),
                                ("99999999999999999999",)], "v string")
    assert [r[0] for r in df.select(to_long("v")).collect()] == [12, 7, -3, None, None, None, None]


def test_time_labels_roll_over(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 35, 7),)], "t timestamp_ntz")
    labels = df.select(time_labels("t")).first()[0]
    assert labels == ["23:35:07", "23:45:07", "23:55:07", "00:05:07", "00:15:07", "00:25:07"]


def test_article_link(spark):
    df = spark.createDataFrame([("abcdefghijklmnopqrst",)], "a string")
    r = df.select(article_url("a"), article_link_text("a")).first()
    assert r[0] == "https://en.wikipedia.org/wiki/abcdefghijklmnopqrst"
    assert r[1] == "https://en.wikipedia.org/wiki/fghijklmnopqrst"


def test_event_time_round_trip_is_zone_free(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    df = spark.createDataFrame([(t,)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = df.select(F.unix_micros(to_event_time("t")).alias("u"),
                      to_wall_time(to_event_time("t")).alias("w")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.u == 1704103200123456
    assert r.w == t


def _ip_model(ip):
    """The rule as specified: non-empty; four dot-separated parts once trailing empty parts are
    dropped; each an integer with optional sign, 0..255; no trailing dot."""
    import re
    if not ip:
        return False
    parts = ip.split(".")
    while parts and parts[-1] == "":
        parts.pop()
    if len(parts) != 4 or ip.endswith("."):
        return False
    for p in parts:
        if not re.fullmatch(r"[+-]?[0-9]+", p):
            return False
        v = int(p)
        if not (-2**31 <= v < 2**31) or not (0 <= v <= 255):
            return False
    return True


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+- ", min_size=0, max_size=18), min_size=40, max_size=80))
def test_ipv4_rule_matches_model(spark, ips):
    ips = ips + ["1.2.3.4", "255.255.255.255", "0.0.0.256", "+1.-0.00.9", "1.2.3.4.."]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, ip string")
    got = {r.i: r.ok for r in df.select("i", is_valid_ipv4("ip").alias("ok")).collect()}
    assert all(got[i] == _ip_model(ip) for i, ip in enumerate(ips))


def test_clock_and_phase_of_instants_ignore_session_zone(spark):
    from pyspark.sql import types as T
    from viewtide.functions import clock_stamp, phase
    t = dt.datetime(2024, 1, 1, 10, 59, 7, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(t,)], "t timestamp")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        r = df.select(clock_stamp("t", T.TimestampType()).alias("c"), phase("t").alias("p")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.c, r.p) == ("10:59:07", 9)
