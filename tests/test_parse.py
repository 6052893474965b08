import os

from viewtide.operators.parse import (catalogue_from_lines, parse_hourly_logs, parse_requests,
                                      parse_window_counts)
from viewtide.operators.history import historical_average
from viewtide.sources.files import read_catalogue, read_hourly_logs


def test_parse_requests(spark):
    lines = ["a\t1.2.3.4\t1704103200", "b\t256.1.1.1\t1", "c\t1.2.3.4\tx1", "d\t1.2.3.4",
             "e\t001.2.3.4\t1704103200\textra", "f\t1.2.3.4\t99999999999999", None, ""]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    good, bad = parse_requests(df)
    g = {r.article: r for r in good.collect()}
    assert set(g) == {"a", "e"}
    assert g["a"].ip == "1.2.3.4"
    assert str(g["a"].ts.astimezone(__import__("datetime").timezone.utc)) == "2024-01-01 10:00:00+00:00"
    reasons = {r.line: r.reason for r in bad.collect()}
    assert reasons["b\t256.1.1.1\t1"] == "ip"
    assert reasons["c\t1.2.3.4\tx1"] == "timestamp"
    assert reasons["d\t1.2.3.4"] == "fields"
    assert reasons["f\t1.2.3.4\t99999999999999"] == "timestamp"
    assert reasons[""] == "fields" and reasons[None] == "fields"


def test_parse_window_counts(spark):
    df = spark.createDataFrame([("a\t10:00:00\t5",), ("b\t10:00:00\tx",), ("c",)], "value string")
    good, bad = parse_window_counts(df)
    assert [(r.article, r.clock, r.views) for r in good.collect()] == [("a", "10:00:00", 5)]
    assert sorted(r.reason for r in bad.collect()) == ["count", "fields"]


HOUR00 = ["en Main_Page 10 999", "de main_page 5 111", "en Cat 7 50", "en Cat 8 50", "en bad 3",
          "en X abc 4", ""]


def test_hourly_logs_fixture(spark):
    df = spark.createDataFrame([(v, 0) for v in HOUR00], "value string, hour int")
    good, bad = parse_hourly_logs(df)
    hist = {r.article: (r.sum_views, r.n, r.avg_views) for r in historical_average(good).collect()}
    assert hist == {"main_page": (15, 2, 7), "cat": (15, 2, 7)}
    reasons = {r.line: r.reason for r in bad.collect()}
    assert reasons == {"en bad 3": "arity", "": "arity", "en X abc 4": "views"}


def test_read_hourly_logs_folders(spark, tmp_dir):
    for hh, lines in (("00", HOUR00), ("13", ["en Dog 4 1"])):
        os.makedirs(f"{tmp_dir}/{hh}")
        with open(f"{tmp_dir}/{hh}/part-0000", "w") as f:
            f.write("\n".join(lines) + "\n")
    good, _ = parse_hourly_logs(read_hourly_logs(spark, tmp_dir))
    got = {(r.hour, r.article): r.avg_views for r in historical_average(good).collect()}
    assert got == {(0, "main_page"): 7, (0, "cat"): 7, (13, "dog"): 4}


def test_catalogue(spark, tmp_dir):
    p = f"{tmp_dir}/wikiList"
    with open(p, "w") as f:
        f.write("en Main_Page 1 2\nde Katze 3 4\nlonely\n")
    assert sorted(r.article for r in read_catalogue(spark, p).collect()) == ["katze", "main_page"]
    df = spark.createDataFrame([("small ring",)], "value string")
    assert catalogue_from_lines(df).first().article == "ring"


from hypothesis import given, settings, strategies as st  # noqa: E402


def _java_field_count(line):
    """Java String.split(sep) with limit 0: split, then drop trailing empty strings; a string with
    no separator is one field."""
    if "\t" not in line:
        return 1
    parts = line.split("\t")
    while parts and parts[-1] == "":
        parts.pop()
    return len(parts)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab\t ", min_size=0, max_size=10), min_size=30, max_size=60))
def test_field_count_regex_matches_java_split(spark, lines):
    from viewtide.operators.parse import _min_java_fields
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = {r.i: r.ok for r in df.select("i", _min_java_fields("value", "\t", 3).alias("ok")).collect()}
    assert all(got[i] == (_java_field_count(v) >= 3) for i, v in enumerate(lines))
