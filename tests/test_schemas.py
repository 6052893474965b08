import datetime as dt

from pyspark.sql import functions as F

from viewtide import schemas as sc
from viewtide.operators import anomaly as anom
from viewtide.operators import history as hist
from viewtide.operators import parse as prs
from viewtide.operators import windows as win

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_operator_outputs_conform(spark):
    req = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(minutes=70))], "article string, ts timestamp_ntz")
    assert sc.conforms(win.sliding_counts(req).schema, sc.WINDOW_COUNTS)
    assert sc.conforms(win.trend_series(req).schema, sc.HOUR_SERIES)
    feed = win.hourly_totals(req)
    assert sc.conforms(feed.schema, sc.HOURLY_TOTALS)
    lines = spark.createDataFrame([("a\t1.2.3.4\t1",)], sc.REQUEST_LINE)
    good, bad = prs.parse_requests(lines)
    assert sc.conforms(good.schema, sc.REQUESTS) and sc.conforms(bad.schema, sc.REJECTS)
    logs, _ = prs.parse_hourly_logs(spark.createDataFrame([("en A 1 2", 0)], "value string, hour int"))
    assert sc.conforms(logs.schema, sc.HOURLY_LOG)
    h = hist.historical_average(feed)
    assert sc.conforms(h.schema, sc.HISTORY)
    assert sc.conforms(hist.update_history(h, feed).schema, sc.HISTORY)
    st = anom.anomaly_step(feed, h, None)
    assert sc.conforms(st.schema, sc.ANOMALY_STATE)
    assert sc.conforms(prs.catalogue_from_lines(spark.createDataFrame([("x y",)], "value string")).schema,
                       sc.CATALOGUE)
    scored = anom.with_distance(st).withColumn("date", F.lit(T0.date())).withColumn("hour", F.lit(0))
    ranked = anom.top_anomalies(scored, 5).select("rank", "article", "distance", "date", "hour")
    assert sc.conforms(ranked.schema, sc.ANOMALIES)
