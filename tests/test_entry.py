import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from viewtide.sources.tables import DRIVER_TABLES

from conftest import SF_SMALL
from tools.oracle_check import digest


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["article", "window_start", "window_end", "s0", "s1", "s2", "s3", "s4", "s5"]
    assert df.count() > 0


def test_every_query_has_oracle():
    from viewtide.plans.catalog import QUERIES  # the training-data queries have tests of their own
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns)[0] == digest(drows, dcols)[0]


@pytest.mark.parametrize("name", ["trending_day", "hourly_totals", "parse_requests", "phase_routed_counts",
                                  "serving_rows", "hourly_totals_stream", "anomaly_backfill_zero"])
def test_queries_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # +05:30: not a whole hour
        df = queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert digest(srows, df.columns)[0] == digest(res.fetchall(), dcols)[0]
