from viewtide.operators.history import historical_average, update_history


def _hist(spark):
    obs = spark.createDataFrame([(0, "main_page", 10), (0, "main_page", 5), (0, "cat", 7), (0, "cat", 8)],
                                "hour int, article string, views bigint")
    return historical_average(obs)


def test_day_fold_fixture(spark):
    day = spark.createDataFrame([(0, "cat", 9), (0, "dog", 4)], "hour int, article string, views bigint")
    got = {r.article: (r.sum_views, r.n, r.avg_views) for r in update_history(_hist(spark), day).collect()}
    assert got == {"cat": (24, 3, 8), "main_page": (15, 2, 7), "dog": (4, 1, 4)}


def test_day_rows_sum_to_one_observation(spark):
    day = spark.createDataFrame([(0, "cat", 4), (0, "cat", 5)], "hour int, article string, views bigint")
    got = {r.article: (r.sum_views, r.n) for r in update_history(_hist(spark), day).collect()}
    assert got["cat"] == (24, 3)


def test_repeated_fold_equals_recompute(spark):
    days = [[(0, "a", 3), (1, "a", 4), (0, "b", 1)], [(0, "a", 5), (1, "c", 2)], [(1, "a", 1), (0, "b", 7)]]
    schema = "hour int, article string, views bigint"
    hist = historical_average(spark.createDataFrame(days[0], schema))
    for d in days[1:]:
        hist = update_history(hist, spark.createDataFrame(d, schema))
    full = historical_average(spark.createDataFrame([r for d in days for r in d], schema))
    key = lambda df: sorted((r.hour, r.article, r.sum_views, r.n, r.avg_views) for r in df.collect())
    assert key(hist) == key(full)


def test_exact_average(spark):
    got = {r.article: r.avg_views for r in historical_average(
        spark.createDataFrame([(0, "x", 7), (0, "x", 8)], "hour int, article string, views bigint"),
        exact=True).collect()}
    assert got == {"x": 7.5}


from hypothesis import given, settings, strategies as st  # noqa: E402

_obs = st.tuples(st.integers(0, 2), st.sampled_from("abcd"), st.integers(0, 50))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(_obs, max_size=8), min_size=2, max_size=4))
def test_fold_equals_recompute_property(spark, days):
    schema = "hour int, article string, views bigint"
    # the fold counts a day's rows for one (hour, article) as one observation: model that directly
    def day_obs(d):
        agg = {}
        for h, a, v in d:
            agg[(h, a)] = agg.get((h, a), 0) + v
        return [(h, a, v) for (h, a), v in agg.items()]
    hist = historical_average(spark.createDataFrame(day_obs(days[0]), schema))
    for d in days[1:]:
        hist = update_history(hist, spark.createDataFrame(d, schema))
        hist = spark.createDataFrame(hist.collect(), hist.schema)
    full = historical_average(spark.createDataFrame([o for d in days for o in day_obs(d)], schema))
    key = lambda df: sorted((r.hour, r.article, r.sum_views, r.n, r.avg_views) for r in df.collect())
    assert key(hist) == key(full)
