import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from metricwatch.operators.detect import scored_series, seasonal_mad
from metricwatch.operators.iforest import iforest_alerts, iforest_scores
from metricwatch.operators.series import decompose
from tests.helpers import classical_decompose, mad_flags

D0 = dt.date(2024, 1, 1)


def series_df(spark, values_by_key):
    rows = [(k, D0 + dt.timedelta(days=i), float(v)) for k, vals in values_by_key.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k string, day date, v double")


def test_decompose_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    data = {f"s{i}": rng.poisson(100, n) + 20 * np.sin(np.arange(n) * 2 * np.pi / 7) for i, n in enumerate([14, 15, 30, 66])}
    out = decompose(series_df(spark, data), ["k"], "day", "v").toPandas()
    for k, y in data.items():
        t, s, r = classical_decompose(np.asarray(y, float))
        got = out[out.k == k].sort_values("day")
        np.testing.assert_allclose(got.trend, t, atol=1e-9)
        np.testing.assert_allclose(got.seasonal, s, atol=1e-9)
        np.testing.assert_allclose(got.resid, r, atol=1e-9)
        np.testing.assert_allclose(got.trend + got.seasonal + got.resid, y, atol=1e-9)
        # the seven phase means of the seasonal component sum to 0
        assert abs(sum(got.seasonal.iloc[:7])) < 1e-9


def test_mad_flags_match_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(100, 10, 66)
    y[[5, 40]] = [300, -50]
    s = scored_series(series_df(spark, {"a": y}), ["k"], "day", "v", k=3.2).toPandas().sort_values("day")
    _, _, r = classical_decompose(y)
    med, mad, flags = mad_flags(r, 3.2)
    assert abs(s.mad.iloc[0] - mad) < 1e-9 and abs(s.resid_median.iloc[0] - med) < 1e-9
    assert list(s.is_outlier) == list(flags)
    assert s.is_outlier.iloc[5] and s.is_outlier.iloc[40]


def test_length_guard(spark):
    y = [10, 12, 30, 11, 10, 9, 10] * 3
    a13 = seasonal_mad(series_df(spark, {"a": y[:13]}), ["k"], "day", "v", k=0.1, metric_col=None)
    a14 = scored_series(series_df(spark, {"a": y[:14]}), ["k"], "day", "v", k=0.1)
    assert a13.count() == 0
    assert a14.count() == 14


def test_constant_series_no_alert(spark):
    s = scored_series(series_df(spark, {"a": [5.0] * 30}), ["k"], "day", "v").toPandas()
    assert (s.mad == 1e-6).all() and not s.is_outlier.any()


def test_pure_pattern_plus_line_no_alert(spark):
    n = 66
    y = 3.0 * np.arange(n) + np.tile([5, -2, 7, 0, 1, -4, -7], 10)[:n] + 1000
    s = scored_series(series_df(spark, {"a": y}), ["k"], "day", "v", k=3.2).toPandas()
    assert s.resid.abs().max() < 1e-9
    assert not s.is_outlier.any()


def test_planted_anomalies(spark):
    rng = np.random.default_rng(42)
    n = 61
    t = np.arange(n)
    sessions = rng.poisson(1000, n) + np.sin(t * 2 * np.pi / 7) * 200
    leads = rng.poisson(50, n) + np.sin(t * 2 * np.pi / 7) * 10
    spend = rng.normal(800, 100, n)
    sessions[10], leads[25], spend[40] = 5000, 5, 3000
    rows = [("d", D0 + dt.timedelta(days=i), m, float(v)) for m, arr in
            (("sessions", sessions), ("leads", leads), ("spend", spend)) for i, v in enumerate(arr)]
    long = spark.createDataFrame(rows, "domain string, day date, metric string, value double")
    a = seasonal_mad(long, ["domain", "metric"], "day", "value", k=3.2).toPandas()
    hits = {(r.metric, (r.day - D0).days, r.type) for r in a.itertuples()}
    assert ("sessions", 10, "spike") in hits
    assert ("leads", 25, "drop") in hits
    assert ("spend", 40, "spike") in hits


def test_latest_only_requires_cutoff_day(spark):
    y = list(np.tile([10, 12, 30, 11, 10, 9, 10], 5)) + [500]
    df = series_df(spark, {"a": y})
    last = D0 + dt.timedelta(days=len(y) - 1)
    hit = seasonal_mad(df, ["k"], "day", "v", latest_only=True, cutoff=last, metric_col=None).collect()
    miss = seasonal_mad(df, ["k"], "day", "v", latest_only=True, cutoff=last + dt.timedelta(days=1), metric_col=None).collect()
    assert len(hit) == 1 and hit[0].day == last and hit[0].type == "spike"
    assert miss == []


def test_results_independent_of_partitioning(spark):
    rng = np.random.default_rng(11)
    data = {f"s{i}": rng.poisson(50, 40) for i in range(6)}
    df = series_df(spark, data)
    a = sorted(map(tuple, seasonal_mad(df, ["k"], "day", "v", k=1.5, metric_col=None).drop("affected", "context").collect()))
    b = sorted(map(tuple, seasonal_mad(df.repartition(5).orderBy(F.rand(3)), ["k"], "day", "v", k=1.5,
                                       metric_col=None).drop("affected", "context").collect()))
    assert a == b and len(a) > 0


def forest_df(spark, n, outlier_at=None, keys=("a",)):
    rng = np.random.default_rng(5)
    rows = []
    for k in keys:
        for i in range(n):
            x = rng.normal(100, 5, 3)
            if i == outlier_at:
                x = np.array([400.0, 2.0, 900.0])
            rows.append((k, D0 + dt.timedelta(days=i), *map(float, x)))
    return spark.createDataFrame(rows, "k string, day date, f1 double, f2 double, f3 double")


def test_forest_scores_and_planted_outlier(spark):
    s = iforest_scores(forest_df(spark, 66, outlier_at=30), ["k"], "day", ["f1", "f2", "f3"]).toPandas()
    assert ((s.score > 0) & (s.score <= 1)).all()
    top = s.sort_values("score", ascending=False).iloc[0]
    assert (top.day - D0).days == 30


def test_forest_against_brute_force_with_repeated_rows(spark):
    from tests.helpers import isolation_scores
    rng = np.random.default_rng(9)
    for n, sample in ((21, 256), (70, 32), (300, 256)):
        rows = [("a", D0 + dt.timedelta(days=i), *map(float, rng.integers(0, 30, 2))) for i in range(n - 3)]
        rows = sorted(rows + [rows[4], rows[4], rows[9]], key=lambda r: r[1:])  # repeated days, features and all
        df = spark.createDataFrame(rows, "k string, day date, f1 double, f2 double").repartition(3)
        got = iforest_scores(df, ["k"], "day", ["f1", "f2"], trees=10, sample=sample).collect()
        want = isolation_scores("a", [(str(r[1]), list(r[2:])) for r in rows], trees=10, sample=sample)
        assert len(got) == n and all(r.n == n for r in got)
        key = lambda r: (r.day, r.f1, r.f2, r.score)
        np.testing.assert_allclose([r.score for r in sorted(got, key=key)],
                                   [s for _, s in sorted(zip(rows, want))], atol=1e-12)


def test_forest_min_rows(spark):
    feats = ["f1", "f2", "f3"]
    assert iforest_alerts(forest_df(spark, 9, 3), ["k"], "day", feats, contamination=0.2).count() == 0
    assert iforest_alerts(forest_df(spark, 10, 3), ["k"], "day", feats, contamination=0.2).count() > 0
    last = D0 + dt.timedelta(days=18)
    assert iforest_alerts(forest_df(spark, 19, 18), ["k"], "day", feats, min_rows=20, latest_only=True,
                          cutoff=last).count() == 0
    got = iforest_alerts(forest_df(spark, 20, 19), ["k"], "day", feats, min_rows=20, latest_only=True,
                         cutoff=last + dt.timedelta(days=1)).collect()
    assert len(got) == 1 and got[0].score is None and got[0].context["f1"] == 400.0


def test_forest_subsample_longer_series(spark):
    s = iforest_scores(forest_df(spark, 300, outlier_at=150), ["k"], "day", ["f1", "f2", "f3"], sample=64).toPandas()
    assert (s.psi == 64).all() and len(s) == 300
    assert (s.sort_values("score", ascending=False).iloc[0].day - D0).days == 150


def test_forest_standardize_and_percentile(spark):
    a = iforest_alerts(forest_df(spark, 66, outlier_at=12), ["k"], "day", ["f1", "f2", "f3"], percentile=99.0,
                       standardize=True).collect()
    assert len(a) == 1 and (a[0].day - D0).days == 12 and a[0].context["f3"] == 900.0


def test_fill_days_follows_calendar(spark):
    # 42 days with every 5th day missing: with fill_calendar the gaps become 0-valued rows
    days = [i for i in range(42) if i % 5 != 4]
    rows = [("a", D0 + dt.timedelta(days=i), 100.0 + (i % 7) * 10) for i in days]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    plain = decompose(df, ["k"], "day", "v").toPandas()
    filled = decompose(df, ["k"], "day", "v", fill_calendar=True).toPandas().sort_values("day")
    assert len(plain) == len(days) and len(filled) == 42
    assert (filled[filled.day.map(lambda d: (d - D0).days % 5 == 4)].v == 0).all()
    t, s, r = classical_decompose(filled.v.to_numpy())
    np.testing.assert_allclose(filled.resid, r, atol=1e-9)


def test_latest_row(spark):
    from metricwatch.operators.series import latest
    df = series_df(spark, {"a": [1, 2, 3], "b": [4, 5]})
    got = sorted((r.k, r.day) for r in latest(df, ["k"], "day").collect())
    assert got == [("a", D0 + dt.timedelta(days=2)), ("b", D0 + dt.timedelta(days=1))]
    only = latest(df, ["k"], "day", cutoff=D0 + dt.timedelta(days=2)).collect()
    assert [r.k for r in only] == ["a"]


def test_anscombe(spark):
    from metricwatch.functions.columns import anscombe
    v = spark.createDataFrame([(0.0,), (10.0,)], "x double").select(anscombe("x")).collect()
    assert abs(v[0][0] - 2 * np.sqrt(0.375)) < 1e-12 and abs(v[1][0] - 2 * np.sqrt(10.375)) < 1e-12


def test_even_period_matches_brute_force(spark):
    rng = np.random.default_rng(21)
    y = rng.normal(50, 5, 40) + 8 * np.tile([1, -1, 2, 0, -2, 0], 7)[:40]
    out = decompose(series_df(spark, {"a": y}), ["k"], "day", "v", period=6).toPandas().sort_values("day")
    t, s, r = classical_decompose(y, period=6)
    np.testing.assert_allclose(out.trend, t, atol=1e-9)
    np.testing.assert_allclose(out.resid, r, atol=1e-9)
