"""Robust Loess against numpy; the forest as a stored model against the forest that scores as it grows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwatch.operators.detect import seasonal_mad
from metricwatch.operators.forest_model import iforest_fit, iforest_model_alerts, iforest_score, with_cutoff
from metricwatch.operators.iforest import iforest_alerts, iforest_scores
from metricwatch.operators.loess import loess_decompose, trend_span
from metricwatch.operators.series import decompose
from metricwatch.sources.history import read_days, write_days
from tests.helpers import isolation_scores, robust_loess

D0 = dt.date(2024, 1, 1)
DAY = dt.timedelta(days=1)


def series(spark, **values):
    rows = [(k, D0 + i * DAY, None if np.isnan(v) else float(v)) for k, ys in values.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "key string, day date, value double")


def waves(n, seed, noise=3.0):
    rng = np.random.default_rng(seed)
    return 100 + 0.7 * np.arange(n) + 20 * np.sin(np.arange(n) * 2 * np.pi / 7) + rng.normal(0, noise, n)


@pytest.mark.parametrize("period,span,rounds", [(7, None, 2), (7, 21, 1), (4, 5, 0), (7, None, 4)])
def test_loess_equals_numpy(spark, period, span, rounds):
    spiky = waves(40, 1)
    spiky[[13, 14]] += 500
    holes = waves(33, 2)
    holes[[0, 5, 20]] = np.nan
    data = {"a": waves(66, 0), "spiky": spiky, "holes": holes, "short": waves(2 * period, 4), "flat": np.full(30, 5.0), "tiny": waves(3, 5)}
    got = loess_decompose(series(spark, **data), ["key"], "day", "value", period, rounds, span).orderBy("key", "day").collect()
    for key, y in data.items():
        rows = [r for r in got if r.key == key]
        assert [r.pos for r in rows] == list(range(len(y))) and {r.n for r in rows} == {len(y)}
        if len(y) < 2 * period:
            assert all(r.trend is None and r.seasonal is None and r.resid is None and r.weight is None for r in rows)
            continue
        want = robust_loess(y, period, span or trend_span(period), rounds)
        for name, w in zip(("trend", "seasonal", "resid", "weight"), want):
            have = np.array([np.nan if r[name] is None else r[name] for r in rows])
            known = ~np.isnan(y)  # a missing value has no season or residual of its own
            if name == "trend" or name == "weight":
                known = np.ones(len(y), bool)
            assert np.allclose(have[known], w[known], rtol=0, atol=1e-9), (key, name)


def test_a_spike_bends_nothing(spark):
    clean = waves(66, 7, noise=1.0)
    spike = clean.copy()
    spike[30] += 1000

    def trends(f):
        df = series(spark, clean=clean, spike=spike)
        out = {(r.key, r.pos): r.trend for r in f(df).collect()}
        return max(abs(out["clean", k] - out["spike", k]) for k in range(26, 35) if k != 30)
    assert trends(lambda df: decompose(df, ["key"], "day", "value")) > 100
    assert trends(lambda df: loess_decompose(df, ["key"], "day", "value")) < 1.0


def test_loess_in_the_detector(spark):
    y = waves(66, 8, noise=1.0)
    y[40] += 60
    got = seasonal_mad(series(spark, a=y), ["key"], "day", "value", k=6.0, metric_col=None, decomposition="loess").collect()
    assert [(r.day, r.type) for r in got if abs(r.score) > 10] == [(D0 + 40 * DAY, "spike")]
    with pytest.raises(ValueError):
        seasonal_mad(series(spark, a=y), ["key"], "day", "value", decomposition="other")


def points(spark, n=60, seed=3, keys=("a", "b"), copies=1):
    rng = np.random.default_rng(seed)
    rows = [(k, D0 + i * DAY, float(rng.normal(50, 5)), float(rng.integers(0, 4)), None if i % 17 == 0 else 7.0) for k in keys for i in range(n)]
    return spark.createDataFrame(rows * copies, "key string, day date, x double, y double, z double")


FEATURES = ["x", "y", "z"]


def by_row(df):
    return sorted((str(r.key), r.day, r.x, r.score if r.score is None else round(r.score, 9), round(r.mean_path, 9), r.n, r.psi) for r in df.collect())


@pytest.mark.parametrize("n,sample,copies", [(60, 256, 1), (1, 256, 1), (2, 256, 1), (90, 16, 1), (40, 32, 3)])
def test_model_scores_equal_the_forest(spark, n, sample, copies):
    df = points(spark, n, copies=copies)
    df = df.unionByName(df.where("key = 'a'").withColumn("key", F.lit(None).cast("string")))
    model = iforest_fit(df, ["key"], "day", FEATURES, trees=25, sample=sample)
    assert model.count() == 3 and model.where("size(trees) <> 25").count() == 0
    assert model.where(f"exists(trees, t -> size(t.feature) >= 2 * {max(2, sample) * 2} OR size(t.feature) <> size(t.size))").count() == 0
    got = by_row(iforest_score(df, model, ["key"], FEATURES))
    if copies == 1:
        want = by_row(iforest_scores(df.where("key IS NOT NULL"), ["key"], "day", FEATURES, trees=25, sample=sample))
        assert [r for r in got if r[0] != "None"] == want
    if n == 1:
        assert all(r[3] is None for r in got)
        return
    plain = df.where("key = 'a'").orderBy("day", *FEATURES).collect()
    scores = isolation_scores("a", [(r.day, [r.x, r.y, r.z or 0.0]) for r in plain], trees=25, sample=sample)
    assert [r[3] for r in got if r[0] == "a"] == [s for _, _, s in sorted((r.day, r.x, round(s, 9)) for r, s in zip(plain, scores))]


def test_a_stored_model_scores_new_days_without_the_old_rows(spark, tmp_path):
    df, path = points(spark), str(tmp_path / "model")
    old, new = df.where(F.col("day") < D0 + 59 * DAY), df.where(F.col("day") == D0 + 59 * DAY)
    new = new.withColumns({c: F.when(F.col("key") == "b", 500.0).otherwise(F.col(c)) for c in "xy"})
    fitted = iforest_fit(old, ["key"], "day", ["x", "y"])
    fitted = with_cutoff(fitted, iforest_score(old, fitted, ["key"], ["x", "y"]), ["key"], contamination=0.05)
    write_days(fitted.withColumn("day", F.lit(D0 + 58 * DAY)), path)
    model = read_days(spark, path, D0 + 58 * DAY).drop("day")
    a = iforest_model_alerts(new, model, ["key"], "day", ["x", "y"]).collect()
    assert [(r.key, r.day, r.method) for r in a if r.key == "b"] == [("b", D0 + 59 * DAY, "iforest")] and a[-1].score > 0
    assert iforest_score(new.withColumn("key", F.lit("unknown")), model, ["key"], ["x", "y"]).where("score IS NOT NULL").count() == 0
    plan = iforest_score(new, model, ["key"], ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and "Python" not in plan


def test_model_cutoff_is_the_percentile(spark):
    df = points(spark)
    model = iforest_fit(df, ["key"], "day", FEATURES)
    scored = iforest_score(df, model, ["key"], FEATURES)
    full = with_cutoff(model, scored, ["key"], percentile=95.0)
    got = iforest_model_alerts(df, full, ["key"], "day", FEATURES).select("key", "day", "score")
    want = iforest_alerts(df, ["key"], "day", FEATURES, percentile=95.0).select("key", "day", "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_empty_tables(spark):
    df = points(spark).limit(0)
    model = iforest_fit(df, ["key"], "day", FEATURES)
    assert model.count() == 0 and iforest_score(points(spark), model, ["key"], FEATURES).where("score IS NULL").count() == 120
    assert loess_decompose(df, ["key"], "day", "x").count() == 0
