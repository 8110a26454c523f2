"""Incidents, the precision-recall curve and the credit of features, against plain Python."""

import datetime as dt
import math
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from metricwatch.operators.evaluate import average_precision, precision_recall_curve, threshold_for
from metricwatch.operators.forest_model import iforest_credit, iforest_fit, iforest_model_alerts, iforest_score, with_cutoff
from metricwatch.operators.incidents import extend_incidents, incidents
from tests.test_loess_and_model import D0, DAY, FEATURES, points


def history(spark, days=40, seed=2):
    r = random.Random(seed)
    rows = [(d, m, D0 + k * DAY, r.choice(("seasonal_mad", "out_of_range")) if m else "iforest", r.choice((None, round(r.random() * 9, 2))))
            for d in ("a", "b") for m in ("x", "y", None) for k in range(days) for _ in range(r.choice((0, 0, 1, 2)))]
    return rows, spark.createDataFrame(rows, "domain string, metric string, day date, method string, score double")


def plain_incidents(rows, gap):
    out = []
    for key, of in groupby(sorted(rows, key=lambda r: (str(r[:2]), r[2])), lambda r: r[:2]):
        run = []
        for r in [*of, None]:
            if run and (r is None or (r[2] - run[-1][2]).days > gap):
                out.append((*key, run[0][2], run[-1][2], len({x[2] for x in run}), len(run),
                            max((x[4] for x in run if x[4] is not None), default=None), sorted({x[3] for x in run})))
                run = []
            run.append(r)
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("gap", [1, 3])
def test_incidents_whole_and_day_by_day(spark, gap):
    rows, alerts = history(spark, 12 if gap == 3 else 40)
    assert found(incidents(alerts, gap)) == plain_incidents(rows, gap)
    days = sorted({r[2] for r in rows})
    stored = incidents(alerts.where(F.col("day") < days[-6]), gap)
    day = days[-6]
    while day <= days[-1]:  # days without an alert too
        stored = spark.createDataFrame(stored.collect(), stored.schema)
        stored = extend_incidents(stored, alerts.where(F.col("day") == day), day, gap)
        assert found(stored) == plain_incidents([r for r in rows if r[2] <= day], gap)
        day += DAY
    assert incidents(alerts.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_curve_equals_sort_and_scan(spark, parts):
    r = random.Random(5)
    rows = [(round(r.gauss(1 if bad else 0, 1), 1), bad) for bad in (r.random() < 0.2 for _ in range(800))] + [(None, True), (None, False), (0.5, None)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        curve = precision_recall_curve(spark.createDataFrame(rows, "score double, is_anomaly boolean"))
        got = {x.threshold: x for x in curve.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    positive = sum(bool(bad) for _, bad in rows)
    assert set(got) == {s for s, _ in rows if s is not None}
    total = 0.0
    for t, x in got.items():
        hit = [bool(bad) for s, bad in rows if s is not None and s >= t]
        assert (x.alerts, x.tp, x.fp, x.fn) == (len(hit), sum(hit), len(hit) - sum(hit), positive - sum(hit))
        assert x.precision == sum(hit) / len(hit) and x.recall == sum(hit) / positive
        total += x.precision * sum(bool(bad) for s, bad in rows if s == t)
    assert math.isclose(average_precision(curve).head()[0], total / positive, rel_tol=1e-12)
    wanted = threshold_for(curve, 0.5).head()
    assert wanted.threshold == min(t for t, x in got.items() if x.precision >= 0.5) and threshold_for(curve, 1.1).head().threshold is None
    nothing = precision_recall_curve(spark.createDataFrame([(1.0, False)], "score double, is_anomaly boolean")).head()
    assert nothing.recall is None and nothing.precision == 0.0


def plain_credit(tree, row):
    node, credit = 1, [0.0] * len(row)
    while tree.feature[node - 1] is not None:
        f = tree.feature[node - 1]
        child = 2 * node + (row[f] > tree.threshold[node - 1])
        credit[f] += math.log2(tree.size[node - 1] / max(tree.size[child - 1], 0.5))
        node = child
    return credit


def test_credit_by_walking_the_trees(spark):
    df = points(spark, 40)
    model = iforest_fit(df, ["key"], "day", FEATURES, trees=12)
    trees = {r.key: r.trees for r in model.collect()}
    for r in iforest_credit(df, model, ["key"], FEATURES).collect():
        each = [plain_credit(t, [r.x, r.y, r.z or 0.0]) for t in trees[r.key]]
        assert all(math.isclose(a, sum(c) / 12, abs_tol=1e-9) for a, c in zip(r.credit, zip(*each)))
    assert iforest_credit(df.withColumn("key", F.lit("none")), model, ["key"], FEATURES).where("credit IS NOT NULL").count() == 0


@pytest.mark.parametrize("metric", ["x", "y"])
def test_the_planted_metric_is_named_first(spark, metric):
    df = points(spark).withColumn("z", F.lit(7.0) + F.dayofmonth("day") % 5)
    df = df.withColumn(metric, F.when(F.col("day") == D0 + 30 * DAY, 400.0).otherwise(F.col(metric)))
    model = iforest_fit(df, ["key"], "day", FEATURES)
    model = with_cutoff(model, iforest_score(df, model, ["key"], FEATURES), ["key"], contamination=0.02)
    got = iforest_model_alerts(df, model, ["key"], "day", FEATURES).where(F.col("day") == D0 + 30 * DAY).collect()
    assert len(got) == 2 and all(r.affected[0] == metric and sorted(r.affected) == FEATURES for r in got)
