"""Profiles by day that add up: exact counters, bounded errors, no raw rows read when merged."""

import datetime as dt
import statistics

import numpy as np
from pyspark.sql import functions as F

from metricwatch.operators.profiles import COUNTERS, day_profiles, estimates, merge_profiles, profile_changes
from metricwatch.sources.history import read_days, write_days

D0 = dt.date(2024, 1, 1)
DAY = dt.timedelta(days=1)


def raw(spark, days=66, per_day=400, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"acc{int(rng.integers(0, 5000))}" if i % 50 else None, D0 + d * DAY, float(round(rng.lognormal(3, 1), 2)) if i % 40 else None)
            for d in range(days) for i in range(per_day)]
    return rows, spark.createDataFrame(rows, "id string, day date, value double")


def test_merging_reads_no_raw_rows_and_errors_are_bounded(spark, tmp_path):
    rows, df = raw(spark)
    write_days(day_profiles(df, "web", "id", "day", "value"), str(tmp_path / "p"))
    merged = merge_profiles(read_days(spark, str(tmp_path / "p"), D0, D0 + 65 * DAY))
    assert all(str(tmp_path / "p") in f for f in merged.inputFiles()) and merged.inputFiles()
    got = estimates(merged).collect()
    assert len(got) == 1
    got, values = got[0], sorted(v for _, _, v in rows if v is not None)
    assert (got.first_day, got.last_day, got.days, got.rows) == (D0, D0 + 65 * DAY, 66, len(rows))
    assert got.missing_ids == sum(i is None for i, _, _ in rows) and got.missing_values == sum(v is None for _, _, v in rows)
    assert (got.low, got.high) == (values[0], values[-1]) and abs(float(got.total) - sum(values)) < 1e-3
    ids = len({i for i, _, _ in rows if i is not None})
    assert abs(got.ids - ids) <= 0.03 * ids
    for q, v in ((0.05, got.q05), (0.5, got.q50), (0.95, got.q95)):
        assert abs(np.searchsorted(values, v) / len(values) - q) <= 0.02
    whole = estimates(merge_profiles(day_profiles(df.withColumn("day", F.lit(D0)), "web", "id", "day", "value"))).head()
    assert all(whole[c] == got[c] for c in COUNTERS)  # the same as one pass over all rows
    assert statistics.median(values) > 0


def test_profiles_of_odd_days(spark):
    rows = [("a", D0, None), (None, D0, None), ("a", D0 + DAY, 2.0), (None, None, 3.0)]
    df = spark.createDataFrame(rows, "id string, day date, value double")
    got = {r.day: r for r in estimates(day_profiles(df, "x", "id", "day", "value")).collect()}
    assert set(got) == {D0, D0 + DAY, None}
    assert (got[D0].rows, got[D0].missing_ids, got[D0].missing_values, got[D0].low, got[D0].q50, got[D0].ids) == (2, 1, 2, None, None, 1)
    assert (got[D0 + DAY].q50, got[None].ids) == (2.0, 0)
    merged = estimates(merge_profiles(day_profiles(df, "x", "id", "day", "value"))).head()
    assert (merged.rows, merged.missing_values, merged.low, merged.high, merged.ids) == (4, 2, 2.0, 3.0, 1)
    assert merge_profiles(day_profiles(df.limit(0), "x", "id", "day", "value")).count() == 0


def test_changes_against_the_day_before(spark):
    rows = [(f"a{i}", D0 + d * DAY, 10.0) for d in range(4) for i in range(100)]
    rows += [(f"b{i}", D0 + 4 * DAY, 50.0) for i in range(300)] + [("c", D0 + 5 * DAY, None if i else 50.0) for i in range(290)]
    df = spark.createDataFrame(rows, "id string, day date, value double")
    got = {r.day: r for r in profile_changes(day_profiles(df, "x", "id", "day", "value")).collect()}
    assert got[D0].unusual == [] and got[D0].rows_times is None and got[D0 + DAY].unusual == [] and got[D0 + DAY].rows_times == 1.0
    assert got[D0 + 4 * DAY].unusual == ["rows", "ids", "median"] and got[D0 + 5 * DAY].unusual == ["ids", "missing_values"]
