"""Decomposition, medians and bounds in blocks against the window plans and plain Python."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwatch.operators.detect import scored_series
from metricwatch.operators.long_series import bounds_blocks, decompose_blocks, medians, with_positions
from metricwatch.operators.series import decompose

D0 = dt.date(2020, 1, 1)


def series(spark, lengths, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(k, i * 3, float(50 + i % 7 * 4 + 0.1 * i + rng.normal())) for k, n in lengths.items() for i in range(n)]
    return spark.createDataFrame(rows, "key string, at int, value double").repartition(5)


def close(a, b, columns):
    a, b = ({(r.key, r["at"]): r for r in df.collect()} for df in (a, b))
    assert a.keys() == b.keys()
    for k, r in a.items():
        for c in columns:
            assert (r[c] is None) == (b[k][c] is None) and (r[c] is None or abs(r[c] - b[k][c]) < 1e-9), (k, c)


@pytest.mark.parametrize("period,block", [(7, 7), (7, 20), (4, 5), (7, 1000)])
def test_blocks_equal_the_window_plan(spark, period, block):
    df = series(spark, {"a": 100, "b": 33, "c": 14, "d": 5, "e": 1})
    close(decompose_blocks(df, ["key"], "at", "value", period, block), decompose(df, ["key"], "at", "value", period),
          ["pos", "n", "trend", "seasonal", "resid"])


@pytest.mark.parametrize("left_over", [1, 3, 10_000])
def test_bounds_equal_the_window_plan(spark, left_over):
    df = series(spark, {"a": 101, "b": 34, "c": 14, "d": 5})
    df = df.withColumn("value", F.when(F.col("at") == 60, 900.0).otherwise(F.col("value")))
    got = bounds_blocks(df, ["key"], "at", "value", rows_per_block=10, left_over=left_over)
    want = scored_series(df, ["key"], "at", "value")
    close(got, want, ["resid", "resid_median", "mad", "lower", "upper"])
    assert {(r.key, r["at"]) for r in got.where("is_outlier").collect()} == {(r.key, r["at"]) for r in want.where("is_outlier").collect()}


def test_positions_with_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "key string, at int")
    assert sorted(((r.key, r["at"], r.pos, r.n) for r in with_positions(df, ["key"], "at", 1).collect()), key=str) == [
        ("a", 5, 0, 1), (None, 1, 0, 2), (None, 2, 1, 2)]


@pytest.mark.parametrize("left_over", [1, 4])
def test_medians_of_odd_values(spark, left_over):
    rng = np.random.default_rng(1)
    values = {"ties": [1.0] * 50 + [2.0] * 50, "same": [3.0] * 9, "one": [7.0], "two": [1.0, 4.0], "wide": [10.0 ** k for k in range(-150, 150, 7)],
              "normal": rng.normal(0, 1, 301).tolist(), "negative": [-5.0, -1.0, -1.0, 0.0, 1e9], "nulls": [None, 2.0, None], "none": [None]}
    rows = spark.createDataFrame([(k, i % 3, v) for k, vs in values.items() for i, v in enumerate(vs)], "key string, _block bigint, v double")
    got = {r.key: r._median for r in medians(rows, ["key"], "v", left_over).collect()}
    assert got == {k: statistics.median(x for x in vs if x is not None) for k, vs in values.items() if any(x is not None for x in vs)}


def test_a_series_of_a_million_rows_in_blocks(spark):
    """No task gets more than a block; the planted rows are found."""
    n, block = 1_000_000, 50_000
    df = spark.range(n).select(F.lit("a").alias("key"), F.col("id").alias("at"), (F.col("id") % 7 * 3.0 + F.rand(5)).alias("value"))
    df = df.withColumn("value", F.when(F.col("id" if "id" in df.columns else "at").isin(123_456, 777_777), 500.0).otherwise(F.col("value")))
    out = bounds_blocks(df, ["key"], "at", "value", k=50.0, rows_per_block=block)
    assert {123_456, 777_777} <= {r["at"] for r in out.where("is_outlier AND pos = at").collect()}
    rows = with_positions(df, ["key"], "at", block)
    assert rows.groupBy("_block").count().agg(F.max("count")).head()[0] == block
    ranges = df.repartitionByRange(n // block, "key", "at").groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
    assert ranges <= 3 * block
