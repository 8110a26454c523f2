"""Data-quality operators: C3, F16 (missing days), F17 (range rules), D13, L5 (validation)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Valid ranges per metric from the reference configuration (inclusive).
DEFAULT_RANGES = [("sessions", 0.0, 100000.0), ("leads", 0.0, 10000.0), ("spend", 0.0, 50000.0)]


def _day(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)))


def missing_days(df: DataFrame, key: list[str], order: str, start, end,
                 keys: DataFrame | None = None) -> DataFrame:
    """Every (key, day) between ``start`` and ``end`` (inclusive) that has no row in ``df``.

    ``keys`` lists the expected series (e.g. every domain of the dictionary, so that fully
    silent series are found); by default the distinct keys present in ``df``. The calendar is
    generated per key with ``explode(sequence(start, end))`` (bounded by the window), then
    anti-joined with the observed (key, day) pairs: no cross join.
    """
    k = (keys if keys is not None else df).select(*key).distinct()
    expected = k.select(*key, F.explode(F.sequence(_day(start), _day(end))).alias(order))
    seen = df.select(*key, F.col(order)).filter(F.col(order).between(_day(start), _day(end))).distinct()
    return expected.join(seen, [*key, order], "left_anti")


def missing_day_alerts(missing: DataFrame, key: list[str], order: str) -> DataFrame:
    """F16: C3 rows as alerts (method missing_day, type missing)."""
    return missing.select(
        *[F.col(c) for c in key],
        F.col(order).alias("day"),
        F.lit(None).cast("string").alias("metric"),
        F.lit("missing_day").alias("method"),
        F.lit("missing").alias("type"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("double").alias("relative_magnitude"),
        F.array().cast("array<string>").alias("affected"),
        F.create_map().cast("map<string,double>").alias("context"),
        F.lit("tolerance=0").alias("params"),
    )


def range_rules(spark: SparkSession, rules: list[tuple[str, float, float]] | None = None) -> DataFrame:
    """The (metric, lo, hi) rules as a small DataFrame (3 rows by default)."""
    return spark.createDataFrame(rules or DEFAULT_RANGES, "metric string, lo double, hi double")


def range_alerts(long: DataFrame, rules: DataFrame, key: list[str] | None = None,
                 order: str = "day", metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """long-form rows whose value lies outside [lo, hi] of their metric's rule.

    No hint: Spark broadcasts a small rules table by its size and shuffles for a large one.
    """
    key = key or ["domain"]
    j = long.join(rules, metric_col, "inner")
    bad = j.filter(~F.col(value_col).between(F.col("lo"), F.col("hi")))
    return bad.select(
        *[F.col(c) for c in key if c != metric_col],
        F.col(order).alias("day"),
        F.col(metric_col).alias("metric"),
        F.lit("out_of_range").alias("method"),
        F.lit("range").alias("type"),
        F.col(value_col).cast("double").alias("value"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("double").alias("relative_magnitude"),
        F.array(F.col(metric_col)).alias("affected"),
        F.create_map(F.lit("lo"), F.col("lo"), F.lit("hi"), F.col("hi")).alias("context"),
        F.format_string("range=[%s, %s]", F.col("lo").cast("string"), F.col("hi").cast("string")).alias("params"),
    )


def duplicate_days(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """(key, day) pairs that occur more than once, with their row count.

    Partial aggregation: a hot key costs one row per map task in the shuffle.
    """
    return (
        df.groupBy(*key, F.col(order)).agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def validate(df: DataFrame, required: list[str], key: list[str], order: str) -> DataFrame:
    """One-row report: missing required columns, emptiness, repeated days, overall verdict.

    The column check reads only the schema. Row and duplicate counts come from one aggregation
    over the per-(key, day) counts, so the data is scanned once and nothing reaches the driver
    but the single report row.
    """
    missing = [c for c in required if c not in df.columns]
    present_key = [c for c in key if c in df.columns]
    if order in df.columns:
        per_day = df.groupBy(*present_key, F.col(order)).agg(F.count(F.lit(1)).alias("_c"))
    else:
        per_day = df.groupBy(*present_key).agg(F.count(F.lit(1)).alias("_c"))
    rep = per_day.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(F.col("_c") > 1).cast("bigint").alias("duplicate_days"),
    )
    return rep.select(
        F.lit(",".join(missing)).alias("missing_columns"),
        (F.col("rows") == 0).alias("is_empty"),
        F.col("rows"),
        F.col("duplicate_days"),
        (F.lit(not missing) & (F.col("rows") > 0)).alias("valid"),
    )


def series_status(df: DataFrame, key: list[str], order: str, min_rows: int = 14, cutoff=None) -> DataFrame:
    """Why a series is or is not tested (instead of silently returning no alerts).

    One row per series: ``rows``, ``last_day`` and ``status``: 'stale' when ``cutoff`` is given
    and the series does not end on it (B10), else 'too_short' below ``min_rows`` (B11), else 'ok'.
    One partial aggregation over the series key.
    """
    agg = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.max(order).alias("last_day"))
    status = F.when(F.col("rows") < F.lit(min_rows), F.lit("too_short")).otherwise(F.lit("ok"))
    if cutoff is not None:
        status = F.when(F.col("last_day") != _day(cutoff), F.lit("stale")).otherwise(status)
    return agg.withColumn("status", status)
