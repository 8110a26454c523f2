"""Univariate detector: D8-D10, F1-F7, with B10/B11 guards.

Seasonal residual + robust median test. Everything is a window over the series key, computed
after the single exchange that ``decompose`` already needs, so the detector adds no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.operators.loess import loess_decompose
from metricwatch.operators.series import N, decompose

MAD_SCALE = 1.4826  # consistency factor of the MAD for a normal distribution
MAD_FLOOR = 1e-6    # a MAD below this (flat or perfectly seasonal series) is raised to it


def mad_bounds(df: DataFrame, key: list[str], k: float, resid: str = "resid",
               mean_of: str | None = None) -> DataFrame:
    """D8 + D9 + F1: per series median of the residual, scaled MAD and the bounds median ± k·MAD.

    Exact medians (``median`` as a window aggregate). The MAD is floored at 1e-6 rather than
    guarded for exact zero, so float noise on a perfectly regular series cannot raise flags.
    ``mean_of`` also adds ``series_mean`` (D10), computed in the same Window operator as the median.
    """
    w = Window.partitionBy(*key)
    extra = [F.avg(F.col(mean_of).cast("double")).over(w).alias("series_mean")] if mean_of else []
    df = df.select("*", F.median(resid).over(w).alias("resid_median"), *extra)
    mad = F.greatest(F.median(F.abs(F.col(resid) - F.col("resid_median"))).over(w) * F.lit(MAD_SCALE), F.lit(MAD_FLOOR))
    df = df.select("*", mad.alias("mad"))
    kk = F.lit(float(k))
    return df.select("*", (F.col("resid_median") - kk * F.col("mad")).alias("lower"),
                     (F.col("resid_median") + kk * F.col("mad")).alias("upper"))


def scored_series(df: DataFrame, key: list[str], order: str, value: str, k: float = 3.2,
                  min_rows: int = 14, period: int = 7, fill_calendar: bool = False, decomposition: str = "classical") -> DataFrame:
    """Decompose, bound and flag every row of every series with at least ``min_rows`` rows.

    Adds trend/seasonal/resid, resid_median, mad, lower, upper, ``series_mean`` (D10) and
    ``is_outlier`` (F2: strictly outside the bounds). ``decomposition="loess"`` decomposes by robust Loess.
    """
    if decomposition not in ("classical", "loess"):
        raise ValueError("decomposition is classical or loess")
    take = decompose if decomposition == "classical" else loess_decompose
    dec = take(df, key, order, value, period=period, fill_calendar=fill_calendar)
    dec = dec.filter(F.col(N) >= F.lit(max(min_rows, 2 * period)))
    out = mad_bounds(dec, key, k, mean_of=value)
    return out.select("*", ((F.col("resid") > F.col("upper")) | (F.col("resid") < F.col("lower"))).alias("is_outlier"))


def seasonal_mad(df: DataFrame, key: list[str], order: str, value: str, k: float = 3.2,
                 min_rows: int = 14, latest_only: bool = False, cutoff=None, period: int = 7,
                 metric_col: str | None = "metric", fill_calendar: bool = False,
                 report_value: str | None = None, decomposition: str = "classical") -> DataFrame:
    """seasonal-residual MAD alerts for every series in ``df`` (long form).

    * ``latest_only=False`` (LOCAL variant): every flagged day.
    * ``latest_only=True`` (DAILY variant): only the last day, and only when that day is
      ``cutoff`` (B10); a series whose last row is older raises nothing.

    Output columns: key..., day (= ``order``), metric, method='seasonal_mad', type spike|drop
    (F6: sign of the residual), value, score = round(|resid| / MAD, 2) (F4, not centred on the
    median), relative_magnitude = round(|resid| / mean * 100, 2), 0 for a zero mean (F5),
    affected, context, params.

    ``report_value`` names the column reported as ``value`` when the tested column is a
    transform of it (e.g. the Anscombe transform of a count, F13); default: ``value`` itself.
    """
    shown = report_value or value
    if latest_only and cutoff is None:
        raise ValueError("latest_only needs a cutoff")
    if latest_only:
        last = F.max(order).over(Window.partitionBy(*key))
        c = cutoff if isinstance(cutoff, Column) else F.lit(
            cutoff if isinstance(cutoff, _dt.date) else _dt.date.fromisoformat(str(cutoff)))
        df = df.withColumn("_last", last).filter(F.col("_last") == c).drop("_last")
    s = scored_series(df, key, order, value, k=k, min_rows=min_rows, period=period, fill_calendar=fill_calendar,
                      decomposition=decomposition)
    if latest_only:
        s = s.filter(F.col("pos") == F.col(N) - 1)
    s = s.filter(F.col("is_outlier"))
    resid_abs = F.abs(F.col("resid"))
    metric = F.col(metric_col) if metric_col and metric_col in df.columns else F.lit(value)
    rel = F.when(F.col("series_mean") != 0, F.round(resid_abs / F.col("series_mean") * 100.0, 2)).otherwise(F.lit(0.0))
    return s.select(
        *[F.col(c) for c in key if c != metric_col],
        F.col(order).alias("day"),
        metric.cast("string").alias("metric"),
        F.lit("seasonal_mad").alias("method"),
        F.when(F.col("resid") > 0, F.lit("spike")).otherwise(F.lit("drop")).alias("type"),
        F.col(shown).cast("double").alias("value"),
        F.round(resid_abs / F.col("mad"), 2).alias("score"),
        rel.alias("relative_magnitude"),
        F.array(metric.cast("string")).alias("affected"),
        F.create_map(metric.cast("string"), F.col(shown).cast("double")).alias("context"),
        F.lit(f"MAD={float(k)}").alias("params"),
    )
