"""Series operators E1-E7: long form, positions, classical additive decomposition, latest row.

A series is the set of rows sharing ``key`` (a list of columns), ordered by ``order``. Every
operator here is a window over ``partitionBy(*key)``, so one series or millions of series run
the same plan: one hash exchange on the key, then sorts inside each partition. Series are
bounded by the analysis window (66 daily rows by default), so no key can skew a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POS = "pos"
N = "n"


def to_long(df: DataFrame, ids: list[str], metrics: list[str] | tuple[str, ...],
            metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Wide metrics -> rows (ids..., metric, value double): one plan then serves every metric."""
    cast = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot(ids, list(metrics), metric_col, value_col)


def calendar_fill(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Add the missing calendar days between each series' first and last day with value 0.

    The calendar is generated per series with ``sequence`` (bounded by the series' own span),
    not by a cross join.
    """
    bounds = df.groupBy(*key).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    cal = bounds.select(*key, F.explode(F.sequence("_lo", "_hi")).alias(order))
    return cal.join(df, [*key, order], "left").fillna(0, subset=[value])


def decompose(df: DataFrame, key: list[str], order: str, value: str, period: int = 7,
              fill_calendar: bool = False) -> DataFrame:
    """Classical additive decomposition, value = trend + seasonal + resid.

    * trend (E1): centred moving average over ``period`` rows (2 x period filter for an even
      period); undefined for the ``period // 2`` rows at each end.
    * ends (E2): each undefined end is filled by a least-squares line through the ``period``
      nearest defined trend rows on that side: positions [h, h + period) at the front and
      [n - 1 - h - period, n - 1 - h) at the back (h = period // 2), the rows the public
      ``extrapolate_trend='freq'`` rule of the usual Python implementation uses.
    * seasonal (E3): mean of value - trend per phase (position mod period), centred so the
      ``period`` phase means average to 0.
    * resid (E4): value - trend - seasonal.

    Adds ``pos``, ``n``, ``trend``, ``seasonal``, ``resid`` (doubles). A series with fewer than
    2 x period rows gets NULL components (the decomposition is undefined there).
    ``fill_calendar=True`` first inserts missing calendar days with 0 so that phase follows the
    calendar instead of the row count.
    """
    if fill_calendar:
        df = calendar_fill(df, key, order, value)
    h = period // 2
    y = F.col(value).cast("double")
    w_ord = Window.partitionBy(*key).orderBy(F.col(order))
    # whole-series frame on the same (partition, order) spec: lands in the same Window operator
    w_all = w_ord.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_phase = Window.partitionBy(*key, "_phase")
    cols = df.columns

    if period % 2:
        raw = F.avg(y).over(w_ord.rowsBetween(-h, h))
    else:
        total = F.sum(y).over(w_ord.rowsBetween(-h, h))
        raw = (total - F.lit(0.5) * (F.lag(y, h).over(w_ord) + F.lead(y, h).over(w_ord))) / F.lit(float(period))
    # Window operator 1: position, length and the centred moving average
    df = df.select("*", (F.row_number().over(w_ord) - 1).cast("bigint").alias(POS), F.count(F.lit(1)).over(w_all).alias(N),
                   raw.alias("_raw"))
    pos, n = F.col(POS), F.col(N)
    back = n - 1 - h
    ok = n >= 2 * period
    df = df.select(*cols, POS, N, F.when((pos >= h) & (pos <= back) & ok, F.col("_raw")).alias("_t"))

    # Window operator 2: least-squares lines through the nearest defined trend rows at each end
    front_rows = (pos >= h) & (pos < F.least(F.lit(h + period), back))
    back_rows = (pos >= F.greatest(F.lit(h), back - period)) & (pos < back)
    posd = pos.cast("double")
    ft, bt = F.when(front_rows, F.col("_t")), F.when(back_rows, F.col("_t"))
    df = df.select("*", F.regr_slope(ft, posd).over(w_all).alias("_fs"), F.regr_intercept(ft, posd).over(w_all).alias("_fi"),
                   F.regr_slope(bt, posd).over(w_all).alias("_bs"), F.regr_intercept(bt, posd).over(w_all).alias("_bi"))
    trend = (
        F.when(F.col("_t").isNotNull(), F.col("_t"))
        .when(ok & (pos < h), F.col("_fs") * posd + F.col("_fi"))
        .when(ok & (pos > back), F.col("_bs") * posd + F.col("_bi"))
    )
    df = df.select(*cols, POS, N, trend.alias("trend"), (pos % period).alias("_phase"))

    # Window operator 3: phase means (same hash partitioning, sorted by phase inside)
    df = df.select("*", F.avg(y - F.col("trend")).over(w_phase).alias("_pm"),
                   F.count(F.col("trend")).over(w_phase).alias("_pc"))
    # Window operator 4: centre the phase means so that they average to 0
    w_key = Window.partitionBy(*key)
    grand = F.sum(F.col("_pm") / F.col("_pc")).over(w_key) / F.lit(float(period))
    df = df.select(*cols, POS, N, "trend", (F.col("_pm") - grand).alias("seasonal"))
    return df.select("*", (y - F.col("trend") - F.col("seasonal")).alias("resid"))


def latest(df: DataFrame, key: list[str], order: str, cutoff=None) -> DataFrame:
    """E6 (+ B10 when ``cutoff`` is given): the last row of each series, kept only if it is the cutoff."""
    last = F.max(order).over(Window.partitionBy(*key))
    out = df.withColumn("_last", last).filter(F.col(order) == F.col("_last")).drop("_last")
    if cutoff is not None:
        out = out.filter(F.col(order) == (cutoff if not isinstance(cutoff, str) else F.to_date(F.lit(cutoff))))
    return out
