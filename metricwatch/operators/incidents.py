"""Alert incidents (L8): runs of alert days of one series, as the history grows.

An incident is a maximal run of days on which a (domain, metric) pair has alerts, where at most
``max_gap`` days lie from one to the next. :func:`incidents` finds them in a whole history;
:func:`extend_incidents` brings stored ones up to a new day from that day's alerts alone, with the same
result as a full run. Multivariate and quality alerts without a metric are a series of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("domain", "metric")


def _per_day(alerts: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per series and day with alerts."""
    return alerts.groupBy(*key, "day").agg(F.count(F.lit(1)).alias("alerts"), F.max("score").alias("peak_score"),
                                           F.sort_array(F.collect_set("method")).alias("methods"))  # a handful of methods


def _run(first: Column, last: Column, days: Column, alerts: Column, peak: Column, methods: Column) -> list[Column]:
    return [first.alias("first_day"), last.alias("last_day"), days.cast("bigint").alias("days"), alerts.cast("bigint").alias("alerts"),
            peak.alias("peak_score"), methods.alias("methods")]


def incidents(alerts: DataFrame, max_gap: int = 1, key: tuple[str, ...] = KEY) -> DataFrame:
    """key..., first_day, last_day, days (with alerts), alerts, peak_score, methods: one row per incident."""
    each = _per_day(alerts, key)
    w = Window.partitionBy(*key).orderBy("day")  # at most a row per day of the history
    begins = (F.coalesce(F.date_diff("day", F.lag("day").over(w)), F.lit(max_gap + 1)) > max_gap).cast("int")
    numbered = each.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(w))
    return numbered.groupBy(*key, "_run").agg(*_run(
        F.min("day"), F.max("day"), F.count(F.lit(1)), F.sum("alerts"), F.max("peak_score"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("methods")))))).drop("_run")


def extend_incidents(stored: DataFrame, alerts: DataFrame, day, max_gap: int = 1, key: tuple[str, ...] = KEY) -> DataFrame:
    """Stored incidents up to the day before, plus the alerts of ``day``.

    An incident whose last day is at most ``max_gap`` days ago goes on if its series has an alert; all others stay as they are.
    """
    today = _per_day(alerts.where(F.col("day") == day), key).select(
        *[F.col(k).alias(f"_{k}") for k in key], F.col("day").alias("_day"), F.col("alerts").alias("_alerts"),
        F.col("peak_score").alias("_peak"), F.col("methods").alias("_methods"), F.lit(True).alias("_new"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    near = F.date_diff(day if isinstance(day, Column) else F.lit(day), F.col("last_day")) <= max_gap
    both = stored.withColumn("_old", F.lit(True)).join(today, [*same, near], "full")
    old, new = F.coalesce("_old", F.lit(False)), F.coalesce("_new", F.lit(False))
    none = F.array().cast("array<string>")
    return both.select(
        *[F.when(old, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in key],
        *_run(F.coalesce("first_day", "_day"), F.coalesce("_day", "last_day"), F.coalesce("days", F.lit(0)) + new.cast("int"),
              F.coalesce("alerts", F.lit(0)) + F.coalesce("_alerts", F.lit(0)), F.greatest("peak_score", "_peak"),
              F.sort_array(F.array_union(F.coalesce("methods", none), F.coalesce("_methods", none)))))
