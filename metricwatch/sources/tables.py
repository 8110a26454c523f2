"""Sources: daily tables, the account dictionary, the analysis window and account-day sums."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.functions.columns import normalize_account_id, to_day

ID = "account_id_norm"
DAY = "day"
DOMAIN = "domain"


def read_source(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A1: a daily table by catalog name, or a parquet file/folder by path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def _day_lit(cutoff: Column | str | _dt.date) -> Column:
    if isinstance(cutoff, Column):
        return cutoff
    return F.lit(cutoff if isinstance(cutoff, _dt.date) else _dt.date.fromisoformat(str(cutoff)))


def analysis_window(df: DataFrame, day: str, cutoff: Column | str | _dt.date,
                    days: int = 65) -> DataFrame:
    """Keep rows with cutoff - days <= date(day) <= cutoff, both ends inclusive.

    ``day`` must be a DATE or TIMESTAMP column for that: on ISO text the filter works but prunes nothing.
    With a literal cutoff the bounds fold to constants and the filter reaches the parquet scan as
    a pushed range predicate on the raw timestamp column.
    """
    c = _day_lit(cutoff)
    d = to_day(F.col(day))
    return df.filter(d.between(F.date_sub(c, days), c))


def account_dictionary(df: DataFrame, id_col: str, domain_col: str) -> DataFrame:
    """A2 + D6: id -> domain map, normalized, exactly one row per id.

    Ids without digits and rows without a domain are dropped (they can never match). When an id
    appears under several domains the smallest domain wins, whatever the partitioning.
    Partial aggregation keeps this cheap even if one id repeats millions of times.
    """
    return (
        df.select(normalize_account_id(F.col(id_col)).alias(ID), F.col(domain_col).cast("string").alias(DOMAIN))
        .filter(F.col(ID).isNotNull() & F.col(DOMAIN).isNotNull())
        .groupBy(ID)
        .agg(F.min(DOMAIN).alias(DOMAIN))
    )


def daily_sum(df: DataFrame, id_col: str, date_col: str, metrics: dict[str, str],
              cutoff: Column | str | _dt.date, days: int = 65) -> DataFrame:
    """D1/D2 + B14: per normalized account and day, the whole-number sum of each metric.

    ``metrics`` maps output name -> input column. Each sum is truncated toward zero to INT after
    summing (the reference's ``CAST(SUM(x) AS INT)``). The window filter runs before the
    aggregation, and the aggregation is partial (map-side), so only one row per account, day and
    map task crosses the shuffle no matter how hot an account is.
    """
    kinds = dict(df.dtypes)

    def exact(out: str) -> Column:  # floating sums depend on their order, decimal ones don't
        return F.col(out).cast("decimal(28,6)") if kinds[metrics[out]] in ("double", "float") else F.col(out)

    needed = list(dict.fromkeys([id_col, date_col, *metrics.values()]))
    windowed = analysis_window(df.select(*needed), date_col, cutoff, days)
    return (
        windowed.select(
            normalize_account_id(F.col(id_col)).alias(ID),
            to_day(F.col(date_col)).alias(DAY),
            *[F.col(src).alias(out) for out, src in metrics.items()],
        )
        .groupBy(ID, DAY)
        .agg(*[F.sum(exact(out)).cast("int").alias(out) for out in metrics])
    )
