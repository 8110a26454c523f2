"""The domain-day ("gold") table: C1, C2, D3, D4, H1, B5-B7, G1."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.sources.tables import DAY, DOMAIN, ID, account_dictionary, daily_sum

GOLD_METRICS = ("spend", "leads", "sessions")


def map_to_domain(df: DataFrame, dictionary: DataFrame, metrics: list[str] | tuple[str, ...]) -> DataFrame:
    """C1 + D3/D4: attach the domain to account-day rows and sum each metric per (domain, day).

    Inner join: accounts missing from the dictionary (or with NULL ids) would get a NULL domain
    and be dropped by B7 anyway, so dropping them at the join is the same result and keeps them
    out of the shuffle. Broadcast is decided by size, by Spark's own checks (the planner's size
    estimate against ``autoBroadcastJoinThreshold``, then AQE's measured shuffle size at runtime),
    falling back to a sort-merge join. The input is already one row per account and day, so a hot account
    cannot skew the join.
    """
    return (
        df.join(dictionary, ID, "inner")
        .groupBy(DOMAIN, DAY)
        .agg(*[F.sum(m).alias(m) for m in metrics])
    )


def union_sources(*dfs: DataFrame) -> DataFrame:
    """H1: bag union by column name (no de-duplication)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def combine_sources(left: DataFrame, right: DataFrame, key: list[str] | None = None,
                    metrics: list[str] | tuple[str, ...] = GOLD_METRICS) -> DataFrame:
    """C2 + B6: full outer join on (domain, day); a metric missing on one side becomes 0.

    Both sides come out of an aggregation hashed on the same key, so the sort-merge join reuses
    that partitioning and adds no exchange.
    """
    key = key or [DOMAIN, DAY]
    present = [m for m in metrics if m in left.columns or m in right.columns]
    return left.join(right, key, "full").fillna(0, subset=present)


def build_gold(web_raw: DataFrame, ads_raws: list[DataFrame], dictionary_raw: DataFrame,
               cutoff: Column | str | _dt.date, days: int = 65, *,
               web_cols: tuple[str, str, str, str] = ("propertyID", "date", "TotalConversions", "TotalSessions"),
               ads_cols: tuple[str, str, str] = ("account_id", "date", "spend_gbp"),
               dict_cols: tuple[str, str] = ("AccountID", "domain")) -> DataFrame:
    """The whole ETL as one lazy plan: (domain, day, spend, leads, sessions), bigint metrics.

    Each source is first summed per account-day on its own (B14 truncates each source
    separately, as the reference does). Then, instead of mapping ads and web to domains in two
    joins and combining them with a full outer join (C2), the account-day rows of all sources
    are unioned with NULL for the metrics a source does not carry, joined to the dictionary
    once and summed per (domain, day) once: a (domain, day) row exists iff any source has one,
    and a metric no source reported is 0, which is exactly the full join + fill-0 result, with
    one join and one shuffle instead of three.
    """
    dictionary = account_dictionary(dictionary_raw, *dict_cols)
    pid, wdate, conv, sess = web_cols
    web = daily_sum(web_raw, pid, wdate, {"leads": conv, "sessions": sess}, cutoff, days)
    aid, adate, spend = ads_cols
    ads = union_sources(*[daily_sum(a, aid, adate, {"spend": spend}, cutoff, days) for a in ads_raws])
    none = F.lit(None).cast("int")
    rows = union_sources(
        ads.select(ID, DAY, "spend", none.alias("leads"), none.alias("sessions")),
        web.select(ID, DAY, none.alias("spend"), "leads", "sessions"),
    )
    summed = map_to_domain(rows, dictionary, list(GOLD_METRICS))
    return summed.select(DOMAIN, DAY, *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in GOLD_METRICS])
