"""The driver's TPC-H-like tables seen as the job's inputs (see FIXTURES.md, part 2).

* dictionary: customer ⋈ nation ⋈ region; AccountID = c_name, domain = r_name
* web_raw:    orders ⋈ customer; propertyID = c_name, date = o_orderdate, one session per
              order, one conversion per order with status 'F'
* ads_a_raw / ads_b_raw: lineitem ⋈ orders ⋈ customer, l_returnflag <> 'N' / = 'N';
              account_id = c_name, date = l_shipdate, spend_gbp = l_extendedprice as decimal(12,2)
* events series: per (event_type, day) count(*), sum(value), count(distinct user_id)

Everything is lazy; the analysis window filter applied later on ``date`` is pushed through the
joins down to the lineitem / orders scans by Catalyst.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.sources.tables import read_source

# Fixed values of the fixture mapping
CUTOFF = _dt.date(2001, 8, 1)
DAYS = 65
EVENTS_FEATURES = ["events", "value_sum", "users"]


_READS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read lazily once per session and path (schema discovery is a Spark job,
    so repeated ``spark.read.parquet`` calls of the same file would each pay for one)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READS[key] = read_source(spark, path)
    return df


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> c_name. No hint: Spark broadcasts it only when its size estimate (or AQE's
    runtime measurement) is under the broadcast threshold, else joins by shuffle."""
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


def dictionary_raw(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """(AccountID, domain): domain = region name (5 domains) or nation name (25)."""
    c = table(spark, sf_dir, "customer").select("c_name", "c_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables: safe to broadcast.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    if level == "nation":
        return j.select(F.col("c_name").alias("AccountID"), F.col("n_name").alias("domain"))
    r = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    return j.join(r, j.n_regionkey == r.r_regionkey).select(
        F.col("c_name").alias("AccountID"), F.col("r_name").alias("domain"))


def web_raw(spark: SparkSession, sf_dir: str, without_every: int | None = None) -> DataFrame:
    """``without_every``: an earlier state of the table that lacks every so manieth order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    if without_every:
        o = o.filter(F.col("o_orderkey") % without_every != 0)
    j = o.join(_accounts(spark, sf_dir), o.o_custkey == F.col("c_custkey"))
    return j.select(
        F.col("c_name").alias("propertyID"),
        F.col("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("TotalConversions"),
        F.lit(1).alias("TotalSessions"),
    )


def ads_raw(spark: SparkSession, sf_dir: str, source: str, without_every: int | None = None) -> DataFrame:
    """source 'a': line items with l_returnflag <> 'N'; source 'b': l_returnflag = 'N'."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_returnflag")
    li = li.filter(F.col("l_returnflag") != "N") if source == "a" else li.filter(F.col("l_returnflag") == "N")
    if without_every:
        li = li.filter(F.col("l_orderkey") % without_every != 0)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(_accounts(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        F.col("c_name").alias("account_id"),
        F.col("l_shipdate").alias("date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("spend_gbp"),
    )


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, day, events, value_sum, users): one row per event type and day.

    count(distinct user_id) per group is planned by Spark as a two-level aggregate (expand on
    user, then count), so no group ever holds its raw user list.
    """
    e = table(spark, sf_dir, "events").select("event_type", "ts", "value", "user_id")
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("value").alias("value_sum"),
        F.countDistinct("user_id").alias("users"),
    )
