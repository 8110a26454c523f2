"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator group.

Inputs are the driver tables seen through ``fixtures``; every query reads whole tables. Column
names match the SQL statements in ``metricwatch.plans.oracle_queries.SQL``.
Doubles that come out of floating arithmetic are rounded to 6 decimals in the final select so
that two engines agree on the last bits.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricwatch.functions.columns import anscombe, cutoff_day
from metricwatch.functions.plan import cut_lineage
from metricwatch.operators.alerts import (
    adaptive_card, cap_per_day, message_card, prioritize, retain, route, run_report,
)
from metricwatch.operators.detect import scored_series, seasonal_mad
from metricwatch.operators.evaluate import evaluate, precision_recall_curve
from metricwatch.operators.gold import GOLD_METRICS, build_gold, combine_sources, map_to_domain, union_sources
from metricwatch.operators.forest_model import iforest_fit, iforest_score
from metricwatch.operators.iforest import iforest_alerts, iforest_scores, standardize_columns
from metricwatch.operators.incidents import incidents
from metricwatch.operators.loess import loess_decompose
from metricwatch.operators.long_series import bounds_blocks
from metricwatch.operators.profiles import day_profiles, estimates, merge_profiles
from metricwatch.operators.quality import (
    duplicate_days, missing_day_alerts, missing_days, range_alerts, range_rules, series_status, validate,
)
from metricwatch.operators.series import decompose, to_long
from metricwatch.plans import fixtures as fx
from metricwatch.plans.variants import daily_variant, local_variant, tested_long
from metricwatch.sources.changes import changed_days, day_fingerprints
from metricwatch.session import ensure_checkpoint_dir
from metricwatch.sources.ledger import deliver_once
from metricwatch.sources.sinks import delivery_summary, read_alerts, write_alerts
from metricwatch.sources.tables import account_dictionary, analysis_window, daily_sum

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, nd: int = 6):
    return F.round(F.col(c), nd).alias(c)


# ------------------------------------------------------------------ ETL
def q_normalize_ids(spark: SparkSession, d: str) -> DataFrame:
    """Normalized account id -> smallest domain, one row per id."""
    return account_dictionary(fx.dictionary_raw(spark, d), "AccountID", "domain")


def q_window_filter(spark: SparkSession, d: str) -> DataFrame:
    """Orders inside the 66-day window ending at the cutoff, with their day."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    w = analysis_window(o, "o_orderdate", fx.CUTOFF, fx.DAYS)
    return w.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


def _web_daily(spark: SparkSession, d: str) -> DataFrame:
    return daily_sum(fx.web_raw(spark, d), "propertyID", "date",
                     {"leads": "TotalConversions", "sessions": "TotalSessions"}, fx.CUTOFF, fx.DAYS)


def _ads_daily(spark: SparkSession, d: str, source: str) -> DataFrame:
    return daily_sum(fx.ads_raw(spark, d, source), "account_id", "date", {"spend": "spend_gbp"},
                     fx.CUTOFF, fx.DAYS)


def q_web_daily(spark: SparkSession, d: str) -> DataFrame:
    """Per account-day INT sums of conversions (leads) and sessions."""
    return _web_daily(spark, d)


def q_ads_daily(spark: SparkSession, d: str) -> DataFrame:
    """Per source and account-day INT sum of spend."""
    return union_sources(
        _ads_daily(spark, d, "a").withColumn("source", F.lit("a")),
        _ads_daily(spark, d, "b").withColumn("source", F.lit("b")),
    ).select("source", "account_id_norm", "day", "spend")


def _dictionary(spark: SparkSession, d: str) -> DataFrame:
    return account_dictionary(fx.dictionary_raw(spark, d), "AccountID", "domain")


def q_spend_by_domain(spark: SparkSession, d: str) -> DataFrame:
    """Both ad sources unioned, mapped to domains, summed per domain-day."""
    ads = union_sources(_ads_daily(spark, d, "a"), _ads_daily(spark, d, "b"))
    return map_to_domain(ads, _dictionary(spark, d), ["spend"])


def q_web_by_domain(spark: SparkSession, d: str) -> DataFrame:
    """Web account-days mapped to domains, leads and sessions summed per domain-day."""
    return map_to_domain(_web_daily(spark, d), _dictionary(spark, d), ["leads", "sessions"])


def gold(spark: SparkSession, d: str) -> DataFrame:
    return build_gold(fx.web_raw(spark, d), [fx.ads_raw(spark, d, "a"), fx.ads_raw(spark, d, "b")],
                      fx.dictionary_raw(spark, d), fx.CUTOFF, fx.DAYS)


def q_combine_sources(spark: SparkSession, d: str) -> DataFrame:
    """Domain-day spend full-outer-joined with domain-day web metrics, gaps filled with 0."""
    c = combine_sources(q_spend_by_domain(spark, d), q_web_by_domain(spark, d))
    return c.select("domain", "day", *[F.col(m).cast("bigint").alias(m) for m in GOLD_METRICS])


def q_gold_daily(spark: SparkSession, d: str) -> DataFrame:
    """One row per (domain, day) with spend, leads, sessions."""
    return gold(spark, d).orderBy("domain", "day")


# ------------------------------------------------------------------ series and detectors
K_LOCAL = 3.2
K_LATEST = 1.0              # with the configured 3.5 (or 2.0) almost no domain is flagged at sf0.01
EVENT_KEY = ["event_type"]


def gold_long(spark: SparkSession, d: str) -> DataFrame:
    return to_long(gold(spark, d), ["domain", "day"], list(GOLD_METRICS))


def _alert_out(df: DataFrame, key: str = "domain") -> DataFrame:
    """Alert rows with the array column as text (maps are dropped or flattened by the caller)."""
    return df.select(key, "day", "metric", "method", "type", "value", "score", "relative_magnitude",
                     F.array_join("affected", ",").alias("affected"), "params")


def q_scored_events(spark: SparkSession, d: str) -> DataFrame:
    """Flagship (entry): daily event counts per type, decomposed, with MAD bounds and flags."""
    s = scored_series(fx.events_daily(spark, d), EVENT_KEY, "day", "events", k=K_LOCAL)
    return s.select("event_type", "day", F.col("events").cast("double").alias("value"), _r("trend"),
                    _r("seasonal"), _r("resid"), _r("resid_median"), _r("mad"), _r("lower"), _r("upper"),
                    "is_outlier")


def q_decompose_events(spark: SparkSession, d: str) -> DataFrame:
    """Trend, seasonal, residual of the daily event counts per type."""
    dec = decompose(fx.events_daily(spark, d), EVENT_KEY, "day", "events")
    return dec.select("event_type", "day", "pos", "n", F.col("events").cast("double").alias("value"),
                      _r("trend"), _r("seasonal"), _r("resid"))


def q_mad_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Per event type the residual median, scaled MAD and bounds at k = 3.2."""
    s = scored_series(fx.events_daily(spark, d), EVENT_KEY, "day", "events", k=K_LOCAL)
    per = s.groupBy("event_type").agg(F.first("n").alias("n"), F.first("resid_median").alias("resid_median"),
                                      F.first("mad").alias("mad"), F.first("lower").alias("lower"),
                                      F.first("upper").alias("upper"))
    return per.select("event_type", "n", _r("resid_median"), _r("mad"), _r("lower"), _r("upper"))


def q_mad_alerts_all(spark: SparkSession, d: str) -> DataFrame:
    """Every flagged day of every (domain, metric) gold series, k = 3.2."""
    return _alert_out(seasonal_mad(gold_long(spark, d), ["domain", "metric"], "day", "value", k=K_LOCAL))


def q_mad_alerts_latest(spark: SparkSession, d: str) -> DataFrame:
    """The cutoff day only, for series that end on it (k = 1.0)."""
    a = seasonal_mad(gold_long(spark, d), ["domain", "metric"], "day", "value", k=K_LATEST,
                     latest_only=True, cutoff=fx.CUTOFF)
    return _alert_out(a)


def q_iforest_scores(spark: SparkSession, d: str) -> DataFrame:
    """Forest scores of (events, value_sum, users) per event type and day."""
    s = iforest_scores(fx.events_daily(spark, d), EVENT_KEY, "day", fx.EVENTS_FEATURES)
    return s.select("event_type", "day", "events", _r("value_sum"), "users", "n", "psi",
                    _r("mean_path"), _r("score"))


def _forest_alert_out(a: DataFrame) -> DataFrame:
    return a.select("event_type", "day", "method", "type", "score",
                    F.array_join("affected", ",").alias("affected"),
                    F.col("context")["events"].alias("ctx_events"),
                    F.round(F.col("context")["value_sum"], 6).alias("ctx_value_sum"),
                    F.col("context")["users"].alias("ctx_users"), "params")


def q_iforest_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Rows above the contamination cut-off (0.05), with their context values."""
    a = iforest_alerts(fx.events_daily(spark, d), EVENT_KEY, "day", fx.EVENTS_FEATURES, contamination=0.05)
    return _forest_alert_out(a)


def q_score_p99(spark: SparkSession, d: str) -> DataFrame:
    """rows above the 99th percentile of their series' scores."""
    a = iforest_alerts(fx.events_daily(spark, d), EVENT_KEY, "day", fx.EVENTS_FEATURES, percentile=99.0)
    return _forest_alert_out(a)


def q_iforest_latest(spark: SparkSession, d: str) -> DataFrame:
    """The cutoff day of each gold domain whose score is above the cut-off (contamination 0.4,
    so that a domain is flagged at every size), through the DAILY branch of the operator."""
    a = iforest_alerts(gold(spark, d), ["domain"], "day", list(GOLD_METRICS), contamination=0.4, min_rows=20,
                       latest_only=True, cutoff=fx.CUTOFF)
    ctx = [F.col("context")[m].alias(f"ctx_{m}") for m in GOLD_METRICS]
    return a.select("domain", "day", "method", "type", "score", F.array_join("affected", ",").alias("affected"), *ctx, "params")


def _orders_daily(spark: SparkSession, d: str) -> DataFrame:
    """(region, day, orders, revenue) over all days."""
    o = fx.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_regionkey").alias("region"), F.to_date("o_orderdate").alias("day"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue")))


def q_iforest_long(spark: SparkSession, d: str) -> DataFrame:
    """F8, F9 on series longer than a tree's sample: daily orders and revenue per region over all days, by fit and score
    (the trees are grown on their samples alone, and no series is one task's)."""
    daily = cut_lineage(_orders_daily(spark, d))
    s = iforest_score(daily, iforest_fit(daily, ["region"], "day", ["orders", "revenue"]), ["region"], ["orders", "revenue"])
    s = s.withColumns({c: F.col(c).cast("double") for c in ("orders", "revenue")})
    return s.select("region", "day", "orders", _r("revenue", 2), "n", "psi", _r("mean_path"), _r("score"))


def q_iforest_latest_rank(spark: SparkSession, d: str) -> DataFrame:
    """The cutoff day of each gold domain (contamination 0.2, >= 20 rows): its score,
    the cut-off, the rank of its score in the series and the verdict."""
    g = gold(spark, d).filter(F.col("day") <= F.lit(fx.CUTOFF))
    s = iforest_scores(g, ["domain"], "day", list(GOLD_METRICS))
    w = Window.partitionBy("domain")
    s = (s.filter(F.col("n") >= 20)
         .withColumn("cutoff_score", F.percentile("score", F.lit(0.8)).over(w))
         .withColumn("score_rank", F.rank().over(w.orderBy(F.col("score").desc())).cast("bigint"))
         .withColumn("_last", F.max("day").over(w)))
    s = s.filter((F.col("day") == F.col("_last")) & (F.col("day") == F.lit(fx.CUTOFF)))
    return s.select("domain", "day", "n", _r("score"), _r("cutoff_score"), "score_rank",
                    (F.col("score") > F.col("cutoff_score")).alias("is_alert"))


#: The first day that a fitted forest has not seen.
NEW_DAYS = fx.CUTOFF - _dt.timedelta(days=6)


def q_iforest_model_scores(spark: SparkSession, d: str) -> DataFrame:
    """F8 and F9 apart: a forest per gold domain fitted on the days before the last seven, all days scored in it."""
    g = cut_lineage(gold(spark, d))
    model = iforest_fit(g.where(F.col("day") < F.lit(NEW_DAYS)), ["domain"], "day", list(GOLD_METRICS))
    s = iforest_score(g, model, ["domain"], list(GOLD_METRICS))
    return s.select("domain", "day", (F.col("day") >= F.lit(NEW_DAYS)).alias("is_new"),
                    *[F.col(m).cast("double").alias(m) for m in GOLD_METRICS], "n", "psi", _r("mean_path"), _r("score"))


def q_stl_events(spark: SparkSession, d: str) -> DataFrame:
    """E1-E5 by robust Loess: trend, seasonal, residual and robustness weight of the daily event counts per type."""
    s = loess_decompose(fx.events_daily(spark, d), EVENT_KEY, "day", "events")
    return s.select("event_type", "day", "pos", "n", F.col("events").cast("double").alias("value"), _r("trend"), _r("seasonal"),
                    _r("resid"), _r("weight"))


def q_long_series_bounds(spark: SparkSession, d: str) -> DataFrame:
    """E1-E5, D8, D9 in blocks of a year: daily orders per region over all days, decomposed, with exact medians."""
    s = bounds_blocks(_orders_daily(spark, d), ["region"], "day", "orders", k=K_LOCAL, rows_per_block=365, left_over=100)
    return s.select("region", "day", F.col("orders").cast("double").alias("value"), "pos", "n", _r("trend"), _r("seasonal"), _r("resid"),
                    _r("resid_median"), _r("mad"), _r("lower"), _r("upper"), "is_outlier")


def q_anscombe(spark: SparkSession, d: str) -> DataFrame:
    """decomposition of 2·sqrt(count + 3/8) per event type."""
    ev = fx.events_daily(spark, d).withColumn("value", anscombe("events"))
    dec = decompose(ev, EVENT_KEY, "day", "value")
    return dec.select("event_type", "day", _r("value"), _r("trend"), _r("seasonal"), _r("resid"))


def q_anscombe_filled(spark: SparkSession, d: str) -> DataFrame:
    """Leads per nation, silent days filled with 0 before the transform, then decomposed."""
    tested, col = tested_long(to_long(nation_gold(spark, d), ["domain", "day"], ["leads"]), anscombe_counts=True, fill_calendar=True)
    dec = decompose(tested, ["domain", "metric"], "day", col)
    return dec.select("domain", "day", F.col("value").cast("bigint").alias("value"), _r(col), _r("trend"), _r("seasonal"), _r("resid"))


def q_standardize(spark: SparkSession, d: str) -> DataFrame:
    """the forest features standardized per event type."""
    z = standardize_columns(fx.events_daily(spark, d), EVENT_KEY, fx.EVENTS_FEATURES, prefix="z_")
    return z.select("event_type", "day", *[_r("z_" + f) for f in fx.EVENTS_FEATURES])


# ------------------------------------------------------------------ data quality
WINDOW_START = fx.CUTOFF - _dt.timedelta(days=fx.DAYS)


def nation_gold(spark: SparkSession, d: str) -> DataFrame:
    return build_gold(fx.web_raw(spark, d), [fx.ads_raw(spark, d, "a"), fx.ads_raw(spark, d, "b")],
                      fx.dictionary_raw(spark, d, "nation"), fx.CUTOFF, fx.DAYS)


def q_missing_days(spark: SparkSession, d: str) -> DataFrame:
    """(nation, day) pairs of the window without a gold row, for all nations of the dictionary."""
    nations = account_dictionary(fx.dictionary_raw(spark, d, "nation"), "AccountID", "domain").select("domain")
    miss = missing_days(nation_gold(spark, d), ["domain"], "day", WINDOW_START, fx.CUTOFF, keys=nations)
    a = missing_day_alerts(miss, ["domain"], "day")
    return a.select("domain", "day", "method", "type", "params")


def q_range_alerts(spark: SparkSession, d: str) -> DataFrame:
    """gold values outside the configured range of their metric."""
    a = range_alerts(gold_long(spark, d), range_rules(spark))
    return a.select("domain", "day", "metric", "method", "type", "value",
                    F.col("context")["lo"].alias("ctx_lo"), F.col("context")["hi"].alias("ctx_hi"))


def _inputs(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, list[str], str]]:
    """Every raw input with its day: name -> (rows, required columns, key)."""
    with_day = lambda df: df.withColumn("day", F.to_date("date"))
    ads = ["account_id", "date", "spend_gbp"]
    return {"web": (with_day(fx.web_raw(spark, d)), ["propertyID", "date", "TotalConversions", "TotalSessions"], "propertyID"),
            "ads_a": (with_day(fx.ads_raw(spark, d, "a")), ads, "account_id"),
            "ads_b": (with_day(fx.ads_raw(spark, d, "b")), ads, "account_id")}


def q_duplicate_days(spark: SparkSession, d: str) -> DataFrame:
    """Per input the (account, day) pairs that occur more than once."""
    return union_sources(*[duplicate_days(df.withColumnRenamed(key, "account"), ["account"], "day").withColumn("input", F.lit(name))
                           for name, (df, _, key) in _inputs(spark, d).items()]).select("input", "account", "day", "rows")


def q_validate(spark: SparkSession, d: str) -> DataFrame:
    """Per input the required columns, emptiness and repeated days, one row each."""
    return union_sources(*[validate(df, required, [key], "day").withColumn("input", F.lit(name))
                           for name, (df, required, key) in _inputs(spark, d).items()])


def q_window_profiles(spark: SparkSession, d: str) -> DataFrame:
    """The window's profile of every input, merged from its days; the estimates are held against exact values
    (distinct ids within 5 %, rank of the median within 2 % of the middle)."""
    inputs = {"web": (fx.web_raw(spark, d), "propertyID", "TotalSessions"), "ads_a": (fx.ads_raw(spark, d, "a"), "account_id", "spend_gbp"),
              "ads_b": (fx.ads_raw(spark, d, "b"), "account_id", "spend_gbp")}
    rows = union_sources(*[analysis_window(df, "date", fx.CUTOFF, fx.DAYS).select(
        F.lit(name).alias("input"), "date", F.col(i).alias("id"), F.col(v).cast("double").alias("value")) for name, (df, i, v) in inputs.items()])
    days = union_sources(*[day_profiles(rows.where(F.col("input") == name), name, "id", "date", "value") for name in inputs])
    merged = estimates(merge_profiles(days)).withColumnsRenamed({"rows": "n"})
    exact = rows.join(merged.select("input", "q50"), "input").groupBy("input").agg(
        F.countDistinct("id").alias("_ids"), F.avg((F.col("value") < F.col("q50")).cast("double")).alias("_below"),
        F.avg((F.col("value") <= F.col("q50")).cast("double")).alias("_upto"))
    return merged.join(exact, "input").select(
        "input", "first_day", "last_day", "days", F.col("n").alias("rows"), "missing_ids", "missing_values", _r("low"), _r("high"),
        F.col("total").cast("double").alias("total"), (F.abs(F.col("ids") - F.col("_ids")) <= 0.05 * F.col("_ids")).alias("ids_ok"),
        ((F.col("_below") <= 0.52) & (F.col("_upto") >= 0.48)).alias("median_ok"))


def q_series_status(spark: SparkSession, d: str) -> DataFrame:
    """B10, B11 reported: per (nation, metric) series of gold whether the DAILY detector would test it (ok),
    or skip it (stale last day, fewer than 14 rows)."""
    long = to_long(nation_gold(spark, d), ["domain", "day"], list(GOLD_METRICS))
    return series_status(long, ["domain", "metric"], "day", min_rows=14, cutoff=fx.CUTOFF)


def q_changed_days(spark: SparkSession, d: str) -> DataFrame:
    """A1, D1-D4 over time: days whose fingerprint differs from an earlier state of the sources, which lacked
    every 61st order (late rows) and the last three days (skipped runs)."""
    def sources(late: bool) -> dict:
        web_cols, ads_cols = ["propertyID", "date", "TotalConversions", "TotalSessions"], ["account_id", "date", "spend_gbp"]
        keep = None if late else 61
        frames = {"web": (fx.web_raw(spark, d, keep), web_cols), "ads0": (fx.ads_raw(spark, d, "a", keep), ads_cols),
                  "ads1": (fx.ads_raw(spark, d, "b", keep), ads_cols)}
        return {name: (df, "date", cols) for name, (df, cols) in frames.items()}
    before = day_fingerprints(sources(False), fx.CUTOFF, fx.DAYS).where(F.col("day") < F.date_sub(F.lit(fx.CUTOFF), 2))
    return changed_days(day_fingerprints(sources(True), fx.CUTOFF, fx.DAYS), before)


# ------------------------------------------------------------------ alerts
FIXTURE_URL = "https://dashboard.example/report"
CAP_N = 3  # the configured 100 per day is never reached by 5 domains; 3 makes the cut visible


def fused(spark: SparkSession, d: str) -> DataFrame:
    """LOCAL variant with quality checks on the gold fixture: MAD (k = 3.2), forest (0.01, >= 10
    rows), missing days over the window for every dictionary domain, range rules."""
    return fused_with_gold(spark, d)[1]


def fused_with_gold(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # gold feeds four detector branches that each prune it differently, so Spark could not
    # share one computation of it: materialize it once in the checkpoint folder instead.
    g = cut_lineage(gold(spark, d))
    domains = _dictionary(spark, d).select("domain").distinct()
    return g, local_variant(g, quality=True, start=WINDOW_START, end=fx.CUTOFF,
                            domains=domains)


def _fused_out(df: DataFrame) -> DataFrame:
    return df.select("domain", "day", "metric", "method", "type", "value", "score", "relative_magnitude",
                     F.array_join("affected", ",").alias("affected"), "params")


def q_fused_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Every detector's alerts in one table."""
    return _fused_out(fused(spark, d))


def q_priority_route(spark: SparkSession, d: str) -> DataFrame:
    """L3, L4: priority from the relative magnitude, channel and team per alert."""
    r = route(prioritize(fused(spark, d)))
    return r.select("domain", "day", "metric", "method", "type", "relative_magnitude", "priority", "channel", "team")


def q_cap_per_day(spark: SparkSession, d: str) -> DataFrame:
    """The strongest alerts per day (priority, then score)."""
    c = cap_per_day(fused(spark, d), n=CAP_N)
    return c.select("domain", "day", "metric", "method", "type", "priority", "score",
                    F.col("rank_in_day").cast("bigint").alias("rank_in_day"))


def q_adaptive_card(spark: SparkSession, d: str) -> DataFrame:
    """Adaptive Card per alert; the JSON is parsed back into its fields."""
    c = adaptive_card(fused(spark, d), FIXTURE_URL)
    j = lambda p: F.get_json_object("card", p)
    return c.select(
        "domain", "day", "metric", "method", "type",
        j("$.attachments[0].content.body[0].text").alias("title"),
        j("$.attachments[0].content.body[0].color").alias("color"),
        j("$.attachments[0].content.body[1].facts[0].value").alias("fact_metric"),
        j("$.attachments[0].content.body[1].facts[1].value").alias("fact_type"),
        j("$.attachments[0].content.body[1].facts[2].value").alias("fact_value"),
        j("$.attachments[0].content.body[1].facts[3].value").alias("fact_date"),
        j("$.attachments[0].content.actions[0].url").alias("url"),
    )


def q_message_card(spark: SparkSession, d: str) -> DataFrame:
    """L2: MessageCard per alert; the JSON is parsed back into its fields."""
    c = message_card(fused(spark, d))
    j = lambda p: F.get_json_object("card", p)
    return c.select(
        "domain", "day", "metric", "method", "type",
        j("$.themeColor").alias("color"), j("$.summary").alias("summary"),
        j("$.sections[0].activityTitle").alias("title"),
        *[j(f"$.sections[0].facts[{i}].name").alias(f"fact{i}_name") for i in range(4)],
        *[j(f"$.sections[0].facts[{i}].value").alias(f"fact{i}_value") for i in range(4)],
    )


def eval_labels(gl: DataFrame) -> DataFrame:
    """Labels by a threshold rule on the long-form gold series: a day is anomalous when its value
    is above 1.5x or below 0.5x its series mean."""
    m = F.avg("value").over(Window.partitionBy("domain", "metric"))
    return gl.withColumn("_m", m).select(
        "domain", "day", "metric",
        ((F.col("value") > F.lit(1.5) * F.col("_m")) | (F.col("value") < F.lit(0.5) * F.col("_m"))).alias("is_anomaly"))


def q_evaluate(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall, F1 of the k = 3.2 MAD alerts against the threshold labels."""
    gl = gold_long(spark, d)  # one plan feeds both sides, so Spark shares its stages
    a = seasonal_mad(gl, ["domain", "metric"], "day", "value", k=K_LOCAL)
    e = evaluate(a, eval_labels(gl))
    return e.select("tp", "fp", "fn", _r("precision"), _r("recall"), _r("f1"))


def q_precision_recall_curve(spark: SparkSession, d: str) -> DataFrame:
    """L6 over all thresholds: MAD scores of every gold row against the threshold labels."""
    s = scored_series(gold_long(spark, d), ["domain", "metric"], "day", "value")
    v, m = F.col("value"), F.col("series_mean")
    rows = s.select(F.round(F.abs(F.col("resid")) / F.col("mad"), 2).alias("score"),
                    ((v > F.lit(1.5) * m) | (v < F.lit(0.5) * m)).alias("is_anomaly"))
    return precision_recall_curve(rows).select("threshold", "anomalies", "alerts", "tp", "fp", "fn", _r("precision"), _r("recall"))


def q_alert_incidents(spark: SparkSession, d: str) -> DataFrame:
    """Runs of alert days per (domain, metric) over the fused alerts."""
    return incidents(fused(spark, d)).withColumn("methods", F.array_join("methods", ","))


def q_run_report(spark: SparkSession, d: str) -> DataFrame:
    """Domains, gold rows and alerts per method for one run (no clock columns)."""
    g, alerts = fused_with_gold(spark, d)
    return run_report(g, alerts)


def q_timed_report(spark: SparkSession, d: str) -> DataFrame:
    """The report with its clock columns, told as whether they lie between the query's begin and end."""
    started = _dt.datetime.now(_dt.timezone.utc)
    row = run_report(*fused_with_gold(spark, d), started_at=started)
    took = (_dt.datetime.now(_dt.timezone.utc) - started).total_seconds()
    end = F.lit(started) + F.make_dt_interval(secs=F.col("run_seconds"))
    return row.select("total_domains", "gold_rows", "total_alerts", F.col("run_seconds").between(0.0, took).alias("run_seconds_right"),
                      (F.abs(F.unix_micros("run_at") - F.unix_micros(end)) < 1000).alias("run_at_right"))


def _shared(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_alert_history(spark: SparkSession, d: str) -> DataFrame:
    """All alerts stored by day; then every fifth day of a month is run again and has MAD alerts alone, every seventh
    none; the window read back."""
    alerts, path = cut_lineage(_fused_out(fused(spark, d))), _shared(spark, "alert-history")
    write_alerts(alerts, path)
    days = [r[0] for r in alerts.select("day").distinct().collect()]  # at most the window's days
    write_alerts(alerts.where("method = 'seasonal_mad'"), path, days=[x for x in days if x.day % 5 == 0])
    write_alerts(alerts.where(F.lit(False)), path, days=[x for x in days if x.day % 7 == 0])
    return read_alerts(spark, path, WINDOW_START, fx.CUTOFF)


def _refuse_fifth_days(card: str, timeout: float) -> bool:
    facts = json.loads(card)["attachments"][0]["content"]["body"][1]["facts"]
    return int(facts[3]["value"][-2:]) % 5 != 0


def _take(card: str, timeout: float) -> bool:
    return True


def q_delivery_ledger(spark: SparkSession, d: str) -> DataFrame:
    """A5: all alerts' cards delivered to a receiver that refuses those of every fifth day of a month, then again to one
    that takes all: only the refused ones are sent the second time."""
    cards, path = cut_lineage(adaptive_card(fused(spark, d), FIXTURE_URL)), _shared(spark, "delivery-ledger")
    deliver_once(cards, _refuse_fifth_days, path, attempts=2)
    told = deliver_once(cards, _take, path)
    return told.select("domain", "day", "metric", "method", "type", "sent", "sent_before", "attempts_used")


def q_delivery_summary(spark: SparkSession, d: str) -> DataFrame:
    """Sent and total over all alerts, those of every fifth day of a month counting as not sent."""
    return delivery_summary(fused(spark, d).withColumn("sent", F.dayofmonth("day") % 5 != 0))


def q_retain(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of the last 30 days up to the cutoff."""
    return _fused_out(retain(fused(spark, d), fx.CUTOFF, 30))


def q_daily_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The DAILY job as configured (k = 3.5, contamination 0.01, forest >= 20 rows) on the fixtures."""
    a = daily_variant(fx.web_raw(spark, d), [fx.ads_raw(spark, d, "a"), fx.ads_raw(spark, d, "b")],
                      fx.dictionary_raw(spark, d), fx.CUTOFF, fx.DAYS, checkpoint_gold=True)
    return _fused_out(a)


def q_daily_alerts_sensitive(spark: SparkSession, d: str) -> DataFrame:
    """The DAILY job per nation with k = 1.0 and contamination 0.2, so that every method raises alerts."""
    a = daily_variant(fx.web_raw(spark, d), [fx.ads_raw(spark, d, "a"), fx.ads_raw(spark, d, "b")],
                      fx.dictionary_raw(spark, d, "nation"), F.lit(fx.CUTOFF), fx.DAYS, k=1.0, contamination=0.2)
    return _fused_out(a)


def q_cutoff_day(spark: SparkSession, d: str) -> DataFrame:
    """B4: 'yesterday' in America/Bogota for every event time read as a UTC instant."""
    e = fx.table(spark, d, "events").select("event_id", "ts")
    return e.select("event_id", cutoff_day("America/Bogota", F.col("ts"), now_zone="UTC").alias("cutoff"))


QUERIES: dict[str, Query] = {
    "normalize_ids": q_normalize_ids,
    "window_filter": q_window_filter,
    "web_daily": q_web_daily,
    "ads_daily": q_ads_daily,
    "spend_by_domain": q_spend_by_domain,
    "web_by_domain": q_web_by_domain,
    "combine_sources": q_combine_sources,
    "gold_daily": q_gold_daily,
    "scored_events": q_scored_events,
    "decompose_events": q_decompose_events,
    "mad_bounds": q_mad_bounds,
    "mad_alerts_all": q_mad_alerts_all,
    "mad_alerts_latest": q_mad_alerts_latest,
    "iforest_scores": q_iforest_scores,
    "iforest_alerts": q_iforest_alerts,
    "iforest_latest": q_iforest_latest,
    "iforest_latest_rank": q_iforest_latest_rank,
    "iforest_long": q_iforest_long,
    "score_p99": q_score_p99,
    "iforest_model_scores": q_iforest_model_scores,
    "stl_events": q_stl_events,
    "long_series_bounds": q_long_series_bounds,
    "anscombe": q_anscombe,
    "anscombe_filled": q_anscombe_filled,
    "standardize": q_standardize,
    "missing_days": q_missing_days,
    "range_alerts": q_range_alerts,
    "duplicate_days": q_duplicate_days,
    "validate": q_validate,
    "series_status": q_series_status,
    "changed_days": q_changed_days,
    "window_profiles": q_window_profiles,
    "fused_alerts": q_fused_alerts,
    "priority_route": q_priority_route,
    "cap_per_day": q_cap_per_day,
    "adaptive_card": q_adaptive_card,
    "message_card": q_message_card,
    "evaluate": q_evaluate,
    "precision_recall_curve": q_precision_recall_curve,
    "alert_incidents": q_alert_incidents,
    "run_report": q_run_report,
    "retain": q_retain,
    "delivery_summary": q_delivery_summary,
    "timed_report": q_timed_report,
    "alert_history": q_alert_history,
    "delivery_ledger": q_delivery_ledger,
    "daily_alerts": q_daily_alerts,
    "daily_alerts_sensitive": q_daily_alerts_sensitive,
    "cutoff_day": q_cutoff_day,
}
