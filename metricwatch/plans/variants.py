"""The two end-to-end variants, from inputs to fused alerts.

LOCAL is one lazy plan; DAILY runs the ETL when it is called (gold is checkpointed) and the
detectors lazily.

LOCAL: every day of every series is tested (k = 3.2, contamination 0.01, forest minimum 10 rows).
DAILY: only the cutoff day is tested, and only for series that end on it (k = 3.5 configured,
contamination 0.01, forest minimum 20 rows).

No per-domain loop: the univariate detector runs on the long form (domain, metric) in one
window plan and the forest on (domain) in another. Both branches consume the gold table, and
each prunes it differently, so Spark cannot share one evaluation of it between them; the
daily job therefore writes gold once to the cluster's checkpoint folder (``checkpoint_gold``,
on by default): the raw tables are scanned and aggregated once, and a lost executor later on
re-reads the small gold files instead of re-running the raw-table aggregation. Callers of
``local_variant`` with a gold plan built from raw tables should do the same (``cut_lineage``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import anscombe, cutoff_day
from metricwatch.functions.plan import cut_lineage
from metricwatch.operators.alerts import DAILY_CAP, adaptive_card, cap_per_day, fuse_alerts, prioritize, route, run_report
from metricwatch.operators.detect import seasonal_mad
from metricwatch.operators.forest_model import iforest_fit, iforest_model_alerts, iforest_score, with_cutoff
from metricwatch.operators.gold import GOLD_METRICS, build_gold
from metricwatch.operators.iforest import iforest_alerts
from metricwatch.operators.quality import missing_day_alerts, missing_days, range_alerts, range_rules
from metricwatch.operators.series import calendar_fill, to_long
from metricwatch.sources.changes import read_gold, refresh_gold
from metricwatch.sources.history import as_date, manifest, read_days, write_days
from metricwatch.sources.ledger import deliver_once
from metricwatch.sources.sinks import deliver, delivery_summary, write_alerts, write_report
from metricwatch.sources.tables import account_dictionary


COUNT_METRICS = ("leads", "sessions")


def tested_long(long: DataFrame, anscombe_counts: bool, fill_calendar: bool = False,
                count_metrics=COUNT_METRICS) -> tuple[DataFrame, str]:
    """Long form plus the column the univariate test runs on (F13: Anscombe on counts, optional).

    Missing calendar days are filled with 0 before the transform, so they are 0 as raw values and
    the transform of 0 as tested ones.
    """
    if fill_calendar:
        long = calendar_fill(long, ["domain", "metric"], "day", "value")
    if not anscombe_counts:
        return long, "value"
    t = F.when(F.col("metric").isin(*count_metrics), anscombe("value")).otherwise(F.col("value"))
    return long.withColumn("value_tested", t), "value_tested"


def local_variant(gold: DataFrame, k: float = 3.2, contamination: float = 0.01, min_rows: int = 14,
                  forest_min_rows: int = 10, metrics=GOLD_METRICS, quality: bool = False, start=None, end=None, domains: DataFrame | None = None,
                  fill_calendar: bool = False, anscombe_counts: bool = False,
                  forest_percentile: float | None = None, standardize: bool = False,
                  count_metrics=COUNT_METRICS, rules=None, decomposition: str = "classical") -> DataFrame:
    """Every flagged day of every (domain, metric) series plus every forest outlier day.

    With ``quality=True`` missing-day alerts over [start, end] (for ``domains`` or the gold
    domains) and range alerts are fused in as well. ``anscombe_counts`` tests 2·sqrt(x + 3/8) of
    the count metrics (leads, sessions) instead of the raw counts; alerts still report raw values.
    ``forest_percentile`` (F15) replaces the contamination cut-off by a score percentile and
    ``standardize`` (F14) scales the forest features per domain first. ``decomposition="loess"`` takes robust Loess.
    """
    long = to_long(gold, ["domain", "day"], list(metrics))
    tested, col = tested_long(long, anscombe_counts, fill_calendar, count_metrics)
    uni = seasonal_mad(tested, ["domain", "metric"], "day", col, k=k, min_rows=min_rows, report_value="value",
                       decomposition=decomposition)
    multi = iforest_alerts(gold, ["domain"], "day", list(metrics), contamination=contamination,
                           min_rows=forest_min_rows, percentile=forest_percentile, standardize=standardize)
    parts = [uni, multi]
    if quality:
        spark = gold.sparkSession
        if start is not None and end is not None:
            parts.append(missing_day_alerts(missing_days(gold, ["domain"], "day", start, end, domains),
                                            ["domain"], "day"))
        parts.append(range_alerts(long, range_rules(spark, rules)))
    return fuse_alerts(*parts)


def daily_variant(web_raw: DataFrame, ads_raws: list[DataFrame], dictionary_raw: DataFrame,
                  cutoff: _dt.date | str | Column | None = None, days: int = 65, k: float = 3.5, contamination: float = 0.01,
                  min_rows: int = 14, forest_min_rows: int = 20, checkpoint_gold: bool = True, tz: str | None = None,
                  quality: bool = True, dict_cols: tuple[str, str] = ("AccountID", "domain"), gold_path: str | None = None,
                  **options) -> DataFrame:
    """The production job: raw daily tables -> gold -> alerts of the cutoff day.

    ``cutoff`` is a date, ISO text or a Column; without one it is yesterday in the time zone ``tz``
    (B4). With ``gold_path`` gold is a stored table by day: the run aggregates the days of the window that are
    new or have changed since (:func:`refresh_gold`: late rows, days that earlier runs have skipped) and reads the window
    from there. Without it the whole window is aggregated and checkpointed. With ``quality`` a dictionary domain
    without a row on that day (with ``calendar``: on any day of the window) raises a missing-day alert
    and values out of range raise one each. With ``model_path`` the forest is a stored model that is fitted anew every
    ``refit_days`` days. Further ``options`` go to :func:`daily_alerts` or
    :func:`build_gold` by name.
    """
    return daily_gold_and_alerts(web_raw, ads_raws, dictionary_raw, cutoff, days, k, contamination, min_rows, forest_min_rows,
                                 checkpoint_gold, tz, quality, dict_cols, gold_path, **options)[1]


def daily_gold_and_alerts(web_raw: DataFrame, ads_raws: list[DataFrame], dictionary_raw: DataFrame,
                          cutoff: _dt.date | str | Column | None = None, days: int = 65, k: float = 3.5, contamination: float = 0.01,
                          min_rows: int = 14, forest_min_rows: int = 20, checkpoint_gold: bool = True, tz: str | None = None,
                          quality: bool = True, dict_cols: tuple[str, str] = ("AccountID", "domain"), gold_path: str | None = None,
                          **options) -> tuple[DataFrame, DataFrame]:
    """The gold window of :func:`daily_variant` (checkpointed or stored) and its alerts."""
    model_path, refit_days = options.pop("model_path", None), options.pop("refit_days", 7)
    if cutoff is None:
        if tz is None:
            raise ValueError("daily_variant needs a cutoff or a time zone")
        cutoff = cutoff_day(tz)
    cutoff = cutoff if isinstance(cutoff, Column | _dt.date) else _dt.date.fromisoformat(str(cutoff))
    detect = {n: options.pop(n) for n in ("metrics", "fill_calendar", "anscombe_counts", "forest_percentile", "standardize",
                                          "count_metrics", "rules", "decomposition") if n in options}
    if options.pop("calendar", False):
        detect["calendar_days"] = days
    if gold_path is not None:
        cutoff = as_date(web_raw.sparkSession, cutoff)
        refresh_gold(web_raw, ads_raws, dictionary_raw, gold_path, cutoff, days, dict_cols=dict_cols, **options)
        gold = read_gold(web_raw.sparkSession, gold_path, cutoff - _dt.timedelta(days=days), cutoff)
    else:
        gold = build_gold(web_raw, ads_raws, dictionary_raw, cutoff, days, dict_cols=dict_cols, **options)
        if checkpoint_gold:
            gold = cut_lineage(gold)
    if model_path is not None:
        if detect.get("standardize"):
            raise ValueError("a stored forest is fitted on raw values")
        detect["forest_model"] = stored_forest(gold, model_path, as_date(gold.sparkSession, cutoff), refit_days, contamination,
                                               detect.get("forest_percentile"), detect.get("metrics", GOLD_METRICS))
    domains = account_dictionary(dictionary_raw, *dict_cols).select("domain").distinct() if quality else None
    return gold, daily_alerts(gold, cutoff, k, contamination, min_rows, forest_min_rows, domains=domains, quality=quality, **detect)


def stored_forest(gold: DataFrame, path: str, cutoff: _dt.date, refit_days: int = 7, contamination: float = 0.01,
                  percentile: float | None = None, metrics=GOLD_METRICS) -> DataFrame:
    """The forest of every domain to score ``cutoff`` in: the last one stored for a day in the ``refit_days`` up to it.

    If there is none, it is fitted on the days of ``gold`` before the cutoff, with its cut-off score, and stored for the cutoff day.
    """
    spark, key, metrics = gold.sparkSession, ["domain"], list(metrics)
    fresh = [d for d in manifest(spark, path.rstrip("/"))["days"] if 0 <= (cutoff - _dt.date.fromisoformat(d)).days < refit_days]
    if not fresh:
        old = gold.filter(F.col("day") < F.lit(cutoff))
        model = cut_lineage(iforest_fit(old, key, "day", metrics))
        full = with_cutoff(model, iforest_score(old, model, key, metrics), key, contamination, percentile)
        write_days(full.withColumn("day", F.lit(cutoff)), path, [cutoff])
        fresh = [cutoff.isoformat()]
    return read_days(spark, path, max(fresh), max(fresh)).drop("day")


def daily_alerts(gold: DataFrame, cutoff: _dt.date | Column, k: float = 3.5,
                 contamination: float = 0.01, min_rows: int = 14, forest_min_rows: int = 20,
                 metrics=GOLD_METRICS, fill_calendar: bool = False, anscombe_counts: bool = False,
                 forest_percentile: float | None = None, standardize: bool = False, count_metrics=COUNT_METRICS,
                 quality: bool = False, domains: DataFrame | None = None, rules=None, calendar_days: int = 0,
                 decomposition: str = "classical", forest_model: DataFrame | None = None) -> DataFrame:
    """DAILY detection on an existing gold table: alerts dated ``cutoff`` only.

    Missing days are looked for from ``calendar_days`` before the cutoff on; those alerts are dated on the missing day.
    With a ``forest_model`` (:func:`stored_forest`) the day is scored in it instead of a forest fitted on the window.
    """
    day = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    long = to_long(gold, ["domain", "day"], list(metrics))
    tested, col = tested_long(long, anscombe_counts, fill_calendar, count_metrics)
    uni = seasonal_mad(tested, ["domain", "metric"], "day", col, k=k, min_rows=min_rows,
                       latest_only=True, cutoff=day, report_value="value", decomposition=decomposition)
    if forest_model is not None:
        multi = iforest_model_alerts(gold.filter(F.col("day") == day), forest_model, ["domain"], "day", list(metrics), forest_min_rows,
                                     f"Contam={contamination}" if forest_percentile is None else f"P{forest_percentile}")
    else:
        multi = iforest_alerts(gold, ["domain"], "day", list(metrics), contamination=contamination,
                               min_rows=forest_min_rows, latest_only=True, cutoff=day,
                               percentile=forest_percentile, standardize=standardize)
    parts = [uni, multi]
    if quality:
        parts.append(missing_day_alerts(missing_days(gold, ["domain"], "day", F.date_sub(day, calendar_days), day, domains), ["domain"], "day"))
        parts.append(range_alerts(long.filter(F.col("day") == day), range_rules(gold.sparkSession, rules)))
    return fuse_alerts(*parts)


def daily_job(web_raw: DataFrame, ads_raws: list[DataFrame], dictionary_raw: DataFrame, history: str, report: str,
              send=None, dashboard_url: str = "", cap: int = DAILY_CAP, ledger: str | None = None, **options) -> DataFrame:
    """The whole run: alerts of the day into the history, the strongest ``cap`` delivered, the report
    written once all that is done. Returns the one-row report.

    A rerun replaces its day in the history, also by nothing. With ``calendar=True`` missing days of the
    whole window are found; in the history they join the alerts that their day has. With ``ledger`` cards
    that an earlier run has delivered are not sent again. The report adds how many alerts the cap held
    back from delivery, and sent and total cards.
    """
    started = _dt.datetime.now(_dt.timezone.utc)
    spark = web_raw.sparkSession
    cutoff = as_date(spark, options.pop("cutoff", None) or cutoff_day(options.pop("tz")))
    gold, found = daily_gold_and_alerts(web_raw, ads_raws, dictionary_raw, cutoff, **options)
    alerts = cut_lineage(route(prioritize(found)))
    earlier = [r[0] for r in alerts.select("day").where(F.col("day") != F.lit(cutoff)).distinct().collect()]  # at most the window's days
    rows = alerts
    if earlier:  # such days keep their other alerts
        had = read_days(spark, history, min(earlier), max(earlier), _ddl(alerts)).where(
            F.col("day").isin(earlier) & (F.col("method") != "missing_day"))
        rows = cut_lineage(alerts.unionByName(had, allowMissingColumns=True).select(*alerts.columns))
    write_alerts(rows, history, days=[cutoff, *earlier])
    shown = cap_per_day(alerts, n=cap)
    n_all, n_shown = alerts.count(), shown.count()
    counts = {"held_back": n_all - n_shown, "sent": 0, "total": 0}
    if send is not None:
        cards = adaptive_card(shown, dashboard_url)
        counts |= delivery_summary(deliver_once(cards, send, ledger) if ledger else deliver(cards, send)).head().asDict()
    row = run_report(gold, alerts, started_at=started)
    row = row.withColumns({k: F.lit(v).cast("bigint") for k, v in counts.items()})
    write_report(row, report)
    return row


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
