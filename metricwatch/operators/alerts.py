"""Alert shaping: H2 fuse, L4 prioritize, L3 route, G3 cap, L1/L2 cards, A4 report, A6 retain."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.columns import python_float_text
from metricwatch.functions.plan import cut_lineage

# Unified alert schema (the series key column is ``domain``).
ALERT_SCHEMA = [
    ("domain", "string"), ("day", "date"), ("metric", "string"), ("method", "string"),
    ("type", "string"), ("value", "double"), ("score", "double"), ("relative_magnitude", "double"),
    ("affected", "array<string>"), ("context", "map<string,double>"), ("params", "string"),
]
ALERT_COLUMNS = [c for c, _ in ALERT_SCHEMA]

# Fixed values from the reference configuration.
PRIORITY_THRESHOLDS = {"critical": 80.0, "high": 50.0, "medium": 25.0, "low": 10.0}
PRIORITIES = ("critical", "high", "medium", "low")
CHANNEL_MAIN = "alertas-marketing"
CHANNEL_CRITICAL = "alertas-criticas"
DAILY_CAP = 100

# Card wording of the reference (labels per type code, texts, colours).
TYPE_WORDING = {
    "code": {"spike": "spike", "drop": "drop", "irregular": "irregular", "missing": "missing", "range": "range"},
    "local": {"spike": "pico", "drop": "caida", "irregular": "patron_multivariante", "missing": "faltante",
              "range": "fuera_de_rango"},
    "daily": {"spike": "Pico Inusual", "drop": "Caída Abrupta", "irregular": "Patrón Irregular (Gasto/Tráfico)",
              "missing": "Día Faltante", "range": "Fuera de Rango"},
}
METHOD_WORDING = {"seasonal_mad": "STL+MAD", "iforest": "Isolation Forest", "missing_day": "Calendario",
                  "out_of_range": "Rango"}
# Own choice: how quality alerts (missing days, values out of range) look on a MessageCard.
QUALITY_COLOR = "7B1FA2"
QUALITY_RULE_FACT = "Regla:"
MULTIVARIATE_LABEL = "Multivariante"
NA = "N/A"
# Adaptive Card (L1) texts, in card order.
ADAPTIVE = {
    "emoji_drop": "🚨", "emoji_other": "📈", "title_sep": " Alerta: ", "domain_default": "Dominio",
    "weight": "Bolder", "size": "Medium", "color_drop": "Attention", "color_other": "Warning",
    "fact_metric": "Métrica:", "fact_type": "Tipo:", "fact_value": "Valor:", "fact_date": "Fecha:",
    "link_title": "📊 Ver en Power BI", "version": "1.4",
    "content_type": "application/vnd.microsoft.card.adaptive",
}
# MessageCard (L2) texts, in card order.
MESSAGE = {
    "context": "http://schema.org/extensions",
    "color_spike": "FFA500", "color_other": "008000", "color_multi": "FF0000",
    "summary_prefix": "Alerta - ", "summary_sep": " - ", "summary_multi": "Alerta - Patrón Multivariante",
    "emoji_spike": "📈", "emoji_other": "📉", "title_mid": " ALERTA - ", "title_end": " DETECTADA",
    "title_multi": "🤖 ALERTA - PATRÓN MULTIVARIANTE",
    "fact_metric": "Métrica:", "fact_date": "Fecha:", "fact_magnitude": "Magnitud:", "fact_method": "Método:",
    "fact_score": "Score:", "fact_metrics": "Métricas:",
}


def conform(df: DataFrame, key: str = "domain") -> DataFrame:
    """Project any detector output onto the unified alert schema (missing columns -> NULL)."""
    cols = []
    for c, t in ALERT_SCHEMA:
        src = key if c == "domain" else c
        cols.append(f"CAST({f'`{src}`' if src in df.columns else 'NULL'} AS {t}) AS {c}")
    return df.selectExpr(*cols)


def fuse_alerts(*dfs: DataFrame, key: str = "domain") -> DataFrame:
    """H2: all detectors' alerts in one table, no de-duplication (bag union)."""
    return reduce(lambda a, b: a.unionByName(b), [conform(d, key) for d in dfs])


def prioritize(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """L4: priority from the relative magnitude (percent): critical >= 80, high >= 50,
    medium >= 25, low >= 10, else NULL. Missing days are critical (zero tolerance); other
    alerts without a magnitude (forest, range) take NULL.
    """
    t = thresholds or PRIORITY_THRESHOLDS
    unknown = set(t) - set(PRIORITIES)
    if unknown:
        raise ValueError(f"priorities are {', '.join(PRIORITIES)}; not {', '.join(sorted(unknown))}")
    m = F.col("relative_magnitude")
    pr = F.when(F.col("method") == "missing_day", F.lit("critical"))
    for name, lo in sorted(t.items(), key=lambda kv: -kv[1]):
        pr = pr.when(m >= F.lit(lo), F.lit(name))
    return df.withColumn("priority", pr)


def priority_rank(c: Column | str = "priority") -> Column:
    """critical 0, high 1, medium 2, low 3, NULL 4: sort key for 'strongest first'."""
    p = F.col(c) if isinstance(c, str) else c
    return (F.when(p == "critical", 0).when(p == "high", 1).when(p == "medium", 2)
            .when(p == "low", 3).otherwise(4))


def route(df: DataFrame) -> DataFrame:
    """L3: channel (critical priority -> critical channel) and owning team by case:
    traffic drop -> technical/SEO, spend -> performance marketing, data quality -> analytics/IT,
    anything else -> the main channel's marketing team.
    """
    team = (
        F.when(F.col("method").isin("missing_day", "out_of_range"), F.lit("analytics_it"))
        .when((F.col("metric") == "sessions") & (F.col("type") == "drop"), F.lit("technical_seo"))
        .when(F.col("metric") == "spend", F.lit("performance"))
        .when(F.col("method") == "iforest", F.lit("performance"))
        .otherwise(F.lit("marketing"))
    )
    channel = F.when(F.col("priority") == "critical", F.lit(CHANNEL_CRITICAL)).otherwise(F.lit(CHANNEL_MAIN))
    return df.withColumn("channel", channel).withColumn("team", team)


def cap_per_day(df: DataFrame, n: int = DAILY_CAP, salts: int = 64) -> DataFrame:
    """At most ``n`` alerts per day, strongest first (priority, then score desc), with a
    total tie-break (domain, metric, method, type) so the cut is deterministic.

    Two-phase top-n: first the top n per (day, salt) where the salt is a hash of the alert's
    identity, then the top n per day among those candidates (at most ``salts * n`` rows per
    day). The global top n of a day is always among the per-salt top n, so the result is exact,
    and no single task ever receives all alerts of a busy day.
    """
    if "priority" not in df.columns:
        df = prioritize(df)
    order = [priority_rank("priority"), F.col("score").desc_nulls_last(), F.col("domain").asc_nulls_last(),
             F.col("metric").asc_nulls_last(), F.col("method"), F.col("type")]
    salt = F.pmod(F.xxhash64("domain", "metric", "method", "type"), F.lit(salts))
    first = (
        df.withColumn("_salt", salt)
        .withColumn("_r", F.row_number().over(Window.partitionBy("day", "_salt").orderBy(*order)))
        .filter(F.col("_r") <= n)
    )
    final = first.withColumn("rank_in_day", F.row_number().over(Window.partitionBy("day").orderBy(*order)))
    return final.filter(F.col("rank_in_day") <= n).drop("_salt", "_r")


def value_text(c: str = "value") -> Column:
    """The alert value as text, 'N/A' when NULL (as the reference renders it)."""
    return F.coalesce(python_float_text(F.col(c)), F.lit(NA))


def _wording(col: Column, wording: str) -> Column:
    m = TYPE_WORDING[wording]
    out = None
    for k, v in m.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(col)


def adaptive_card(df: DataFrame, dashboard_url: str, wording: str = "daily") -> DataFrame:
    """L1: one Adaptive Card JSON document per alert, in column ``card``.

    Title '<emoji> Alerta: <domain>' (🚨 and colour 'Attention' for a drop, 📈 and 'Warning'
    otherwise), a fact set (metric, type, value, date) and a link to the dashboard. Built with
    ``to_json(named_struct(...))`` on the executors.
    """
    t = ADAPTIVE
    lit = F.lit
    is_drop = F.col("type") == "drop"
    metric = F.coalesce(F.col("metric"), F.when(F.col("method") == "iforest", lit(MULTIVARIATE_LABEL)), lit(NA))
    tipo = F.coalesce(_wording(F.col("type"), wording), lit(NA))
    fact = lambda title, v: F.struct(lit(title).alias("title"), v.alias("value"))
    body = F.array(
        F.struct(
            lit("TextBlock").alias("type"),
            F.concat(F.when(is_drop, lit(t["emoji_drop"])).otherwise(lit(t["emoji_other"])), lit(t["title_sep"]),
                     F.coalesce(F.col("domain"), lit(t["domain_default"]))).alias("text"),
            lit(t["weight"]).alias("weight"), lit(t["size"]).alias("size"),
            F.when(is_drop, lit(t["color_drop"])).otherwise(lit(t["color_other"])).alias("color"),
            lit(None).cast("array<struct<title:string,value:string>>").alias("facts"),
        ),
        F.struct(
            lit("FactSet").alias("type"),
            lit(None).cast("string").alias("text"), lit(None).cast("string").alias("weight"),
            lit(None).cast("string").alias("size"), lit(None).cast("string").alias("color"),
            F.array(fact(t["fact_metric"], metric), fact(t["fact_type"], tipo), fact(t["fact_value"], value_text()),
                    fact(t["fact_date"], F.date_format("day", "yyyy-MM-dd"))).alias("facts"),
        ),
    )
    content = F.struct(
        lit("AdaptiveCard").alias("type"), lit(t["version"]).alias("version"), body.alias("body"),
        F.array(F.struct(lit("Action.OpenUrl").alias("type"), lit(t["link_title"]).alias("title"),
                         lit(dashboard_url).alias("url"))).alias("actions"),
    )
    payload = F.struct(
        lit("message").alias("type"),
        F.array(F.struct(lit(t["content_type"]).alias("contentType"), content.alias("content"))).alias("attachments"),
    )
    return df.withColumn("card", F.to_json(payload, {"ignoreNullFields": "true"}))


def message_card(df: DataFrame, wording: str = "local") -> DataFrame:
    """L2: the older MessageCard JSON per alert, in column ``card``.

    Univariate alerts: colour FFA500 for a spike, 008000 otherwise; title
    '<📈|📉> ALERTA - <TYPE> DETECTADA'; facts metric, date, magnitude '%', method. Forest
    alerts: colour FF0000, facts score, metrics (comma-joined), date. The branch is chosen by
    method code, not by display text.
    """
    t = MESSAGE
    lit = F.lit
    is_if = F.col("method") == "iforest"
    is_spike = F.col("type") == "spike"
    tipo = _wording(F.col("type"), wording)
    day_txt = F.date_format("day", "yyyy-MM-dd")
    fact = lambda name, v: F.struct(lit(name).alias("name"), v.alias("value"))
    uni_facts = F.array(
        fact(t["fact_metric"], F.coalesce(F.col("metric"), lit(NA))), fact(t["fact_date"], day_txt),
        fact(t["fact_magnitude"],
             F.concat(F.coalesce(python_float_text(F.col("relative_magnitude")), lit(NA)), lit("%"))),
        fact(t["fact_method"], F.coalesce(_method_text(), F.col("method"))),
    )
    if_facts = F.array(
        fact(t["fact_score"], F.coalesce(python_float_text(F.col("score")), lit(NA))),
        fact(t["fact_metrics"], F.array_join(F.col("affected"), ", ")),
        fact(t["fact_date"], day_txt),
    )
    is_quality = F.col("method").isin("missing_day", "out_of_range")
    quality_facts = F.array(
        fact(t["fact_metric"], F.coalesce(F.col("metric"), lit(NA))), fact(t["fact_date"], day_txt),
        fact(QUALITY_RULE_FACT, F.col("params")), fact(t["fact_method"], F.coalesce(_method_text(), F.col("method"))),
    )
    color = F.when(is_if, lit(t["color_multi"])).when(is_quality, lit(QUALITY_COLOR)).when(is_spike, lit(t["color_spike"])).otherwise(lit(t["color_other"]))
    summary = F.when(is_if, lit(t["summary_multi"])).otherwise(
        F.concat(lit(t["summary_prefix"]), tipo, lit(t["summary_sep"]), F.coalesce(F.col("metric"), lit(NA))))
    title = F.when(is_if, lit(t["title_multi"])).otherwise(
        F.concat(F.when(is_spike, lit(t["emoji_spike"])).otherwise(lit(t["emoji_other"])), lit(t["title_mid"]),
                 F.upper(tipo), lit(t["title_end"])))
    payload = F.struct(
        lit("MessageCard").alias("@type"), lit(t["context"]).alias("@context"),
        color.alias("themeColor"), summary.alias("summary"),
        F.array(F.struct(title.alias("activityTitle"),
                         F.when(is_if, if_facts).when(is_quality, quality_facts).otherwise(uni_facts).alias("facts"))).alias("sections"),
    )
    return df.withColumn("card", F.to_json(payload))


def _method_text() -> Column:
    out = None
    for k, v in METHOD_WORDING.items():
        out = F.when(F.col("method") == k, F.lit(v)) if out is None else out.when(F.col("method") == k, F.lit(v))
    return out


def run_report(gold: DataFrame, alerts: DataFrame, started_at: _dt.datetime | None = None,
               key: str = "domain") -> DataFrame:
    """A4 + D5 + D7 + D14 (+ L7): one-row run report.

    Columns: total_domains, gold_rows, total_alerts, alerts_seasonal_mad, alerts_iforest,
    alerts_missing, alerts_range; with ``started_at`` also run_at and run_seconds. The two
    inputs are tagged and unioned so that one aggregation produces the row: no join.
    """
    g = gold.select(F.col(key).alias("_dom"), F.lit(None).cast("string").alias("_method"), F.lit(1).alias("_g"))
    a = alerts.select(F.lit(None).cast("string").alias("_dom"), F.col("method").alias("_method"), F.lit(0).alias("_g"))
    u = g.unionByName(a)
    m = F.col("_method")
    rep = u.agg(
        F.countDistinct("_dom").cast("bigint").alias("total_domains"),
        F.sum("_g").cast("bigint").alias("gold_rows"),
        F.count_if(F.col("_g") == 0).cast("bigint").alias("total_alerts"),
        F.count_if(m == "seasonal_mad").cast("bigint").alias("alerts_seasonal_mad"),
        F.count_if(m == "iforest").cast("bigint").alias("alerts_iforest"),
        F.count_if(m == "missing_day").cast("bigint").alias("alerts_missing"),
        F.count_if(m == "out_of_range").cast("bigint").alias("alerts_range"),
    )
    rep = rep.withColumn("gold_rows", F.coalesce(F.col("gold_rows"), F.lit(0).cast("bigint")))
    if started_at is not None:
        # the one row is made (with everything lazy behind it) before the clock is read
        rep = cut_lineage(rep)
        now = _dt.datetime.now(_dt.timezone.utc)
        rep = rep.withColumn("run_at", F.lit(now)).withColumn("run_seconds", F.lit((now - started_at.astimezone(_dt.timezone.utc)).total_seconds()))
    return rep


def retain(df: DataFrame, cutoff, days: int = 30, order: str = "day") -> DataFrame:
    """Keep the last ``days`` days up to ``cutoff`` (older history is dropped)."""
    c = cutoff if isinstance(cutoff, Column) else F.lit(
        cutoff if isinstance(cutoff, _dt.date) else _dt.date.fromisoformat(str(cutoff)))
    return df.filter(F.col(order).between(F.date_sub(c, days), c))
