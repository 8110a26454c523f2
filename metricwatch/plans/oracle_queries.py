"""SQL statements (DuckDB dialect) for each registered query, by name."""

from __future__ import annotations

from metricwatch.plans.oracle import (
    ADS_DAILY, ADS_RAW, ALL_GOLD, CUTOFF, DAYS, DICTIONARY, WEB_DAILY, WEB_RAW, _in_window, with_,
)

SQL: dict[str, str] = {}

SQL["normalize_ids"] = with_(DICTIONARY) + "\nSELECT account_id_norm, domain FROM dict"

SQL["window_filter"] = f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE {_in_window('o_orderdate')}"""

SQL["web_daily"] = with_(WEB_RAW, WEB_DAILY) + "\nSELECT account_id_norm, day, leads, sessions FROM web"

SQL["ads_daily"] = with_(ADS_RAW, ADS_DAILY) + "\nSELECT source, account_id_norm, day, spend FROM ads"

SQL["spend_by_domain"] = with_(DICTIONARY, ADS_RAW, ADS_DAILY) + """
SELECT d.domain, a.day, CAST(sum(a.spend) AS BIGINT) AS spend
FROM ads a JOIN dict d ON a.account_id_norm = d.account_id_norm GROUP BY 1, 2"""

SQL["web_by_domain"] = with_(DICTIONARY, WEB_RAW, WEB_DAILY) + """
SELECT d.domain, w.day, CAST(sum(w.leads) AS BIGINT) AS leads, CAST(sum(w.sessions) AS BIGINT) AS sessions
FROM web w JOIN dict d ON w.account_id_norm = d.account_id_norm GROUP BY 1, 2"""

SQL["combine_sources"] = with_(ALL_GOLD) + "\nSELECT domain, day, spend, leads, sessions FROM gold"

SQL["gold_daily"] = with_(ALL_GOLD) + "\nSELECT domain, day, spend, leads, sessions FROM gold ORDER BY domain, day"

# ------------------------------------------------------------------ series and detectors
from metricwatch.plans.oracle import EVENTS_DAILY, GOLD_LONG, decompose_sql, iforest_sql, loess_sql, mad_sql  # noqa: E402

_FEATS = ["events", "value_sum", "users"]
_GOLD_FEATS = ["spend", "leads", "sessions"]


def _r(c: str) -> str:
    return f"round({c}, 6) AS {c}"


SQL["scored_events"] = with_(EVENTS_DAILY, decompose_sql("ev", ["event_type"], "day", "events"),
                             mad_sql("dec", ["event_type"], 3.2)) + f"""
SELECT event_type, day, _y AS value, {_r('trend')}, {_r('seasonal')}, {_r('resid')}, {_r('resid_median')},
       {_r('mad')}, {_r('lower')}, {_r('upper')}, (resid > upper OR resid < lower) AS is_outlier
FROM mad"""

SQL["decompose_events"] = with_(EVENTS_DAILY, decompose_sql("ev", ["event_type"], "day", "events")) + f"""
SELECT event_type, day, pos, n, _y AS value, {_r('trend')}, {_r('seasonal')}, {_r('resid')} FROM dec"""

SQL["mad_bounds"] = with_(EVENTS_DAILY, decompose_sql("ev", ["event_type"], "day", "events"),
                          mad_sql("dec", ["event_type"], 3.2)) + f"""
SELECT DISTINCT event_type, n, {_r('resid_median')}, {_r('mad')}, {_r('lower')}, {_r('upper')} FROM mad"""

_ALERT_SELECT = """
SELECT domain, day, metric, 'seasonal_mad' AS method, CASE WHEN resid > 0 THEN 'spike' ELSE 'drop' END AS type,
       _y AS value, round(abs(resid) / mad, 2) AS score,
       CASE WHEN series_mean <> 0 THEN round(abs(resid) / series_mean * 100.0, 2) ELSE 0.0 END AS relative_magnitude,
       metric AS affected, '{params}' AS params
FROM mad WHERE (resid > upper OR resid < lower){extra}"""

SQL["mad_alerts_all"] = with_(ALL_GOLD, GOLD_LONG, decompose_sql("gold_long", ["domain", "metric"], "day", "value"),
                              mad_sql("dec", ["domain", "metric"], 3.2)) + _ALERT_SELECT.format(params="MAD=3.2", extra="")

_FRESH = f"""
fresh AS (
  SELECT * FROM (SELECT *, max(day) OVER (PARTITION BY domain, metric) AS _last FROM gold_long)
  WHERE _last = CAST('{CUTOFF}' AS DATE)
)"""

SQL["mad_alerts_latest"] = with_(ALL_GOLD, GOLD_LONG, _FRESH, decompose_sql("fresh", ["domain", "metric"], "day", "value"),
                                 mad_sql("dec", ["domain", "metric"], 1.0)) + _ALERT_SELECT.format(
    params="MAD=1.0", extra=" AND pos = n - 1")

SQL["iforest_scores"] = with_(EVENTS_DAILY, iforest_sql("ev", ["event_type"], "day", _FEATS)) + f"""
SELECT event_type, day, events, {_r('value_sum')}, users, n, psi, {_r('mean_path')}, {_r('score')} FROM ifo"""


def _forest_alerts(q: float, params: str) -> str:
    return with_(EVENTS_DAILY, iforest_sql("ev", ["event_type"], "day", _FEATS)) + f""",
th AS (SELECT *, quantile_cont(score, {q}) OVER (PARTITION BY event_type) AS q FROM ifo WHERE n >= 10)
SELECT event_type, day, 'iforest' AS method, 'irregular' AS type, round(score - q, 4) AS score,
       'events,value_sum,users' AS affected, CAST(events AS DOUBLE) AS ctx_events,
       round(value_sum, 6) AS ctx_value_sum, CAST(users AS DOUBLE) AS ctx_users, '{params}' AS params
FROM th WHERE score > q"""


SQL["iforest_alerts"] = _forest_alerts(0.95, "Contam=0.05")
SQL["score_p99"] = _forest_alerts(0.99, "P99.0")

SQL["iforest_latest_rank"] = with_(ALL_GOLD, f"""
g AS (SELECT * FROM gold WHERE day <= CAST('{CUTOFF}' AS DATE))""",
                              iforest_sql("g", ["domain"], "day", _GOLD_FEATS, longest=DAYS + 1)) + f""",
r AS (
  SELECT *, quantile_cont(score, 0.8) OVER (PARTITION BY domain) AS cutoff_score,
         CAST(rank() OVER (PARTITION BY domain ORDER BY score DESC) AS BIGINT) AS score_rank,
         max(day) OVER (PARTITION BY domain) AS _last
  FROM ifo WHERE n >= 20
)
SELECT domain, day, n, {_r('score')}, {_r('cutoff_score')}, score_rank, score > cutoff_score AS is_alert
FROM r WHERE day = _last AND day = CAST('{CUTOFF}' AS DATE)"""

SQL["iforest_latest"] = with_(ALL_GOLD, f"""
g AS (
  SELECT * FROM (SELECT *, max(day) OVER (PARTITION BY domain) AS _last FROM gold WHERE day <= CAST('{CUTOFF}' AS DATE))
  WHERE _last = CAST('{CUTOFF}' AS DATE)
)""", iforest_sql("g", ["domain"], "day", _GOLD_FEATS, longest=DAYS + 1)) + f"""
SELECT domain, day, 'iforest' AS method, 'irregular' AS type, CAST(NULL AS DOUBLE) AS score, 'spend,leads,sessions' AS affected,
       spend AS ctx_spend, leads AS ctx_leads, sessions AS ctx_sessions, 'Contam=0.4' AS params
FROM (SELECT *, quantile_cont(score, 0.6) OVER (PARTITION BY domain) AS q FROM ifo WHERE n >= 20)
WHERE score > q AND day = CAST('{CUTOFF}' AS DATE)"""

_ORDERS_DAILY = """
daily AS (
  SELECT n_regionkey AS region, CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
)"""

SQL["iforest_long"] = with_(_ORDERS_DAILY, iforest_sql("daily", ["region"], "day", ["orders", "revenue"])) + f"""
SELECT region, day, orders, round(revenue, 2) AS revenue, n, psi, {_r('mean_path')}, {_r('score')} FROM ifo"""

SQL["anscombe"] = with_(EVENTS_DAILY, """
eva AS (SELECT *, 2.0 * sqrt(CAST(events AS DOUBLE) + 0.375) AS value FROM ev)""",
                        decompose_sql("eva", ["event_type"], "day", "value")) + f"""
SELECT event_type, day, {_r('value')}, {_r('trend')}, {_r('seasonal')}, {_r('resid')} FROM dec"""

_Z = ",\n  ".join(
    f"round(CASE WHEN stddev_pop(CAST({f} AS DOUBLE)) OVER w > 0 THEN (CAST({f} AS DOUBLE) - avg(CAST({f} AS DOUBLE)) OVER w) "
    f"/ stddev_pop(CAST({f} AS DOUBLE)) OVER w ELSE 0.0 END, 6) AS z_{f}" for f in _FEATS)
SQL["standardize"] = with_(EVENTS_DAILY) + f"""
SELECT event_type, day,
  {_Z}
FROM ev WINDOW w AS (PARTITION BY event_type)"""

# ------------------------------------------------------------------ data quality
_START = "2001-05-28"  # cutoff - 65 days

_NATION_GOLD = ALL_GOLD.replace("r.r_name", "n.n_name")

SQL["missing_days"] = with_(_NATION_GOLD) + f"""
SELECT domain, day, 'missing_day' AS method, 'missing' AS type, 'tolerance=0' AS params
FROM (SELECT DISTINCT domain FROM dict), (SELECT CAST(d AS DATE) AS day
      FROM generate_series(TIMESTAMP '{_START} 00:00:00', TIMESTAMP '{CUTOFF} 00:00:00', INTERVAL 1 DAY) t(d))
WHERE (domain, day) NOT IN (SELECT (domain, day) FROM gold)"""

_RULES = """
rules AS (SELECT metric, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi
          FROM (VALUES ('sessions', 0, 100000), ('leads', 0, 10000), ('spend', 0, 50000)) t(metric, lo, hi))"""

SQL["range_alerts"] = with_(ALL_GOLD, GOLD_LONG, _RULES) + """
SELECT g.domain, g.day, g.metric, 'out_of_range' AS method, 'range' AS type, g.value, r.lo AS ctx_lo, r.hi AS ctx_hi
FROM gold_long g JOIN rules r ON g.metric = r.metric WHERE NOT (g.value BETWEEN r.lo AND r.hi)"""

_INPUTS = with_(WEB_RAW, ADS_RAW, """
inputs AS (
  SELECT 'web' AS input, propertyID AS account, CAST(date AS DATE) AS day FROM web_raw
  UNION ALL SELECT 'ads_' || source, account_id, CAST(date AS DATE) FROM ads_raw
),
per AS (SELECT input, account, day, count(*) AS c FROM inputs GROUP BY 1, 2, 3)""")

SQL["duplicate_days"] = _INPUTS + "\nSELECT input, account, day, c AS rows FROM per WHERE c > 1"

SQL["validate"] = _INPUTS + """
SELECT i.input, '' AS missing_columns, coalesce(sum(c), 0) = 0 AS is_empty, CAST(coalesce(sum(c), 0) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE c > 1) AS BIGINT) AS duplicate_days, coalesce(sum(c), 0) > 0 AS valid
FROM (VALUES ('web'), ('ads_a'), ('ads_b')) i(input) LEFT JOIN per ON per.input = i.input GROUP BY 1"""

SQL["series_status"] = with_(_NATION_GOLD, GOLD_LONG) + f"""
SELECT domain, metric, count(*) AS rows, max(day) AS last_day,
       CASE WHEN max(day) <> CAST('{CUTOFF}' AS DATE) THEN 'stale'
            WHEN count(*) < 14 THEN 'too_short' ELSE 'ok' END AS status
FROM gold_long GROUP BY domain, metric"""

# ------------------------------------------------------------------ alerts
_FUSED_CTES = with_(ALL_GOLD, GOLD_LONG, decompose_sql("gold_long", ["domain", "metric"], "day", "value"),
                    mad_sql("dec", ["domain", "metric"], 3.2),
                    iforest_sql("gold", ["domain"], "day", _GOLD_FEATS, longest=DAYS + 1), _RULES) + f""",
uni AS (
  SELECT domain, day, metric, 'seasonal_mad' AS method, CASE WHEN resid > 0 THEN 'spike' ELSE 'drop' END AS type,
         _y AS value, round(abs(resid) / mad, 2) AS score,
         CASE WHEN series_mean <> 0 THEN round(abs(resid) / series_mean * 100.0, 2) ELSE 0.0 END AS relative_magnitude,
         metric AS affected, 'MAD=3.2' AS params
  FROM mad WHERE resid > upper OR resid < lower
),
multi AS (
  SELECT domain, day, CAST(NULL AS VARCHAR) AS metric, 'iforest' AS method, 'irregular' AS type,
         CAST(NULL AS DOUBLE) AS value, round(score - q, 4) AS score, CAST(NULL AS DOUBLE) AS relative_magnitude,
         'spend,leads,sessions' AS affected, 'Contam=0.01' AS params
  FROM (SELECT *, quantile_cont(score, 0.99) OVER (PARTITION BY domain) AS q FROM ifo WHERE n >= 10)
  WHERE score > q
),
cal AS (
  SELECT d.domain, CAST(t.d AS DATE) AS day
  FROM (SELECT DISTINCT domain FROM dict) d,
       generate_series(TIMESTAMP '{_START} 00:00:00', TIMESTAMP '{CUTOFF} 00:00:00', INTERVAL 1 DAY) t(d)
),
miss AS (
  SELECT c.domain, c.day, CAST(NULL AS VARCHAR) AS metric, 'missing_day' AS method, 'missing' AS type,
         CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS DOUBLE) AS relative_magnitude,
         '' AS affected, 'tolerance=0' AS params
  FROM cal c WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE g.domain = c.domain AND g.day = c.day)
),
rng AS (
  SELECT g.domain, g.day, g.metric, 'out_of_range' AS method, 'range' AS type, g.value,
         CAST(NULL AS DOUBLE) AS score, CAST(NULL AS DOUBLE) AS relative_magnitude, g.metric AS affected,
         'range=[' || CAST(r.lo AS VARCHAR) || ', ' || CAST(r.hi AS VARCHAR) || ']' AS params
  FROM gold_long g JOIN rules r ON g.metric = r.metric WHERE NOT (g.value BETWEEN r.lo AND r.hi)
),
fused AS MATERIALIZED (
  SELECT * FROM uni UNION ALL SELECT * FROM multi UNION ALL SELECT * FROM miss UNION ALL SELECT * FROM rng
),
pr AS (
  SELECT *, CASE WHEN method = 'missing_day' THEN 'critical' WHEN relative_magnitude >= 80 THEN 'critical'
                 WHEN relative_magnitude >= 50 THEN 'high' WHEN relative_magnitude >= 25 THEN 'medium'
                 WHEN relative_magnitude >= 10 THEN 'low' END AS priority
  FROM fused
)"""

_FUSED_COLS = "domain, day, metric, method, type, value, score, relative_magnitude, affected, params"

SQL["fused_alerts"] = _FUSED_CTES + f"\nSELECT {_FUSED_COLS} FROM fused"

SQL["priority_route"] = _FUSED_CTES + """
SELECT domain, day, metric, method, type, relative_magnitude, priority,
       CASE WHEN priority = 'critical' THEN 'alertas-criticas' ELSE 'alertas-marketing' END AS channel,
       CASE WHEN method IN ('missing_day', 'out_of_range') THEN 'analytics_it'
            WHEN metric = 'sessions' AND type = 'drop' THEN 'technical_seo'
            WHEN metric = 'spend' THEN 'performance'
            WHEN method = 'iforest' THEN 'performance'
            ELSE 'marketing' END AS team
FROM pr"""

SQL["cap_per_day"] = _FUSED_CTES + """,
rk AS (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY
           CASE priority WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END,
           score DESC NULLS LAST, domain ASC NULLS LAST, metric ASC NULLS LAST, method, type) AS rank_in_day
  FROM pr
)
SELECT domain, day, metric, method, type, priority, score, CAST(rank_in_day AS BIGINT) AS rank_in_day
FROM rk WHERE rank_in_day <= 3"""


def _pytext(x: str) -> str:
    s = f"regexp_replace(printf('%.6f', {x}), '0+$', '')"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} = floor({x}) AND abs({x}) < 1e15 "
            f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) || '.0' "
            f"WHEN {s} LIKE '%.' THEN {s} || '0' ELSE {s} END)")


_DAILY_WORDS = ("CASE type WHEN 'spike' THEN 'Pico Inusual' WHEN 'drop' THEN 'Caída Abrupta' "
                "WHEN 'irregular' THEN 'Patrón Irregular (Gasto/Tráfico)' WHEN 'missing' THEN 'Día Faltante' "
                "WHEN 'range' THEN 'Fuera de Rango' ELSE type END")
_LOCAL_WORDS = ("CASE type WHEN 'spike' THEN 'pico' WHEN 'drop' THEN 'caida' WHEN 'irregular' THEN 'patron_multivariante' "
                "WHEN 'missing' THEN 'faltante' WHEN 'range' THEN 'fuera_de_rango' ELSE type END")

SQL["adaptive_card"] = _FUSED_CTES + f""",
cards AS (
  SELECT *, json_object('type', 'message', 'attachments', json_array(json_object(
      'contentType', 'application/vnd.microsoft.card.adaptive',
      'content', json_object('type', 'AdaptiveCard', 'version', '1.4',
        'body', json_array(
          json_object('type', 'TextBlock',
                      'text', (CASE WHEN type = 'drop' THEN '🚨' ELSE '📈' END) || ' Alerta: ' || coalesce(domain, 'Dominio'),
                      'weight', 'Bolder', 'size', 'Medium',
                      'color', CASE WHEN type = 'drop' THEN 'Attention' ELSE 'Warning' END),
          json_object('type', 'FactSet', 'facts', json_array(
            json_object('title', 'Métrica:', 'value', coalesce(metric, CASE WHEN method = 'iforest' THEN 'Multivariante' END, 'N/A')),
            json_object('title', 'Tipo:', 'value', coalesce({_DAILY_WORDS}, 'N/A')),
            json_object('title', 'Valor:', 'value', coalesce({_pytext('value')}, 'N/A')),
            json_object('title', 'Fecha:', 'value', strftime(day, '%Y-%m-%d'))))),
        'actions', json_array(json_object('type', 'Action.OpenUrl', 'title', '📊 Ver en Power BI',
                                          'url', 'https://dashboard.example/report')))))) AS card
  FROM fused
)
SELECT domain, day, metric, method, type,
       json_extract_string(card, '$.attachments[0].content.body[0].text') AS title,
       json_extract_string(card, '$.attachments[0].content.body[0].color') AS color,
       json_extract_string(card, '$.attachments[0].content.body[1].facts[0].value') AS fact_metric,
       json_extract_string(card, '$.attachments[0].content.body[1].facts[1].value') AS fact_type,
       json_extract_string(card, '$.attachments[0].content.body[1].facts[2].value') AS fact_value,
       json_extract_string(card, '$.attachments[0].content.body[1].facts[3].value') AS fact_date,
       json_extract_string(card, '$.attachments[0].content.actions[0].url') AS url
FROM cards"""

_METHOD_WORDS = ("CASE method WHEN 'seasonal_mad' THEN 'STL+MAD' WHEN 'iforest' THEN 'Isolation Forest' "
                 "WHEN 'missing_day' THEN 'Calendario' WHEN 'out_of_range' THEN 'Rango' ELSE method END")

SQL["message_card"] = _FUSED_CTES + f""",
cards AS (
  SELECT *, json_object(
      '@type', 'MessageCard', '@context', 'http://schema.org/extensions',
      'themeColor', CASE WHEN method = 'iforest' THEN 'FF0000' WHEN method IN ('missing_day', 'out_of_range') THEN '7B1FA2' WHEN type = 'spike' THEN 'FFA500' ELSE '008000' END,
      'summary', CASE WHEN method = 'iforest' THEN 'Alerta - Patrón Multivariante'
                      ELSE 'Alerta - ' || ({_LOCAL_WORDS}) || ' - ' || coalesce(metric, 'N/A') END,
      'sections', json_array(json_object(
        'activityTitle', CASE WHEN method = 'iforest' THEN '🤖 ALERTA - PATRÓN MULTIVARIANTE'
                              ELSE (CASE WHEN type = 'spike' THEN '📈' ELSE '📉' END) || ' ALERTA - '
                                   || upper({_LOCAL_WORDS}) || ' DETECTADA' END,
        'facts', CASE WHEN method = 'iforest' THEN json_array(
                        json_object('name', 'Score:', 'value', coalesce({_pytext('score')}, 'N/A')),
                        json_object('name', 'Métricas:', 'value', replace(affected, ',', ', ')),
                        json_object('name', 'Fecha:', 'value', strftime(day, '%Y-%m-%d')))
                      WHEN method IN ('missing_day', 'out_of_range') THEN json_array(
                        json_object('name', 'Métrica:', 'value', coalesce(metric, 'N/A')),
                        json_object('name', 'Fecha:', 'value', strftime(day, '%Y-%m-%d')),
                        json_object('name', 'Regla:', 'value', params),
                        json_object('name', 'Método:', 'value', {_METHOD_WORDS}))
                      ELSE json_array(
                        json_object('name', 'Métrica:', 'value', coalesce(metric, 'N/A')),
                        json_object('name', 'Fecha:', 'value', strftime(day, '%Y-%m-%d')),
                        json_object('name', 'Magnitud:', 'value', coalesce({_pytext('relative_magnitude')}, 'N/A') || '%'),
                        json_object('name', 'Método:', 'value', {_METHOD_WORDS})) END))) AS card
  FROM fused
)
SELECT domain, day, metric, method, type,
       json_extract_string(card, '$.themeColor') AS color, json_extract_string(card, '$.summary') AS summary,
       json_extract_string(card, '$.sections[0].activityTitle') AS title,
       {", ".join(f"json_extract_string(card, '$.sections[0].facts[{i}].name') AS fact{i}_name" for i in range(4))},
       {", ".join(f"json_extract_string(card, '$.sections[0].facts[{i}].value') AS fact{i}_value" for i in range(4))}
FROM cards"""

SQL["evaluate"] = _FUSED_CTES + """,
a AS (SELECT DISTINCT domain, day, metric FROM uni),
lab AS (
  SELECT DISTINCT domain, day, metric
  FROM (SELECT *, avg(value) OVER (PARTITION BY domain, metric) AS m FROM gold_long)
  WHERE value > 1.5 * m OR value < 0.5 * m
),
j AS (
  SELECT a.domain IS NOT NULL AS _a, l.domain IS NOT NULL AS _l
  FROM a FULL JOIN lab l ON a.domain IS NOT DISTINCT FROM l.domain AND a.day IS NOT DISTINCT FROM l.day
                          AND a.metric IS NOT DISTINCT FROM l.metric
),
c AS (
  SELECT CAST(count(*) FILTER (WHERE _a AND _l) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE _a AND NOT _l) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE NOT _a AND _l) AS BIGINT) AS fn
  FROM j
),
pr2 AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS p,
            CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS r
  FROM c
)
SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) END, 6) AS f1
FROM pr2"""

SQL["run_report"] = _FUSED_CTES + """
SELECT CAST((SELECT count(DISTINCT domain) FROM gold) AS BIGINT) AS total_domains,
       CAST((SELECT count(*) FROM gold) AS BIGINT) AS gold_rows,
       CAST(count(*) AS BIGINT) AS total_alerts,
       CAST(count(*) FILTER (WHERE method = 'seasonal_mad') AS BIGINT) AS alerts_seasonal_mad,
       CAST(count(*) FILTER (WHERE method = 'iforest') AS BIGINT) AS alerts_iforest,
       CAST(count(*) FILTER (WHERE method = 'missing_day') AS BIGINT) AS alerts_missing,
       CAST(count(*) FILTER (WHERE method = 'out_of_range') AS BIGINT) AS alerts_range
FROM fused"""

SQL["delivery_summary"] = _FUSED_CTES + """
SELECT CAST(count(*) FILTER (WHERE extract(day FROM day) % 5 <> 0) AS BIGINT) AS sent, CAST(count(*) AS BIGINT) AS total
FROM fused"""

SQL["timed_report"] = _FUSED_CTES + """
SELECT CAST((SELECT count(DISTINCT domain) FROM gold) AS BIGINT) AS total_domains,
       CAST((SELECT count(*) FROM gold) AS BIGINT) AS gold_rows,
       CAST(count(*) AS BIGINT) AS total_alerts, true AS run_seconds_right, true AS run_at_right
FROM fused"""

SQL["alert_history"] = _FUSED_CTES + f"""
SELECT {_FUSED_COLS} FROM fused
WHERE extract(day FROM day) % 7 <> 0 AND (extract(day FROM day) % 5 <> 0 OR method = 'seasonal_mad')"""

SQL["delivery_ledger"] = _FUSED_CTES + """
SELECT domain, day, metric, method, type, true AS sent, extract(day FROM day) % 5 <> 0 AS sent_before,
       CAST(CASE WHEN extract(day FROM day) % 5 <> 0 THEN 0 ELSE 1 END AS INTEGER) AS attempts_used
FROM fused"""

SQL["anscombe_filled"] = with_(_NATION_GOLD, """
cal AS (
  SELECT domain, 'leads' AS metric, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM gold GROUP BY domain
),
filled AS (
  SELECT c.domain, c.metric, c.day, CAST(coalesce(g.leads, 0) AS BIGINT) AS value,
         2.0 * sqrt(CAST(coalesce(g.leads, 0) AS DOUBLE) + 0.375) AS value_tested
  FROM cal c LEFT JOIN gold g ON c.domain = g.domain AND c.day = g.day
)""", decompose_sql("filled", ["domain", "metric"], "day", "value_tested")) + f"""
SELECT domain, day, value, {_r('value_tested')}, {_r('trend')}, {_r('seasonal')}, {_r('resid')} FROM dec"""

SQL["retain"] = _FUSED_CTES + f"""
SELECT {_FUSED_COLS} FROM fused WHERE day >= CAST('{CUTOFF}' AS DATE) - 30"""



def _daily(k: float, contamination: float, level: str) -> str:
    """The DAILY job: both detectors on fresh series, missing days and ranges of the cutoff day."""
    return with_(ALL_GOLD.replace("r.r_name", level), GOLD_LONG, _FRESH, decompose_sql("fresh", ["domain", "metric"], "day", "value"),
                 mad_sql("dec", ["domain", "metric"], k), f"""
gfresh AS (
  SELECT * FROM (SELECT *, max(day) OVER (PARTITION BY domain) AS _last FROM gold WHERE day <= CAST('{CUTOFF}' AS DATE))
  WHERE _last = CAST('{CUTOFF}' AS DATE)
)""", iforest_sql("gfresh", ["domain"], "day", _GOLD_FEATS, longest=DAYS + 1), _RULES) + f""",
uni AS (
  SELECT domain, day, metric, 'seasonal_mad' AS method, CASE WHEN resid > 0 THEN 'spike' ELSE 'drop' END AS type,
         _y AS value, round(abs(resid) / mad, 2) AS score,
         CASE WHEN series_mean <> 0 THEN round(abs(resid) / series_mean * 100.0, 2) ELSE 0.0 END AS relative_magnitude,
         metric AS affected, 'MAD={k}' AS params
  FROM mad WHERE (resid > upper OR resid < lower) AND pos = n - 1
),
multi AS (
  SELECT domain, day, CAST(NULL AS VARCHAR) AS metric, 'iforest' AS method, 'irregular' AS type,
         CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS DOUBLE) AS relative_magnitude,
         'spend,leads,sessions' AS affected, 'Contam={contamination}' AS params
  FROM (SELECT *, quantile_cont(score, {1.0 - contamination!r}) OVER (PARTITION BY domain) AS q,
               max(day) OVER (PARTITION BY domain) AS _l FROM ifo WHERE n >= 20)
  WHERE score > q AND day = _l
),
dark AS (
  SELECT DISTINCT domain, CAST('{CUTOFF}' AS DATE) AS day, CAST(NULL AS VARCHAR) AS metric, 'missing_day' AS method, 'missing' AS type,
         CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS DOUBLE) AS relative_magnitude,
         '' AS affected, 'tolerance=0' AS params
  FROM dict WHERE domain NOT IN (SELECT domain FROM gold WHERE day = CAST('{CUTOFF}' AS DATE))
),
outside AS (
  SELECT domain, day, metric, 'out_of_range' AS method, 'range' AS type, value, CAST(NULL AS DOUBLE) AS score,
         CAST(NULL AS DOUBLE) AS relative_magnitude, metric AS affected, 'range=[' || lo || ', ' || hi || ']' AS params
  FROM gold_long JOIN rules USING (metric) WHERE NOT (value BETWEEN lo AND hi) AND day = CAST('{CUTOFF}' AS DATE)
)
SELECT {_FUSED_COLS} FROM uni UNION ALL SELECT {_FUSED_COLS} FROM multi UNION ALL SELECT {_FUSED_COLS} FROM dark
UNION ALL SELECT {_FUSED_COLS} FROM outside"""


SQL["daily_alerts"] = _daily(3.5, 0.01, "r.r_name")
SQL["daily_alerts_sensitive"] = _daily(1.0, 0.2, "n.n_name")

SQL["stl_events"] = with_(EVENTS_DAILY, loess_sql("ev", ["event_type"], "day", "events")) + f"""
SELECT event_type, day, pos, n, _y AS value, {_r('trend')}, {_r('seasonal')}, {_r('resid')}, {_r('weight')} FROM lo"""

SQL["iforest_model_scores"] = with_(ALL_GOLD, iforest_sql("gold", ["domain"], "day", _GOLD_FEATS, longest=DAYS + 1,
                                                          fitted="day < CAST('2001-07-26' AS DATE)")) + f"""
SELECT domain, day, day >= CAST('2001-07-26' AS DATE) AS is_new, spend, leads, sessions, n, psi, {_r('mean_path')}, {_r('score')} FROM ifo"""

SQL["long_series_bounds"] = with_(_ORDERS_DAILY, decompose_sql("daily", ["region"], "day", "orders"), mad_sql("dec", ["region"], 3.2)) + f"""
SELECT region, day, _y AS value, pos, n, {_r('trend')}, {_r('seasonal')}, {_r('resid')}, {_r('resid_median')}, {_r('mad')}, {_r('lower')},
       {_r('upper')}, (resid > upper OR resid < lower) AS is_outlier FROM mad"""

SQL["precision_recall_curve"] = with_(ALL_GOLD, GOLD_LONG, decompose_sql("gold_long", ["domain", "metric"], "day", "value"),
                                      mad_sql("dec", ["domain", "metric"], 3.2)) + """,
s AS (SELECT round(abs(resid) / mad, 2) AS threshold, _y > 1.5 * series_mean OR _y < 0.5 * series_mean AS bad FROM mad),
e AS (SELECT threshold, count(*) AS n, count(*) FILTER (bad) AS anomalies FROM s GROUP BY threshold),
c AS (SELECT threshold, anomalies, sum(n) OVER w AS alerts, sum(anomalies) OVER w AS tp, sum(anomalies) OVER () AS pos
      FROM e WINDOW w AS (ORDER BY threshold DESC))
SELECT threshold, CAST(anomalies AS BIGINT) AS anomalies, CAST(alerts AS BIGINT) AS alerts, CAST(tp AS BIGINT) AS tp,
       CAST(alerts - tp AS BIGINT) AS fp, CAST(pos - tp AS BIGINT) AS fn, round(CAST(tp AS DOUBLE) / CAST(alerts AS DOUBLE), 6) AS precision,
       CASE WHEN pos > 0 THEN round(CAST(tp AS DOUBLE) / CAST(pos AS DOUBLE), 6) END AS recall
FROM c"""

SQL["alert_incidents"] = _FUSED_CTES + """,
per AS (SELECT domain, metric, day, count(*) AS alerts, max(score) AS peak FROM fused GROUP BY 1, 2, 3),
marked AS (SELECT *, CASE WHEN day - lag(day) OVER w <= 1 THEN 0 ELSE 1 END AS b FROM per WINDOW w AS (PARTITION BY domain, metric ORDER BY day)),
runs AS (SELECT *, sum(b) OVER (PARTITION BY domain, metric ORDER BY day) AS run FROM marked),
found AS (SELECT domain, metric, run, min(day) AS first_day, max(day) AS last_day, count(*) AS days, CAST(sum(alerts) AS BIGINT) AS alerts,
          max(peak) AS peak_score FROM runs GROUP BY 1, 2, 3)
SELECT i.domain, i.metric, first_day, last_day, days, alerts, peak_score,
       (SELECT string_agg(DISTINCT f.method, ',' ORDER BY f.method) FROM fused f
        WHERE f.domain = i.domain AND f.metric IS NOT DISTINCT FROM i.metric AND f.day BETWEEN first_day AND last_day) AS methods
FROM found i"""

SQL["window_profiles"] = with_(WEB_RAW, ADS_RAW, f"""
r AS (
  SELECT 'web' AS input, date, CAST(TotalSessions AS DECIMAL(28,6)) AS v FROM web_raw WHERE {_in_window('date')}
  UNION ALL SELECT 'ads_' || source, date, CAST(spend_gbp AS DECIMAL(28,6)) FROM ads_raw WHERE {_in_window('date')}
)""") + """
SELECT input, CAST(min(date) AS DATE) AS first_day, CAST(max(date) AS DATE) AS last_day, count(DISTINCT CAST(date AS DATE)) AS days, count(*) AS rows,
       CAST(0 AS BIGINT) AS missing_ids, CAST(0 AS BIGINT) AS missing_values, CAST(min(v) AS DOUBLE) AS low, CAST(max(v) AS DOUBLE) AS high,
       CAST(sum(v) AS DOUBLE) AS total, true AS ids_ok, true AS median_ok
FROM r GROUP BY input"""

SQL["changed_days"] = with_(WEB_RAW, ADS_RAW, f"""
rows_now AS (
  SELECT CASE source WHEN 'a' THEN 'ads0' ELSE 'ads1' END AS source, CAST(date AS DATE) AS day,
         concat_ws('|', account_id, date, spend_gbp) AS line FROM ads_raw WHERE {_in_window('date')}
  UNION ALL SELECT 'web', CAST(date AS DATE), concat_ws('|', propertyID, date, TotalConversions, TotalSessions) FROM web_raw WHERE {_in_window('date')}
),
web_old AS (
  SELECT c.c_name AS propertyID, o.o_orderdate AS date, CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS TotalConversions, 1 AS TotalSessions
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 61 <> 0 AND CAST(o.o_orderdate AS DATE) < CAST('{CUTOFF}' AS DATE) - 2
),
ads_old AS (
  SELECT CASE WHEN l.l_returnflag <> 'N' THEN 'ads0' ELSE 'ads1' END AS source, c.c_name AS account_id, l.l_shipdate AS date,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS spend_gbp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_returnflag IS NOT NULL AND l.l_orderkey % 61 <> 0 AND CAST(l.l_shipdate AS DATE) < CAST('{CUTOFF}' AS DATE) - 2
),
rows_old AS (
  SELECT source, CAST(date AS DATE) AS day, concat_ws('|', account_id, date, spend_gbp) AS line FROM ads_old WHERE {_in_window('date')}
  UNION ALL SELECT 'web', CAST(date AS DATE), concat_ws('|', propertyID, date, TotalConversions, TotalSessions) FROM web_old WHERE {_in_window('date')}
),
p_now AS (SELECT source, day, string_agg(line, ',' ORDER BY line) AS body FROM rows_now GROUP BY ALL),
p_old AS (SELECT source, day, string_agg(line, ',' ORDER BY line) AS body FROM rows_old GROUP BY ALL)""") + """
SELECT source, day, CASE WHEN p_old.body IS NULL THEN 'new' WHEN p_now.body IS NULL THEN 'gone' ELSE 'changed' END AS change
FROM p_now FULL JOIN p_old USING (source, day) WHERE p_now.body IS DISTINCT FROM p_old.body"""

SQL["cutoff_day"] = """
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Bogota' AS DATE) - 1 AS cutoff FROM events"""
