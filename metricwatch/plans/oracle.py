"""Plain-SQL statements of the registered queries, for an independent engine (DuckDB).

Each statement is written from the operator definitions, not from the Spark code, and runs on
the driver tables registered as views. Notes on portable arithmetic:

* whole-number truncation is ``trunc`` before the INTEGER cast (a plain cast would round);
* ``regexp_replace`` needs the 'g' flag to replace every match;
* sums of integers are cast to BIGINT, doubles are rounded to 6 decimals in the final select;
* hashed draws use the first 8 hex digits of md5 over '|'-joined text, as the Spark side does.
"""

from __future__ import annotations

import math

CUTOFF = "2001-08-01"
DAYS = 65


def _norm(col: str) -> str:
    return f"nullif(regexp_replace(CAST({col} AS VARCHAR), '[^0-9]', '', 'g'), '')"


def _in_window(col: str, cutoff: str = CUTOFF, days: int = DAYS) -> str:
    return f"CAST({col} AS DATE) BETWEEN CAST('{cutoff}' AS DATE) - {days} AND CAST('{cutoff}' AS DATE)"


def _hash(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)}))"


def _part(hash_: str, at: int) -> str:
    return f"(CAST(('0x' || substr({hash_}, {at}, 8)) AS BIGINT) / 4294967296.0)"


def _draw(*parts: str) -> str:
    return _part(_hash(*parts), 1)


# ---------------------------------------------------------------- fixture inputs
DICTIONARY = f"""
dict_raw AS (
  SELECT c.c_name AS AccountID, r.r_name AS domain
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
dict AS (
  SELECT {_norm('AccountID')} AS account_id_norm, min(domain) AS domain
  FROM dict_raw
  WHERE {_norm('AccountID')} IS NOT NULL AND domain IS NOT NULL
  GROUP BY 1
)"""

WEB_RAW = """
web_raw AS (
  SELECT c.c_name AS propertyID, o.o_orderdate AS date,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS TotalConversions, 1 AS TotalSessions
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

ADS_RAW = """
ads_raw AS (
  SELECT CASE WHEN l.l_returnflag <> 'N' THEN 'a' ELSE 'b' END AS source,
         c.c_name AS account_id, l.l_shipdate AS date,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS spend_gbp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_returnflag IS NOT NULL
)"""

WEB_DAILY = f"""
web AS (
  SELECT {_norm('propertyID')} AS account_id_norm, CAST(date AS DATE) AS day,
         CAST(trunc(sum(TotalConversions)) AS INTEGER) AS leads,
         CAST(trunc(sum(TotalSessions)) AS INTEGER) AS sessions
  FROM web_raw WHERE {_in_window('date')}
  GROUP BY 1, 2
)"""

ADS_DAILY = f"""
ads AS (
  SELECT source, {_norm('account_id')} AS account_id_norm, CAST(date AS DATE) AS day,
         CAST(trunc(sum(spend_gbp)) AS INTEGER) AS spend
  FROM ads_raw WHERE {_in_window('date')}
  GROUP BY 1, 2, 3
)"""

GOLD = """
ads_dom AS (
  SELECT d.domain, a.day, sum(a.spend) AS spend
  FROM ads a JOIN dict d ON a.account_id_norm = d.account_id_norm GROUP BY 1, 2
),
web_dom AS (
  SELECT d.domain, w.day, sum(w.leads) AS leads, sum(w.sessions) AS sessions
  FROM web w JOIN dict d ON w.account_id_norm = d.account_id_norm GROUP BY 1, 2
),
gold AS MATERIALIZED (
  SELECT coalesce(a.domain, w.domain) AS domain, coalesce(a.day, w.day) AS day,
         CAST(coalesce(a.spend, 0) AS BIGINT) AS spend,
         CAST(coalesce(w.leads, 0) AS BIGINT) AS leads,
         CAST(coalesce(w.sessions, 0) AS BIGINT) AS sessions
  FROM ads_dom a FULL JOIN web_dom w ON a.domain = w.domain AND a.day = w.day
)"""

GOLD_LONG = """
gold_long AS MATERIALIZED (
  SELECT domain, 'spend' AS metric, day, CAST(spend AS DOUBLE) AS value FROM gold
  UNION ALL SELECT domain, 'leads', day, CAST(leads AS DOUBLE) FROM gold
  UNION ALL SELECT domain, 'sessions', day, CAST(sessions AS DOUBLE) FROM gold
)"""

EVENTS_DAILY = """
ev AS (
  SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events, sum(value) AS value_sum,
         count(DISTINCT user_id) AS users
  FROM events GROUP BY 1, 2
)"""

ALL_GOLD = ",".join([DICTIONARY, WEB_RAW, ADS_RAW, WEB_DAILY, ADS_DAILY, GOLD])


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------- decomposition
def decompose_sql(src: str, key: list[str], order: str, value: str, name: str = "dec",
                  period: int = 7) -> str:
    """CTEs ``{name}_p .. {name}``: classical additive decomposition over ``src`` (odd period)."""
    h = period // 2
    k = ", ".join(key)
    return f"""
{name}_p AS (
  SELECT *, CAST({value} AS DOUBLE) AS _y,
         row_number() OVER (PARTITION BY {k} ORDER BY {order}) - 1 AS pos,
         count(*) OVER (PARTITION BY {k}) AS n
  FROM {src}
),
{name}_t AS (
  SELECT *, CASE WHEN pos >= {h} AND pos <= n - 1 - {h} AND n >= {2 * period}
                 THEN avg(_y) OVER (PARTITION BY {k} ORDER BY {order} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)
            END AS _t
  FROM {name}_p
),
{name}_f AS (
  SELECT *,
    regr_slope(CASE WHEN pos >= {h} AND pos < least({h + period}, n - 1 - {h}) THEN _t END, CAST(pos AS DOUBLE)) OVER (PARTITION BY {k}) AS _fs,
    regr_intercept(CASE WHEN pos >= {h} AND pos < least({h + period}, n - 1 - {h}) THEN _t END, CAST(pos AS DOUBLE)) OVER (PARTITION BY {k}) AS _fi,
    regr_slope(CASE WHEN pos >= greatest({h}, n - 1 - {h} - {period}) AND pos < n - 1 - {h} THEN _t END, CAST(pos AS DOUBLE)) OVER (PARTITION BY {k}) AS _bs,
    regr_intercept(CASE WHEN pos >= greatest({h}, n - 1 - {h} - {period}) AND pos < n - 1 - {h} THEN _t END, CAST(pos AS DOUBLE)) OVER (PARTITION BY {k}) AS _bi
  FROM {name}_t
),
{name}_tr AS (
  SELECT *, CASE WHEN _t IS NOT NULL THEN _t
                 WHEN n >= {2 * period} AND pos < {h} THEN _fs * pos + _fi
                 WHEN n >= {2 * period} AND pos > n - 1 - {h} THEN _bs * pos + _bi END AS trend
  FROM {name}_f
),
{name}_s AS (
  SELECT *, avg(_y - trend) OVER (PARTITION BY {k}, pos % {period}) AS _pm,
            count(trend) OVER (PARTITION BY {k}, pos % {period}) AS _pc
  FROM {name}_tr
),
{name}_g AS (
  SELECT *, _pm - sum(_pm / _pc) OVER (PARTITION BY {k}) / {float(period)} AS seasonal FROM {name}_s
),
{name} AS (
  SELECT *, _y - trend - seasonal AS resid FROM {name}_g
)"""


def mad_sql(src: str, key: list[str], k_mult: float, name: str = "mad", min_rows: int = 14) -> str:
    k = ", ".join(key)
    return f"""
{name}_m AS (
  SELECT *, median(resid) OVER (PARTITION BY {k}) AS resid_median,
            avg(_y) OVER (PARTITION BY {k}) AS series_mean
  FROM {src} WHERE n >= {max(min_rows, 14)}
),
{name} AS (
  SELECT *, resid_median - {float(k_mult)} * mad AS lower, resid_median + {float(k_mult)} * mad AS upper
  FROM (SELECT *, greatest(median(abs(resid - resid_median)) OVER (PARTITION BY {k}) * 1.4826, 1e-6) AS mad
        FROM {name}_m)
)"""


def loess_sql(src: str, key: list[str], order: str, value: str, name: str = "lo", period: int = 7, span: int = 11, rounds: int = 2) -> str:
    """CTEs ending in ``{name}``: robust Loess decomposition over ``src``; neighbours by a self-join, the line by its normal equations."""
    k = ", ".join(key)
    same = " AND ".join(f"a.{c} = b.{c}" for c in key)
    ctes, at = [f"""
{name}_p0 AS (
  SELECT {k}, {order}, CAST({value} AS DOUBLE) AS y, row_number() OVER (PARTITION BY {k} ORDER BY {order}) - 1 AS pos,
         count(*) OVER (PARTITION BY {k}) AS n, 1.0::DOUBLE AS rho, 0.0::DOUBLE AS trend
  FROM {src}
)"""], 0
    for done in range(rounds + 1):
        for _ in range(2):
            p = f"{name}_p{at}"
            ctes.append(f"""
{p}m AS (
  SELECT {k}, {order}, y, pos, n, rho, trend, coalesce(sum(rho * (y - trend)) OVER ph / nullif(sum(rho) OVER ph, 0), avg(y - trend) OVER ph) AS pm, count(*) OVER ph AS pc
  FROM {p} WINDOW ph AS (PARTITION BY {k}, pos % {period})
),
{p}s AS MATERIALIZED (
  SELECT *, pm - sum(pm / pc) OVER (PARTITION BY {k}) / {period} AS season, greatest(0, least(pos - {span // 2}, n - {span})) AS lo,
         least(n - 1, greatest(0, least(pos - {span // 2}, n - {span})) + {span - 1}) AS hi FROM {p}m
),
{p}w AS (
  SELECT {", ".join(f"a.{c}" for c in key)}, a.pos, b.pos - a.pos AS x, b.y - b.season AS z,
         b.rho * pow(greatest(0, 1 - pow(abs(b.pos - a.pos) / (greatest(a.pos - a.lo, a.hi - a.pos) + greatest(0, {span} - a.n) // 2)::DOUBLE, 3)), 3) AS w
  FROM {p}s a JOIN {p}s b ON {same} AND b.pos BETWEEN a.lo AND a.hi
),
{p}l AS (
  SELECT {k}, pos, sum(w) AS sw, sum(w * x) AS sx, sum(w * x * x) AS sxx, sum(w * z) AS sz, sum(w * x * z) AS sxz FROM {p}w GROUP BY {k}, pos
),
{name}_p{at + 1} AS (
  SELECT {", ".join(f"a.{c}" for c in key)}, a.{order}, y, a.pos, n, rho, season, CASE WHEN sw <= 1e-12 THEN y - season
         WHEN sw * sxx - sx * sx <= 1e-9 * sw THEN sz / sw ELSE (sxx * sz - sx * sxz) / (sw * sxx - sx * sx) END AS trend
  FROM {p}s a JOIN {p}l b ON {same} AND a.pos = b.pos
)""")
            at += 1
        if done < rounds:
            ctes.append(f"""
{name}_p{at + 1} AS (
  SELECT * EXCLUDE (rho, far), CASE WHEN far <= 1e-12 THEN 1.0 ELSE pow(greatest(0, 1 - pow(abs(y - trend - season) / far, 2)), 2) END AS rho
  FROM (SELECT *, 6 * median(abs(y - trend - season)) OVER (PARTITION BY {k}) AS far FROM {name}_p{at})
)""")
            at += 1
    ctes.append(f"""
{name} AS (
  SELECT {k}, {order}, y AS _y, pos, n, trend, season AS seasonal, y - trend - season AS resid, rho AS weight FROM {name}_p{at} WHERE n >= {2 * period}
)""")
    return ",".join(ctes)


# ---------------------------------------------------------------- isolation forest
def iforest_sql(src: str, key: list[str], order: str, features: list[str], name: str = "ifo",
                trees: int = 100, sample: int = 256, seed: int = 42, longest: int | None = None, fitted: str = "true") -> str:
    """CTEs ending in ``{name}``: (key, order, features, n, psi, mean_path, score).

    ``longest`` is the length of the longest series, if known: its trees need no deeper levels. The trees are
    fitted on the rows for which ``fitted`` holds, and all rows are scored.
    """
    levels = max(1, math.ceil(math.log2(max(min(sample, longest or sample), 2))))
    k = ", ".join(key)
    feats = ", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in features)
    fl = ", ".join(features)
    ctes = [f"""
{name}_b AS (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {order}, {fl}) AS _row
  FROM (SELECT {k}, {order}, {feats}, count(*) FILTER ({fitted}) OVER (PARTITION BY {k}) AS n, {fitted} AS _fit FROM {src})
),
{name}_x AS (
  SELECT *, least(n, {sample}) AS psi,
         length(bin(greatest(least(n, {sample}), 2) - 1)) AS _limit,
         t.tree AS tree
  FROM {name}_b, (SELECT CAST(range AS INTEGER) AS tree FROM range({trees})) t
),
{name}_0 AS (
  SELECT *, _fit AND (n <= {sample} OR row_number() OVER (PARTITION BY {k}, tree ORDER BY NOT _fit, {_draw(str(seed), *key, 'tree', order, "'s'")}, _row) <= {sample}) AS _in,
         CAST(1 AS BIGINT) AS _node, 0 AS _depth, false AS _done, CAST(NULL AS BIGINT) AS _leaf
  FROM {name}_x
)"""]
    base_cols = f"{k}, {order}, {fl}, n, _row, psi, _limit, tree, _in"
    for lvl in range(levels):
        prev, st, nx = f"{name}_{lvl}", f"{name}_{lvl}s", f"{name}_{lvl + 1}"
        stats = ",\n         ".join(
            f"min(CASE WHEN _in THEN {f} END) OVER w AS _mn{i}, max(CASE WHEN _in THEN {f} END) OVER w AS _mx{i}"
            for i, f in enumerate(features))
        spread = [f"(_mx{i} > _mn{i})" for i in range(len(features))]
        # right-hand branch test: the pick-th feature with spread
        cases, before = [], "0"
        for i, f in enumerate(features):
            cases.append(f"WHEN {spread[i]} AND {before} = _pick THEN {f} > _mn{i} + _u * (_mx{i} - _mn{i})")
            before = f"{before} + CAST({spread[i]} AS INTEGER)"
        ctes.append(f"""
{st} AS (
  SELECT *, count(CASE WHEN _in THEN 1 END) OVER w AS _cnt, {_hash(str(seed), *key, 'tree', '_node')} AS _h,
         {stats}
  FROM {prev}
  WINDOW w AS (PARTITION BY {k}, tree, _node)
),
{nx} AS (
  SELECT {base_cols}, CASE WHEN _stop THEN _node ELSE _node * 2 + _right END AS _node, CASE WHEN _stop THEN _depth ELSE _depth + 1 END AS _depth,
         _stop AS _done, CASE WHEN NOT _done AND _stop THEN _cnt ELSE _leaf END AS _leaf
  FROM (SELECT *, _done OR _cnt <= 1 OR _depth >= _limit OR _sp = 0 AS _stop, CAST(CASE {" ".join(cases)} ELSE false END AS BIGINT) AS _right
        FROM (SELECT *, {_part('_h', 9)} AS _u, floor({_part('_h', 1)} * _sp) AS _pick
              FROM (SELECT *, {before} AS _sp FROM {st})))
)""")
    last = f"{name}_{levels}"
    c_leaf = ("CASE WHEN _lf <= 1 THEN 0.0 WHEN _lf = 2 THEN 1.0 "
              "ELSE 2.0 * (ln(_lf - 1.0) + 0.5772156649015329) - 2.0 * (_lf - 1.0) / _lf END")
    c_psi = ("CASE WHEN psi <= 1 THEN 0.0 WHEN psi = 2 THEN 1.0 "
             "ELSE 2.0 * (ln(psi - 1.0) + 0.5772156649015329) - 2.0 * (psi - 1.0) / psi END")
    ctes.append(f"""
{name}_l AS (
  SELECT *, CASE WHEN _done THEN _leaf ELSE count(CASE WHEN _in THEN 1 END) OVER (PARTITION BY {k}, tree, _node) END AS _lf
  FROM {last}
),
{name}_p AS (
  SELECT {k}, {order}, {fl}, n, psi, avg(_depth + {c_leaf}) AS mean_path
  FROM {name}_l GROUP BY {k}, {order}, {fl}, n, _row, psi
),
{name} AS (
  SELECT *, pow(2.0, -mean_path / ({c_psi})) AS score FROM {name}_p
)""")
    return ",".join(ctes)
