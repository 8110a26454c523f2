import datetime as dt

import numpy as np

from metricwatch.plans.variants import daily_variant, local_variant
from metricwatch.operators.gold import build_gold

CUT = dt.date(2001, 8, 1)


def raw_tables(spark):
    rng = np.random.default_rng(9)
    web, ads, dic = [], [], []
    for dom, acct in (("a.com", "ACC-001"), ("b.com", "ACC-002")):
        dic.append((acct, dom))
        for i in range(66):
            day = CUT - dt.timedelta(days=65 - i)
            ts = dt.datetime.combine(day, dt.time(12))
            sessions = 1000 + 200 * np.sin(i * 2 * np.pi / 7) + rng.normal(0, 20)
            leads = 50 + 10 * np.sin(i * 2 * np.pi / 7) + rng.normal(0, 2)
            spend = 800 + rng.normal(0, 30)
            if day == CUT and dom == "a.com":
                sessions = 9000.0                       # univariate spike on the cutoff day
            if day == CUT and dom == "b.com":
                sessions, leads, spend = 3000.0, 400.0, 9000.0   # whole-row anomaly
            # two web rows and two ad rows per day: the daily sums must add them up
            web += [(acct, ts, float(leads) / 2, float(sessions) / 2)] * 2
            ads += [(acct.lower(), ts, float(spend) / 2)] * 2
    w = spark.createDataFrame(web, "propertyID string, date timestamp_ntz, TotalConversions double, TotalSessions double")
    a = spark.createDataFrame(ads, "account_id string, date timestamp_ntz, spend_gbp double")
    d = spark.createDataFrame(dic, "AccountID string, domain string")
    return w, a, d


def test_daily_variant_flags_cutoff_day(spark):
    w, a, d = raw_tables(spark)
    alerts = daily_variant(w, [a], d, CUT, 65).collect()
    got = {(r.domain, r.metric, r.method, r.type) for r in alerts}
    assert ("a.com", "sessions", "seasonal_mad", "spike") in got
    assert ("b.com", None, "iforest", "irregular") in got
    assert all(r.day == CUT for r in alerts)


def test_local_variant_with_quality(spark):
    w, a, d = raw_tables(spark)
    gold = build_gold(w, [a], d, CUT, 65)
    gold = gold.filter(~((gold.domain == "a.com") & (gold.day == CUT - dt.timedelta(days=30))))
    alerts = local_variant(gold, quality=True, start=CUT - dt.timedelta(days=65), end=CUT).collect()
    methods = {(r.domain, r.method) for r in alerts}
    assert ("a.com", "missing_day") in methods
    assert ("a.com", "seasonal_mad") in methods and ("b.com", "iforest") in methods
    assert any(r.method == "out_of_range" and r.metric == "sessions" for r in alerts) is False


def test_anscombe_option_reports_raw_values(spark):
    w, a, d = raw_tables(spark)
    alerts = daily_variant(w, [a], d, CUT, 65, anscombe_counts=True).collect()
    spike = [r for r in alerts if r.domain == "a.com" and r.metric == "sessions"]
    assert len(spike) == 1 and spike[0].value == 9000.0 and spike[0].type == "spike"


def test_forest_options_in_daily_variant(spark):
    w, a, d = raw_tables(spark)
    alerts = daily_variant(w, [a], d, CUT, 65, forest_percentile=99.0, standardize=True).collect()
    assert ("b.com", "iforest") in {(r.domain, r.method) for r in alerts}
    assert all(r.params == "P99.0" for r in alerts if r.method == "iforest")


def test_dark_domain_and_zone_cutoff(spark):
    from pyspark.sql import functions as F

    from metricwatch.functions.columns import cutoff_day
    w, a, d = raw_tables(spark)
    d = d.unionByName(spark.createDataFrame([("900", "dark.com")], "AccountID string, domain string"))
    now = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit((CUT - dt.date(2000, 12, 31)).days))
    for cutoff in (CUT, F.lit(CUT), cutoff_day("UTC", now, now_zone="UTC")):
        alerts = daily_variant(w, [a], d, cutoff, 65).collect()
        got = {(r.domain, r.metric, r.method) for r in alerts}
        assert ("dark.com", None, "missing_day") in got and ("a.com", "sessions", "seasonal_mad") in got
    assert daily_variant(w, [a], d, tz="America/Bogota").filter("method <> 'missing_day'").count() == 0  # long ago
    assert daily_variant(w, [a], d, CUT, 65, quality=False).filter("method = 'missing_day'").count() == 0


def test_filled_days_are_zero_before_the_transform(spark):
    from metricwatch.plans.variants import tested_long
    rows = [("a", "leads", CUT - dt.timedelta(days=k), 10.0) for k in (0, 1, 3)]
    long = spark.createDataFrame(rows, "domain string, metric string, day date, value double")
    out, col = tested_long(long, True, True)
    gap = out.where(out.day == CUT - dt.timedelta(days=2)).first()
    assert gap.value == 0.0 and abs(gap[col] - 2 * 0.375 ** 0.5) < 1e-12


def test_daily_job_stores_delivers_and_reports(spark, tmp_path):
    import time

    from metricwatch.plans.variants import daily_job
    from metricwatch.sources.sinks import read_alerts
    w, a, d = raw_tables(spark)
    for _ in range(2):  # a rerun replaces its day
        t = time.time()
        row = daily_job(w, [a], d, str(tmp_path / "alerts"), str(tmp_path / "report"), send=lambda card, timeout: True,
                        cap=1, cutoff=CUT, days=65).first()
        took = time.time() - t
    stored = read_alerts(spark, str(tmp_path / "alerts")).count()
    assert stored == row.total_alerts == row.held_back + row.total and (row.sent, row.total) == (1, 1)
    assert 0.3 * took < row.run_seconds <= took


def test_daily_job_reports_all_of_gold(spark, tmp_path):
    from metricwatch.plans.variants import daily_job
    w, a, d = raw_tables(spark)
    for k, path in enumerate((None, str(tmp_path / "gold"))):
        row = daily_job(w, [a], d.unionByName(spark.createDataFrame([("900", "dark.com")], "AccountID string, domain string")),
                        str(tmp_path / f"alerts{k}"), str(tmp_path / f"report{k}"), cutoff=CUT, days=65, gold_path=path).first()
        assert (row.total_domains, row.gold_rows) == (2, 132)  # dark.com raises an alert and has no row


def test_gold_table_grows_by_a_day(spark, tmp_path):
    from metricwatch.sources.changes import read_gold
    w, a, d = raw_tables(spark)
    path, yesterday = str(tmp_path / "gold"), CUT - dt.timedelta(days=1)
    daily_variant(w, [a], d, yesterday, 65, gold_path=path)
    out = daily_variant(w, [a], d, CUT, 65, gold_path=path)
    whole = build_gold(w, [a], d, CUT, 66).select("domain", "day", "spend", "leads", "sessions")
    stored = read_gold(spark, path).select(*whole.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))
    cols = [c for c in out.columns if c not in ("affected", "context")]
    assert sorted(map(str, out.select(*cols).collect())) == sorted(map(str, daily_variant(w, [a], d, CUT, 65).select(*cols).collect()))


def test_daily_variant_with_a_stored_forest(spark, tmp_path):
    from metricwatch.sources.history import manifest
    w, a, d = raw_tables(spark)
    path = str(tmp_path / "model")
    for cutoff in (CUT - dt.timedelta(days=3), CUT):  # the second run scores in the first one's trees
        alerts = daily_variant(w, [a], d, cutoff, 65, model_path=path).collect()
        assert list(manifest(spark, path)["days"]) == [(CUT - dt.timedelta(days=3)).isoformat()]
    found = {(r.domain, r.method): r for r in alerts}
    assert ("b.com", "iforest") in found and ("a.com", "seasonal_mad") in found and found["b.com", "iforest"].params == "Contam=0.01"
    assert sorted(found["b.com", "iforest"].affected) == ["leads", "sessions", "spend"] and all(r.day == CUT for r in alerts)
    daily_variant(w, [a], d, CUT, 65, model_path=path, refit_days=2)
    assert sorted(manifest(spark, path)["days"]) == [(CUT - dt.timedelta(days=3)).isoformat(), CUT.isoformat()]
