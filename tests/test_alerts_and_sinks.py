import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from metricwatch.operators.alerts import (
    ALERT_COLUMNS, adaptive_card, cap_per_day, fuse_alerts, message_card, prioritize, priority_rank, retain, route,
    run_report,
)
from metricwatch.operators.evaluate import evaluate
from metricwatch.operators.quality import duplicate_days, missing_days, range_alerts, range_rules, validate
from metricwatch.sources.sinks import deliver, delivery_summary, read_alerts, write_alerts, write_report

D0 = dt.date(2001, 7, 1)
SCHEMA = ("domain string, day date, metric string, method string, type string, value double, score double, "
          "relative_magnitude double, affected array<string>, context map<string,double>, params string")


def alerts_df(spark, n_days=3, per_day=40):
    rows = []
    for d in range(n_days):
        for i in range(per_day):
            rel = float((i * 37 + d * 11) % 120)
            score = float((i * 13 + d) % 17) if i % 5 else None
            method = "seasonal_mad" if i % 7 else "iforest"
            rows.append((f"dom{i % 9}.com", D0 + dt.timedelta(days=d), None if method == "iforest" else f"m{i % 4}",
                         method, "drop" if i % 2 else "spike", float(i), score, rel if method != "iforest" else None,
                         [f"m{i % 4}"], {f"m{i % 4}": float(i)}, "MAD=3.2"))
    return spark.createDataFrame(rows, SCHEMA)


def test_cap_per_day_matches_brute_force(spark):
    a = prioritize(alerts_df(spark))
    got = cap_per_day(a, n=7, salts=4).select("domain", "day", "metric", "method", "type", "rank_in_day").toPandas()
    pdf = a.withColumn("_p", priority_rank()).toPandas()
    pdf["_s"] = pdf.score.fillna(-1e300)
    exp = []
    for day, g in pdf.groupby("day"):
        g = g.assign(_m=g.metric.fillna("~~~")).sort_values(["_p", "_s", "domain", "_m", "method", "type"],
                                                           ascending=[True, False, True, True, True, True])
        exp += [(r.domain, r.day, r.method, r.type, k + 1) for k, r in enumerate(g.head(7).itertuples())]
    assert sorted(exp, key=str) == sorted([(r.domain, r.day, r.method, r.type, r.rank_in_day) for r in got.itertuples()], key=str)


def test_priority_and_route(spark):
    rows = [("d", D0, "sessions", "seasonal_mad", "drop", 1.0, 5.0, 85.0, ["sessions"], {"sessions": 1.0}, "p"),
            ("d", D0, "spend", "seasonal_mad", "spike", 1.0, 5.0, 30.0, ["spend"], {"spend": 1.0}, "p"),
            ("d", D0, None, "missing_day", "missing", None, None, None, [], {}, "p"),
            ("d", D0, "leads", "seasonal_mad", "spike", 1.0, 5.0, 9.99, ["leads"], {"leads": 1.0}, "p")]
    r = route(prioritize(spark.createDataFrame(rows, SCHEMA))).select("priority", "channel", "team").collect()
    assert [tuple(x) for x in r] == [("critical", "alertas-criticas", "technical_seo"), ("medium", "alertas-marketing", "performance"),
                                     ("critical", "alertas-criticas", "analytics_it"), (None, "alertas-marketing", "marketing")]


def test_cards_json(spark):
    rows = [("shop.com", D0, "sessions", "seasonal_mad", "drop", 42.0, 5.5, 12.3, ["sessions"], {"sessions": 42.0}, "MAD=3.5"),
            ("shop.com", D0, None, "iforest", "irregular", None, 0.0123, None, ["spend", "leads"], {"spend": 1.0}, "Contam=0.01")]
    df = spark.createDataFrame(rows, SCHEMA)
    ac = [json.loads(r.card) for r in adaptive_card(df, "https://x/report").collect()]
    body = ac[0]["attachments"][0]["content"]["body"]
    assert body[0]["text"] == "🚨 Alerta: shop.com" and body[0]["color"] == "Attention"
    assert [f["value"] for f in body[1]["facts"]] == ["sessions", "Caída Abrupta", "42.0", "2001-07-01"]
    assert ac[1]["attachments"][0]["content"]["body"][1]["facts"][2]["value"] == "N/A"
    assert ac[0]["attachments"][0]["content"]["actions"][0]["url"] == "https://x/report"
    mc = [json.loads(r.card) for r in message_card(df).collect()]
    assert mc[0]["themeColor"] == "008000" and mc[0]["sections"][0]["activityTitle"] == "📉 ALERTA - CAIDA DETECTADA"
    assert mc[0]["sections"][0]["facts"][2]["value"] == "12.3%"
    assert mc[1]["themeColor"] == "FF0000"
    assert [f["value"] for f in mc[1]["sections"][0]["facts"]] == ["0.0123", "spend, leads", "2001-07-01"]


def test_deliver_retries_and_summary(spark):
    df = adaptive_card(alerts_df(spark, 1, 10), "u").repartition(3)

    log = tempfile.mkdtemp(prefix="mw-sends-")

    def send(card, timeout):
        # fails on the first try for spikes, always for domain dom3; every try leaves a file
        import hashlib
        import os
        import uuid
        name = hashlib.md5(card.encode()).hexdigest()
        tries = sum(f.startswith(name) for f in os.listdir(log))
        open(f"{log}/{name}-{uuid.uuid4().hex}", "w").close()
        if "dom3.com" in card:
            raise IOError("down")
        return tries > 0 or "Pico" not in card

    out = deliver(df, send, attempts=3, timeout=1.0)
    s = delivery_summary(out).first()
    rows = out.collect()
    assert s.total == 10 and s.sent == 10 - df.filter(F.col("domain") == "dom3.com").count()
    failed = [r for r in rows if not r.sent]
    assert {r.attempts_used for r in failed} == {3} and all("down" in r.last_error for r in failed)
    assert {r.attempts_used for r in rows if r.sent and r.type == "spike"} <= {1, 2}
    import os
    assert len(os.listdir(log)) == sum(r.attempts_used for r in rows)  # two actions, one delivery


def test_quality_cards_have_their_own_look(spark):
    rows = [("d", D0, None, "missing_day", "missing", None, None, None, [], {}, "tolerance=0")]
    card = json.loads(message_card(spark.createDataFrame(rows, SCHEMA)).first().card)
    assert card["themeColor"] == "7B1FA2" and card["sections"][0]["facts"][2]["value"] == "tolerance=0"


def test_write_read_back_and_report(spark):
    path = tempfile.mkdtemp(prefix="mw-hist-") + "/alerts"
    a = alerts_df(spark)
    write_alerts(a, path)
    write_alerts(a, path, files_per_day=2)
    import glob
    folders = [glob.glob(f"{v}/day={D0}/*.parquet") for v in glob.glob(path + "/data/*")]
    assert sorted(len(f) > 2 for f in folders)[0] is False and read_alerts(spark, path).count() == a.count()  # written twice, there once
    write_alerts(a.filter(F.col("day") == D0).limit(1), path)  # another run of one day replaces that day only
    assert read_alerts(spark, path, D0, D0).count() == 1
    back = read_alerts(spark, path, D0 + dt.timedelta(days=1), D0 + dt.timedelta(days=2))
    assert back.count() == a.filter(F.col("day") >= D0 + dt.timedelta(days=1)).count()
    assert set(ALERT_COLUMNS) == set(back.columns)
    gold = spark.createDataFrame([("a", D0), ("b", D0), ("a", D0 + dt.timedelta(days=1))], "domain string, day date")
    started = dt.datetime.now(dt.timezone.utc)
    rep = run_report(gold, a, started_at=started)
    r = rep.first()
    assert (r.total_domains, r.gold_rows, r.total_alerts) == (2, 3, a.count())
    assert r.alerts_seasonal_mad + r.alerts_iforest == a.count() and r.run_seconds >= 0
    write_report(rep, tempfile.mkdtemp(prefix="mw-rep-") + "/report")
    assert retain(a, D0 + dt.timedelta(days=31), 30).count() == a.filter(F.col("day") >= D0 + dt.timedelta(days=1)).count()


def test_quality_operators(spark):
    obs = spark.createDataFrame([("a", D0), ("a", D0 + dt.timedelta(days=2)), ("a", D0 + dt.timedelta(days=2))],
                                "domain string, day date")
    keys = spark.createDataFrame([("a",), ("silent",)], "domain string")
    miss = sorted(tuple(r) for r in missing_days(obs, ["domain"], "day", D0, D0 + dt.timedelta(days=2), keys).collect())
    assert miss == [("a", D0 + dt.timedelta(days=1)), ("silent", D0), ("silent", D0 + dt.timedelta(days=1)),
                    ("silent", D0 + dt.timedelta(days=2))]
    assert [tuple(r) for r in duplicate_days(obs, ["domain"], "day").collect()] == [("a", D0 + dt.timedelta(days=2), 2)]
    v = validate(obs, ["domain", "day", "value"], ["domain"], "day").first()
    assert (v.missing_columns, v.is_empty, v.rows, v.duplicate_days, v.valid) == ("value", False, 3, 1, False)
    e = validate(obs.limit(0), ["domain", "day"], ["domain"], "day").first()
    assert (e.is_empty, e.rows, e.valid) == (True, 0, False)
    long = spark.createDataFrame([("a", D0, "sessions", 100001.0), ("a", D0, "spend", -1.0), ("a", D0, "leads", 5.0)],
                                 "domain string, day date, metric string, value double")
    assert sorted(r.metric for r in range_alerts(long, range_rules(spark)).collect()) == ["sessions", "spend"]


def test_fuse_and_evaluate(spark):
    a = alerts_df(spark, 1, 5)
    m = missing_days(spark.createDataFrame([("x", D0)], "domain string, day date"), ["domain"], "day", D0,
                     D0 + dt.timedelta(days=1))
    f = fuse_alerts(a, m.withColumn("method", F.lit("missing_day")))
    assert f.columns == ALERT_COLUMNS and f.count() == 6
    alerts = spark.createDataFrame([("d", D0, "m"), ("d", D0 + dt.timedelta(days=1), "m")], "domain string, day date, metric string")
    labels = spark.createDataFrame([("d", D0, "m", True), ("d", D0 + dt.timedelta(days=2), "m", True),
                                    ("d", D0 + dt.timedelta(days=1), "m", False)],
                                   "domain string, day date, metric string, is_anomaly boolean")
    e = evaluate(alerts, labels).first()
    assert (e.tp, e.fp, e.fn) == (1, 1, 1) and abs(e.precision - 0.5) < 1e-12 and abs(e.f1 - 0.5) < 1e-12


def test_retain_history_rewrites_window(spark):
    from metricwatch.sources.sinks import retain_history
    base = tempfile.mkdtemp(prefix="mw-ret-")
    a = alerts_df(spark, n_days=5, per_day=4)
    write_alerts(a, base + "/hist")
    retain_history(spark, base + "/hist", base + "/kept", D0 + dt.timedelta(days=32), 30)
    kept = read_alerts(spark, base + "/kept")
    assert sorted({r.day for r in kept.collect()}) == [D0 + dt.timedelta(days=d) for d in (2, 3, 4)]


def test_evaluate_matches_multivariate_alerts(spark):
    alerts = spark.createDataFrame([("d", D0, None), ("d", D0, "m")], "domain string, day date, metric string")
    labels = spark.createDataFrame([("d", D0, None, True)], "domain string, day date, metric string, is_anomaly boolean")
    e = evaluate(alerts, labels).first()
    assert (e.tp, e.fp, e.fn) == (1, 1, 0)
