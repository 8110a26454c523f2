"""Committed versions by day, the delivery ledger, and gold kept up to date under late and skipped days."""

import datetime as dt
import os
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from metricwatch.operators.alerts import adaptive_card
from metricwatch.operators.gold import build_gold
from metricwatch.sources import changes, history, ledger
from metricwatch.sources.sinks import delivery_summary, read_alerts, write_alerts
from tests.test_alerts_and_sinks import D0, alerts_df
from tests.test_pipeline import CUT, raw_tables

DAY = dt.timedelta(days=1)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def numbers(spark, n, day=D0, k=0):
    return spark.range(n).select(F.lit(day).alias("day"), (F.col("id") + k).alias("x"))


def test_rerun_that_finds_nothing_empties_its_day(spark, tmp_path):
    path, a = str(tmp_path / "h"), alerts_df(spark)
    write_alerts(a, path, days=[D0, D0 + DAY])
    n = read_alerts(spark, path).count()
    write_alerts(a.limit(0), path, days=[D0])
    assert read_alerts(spark, path, D0, D0).count() == 0 and 0 < read_alerts(spark, path).count() < n
    write_alerts(a, path, days=[D0 + DAY])  # rows of days that the run doesn't cover are not written
    assert read_alerts(spark, path, D0, D0).count() == 0
    write_alerts(a.limit(0), path, days=[D0 + DAY])
    assert read_alerts(spark, path).count() == 0 and read_alerts(spark, path).columns == a.columns


def test_a_run_that_dies_is_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    history.write_days(numbers(spark, 5), path, [D0])

    def dies(*_):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(history, "_publish", dies)
        with pytest.raises(RuntimeError):
            history.write_days(numbers(spark, 9, k=100), path, [D0])
    assert len(os.listdir(f"{path}/data")) == 2 and rows_of(history.read_days(spark, path)) == rows_of(numbers(spark, 5))
    bad = numbers(spark, 9).withColumn("x", F.raise_error(F.lit("half-way")))
    with pytest.raises(Exception, match="half-way"):
        history.write_days(bad, path, [D0])
    assert rows_of(history.read_days(spark, path)) == rows_of(numbers(spark, 5))
    assert history.drop_old_versions(spark, path, older_than_seconds=-1) == 2
    assert rows_of(history.read_days(spark, path)) == rows_of(numbers(spark, 5))


def test_runs_at_the_same_time_leave_one_whole_version(spark, tmp_path):
    path, threads = str(tmp_path / "t"), []
    for k in range(6):  # all cover one day, and each a day of its own
        df = numbers(spark, 20 + k, k=1000 * k).unionByName(numbers(spark, 3, D0 + (k + 1) * DAY, k))
        threads.append(threading.Thread(target=history.write_days, args=(df, path, [D0, D0 + (k + 1) * DAY])))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    one = rows_of(history.read_days(spark, path, D0, D0))
    assert one in [rows_of(numbers(spark, 20 + k, k=1000 * k)) for k in range(6)]
    assert history.read_days(spark, path, D0 + DAY).count() == 18
    assert history.manifest(spark, path)["number"] == 6


def test_old_manifests_go_and_the_last_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        history.write_days(numbers(spark, 4 + k), path, [D0])
    assert history.drop_old_versions(spark, path) == 0 and len(os.listdir(f"{path}/manifest")) >= 3  # all are young
    history.drop_old_versions(spark, path, older_than_seconds=-1)
    assert [f for f in os.listdir(f"{path}/manifest") if f.endswith(".json") and not f.startswith(".")] == ["000000000003.json"]
    assert history.write_days(numbers(spark, 9), path, [D0])["number"] == 4 and history.read_days(spark, path).count() == 9
    with pytest.raises(ValueError, match="version"):
        history.write_days(numbers(spark, 1).withColumn("Version", F.lit(1)), path, [D0])


def test_publish_takes_a_name_once(spark, tmp_path):
    assert history._publish(spark, str(tmp_path / "m"), "1.json", "a") and not history._publish(spark, str(tmp_path / "m"), "1.json", "b")
    assert os.listdir(tmp_path / "m") == ["1.json"] and (tmp_path / "m" / "1.json").read_text() == "a"


def test_plain_tables_and_empty_paths_are_read(spark, tmp_path):
    numbers(spark, 4).write.partitionBy("day").parquet(str(tmp_path / "plain"))
    assert history.read_days(spark, str(tmp_path / "plain"), D0, D0).count() == 4
    assert history.read_days(spark, str(tmp_path / "plain"), D0 + DAY).count() == 0
    assert history.read_days(spark, str(tmp_path / "none"), schema="day date").count() == 0


def test_only_wanted_days_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    history.write_days(numbers(spark, 4).unionByName(numbers(spark, 4, D0 + DAY)), path)
    files = history.read_days(spark, path, D0, D0).inputFiles()
    assert files and all(f"day={D0}" in f for f in files)


def sender(log, refuse=(), die_after=None):
    """Writes a file per send; refuses some cards, and raises SystemExit, which ends the task, after some."""
    def send(card, timeout):
        import json
        import uuid
        if die_after is not None and len(os.listdir(log)) >= die_after:
            raise SystemExit("worker gone")
        name = json.loads(card)["attachments"][0]["content"]["body"][0]["text"].split()[-1]
        fact = json.loads(card)["attachments"][0]["content"]["body"][1]["facts"]
        open(f"{log}/{uuid.uuid4().hex}", "w").write(name + "|" + "|".join(f["value"] for f in fact))
        return name not in refuse
    return send


def sent(log):
    return Counter(open(f"{log}/{f}").read() for f in os.listdir(log))


def test_a_delivery_that_died_goes_on_where_it_stopped(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir()
    cards = adaptive_card(alerts_df(spark).dropDuplicates(["domain", "day", "metric", "method", "type"]), "u").coalesce(1)
    n = cards.count()
    with pytest.raises(Exception):
        ledger.deliver_once(cards, sender(str(log), die_after=5), path)
    assert sum(sent(log).values()) == 5 and ledger.acknowledged(cards, path).count() == 5
    out = ledger.deliver_once(cards, sender(str(log)), path)
    assert out.count() == n and out.where("sent_before").count() == 5 and out.where("sent").count() == n
    assert set(sent(log).values()) == {1} and sum(sent(log).values()) == n  # every card once
    again = ledger.deliver_once(cards, sender(str(log)), path)
    assert sum(sent(log).values()) == n and again.where("sent_before AND sent AND attempts_used = 0").count() == n
    assert tuple(delivery_summary(again).head()) == (n, n)


def test_refused_cards_are_tried_again_next_time(spark, tmp_path):
    log, path = tmp_path / "log", "file://" + str(tmp_path / "ledger")
    log.mkdir()
    a = alerts_df(spark).dropDuplicates(["domain", "day", "metric", "method", "type"])
    cards, dom = adaptive_card(a, "u"), a.first().domain
    refused = a.where(F.col("domain") == dom).count()
    out = ledger.deliver_once(cards.unionByName(cards), sender(str(log), refuse=(dom,)), path, attempts=2)
    assert out.where("NOT sent").count() == 2 * refused and out.where("attempts_used = 2").count() == 2 * refused
    before = sum(sent(log).values())
    out = ledger.deliver_once(cards, sender(str(log)), path)
    assert sum(sent(log).values()) == before + refused and out.where("sent").count() == a.count()


def test_card_keys(spark):
    df = spark.createDataFrame([("d", D0, None, "m", "t"), ("d", D0, "", "m", "t"), ("d", D0, "x", "m", "t"), ("d|", D0, "x", "m", "t")],
                               "domain string, day date, metric string, method string, type string")
    keys = [r[0] for r in df.select(ledger.card_key(df)).collect()]
    assert len(set(keys)) == 4 and keys == [r[0] for r in df.select(ledger.card_key(df)).collect()]


GOLD = ["domain", "day", "spend", "leads", "sessions"]


def test_gold_after_late_rows_and_skipped_days_equals_a_rebuild(spark, tmp_path):
    w, a, d = raw_tables(spark)
    path = str(tmp_path / "gold")
    late, skipped = CUT - 10 * DAY, [CUT - 2 * DAY, CUT - DAY]
    day = F.to_date("date")
    w0, a0 = w.where((day != late) | (F.col("propertyID") == "ACC-001")), a.where(day != CUT - 20 * DAY)
    first = changes.refresh_gold(w0, [a0], d, path, CUT - 3 * DAY)
    assert len(first) == 63
    versions = history.manifest(spark, path + "/gold")["days"]
    todo = changes.refresh_gold(w, [a], d, path, CUT)
    assert todo == sorted([late, CUT - 20 * DAY, *skipped, CUT])
    whole = build_gold(w, [a], d, CUT, 65)
    assert rows_of(changes.read_gold(spark, path, CUT - 65 * DAY, CUT).select(GOLD)) == rows_of(whole.select(GOLD))
    after = history.manifest(spark, path + "/gold")["days"]
    assert {k for k in after if after[k] != versions.get(k)} == {x.isoformat() for x in todo}  # the others are left as they were
    assert changes.refresh_gold(w, [a], d, path, CUT) == []
    gone = changes.refresh_gold(w.where(day != late), [a.where(day != late)], d, path, CUT)  # withdrawn rows
    assert gone == [late] and changes.read_gold(spark, path, late, late).count() == 0
    other = d.withColumn("domain", F.concat("domain", F.lit("x")))
    assert len(changes.refresh_gold(w, [a], other, path, CUT)) == 66  # another dictionary changes every day
    assert {r.domain for r in changes.read_gold(spark, path, CUT, CUT).collect()} == {"a.comx", "b.comx"}


def test_gold_by_files_reads_no_metric_of_unchanged_days(spark, tmp_path):
    w, a, d = raw_tables(spark)
    web, ads, path = str(tmp_path / "web"), str(tmp_path / "ads"), str(tmp_path / "gold")
    late = CUT - 10 * DAY
    is_late = F.to_date("date") == late
    for df, place in ((w, web), (a, ads)):
        df.where(~is_late | (F.hash(*df.columns) % 2 == 0)).withColumn("d", F.to_date("date")).repartition("d").write.partitionBy("d").parquet(place)
    read = lambda place: spark.read.parquet(place)

    def refresh():
        return changes.refresh_gold(read(web), [read(ads)], d, path, CUT, fingerprints="files")
    assert len(refresh()) == 66 and refresh() == []
    for df, place in ((w, web), (a, ads)):
        df.where(is_late & (F.hash(*df.columns) % 2 != 0)).withColumn("d", F.to_date("date")).write.mode("append").partitionBy("d").parquet(place)
    assert refresh() == [late] and refresh() == []
    assert rows_of(changes.read_gold(spark, path, CUT - 65 * DAY, CUT).select(GOLD)) == rows_of(build_gold(w, [a], d, CUT, 65).select(GOLD))
    plan = changes.day_fingerprints({"web": (read(web), "date", w.columns)}, CUT, by="files")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date:" in plan and "TotalSessions" not in plan and "propertyID" not in plan
    by_day = changes.day_fingerprints({"web": (read(web), "d", w.columns)}, CUT, by="files")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in by_day
    with pytest.raises(ValueError):
        changes.day_fingerprints({"web": (read(web), "date", w.columns)}, CUT, by="names")


def test_a_day_whose_gold_another_run_has_written_is_done_again(spark, tmp_path):
    w, a, d = raw_tables(spark)
    path = str(tmp_path / "gold")
    changes.refresh_gold(w, [a], d, path, CUT, 5)
    stale = changes.read_gold(spark, path, CUT, CUT).withColumn("spend", F.col("spend") + 1)
    history.write_days(stale, f"{path}/gold", [CUT])  # as a run that began earlier and commits its gold last
    assert changes.refresh_gold(w, [a], d, path, CUT, 5) == [CUT] and changes.refresh_gold(w, [a], d, path, CUT, 5) == []
    assert rows_of(changes.read_gold(spark, path, CUT, CUT).select(GOLD)) == rows_of(build_gold(w, [a], d, CUT, 0).select(GOLD))


def test_fingerprints_tell_repeats_and_nulls(spark):
    def prints(rows):
        df = spark.createDataFrame(rows, "id string, date date, v double")
        return rows_of(changes.day_fingerprints({"s": (df, "date", ["id", "v"])}, D0, 5))
    one = [("a", D0, 1.0), ("b", D0, None)]
    assert prints(one) == prints(one[::-1]) and len({str(prints(x)) for x in (
        one, one + one, [("a", D0, None), ("b", D0, 1.0)], [(None, D0, 1.0), ("b", D0, None)], [("a", D0, 1.0)] * 2)}) == 5


def test_daily_job_twice_sends_once_and_finds_gaps_in_the_window(spark, tmp_path):
    from metricwatch.plans.variants import daily_job
    log = tmp_path / "log"
    log.mkdir()
    w, a, d = raw_tables(spark)
    hole = CUT - 30 * DAY
    w, a = w.where(F.to_date("date") != hole), a.where(F.to_date("date") != hole)
    for _ in range(2):
        row = daily_job(w, [a], d, str(tmp_path / "h"), str(tmp_path / "r"), send=sender(str(log)), ledger=str(tmp_path / "l"),
                        cutoff=CUT, days=65, gold_path=str(tmp_path / "g"), calendar=True).first()
        assert row.sent == row.total == row.total_alerts
    assert sum(sent(log).values()) == row.total
    found = read_alerts(spark, str(tmp_path / "h"))
    assert found.count() == row.total_alerts and {(r.domain, r.method) for r in found.where(F.col("day") == hole).collect()} == {
        ("a.com", "missing_day"), ("b.com", "missing_day")}
