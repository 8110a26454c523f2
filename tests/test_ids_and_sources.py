import datetime as dt

from pyspark.sql import functions as F

from metricwatch.functions.columns import cutoff_day, normalize_account_id, python_float_text
from metricwatch.operators.gold import build_gold
from metricwatch.sources.tables import account_dictionary, analysis_window, daily_sum


def test_normalize_account_id(spark):
    df = spark.createDataFrame([("Customer#000000123",), ("ab-c",), ("12-34",), (None,)], "x string")
    got = [r[0] for r in df.select(normalize_account_id("x")).collect()]
    assert got == ["000000123", None, "1234", None]


def test_digitless_ids_never_match(spark):
    left = spark.createDataFrame([("ab-c", 1)], "id string, v int").select(normalize_account_id("id").alias("k"), "v")
    right = spark.createDataFrame([("x-y", "d")], "id string, dom string").select(normalize_account_id("id").alias("k"), "dom")
    assert left.join(right, "k").count() == 0


def test_dictionary_smallest_domain_any_partitioning(spark):
    rows = [("A-1", "zeta.com"), ("A-1", "alpha.com"), ("B-2", "b.com"), ("B-2", "b.com"), ("c", "none.com")]
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "AccountID string, domain string").repartition(parts)
        got = {r.account_id_norm: r.domain for r in account_dictionary(df, "AccountID", "domain").collect()}
        assert got == {"1": "alpha.com", "2": "b.com"}


def test_cutoff_day_same_under_two_session_zones(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 8, 2, 3, 0),), (dt.datetime(2001, 8, 2, 6, 0),)], "ts timestamp_ntz")
    res = []
    for tz in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        res.append([r[0] for r in df.select(cutoff_day("America/Bogota", F.col("ts"), now_zone="UTC")).collect()])
        aware = dt.datetime(2001, 8, 2, 3, 0, tzinfo=dt.timezone.utc)
        res.append([spark.range(1).select(cutoff_day("America/Bogota", aware)).first()[0]])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # 03:00 UTC is 22:00 of Aug 1 in Bogota -> yesterday is Jul 31; 06:00 UTC is Aug 2 01:00 -> Aug 1
    assert res[0] == res[2] == [dt.date(2001, 7, 31), dt.date(2001, 8, 1)]
    assert res[1] == res[3] == [dt.date(2001, 7, 31)]


def test_window_inclusive_and_int_truncation(spark):
    rows = [("p-1", dt.datetime(2001, 5, 27, 12), 1.9), ("p-1", dt.datetime(2001, 5, 28, 0), 1.9),
            ("p-1", dt.datetime(2001, 5, 28, 23), 1.9), ("p-1", dt.datetime(2001, 8, 1, 23, 59), 2.5),
            ("p-1", dt.datetime(2001, 8, 2, 0), 7.0)]
    df = spark.createDataFrame(rows, "id string, date timestamp_ntz, x double")
    assert analysis_window(df, "date", dt.date(2001, 8, 1), 65).count() == 3
    got = {r.day: r.v for r in daily_sum(df, "id", "date", {"v": "x"}, dt.date(2001, 8, 1), 65).collect()}
    assert got == {dt.date(2001, 5, 28): 3, dt.date(2001, 8, 1): 2}


def test_gold_fills_missing_side_with_zero(spark):
    web = spark.createDataFrame([("1", dt.datetime(2001, 8, 1), 3, 10)],
                                "propertyID string, date timestamp_ntz, TotalConversions int, TotalSessions int")
    ads = spark.createDataFrame([("1", dt.datetime(2001, 7, 31), 99.9)], "account_id string, date timestamp_ntz, spend_gbp double")
    dic = spark.createDataFrame([("1", "d.com")], "AccountID string, domain string")
    got = sorted(tuple(r) for r in build_gold(web, [ads], dic, dt.date(2001, 8, 1), 65).collect())
    assert got == [("d.com", dt.date(2001, 7, 31), 99, 0, 0), ("d.com", dt.date(2001, 8, 1), 0, 3, 10)]


def test_python_float_text(spark):
    df = spark.createDataFrame([(5.0,), (12.3,), (0.0005,), (None,), (-3.0,)], "x double")
    assert [r[0] for r in df.select(python_float_text("x")).collect()] == ["5.0", "12.3", "0.0005", None, "-3.0"]


def test_daily_sum_same_source_twice(spark):
    df = spark.createDataFrame([("1", dt.datetime(2001, 8, 1), 2.0)], "id string, date timestamp_ntz, x double")
    r = daily_sum(df, "id", "date", {"a": "x", "b": "x"}, dt.date(2001, 8, 1), 65).first()
    assert (r.a, r.b) == (2, 2)


def test_unit_draw_column_and_sql_agree(spark):
    from metricwatch.functions.columns import unit_draw, unit_draw_sql
    df = spark.createDataFrame([("a", 1, 7), ("b", 2, 9)], "k string, t int, n bigint")
    a = [r[0] for r in df.select(unit_draw(F.lit(42), "k", "t", "n", F.lit("f"))).collect()]
    b = [r[0] for r in df.selectExpr(unit_draw_sql("42", "k", "t", "n", "'f'")).collect()]
    assert a == b and all(0 <= x < 1 for x in a)


def test_read_source_by_name_and_path(spark, tmp_path):
    from metricwatch.sources.tables import read_source
    df = spark.createDataFrame([(1,)], "x int")
    df.createOrReplaceTempView("mw_src_view")
    assert read_source(spark, "mw_src_view").count() == 1
    p = str(tmp_path / "t.parquet")
    df.write.parquet(p)
    assert read_source(spark, p).count() == 1


def test_daily_sum_of_doubles_does_not_depend_on_partitions(spark):
    import datetime as dt

    from metricwatch.sources.tables import daily_sum
    day = dt.date(2001, 7, 1)
    df = spark.createDataFrame([("7", day, 0.1)] * 10, "a string, d date, x double")
    for n in (1, 2, 5):
        assert daily_sum(df.repartition(n), "a", "d", {"x": "x"}, day).first().x == 1


def test_cutoff_day_of_a_zone_alone(spark):
    import datetime as dt
    from zoneinfo import ZoneInfo

    from metricwatch.functions.columns import cutoff_day
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for zone in ("America/Bogota", "Pacific/Kiritimati"):
                want = dt.datetime.now(ZoneInfo(zone)).date() - dt.timedelta(days=1)
                at = F.timestamp_seconds(F.lit(1_700_000_000))
                assert spark.range(1).select(cutoff_day(zone)).first()[0] == want
                assert spark.range(1).select(cutoff_day(zone, at)).first()[0] == \
                    dt.datetime.fromtimestamp(1_700_000_000, ZoneInfo(zone)).date() - dt.timedelta(days=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cut_lineage_reads_back(spark):
    from metricwatch.functions.plan import cut_lineage
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    c = cut_lineage(df)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, df.collect()))
    assert "Exchange" not in c._jdf.queryExecution().executedPlan().toString()
