import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_scored_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 150
    assert {"event_type", "day", "resid", "mad", "is_outlier"} <= set(df.columns)


def test_every_query_has_sql_and_runs(spark):
    from metricwatch.plans.oracle_queries import SQL
    from metricwatch.plans.queries import QUERIES
    qs, sql = E.queries(), E.oracle_sql()
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(qs) and set(SQL) <= set(sql)
    for name in ["gold_daily", "mad_alerts_all", "missing_days", "validate", "cutoff_day"]:
        assert qs[name](spark, SF).count() >= 0
