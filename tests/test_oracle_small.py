"""A few registered queries against their DuckDB statements on the smallest tables."""

import pytest

from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", ["gold_daily", "mad_alerts_latest", "iforest_alerts", "missing_days", "cap_per_day",
                                  "daily_alerts", "validate"])
def test_query_matches_sql(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["cols_match"] and r["hash_match"] and r["types_match"], r


@pytest.mark.parametrize("parts", [1, 3])
def test_partition_count_does_not_change_results(spark, con, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for name in ["iforest_scores", "fused_alerts"]:
            r = compare(spark, con, name, SF)
            assert r["hash_match"], r
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
