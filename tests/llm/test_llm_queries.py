"""Queries with SQL against DuckDB, and the pipeline stage by stage."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from metricwatch.session import ensure_checkpoint_dir
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return duck(SF)


def test_all_are_registered():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", ["op2_url_filters", "op3_line_dedup", "op5_exact_dedup", "op8_mixing_weights", "op9_quality_rules",
                                  "op11_ranked_lexical_search", "op13_spelling_variants"])
def test_query_matches_sql(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["cols_match"] and r["hash_match"] and r["types_match"], r


def test_pipeline_stages(spark, tmp_path):
    from tests.llm.test_duplicates import plain_components, plain_fingerprint, plain_lines
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, held[-1], SF).write.parquet(str(tmp_path / str(k)))
        held.append(spark.read.parquet(str(tmp_path / str(k))))
    good, lined, near, mixed, packed = held[1:]
    for df in (good, lined, near, mixed):
        assert df.columns == docs.columns
    kept = {r["doc_id"] for r in E.queries()["op9_quality_rules"](spark, SF).where("kept").select("doc_id").collect()}
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(kept)
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    assert pairs(lined) == sorted(plain_lines(pairs(good)))
    want = plain_components([(i, plain_fingerprint(t)) for i, t in pairs(lined)], 2)
    assert [i for i, _ in pairs(near)] == sorted({c for _, _, c in want})  # ids are unique here: a group is named by the row that stays
    assert set(pairs(mixed)) == set(pairs(near))  # some more than once
    assert {r["doc_id"] for r in packed.collect()} == {i for i, _ in pairs(near)}
    assert packed.where("piece = 0").count() == mixed.count()
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    there = set(os.listdir(base))
    whole = corpus_pipeline.run(spark, SF)
    assert [n[:16] for n in set(os.listdir(base)) - there if n.startswith("pipeline-stage")] == ["pipeline-stage-4"]  # the others are gone
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, packed.drop("sequence_id", "offset").collect()))
