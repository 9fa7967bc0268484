"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import json
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from conftest import SF01  # noqa: E402
from oracle_check import compare  # noqa: E402
from strata.plans.registry import QUERIES  # noqa: E402
from strata.sources.catalog import TEST_TABLES  # noqa: E402

# the numbered queries of the training-text operators have tests of their own
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "progress_id" in df.columns


def test_every_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(NAMES) <= set(o) <= set(q)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF01)
    issues, ns, nd = compare(df, duck.sql(entry.oracle_sql()[name]))
    assert not issues, issues
    assert ns == nd


def test_hold_out_is_stable_and_near_fraction(spark):
    df = entry.queries()["hold_out_split"](spark, SF01)
    a = {(r.country_code, r.goal_code): r.is_test for r in df.collect()}
    b = {(r.country_code, r.goal_code): r.is_test for r in df.repartition(3).collect()}
    assert a == b
    share = sum(a.values()) / len(a)
    assert 0.15 < share < 0.25


def test_series_documents_deal_out_records_once(spark, tmp_path, capsys):
    import datetime
    from decimal import Decimal

    from strata.plans.registry import series_documents
    rows = [(k, c, "O", Decimal("1.50"), datetime.date(2001, 1, 1), "5-LOW") for k, c in
            ((1, 7), (2, 7), (1500, 7), (1500, 7), (2100, 8), (3, None))]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(15,2), o_orderdate date, "
                                "o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with very many series
    try:
        docs = series_documents(spark, str(tmp_path), "o_custkey")
        headers = sorted((r.series, json.loads(r.payload)[0]["page"], json.loads(r.payload)[0]["total"], len(json.loads(r.payload)[1]))
                         for r in docs.collect())
        series_documents(spark, str(tmp_path), "o_custkey").explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert headers == [(7, 1, 4, 2), (7, 2, 4, 2), (8, 3, 1, 1)]
    plan = capsys.readouterr().out
    assert plan.index("collect_list") < plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning")
