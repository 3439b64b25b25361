"""Shapes of physical plans, and agreement between plans."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from duck_sql import all_sql
from tests.conftest import rows
from tillroll.plans.registry import QUERIES

PLANNED = [
    "std_union",
    "ingest_audit",
    "source_profile",
    "dwd_quality",
    "dws_basket_item",
    "dws_customer_monthly",
    "ads_overview",
    "recon_report",
    "rfm_snapshots",
    "segment_migrations",
    "scope_baskets",
    "segment_rules",
    "rule_drift",
    "product_profiles",
    "q_companions",
    "synthetic_transactions",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(all_sql()) == set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_in_spark_without_cross_joins(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan, unwanted


def test_scans_read_only_needed_columns_and_push_filters(spark, sf_dir, tmp_path):
    from tillroll.operators import kpi, rfm, warehouse
    from tillroll.sources import sample_tables as sample
    from tillroll.sources import tables

    tables.write_table(sample.fact(spark, sf_dir, faults=True), str(tmp_path / "fact"), "parquet")
    fact = tables.read_table(spark, str(tmp_path / "fact"), "parquet")
    plan = plan_of(warehouse.customer_summary(fact))
    assert "EqualTo(is_valid_analysis,1)" in plan
    assert "description" not in plan and "country" not in plan
    items = tables.read_table(spark, str(tmp_path / "fact"), "parquet")
    assert "GreaterThanOrEqual(invoice_ts" in plan_of(rfm.observe(items, "1999-12-31", "1998-01-01"))
    assert "TakeOrderedAndProject" in plan_of(kpi.top_products(warehouse.basket_item(fact)))


def test_top_rules_are_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(queries()["segment_top_products"](spark, sf_dir))


@pytest.mark.parametrize("name", ["rfm_segment_summary", "association_rules", "basket_budgets"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(rows(queries()[name](spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and results[0]


def test_entry_returns_segments(spark):
    df = entry(spark)
    assert "segment_code" in df.columns and df.count() > 0
