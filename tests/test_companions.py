"""The companion index against the counts made for each call."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators.companions import companion_index
from tillroll.operators.recommend import REQUEST_COLUMNS, companions, predictions, scenario_contents
from tillroll.sources.buckets import read_buckets, write_buckets
from tillroll.sources.stage import materialise

LINES = "invoice_no string, stock_code string, product_name string, source_segment_code string"
REQUESTS = "request_id string, segment_code string, product_code string, min_lift double, max_results int"


def scenario(seed, invoices=60, products=12, width=6):
    """Products under several names or none, rare products, lines that repeat, invoices of several segments."""
    rnd = random.Random(seed)
    made = []
    for invoice in range(invoices):
        segment = rnd.choice(["S1", "S2", None])
        for _ in range(rnd.randint(1, width)):
            code = f"P{min(rnd.randint(0, products), rnd.randint(0, products))}"
            made.append((f"I{invoice}", code, rnd.choice([f"n{code}"] * 6 + ["other", None]), rnd.choice([segment] * 9 + ["S1"])))
    return made


def asked(spark, products=13, min_lift=0.0):
    found = [(f"{s}/{n}", s, f"P{n}", min_lift, 50) for s in ("ALL", "S1", "S2", "none") for n in range(products)]
    return spark.createDataFrame(found, REQUESTS).select(*REQUEST_COLUMNS)


@pytest.mark.parametrize(("seed", "width"), [(1, 256), (2, 2)])
def test_index_answers_as_the_lines_do(spark, seed, width):
    lines = spark.createDataFrame(scenario(seed, width=9), LINES)
    requests = asked(spark)
    found = rows(predictions(companion_index(lines, width), requests, 0.05))
    assert len(found) > 50 and found == rows(companions(lines, requests, 0.05))


def test_empty_lines_and_one_very_wide_invoice(spark):
    assert companion_index(spark.createDataFrame([], LINES)).count() == 0
    data = [(f"I{n}", f"P{p}", f"n{p}", "S1") for n in range(2) for p in range(40)]
    index = companion_index(spark.createDataFrame(data, LINES), width=4)
    assert index.count() == 2 * 40 * 39  # two scopes
    assert {(r.pair_baskets, r.anchor_baskets, r.baskets, r.total) for r in index.collect()} == {(2, 2, 2, 2)}


def test_buckets_are_joined_without_a_shuffle(spark, tmp_path):
    lines = spark.createDataFrame(scenario(3), LINES)
    index = companion_index(lines)
    stored = write_buckets(index, str(tmp_path / "it's stored"), ["scope", "anchor"], 4)
    fresh = spark.newSession()
    assert rows(read_buckets(fresh, stored)) == rows(index) == rows(read_buckets(spark, stored))
    requests = asked(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = predictions(read_buckets(spark, stored), requests, 0.05)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(companions(lines, requests, 0.05))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan


def test_lines_are_shuffled_once_for_all_scopes(spark):
    scopes = materialise(asked(spark).select(F.col("segment_code").alias("scope")).distinct(), "scopes")
    lines = materialise(spark.createDataFrame(scenario(4), LINES), "lines")
    plan = scenario_contents(lines, F.broadcast(scopes))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("width", [0, 3])
def test_wide_invoices_and_lines_without_invoice_count_as_before(spark, width):
    """Invoices over the width are joined with themselves; a line without invoice covers its product and pairs with none."""
    data = [*scenario(5, width=9), (None, "P1", "nP1", "S1"), (None, "P2", "nP2", None)]
    lines, requests = spark.createDataFrame(data, LINES), asked(spark)
    found = companions(lines, requests, 0.05, width=width)
    assert found.count() > 50 and rows(found) == rows(companions(lines, requests, 0.05))
    held = {}
    for invoice, code, name, _ in data:
        held.setdefault(invoice, set()).add((code, name))
    top = {r.request_id: r for r in found.collect() if r.position == 1}
    for n in range(13):
        baskets = [goods for invoice, goods in held.items() if invoice and f"P{n}" in {code for code, _ in goods}]
        best = max((sum(good in goods for goods in baskets) for good in {g for b in baskets for g in b if g[0] != f"P{n}" and g[1]}), default=0)
        if f"ALL/{n}" in top:
            assert top[f"ALL/{n}"].coverage_basket_count == best
    assert {r.scope_basket_count for r in top.values() if r.segment_code == "ALL"} == {len(held) - 1}
