from __future__ import annotations

import hashlib
import itertools
import statistics
from collections import Counter
from dataclasses import replace

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.config import AnalyticsConfig, AugmentationConfig, BasketConfig
from tillroll.functions import random
from tillroll.operators import generate, medians, profiles
from tillroll.operators.companions import companion_index
from tillroll.plans import jobs
from tillroll.plans.registry import _items
from tillroll.schemas import BASKET_ITEM_COLUMNS, MARTS
from tillroll.sources.buckets import read_buckets
from tillroll.sources.items import export_tsv, read_basket_items, read_segments
from tillroll.sources.marts import read_manifest, read_marts
from tillroll.sources.stage import materialise

CFG = AugmentationConfig(
    target_rows=10_000,
    synthetic_customers=10,
    top_anchors=4,
    min_pair_baskets=1,
    max_basket_size=4,
    seed=42,
    batch_id="TEST-BATCH",
)
SEGMENTS = [("K1", "CHAMPIONS"), ("K2", "LOYAL"), ("K3", "LOYAL")]


@pytest.fixture(scope="module")
def segments(spark):
    data = [(c, s, s.title()) for c, s in SEGMENTS]
    return spark.createDataFrame(data, "customer_id string, segment_code string, segment_name string")


@pytest.fixture(scope="module")
def generated(scenario_items, segments, tmp_path_factory):
    lines, context = generate.generate(scenario_items, segments, CFG)
    return lines.cache(), context


def test_generated_lines_keep_their_invariants(generated, scenario_items):
    lines, context = generated
    all_lines = lines.collect()
    assert len(all_lines) == 10_000 == len({r.synthetic_line_id for r in all_lines})
    assert sorted(r.synthetic_line_id for r in all_lines)[-1] == "TEST-BATCH-00010000"
    baskets = Counter(r.invoice_no for r in all_lines)
    assert min(baskets.values()) >= 2 and max(baskets.values()) <= 4
    assert all(len({r.stock_code for r in all_lines if r.invoice_no == i}) == n for i, n in list(baskets.items())[:50])
    assert all(1 <= r.item_quantity <= 96 and r.item_amount > 0 for r in all_lines)
    assert all(0.58 <= r.generation_confidence <= 0.98 for r in all_lines)
    assert {r.generation_batch_id for r in all_lines} == {"TEST-BATCH"}
    last = max(r.invoice_ts for r in scenario_items.collect())
    assert all(r.invoice_ts.date() > last.date() and 8 <= r.invoice_ts.hour <= 18 for r in all_lines)
    owner = dict(SEGMENTS)
    assert all(owner.get(r.customer_id, r.source_segment_code) == r.source_segment_code for r in all_lines)
    new = sum(r.customer_id.startswith("SYN-C") for r in all_lines) / len(all_lines)
    assert 0.15 < new < 0.25
    assert lines.schema.names == MARTS["synthetic_transaction"].schema.names


def test_generation_does_not_depend_on_partitions(spark, generated):
    lines, context = generated
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = generate.generate_lines(spark, context, CFG)
        assert rows(again) == rows(lines)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    other = generate.generate_lines(spark, context, replace(CFG, seed=43))
    assert rows(other) != rows(lines)


def test_report_describes_the_lines(generated):
    lines, context = generated
    report = generate.quality_report(lines, CFG, context.anchor_count, context.product_count).first()
    assert (report.synthetic_row_count, report.all_amounts_positive, report.all_quantities_positive) == (10_000, 1, 1)
    # "D" is a service code, so three products are left and all are anchors.
    assert (report.anchor_product_count, report.relationship_anchor_coverage) == (3, 1.0)
    assert report.new_synthetic_customer_count <= 10


@given(st.integers(10, 5000), st.integers(2, 6), st.integers(0, 4))
def test_size_plan_adds_up(total, smallest, more):
    largest = max(3, smallest + more)
    plan = generate.plan_sizes(total, smallest, largest)
    assert plan.blocks * sum(plan.sizes) + sum(plan.tail) == total
    assert all(2 <= size <= largest for size in (*plan.sizes, *plan.tail))


def test_impossible_sizes_and_settings_are_refused(scenario_items, segments):
    with pytest.raises(ValueError):
        generate.plan_sizes(7, 2, 2)
    for bad in ({"target_rows": 9_999}, {"min_basket_size": 1}, {"max_basket_size": 2}):
        with pytest.raises(ValueError):
            replace(CFG, **bad).validate()
    with pytest.raises(ValueError, match="no anchor"):
        generate.generate(scenario_items, segments, replace(CFG, min_pair_baskets=99))


def test_synthetic_pool_splits_all_customers_by_size(spark):
    sizes = spark.createDataFrame([("A", 1), ("B", 5), ("C", 0), ("D", 4)], "segment_code string, customer_count int")
    pool = {r.segment_code: (r.pool_first, r.pool_size) for r in generate.synthetic_pool(sizes, 25).collect()}
    numbers = sorted(n for first, size in pool.values() for n in range(first, first + size))
    assert numbers == list(range(1, 26))
    assert pool["C"][1] == 0 and abs(pool["B"][1] - 12.5) <= 1 and abs(pool["A"][1] - 2.5) <= 1


@pytest.mark.parametrize("width", [1, 3, 256])
def test_pairs_of_wide_invoices_equal_brute_force(make_items, width):
    codes = [f"P{n}" for n in range(11)]
    content = [codes, codes[:4], codes[2:9], codes[5:6], [*codes[:2], "P0", "P1"]]
    items = make_items([(str(n), f"C{n}", None, code, code, 1, 2) for n, invoice in enumerate(content) for code in invoice])
    pairs, counts = profiles.pair_counts(items, profiles.profiles(items), CFG, width)
    want = Counter(pair for invoice in content for pair in itertools.combinations(sorted(set(invoice)), 2))
    assert {(r.left_code, r.right_code): r.pair_count for r in pairs.collect()} == want
    assert {r.stock_code: r.basket_count for r in counts.collect()} == Counter(c for invoice in content for c in set(invoice))


def test_no_cell_holds_a_large_part_of_a_wide_invoices_pairs(spark):
    n = 20_000
    wide = spark.range(n).select(F.lit("W").alias("invoice_no"), F.format_string("P%05d", "id").alias("stock_code"))
    small = spark.range(300).select(F.format_string("S%d", F.col("id") % 100).alias("invoice_no"), F.format_string("P%05d", "id").alias("stock_code"))
    cells = profiles.cells(wide.union(small), 256)
    made = F.when(F.col("low") == F.col("high"), F.size("firsts") * (F.size("firsts") - 1) / 2).otherwise(F.size("firsts") * F.size("others"))
    rows = {r.invoice_no: r for r in cells.groupBy("invoice_no").agg(F.sum(made).alias("pairs"), F.max(made).alias("most"), F.count("*").alias("cells")).collect()}
    assert rows["W"].pairs == n * (n - 1) / 2 and rows["W"].most < 0.01 * rows["W"].pairs
    assert len(rows) == 101 and rows["S7"].cells == 1 and rows["S7"].pairs == 3


def test_draws_are_digests_that_any_engine_can_state(spark):
    expected = int(hashlib.md5(b"42|place|7|x").hexdigest()[:13], 16) / 2**52
    frame = spark.range(1000).withColumn("text", F.lit("x"))
    drawn = [r[0] for r in frame.select(random.uniform(42, "place", F.col("id"), F.col("text"))).collect()]
    assert drawn[7] == expected and len(set(drawn)) == 1000
    assert all(0 <= u < 1 for u in drawn) and abs(statistics.mean(drawn) - 0.5) < 0.05
    assert [r[0] for r in frame.select(random.below(F.lit(10), 42, "place", F.col("id"), F.col("text"))).collect()] == [int(u * 10) for u in drawn]


def test_a_draw_looks_at_the_few_buckets_of_its_cell(spark):
    buckets, numbers = 300, 2000
    weights = {"A": [1 + n % 7 for n in range(buckets)], "B": [1] * 3 + [buckets]}
    shares = {s: [sum(w[: n + 1]) / (sum(w) * 1.001) for n in range(len(w))] for s, w in weights.items()}
    data = [(s, n, upto) for s, found in shares.items() for n, upto in enumerate(found)]
    cells = generate._share_cells(spark.createDataFrame(data, "segment_code string, bucket bigint, upto double"), buckets)
    lists = {(r["segment_code"], r["cell"]): r["buckets"] for r in cells.collect()}
    assert len(lists) == 2 * buckets and max(map(len, lists.values())) <= 6
    drawn = spark.range(numbers).select(F.explode(F.array(F.lit("A"), F.lit("B"))).alias("segment_code"), (F.col("id") / numbers).alias("u"))
    drawn = drawn.withColumn("cell", generate._cell(F.col("u"), buckets)).join(cells, ["segment_code", "cell"])
    found = drawn.select("segment_code", "u", random.pick(F.col("buckets"), F.col("u"))["bucket"].alias("bucket")).collect()
    assert len(found) == 2 * numbers
    for r in found:
        own = shares[r["segment_code"]]
        assert r["bucket"] == next((n for n, upto in enumerate(own) if upto > r["u"]), len(own) - 1)


def test_exact_median_equals_statistics(spark):
    groups = {"one": [5], "two": [1, 2], "ties": [3] * 9 + [4], "wide": [-(10**12), 10**12, 7, 0], "many": [n * 7919 % 10**7 for n in range(501)]}
    df = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values] + [("one", None)], "k string, v bigint")
    found = {r.k: r.m for r in medians.exact_median(df, ["k"], "v", "m").collect()}
    assert found == {k: float(statistics.median(values)) for k, values in groups.items()}


def test_profiles_name_ties_clips_and_missing_names(make_items):
    data = [("1", "C", None, "A", "zeta", 100, 200), ("2", "C", None, "A", "alpha", 90, 90), ("3", "C", None, "B", None, 1, 3)]
    found = {r.stock_code: r for r in profiles.profiles(make_items(data)).collect()}
    assert (found["A"].product_name, found["A"].median_quantity, found["A"].median_unit_price) == ("alpha", 72.0, 1.5)
    assert found["B"].product_name == "UNKNOWN PRODUCT"


def test_augmented_rows_keep_their_origin(spark, scenario_items, segments, tmp_path):
    items = scenario_items.unionByName(scenario_items.limit(1).withColumn("item_amount", F.lit(-1).cast("decimal(20,4)")))
    folder = str(tmp_path / "augmented")
    manifest = jobs.run_augmentation(items, segments, folder, CFG)
    assert (manifest["real_row_count"], manifest["clean_row_count"], manifest["augmented_row_count"]) == (16, 15, 10_015)
    back = read_basket_items(spark, manifest["augmented_items"])
    assert back.columns == BASKET_ITEM_COLUMNS
    origins = {r.data_origin: r["count"] for r in back.groupBy("data_origin").count().collect()}
    assert origins == {"REAL": 15, "MODEL_GENERATED": 10_000}
    real = back.filter("data_origin = 'REAL'").agg(F.max("generation_confidence"), F.max("source_segment_code")).first()
    assert tuple(real) == (1.0, None)
    assert read_manifest(spark, folder)["generation_batch_id"] == "TEST-BATCH"
    index = read_buckets(spark, read_manifest(spark, folder)["companion_index"])
    assert rows(index) == rows(companion_index(spark.read.parquet(manifest["synthetic_transactions"])))
    assert index.filter("scope = 'ALL'").count() > 0


def test_too_few_candidates_are_refused(scenario_items, segments):
    with pytest.raises(ValueError, match="cannot be drawn|not enough"):
        only_one = scenario_items.filter("stock_code IN ('E', 'D')")
        generate.generate(only_one, segments, CFG)


def test_row_target_holds_with_short_candidate_lists(spark, sf_dir):
    items = _items(spark, sf_dir)
    segments = items.select("customer_id", F.lit("LOYAL").alias("segment_code"), F.lit("x").alias("segment_name")).distinct()
    cfg = replace(CFG, relation_products=2, segment_products=1, max_basket_size=6)
    lines, _ = generate.generate(items, segments, cfg)
    assert lines.count() == cfg.target_rows


def test_failed_runs_leave_the_last_one_and_no_intermediates(spark, sf_dir, tmp_path, monkeypatch):
    from pathlib import Path

    from tillroll.session import ensure_checkpoint_dir

    items = _items(spark, sf_dir)
    outputs = str(tmp_path / "outputs")
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    cfg = AnalyticsConfig(basket=BasketConfig(min_confidence=0.05, min_segment_baskets=50))
    manifest = jobs.run_analytics(items, outputs, cfg)
    assert set(folder.iterdir()) == before

    def fail(*_):
        raise RuntimeError("half-way")

    monkeypatch.setattr(jobs.kpi, "kpi_monthly", fail)
    with pytest.raises(RuntimeError):
        jobs.run_analytics(items, outputs, cfg)
    assert read_manifest(spark, outputs)["outputs"] == manifest["outputs"]
    assert set(folder.iterdir()) == before


def test_analytics_job_feeds_the_marts(spark, sf_dir, tmp_path):
    items = _items(spark, sf_dir)
    export_tsv(items, str(tmp_path / "items"))
    loaded = read_basket_items(spark, str(tmp_path / "items"))
    outputs, marts = str(tmp_path / "outputs"), str(tmp_path / "marts")
    cfg = AnalyticsConfig(basket=BasketConfig(min_confidence=0.05, min_segment_baskets=50))
    manifest = jobs.run_analytics(loaded, outputs, cfg)
    assert manifest["transaction_row_count"] == items.count()
    assert read_manifest(spark, outputs)["rfm_customer_count"] == manifest["rfm_customer_count"] > 0
    assert set(manifest["outputs"]) == {
        "rfm_snapshots", "rfm_customers", "rfm_segment_summary", "segment_migrations", "association_rules",
        "rule_drift", "monthly_sales", "top_products", "business_overview",
    }
    counts = jobs.load_marts(spark, outputs, marts)
    assert counts["association_rule"] == manifest["association_rule_count"] > 0
    assert set(read_marts(spark, marts)) == set(counts) == set(MARTS) - {"synthetic_transaction"}
    path = tmp_path / "segments.csv"
    spark.read.parquet(manifest["outputs"]["rfm_customers"]).coalesce(1).write.csv(str(path), header=True)
    assert read_segments(spark, str(path)).count() == manifest["rfm_customer_count"]


def test_cells_and_medians_read_their_input_once(make_items):
    """What they return reads stored products of invoices and stored counts, however often it is used."""
    data = [(f"I{n}", "C", None, code, code, 1, n) for n in range(4) for code in "ABC"]
    lines = materialise(make_items(data), "lines-read-once")
    dealt = profiles.cells(lines.select("invoice_no", "stock_code"), 2)
    found = medians.exact_median(lines.withColumn("v", F.col("item_amount").cast("double")), ["stock_code"], "v", "m", per_unit=100)
    for df in (dealt, found):
        assert "lines-read-once" not in df._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == {(code, 1.5) for code in "ABC"}
