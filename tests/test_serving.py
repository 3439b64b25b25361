from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators import recommend, serving
from tillroll.schemas import MARTS
from tillroll.sources import marts as store

DAY = dt.date(2011, 1, 2)
STAMP = dt.datetime(2011, 1, 1)


def synthetic(n, invoice, code, name, customer="SYN-C000001", segment="CHAMPIONS"):
    return (f"L{n}", invoice, customer, STAMP, code, name, 1, Decimal("10.0000"), segment, Decimal("0.800000"), "m", "B1")


def rule(rule_id, segment, left, right, lift, rank, confidence="0.5"):
    numbers = [Decimal("0.1"), Decimal(confidence), Decimal(lift), None, None]
    return (rule_id, segment, segment.title(), left, left.lower(), right, right.lower(), *numbers, 50, 500, Decimal(rank))


DATA = {
    "business_overview": [(100, 250, 50, 5000, Decimal("50000.00"), Decimal("200.00"), STAMP, STAMP)],
    "monthly_sale": [("2011-02", 1, 1, 1, 1, Decimal(1), Decimal(1)), ("2011-01", 1, 1, 1, 1, Decimal(1), Decimal(1))],
    "rfm_segment_summary": [
        (DAY, "CHAMPIONS", "x", 20, Decimal(30000), Decimal(1), Decimal(1), Decimal(1), Decimal("0.2"), Decimal("0.6")),
        (DAY, "LOYAL", "y", 10, Decimal(40000), Decimal(1), Decimal(1), Decimal(1), Decimal("0.1"), Decimal("0.4")),
        (dt.date(2010, 12, 31), "NEW", "z", 1, Decimal(1), Decimal(1), Decimal(1), Decimal(1), Decimal(1), Decimal(1)),
    ],
    "rfm_customer_snapshot": [
        (DAY, f"C{n:03d}", STAMP, 1, 1, Decimal(1000 - n // 2), 5, 5, 5, "555", "CHAMPIONS" if n < 4 else "LOYAL", "x") for n in range(7)
    ],
    "segment_migration": [("NEW", "z", to, "y", n, dt.date(2010, 12, 31), DAY) for to, n in (("LOYAL", 3), ("NEW", 9))],
    "association_rule": [
        rule("r1", "CHAMPIONS", "A", "B", "2.5", "9.0", "0.655"),
        rule("r2", "ALL", "A", "C", "1.5", "3.0"),
        rule("r3", "ALL", "D", "A", "3.0", "8.0"),
        rule("r4", "ALL", "A|D", "E", "1.2", "2.0"),
        rule("r5", "ALL", "A%", "E", "9.0", "1.0"),
    ],
    "rule_drift": [
        ("ALL", None, "A", None, "B", None, *[Decimal(1)] * 3, 1, None, None, None, None, None, None, "DROPPED"),
        ("ALL", "a", "C", "c", "D", "d", None, None, None, None, *[Decimal(2)] * 3, 1, None, None, "NEW"),
    ],
    "top_product": [("A", "first name", 5, 5, 5, Decimal(10)), ("A", "second name", 5, 5, 5, Decimal(20))],
    "synthetic_transaction": [
        synthetic(1, "S1", "A", "a"),
        synthetic(2, "S2", "X", "x"),
        synthetic(3, "S2", "Y", "y"),
        synthetic(4, "S3", "X", "x", "C1"),
        synthetic(5, "S3", "Y", "y", "C1"),
    ],
}


@pytest.fixture(scope="module")
def marts(spark):
    return {name: spark.createDataFrame(data, MARTS[name].schema) for name, data in DATA.items()}


def test_reads_are_ordered_and_limited(marts):
    assert serving.overview(marts).first().sales_amount == Decimal("50000.00")
    assert [r.invoice_month for r in serving.monthly(marts).collect()] == ["2011-01", "2011-02"]
    assert serving.latest_snapshot(marts).first()[0] == DAY
    assert [r.segment_code for r in serving.segments(marts).collect()] == ["LOYAL", "CHAMPIONS"]
    assert [r.segment_code for r in serving.segments(marts, "2010-12-31").collect()] == ["NEW"]
    assert [r.customer_count for r in serving.migrations(marts, to_day=DAY).collect()] == [9, 3]
    assert serving.migrations(marts, from_day=DAY).count() == 0
    assert [r.drift_status for r in serving.drift(marts).collect()] == ["NEW", "DROPPED"]
    assert serving.drift(marts, "NEW").count() == 1
    assert [r.product_name for r in serving.top_products(marts, 1).collect()] == ["second name"]


def test_customer_pages_cover_all_customers_once(marts):
    pages = [serving.customers(marts, page=p, size=3).collect() for p in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [3, 3, 1, 0]
    assert [r.customer_id for p in pages for r in p] == [f"C{n:03d}" for n in range(7)]
    assert {(r.total_count, r.total_pages) for p in pages for r in p} == {(7, 3)}
    only = serving.customers(marts, segment="LOYAL").collect()
    assert {r.segment_code for r in only} == {"LOYAL"} and only[0].total_count == 3
    with pytest.raises(ValueError):
        serving.customers(marts, page=0)


def test_rule_filters_match_whole_codes(marts):
    def ids(**kw):
        return [r.rule_id for r in serving.rules(marts, **kw).collect()]

    assert ids() == ["r3", "r2", "r4", "r5"]
    assert ids(product="A") == ["r3", "r2", "r4"]
    assert ids(product="A%") == ["r5"]
    assert ids(segment="CHAMPIONS", min_lift=2.0) == ["r1"]
    assert ids(min_lift=2.0, limit=1) == ["r3"]


def ask(spark, marts, product, segment="ALL", **kw):
    request = recommend.request(spark, product, segment, **kw)
    return recommend.recommend(marts, request).orderBy("position").collect()


def test_segment_rule_answers_first(spark, marts):
    found = ask(spark, marts, "A", "CHAMPIONS")
    assert [(r.consequent_codes, r.strategy, r.source_type) for r in found] == [("B", "组合折扣", "SEGMENT_RULE")]
    assert found[0].reason == "历史置信度65.5%，提升度2.50，覆盖50张购物篮"


def test_rules_of_all_customers_answer_next(spark, marts):
    found = ask(spark, marts, "A", "NEW")
    assert [(r.rule_id, r.source_type) for r in found] == [("r2", "GLOBAL_RULE_FALLBACK"), ("r4", "GLOBAL_RULE_FALLBACK")]
    assert [r.rule_id for r in ask(spark, marts, "A", "NEW", max_results=1)] == ["r2"]
    # A direct request for all customers is no fallback.
    assert {r.source_type for r in ask(spark, marts, "A")} == {"SEGMENT_RULE"}


def test_totals_survive_a_page_past_the_end(marts):
    total = serving.customers_total(marts, size=2).first()
    seen, after = [], None
    while page := serving.customers_after(marts, after, size=2).collect():
        seen += [(r.monetary, r.customer_id) for r in page]
        after = seen[-1]
    first_pages = [serving.customers(marts, page=p, size=2).collect() for p in range(1, total.total_pages + 1)]
    assert seen == [(r.monetary, r.customer_id) for page in first_pages for r in page]
    assert len(seen) == total.total_count
    assert serving.customers(marts, page=99, size=2).count() == 0
    nobody = serving.customers_total(marts, segment="NOBODY").first()
    assert (nobody.total_count, nobody.total_pages) == (0, 0) and nobody.snapshot_date is not None
    with pytest.raises(ValueError, match="size"):
        serving.customers_total(marts, size=0)


def test_rules_that_end_in_the_product_take_no_place(spark, marts):
    # The best rule naming A has it as its consequent; the next one still answers a request for one rule.
    found = recommend.match_rules(marts["association_rule"], recommend.request(spark, "A", max_results=1), "S").collect()
    assert [(r.rule_id, r.position) for r in found] == [("r2", 1)]


@pytest.mark.parametrize(
    ("request_", "problem"),
    [
        ((None, "A", 1.0, 5), "no id"),
        (("1", " ", 1.0, 5), "no product"),
        (("1", "A", -0.1, 5), "below zero"),
        (("1", "A", 1.0, 0), "between 1 and 50"),
        (("1", "A", 1.0, 51), "between 1 and 50"),
        (("7", "A", 1.0, 5), "repeat"),
    ],
)
def test_wrong_requests_are_refused(spark, marts, request_, problem):
    made = [("7", "ALL", "A", 1.0, 5), (request_[0], "ALL", *request_[1:])]
    schema = "request_id string, segment_code string, product_code string, min_lift double, max_results int"
    with pytest.raises(ValueError, match=problem):
        recommend.recommend(marts, spark.createDataFrame(made, schema))


def test_very_many_requests_for_one_product(spark, marts):
    many = spark.range(100_000).select(
        F.col("id").cast("string").alias("request_id"),
        F.lit("NEW").alias("segment_code"),
        F.lit("A").alias("product_code"),
        F.lit(1.05).alias("min_lift"),
        F.lit(10).alias("max_results"),
    )
    found = recommend.recommend(marts, many)
    assert found.count() == 200_000 and found.filter("request_id = '99999'").count() == 2


def test_predictions_answer_last(spark, marts):
    found = ask(spark, marts, "X", "CHAMPIONS")
    assert [(r.consequent_codes, r.segment_code, r.source_type) for r in found] == [("Y", "CHAMPIONS", "MODEL_PREDICTION")]
    assert (found[0].confidence, found[0].lift, found[0].coverage_basket_count) == (1.0, 1.5, 2)
    assert found[0].reason == "模型增强场景置信度100.0%，提升度1.50，覆盖2张预测购物篮"
    assert [r.segment_code for r in ask(spark, marts, "X", "NEW")] == ["ALL"]
    assert ask(spark, marts, "unknown", "NEW") == []


def test_many_requests_equal_single_requests(spark, marts):
    asked = [("A", "CHAMPIONS"), ("A", "NEW"), ("X", "NEW"), ("D", "ALL"), ("none", "ALL")]
    table = spark.createDataFrame(
        [(str(n), s, p, 1.05, 10) for n, (p, s) in enumerate(asked)],
        "request_id string, segment_code string, product_code string, min_lift double, max_results int",
    )
    together = recommend.recommend(marts, table).drop("request_id")
    alone = [tuple(r)[1:] for p, s in asked for r in ask(spark, marts, p, s)]
    assert rows(together) == sorted(alone, key=repr) and len(alone) >= 5


def test_augmentation_summary(marts):
    row = serving.augmentation_summary(marts).first()
    assert (row.enabled, row.synthetic_row_count, row.synthetic_order_count, row.synthetic_customer_count) == (1, 5, 3, 2)
    assert (row.predicted_sales_amount, row.average_confidence) == (Decimal("50.00"), Decimal("0.800000"))
    empty = serving.augmentation_summary({"synthetic_transaction": marts["synthetic_transaction"].limit(0)}).first()
    assert (empty.enabled, empty.synthetic_row_count, empty.predicted_sales_amount, empty.forecast_start) == (0, 0, 0, None)


def test_publication_replaces_all_marts_at_once(spark, marts, tmp_path):
    folder = str(tmp_path / "marts")
    counts = store.publish_marts(marts, folder)
    assert counts == {name: len(data) for name, data in DATA.items()}
    first = store.current_version(spark, folder)
    back = store.read_marts(spark, folder)
    assert rows(back["association_rule"]) == rows(marts["association_rule"])
    assert back["top_product"].schema == MARTS["top_product"].schema
    double = {"top_product": marts["top_product"].union(marts["top_product"])}
    with pytest.raises(ValueError, match="top_product"):
        store.publish_marts(double, folder)
    assert store.current_version(spark, folder) == first
    fewer = {"top_product": marts["top_product"].limit(1)}
    assert store.publish_marts(fewer, folder) == {"top_product": 1}
    assert set(store.read_marts(spark, folder)) == {"top_product"}
    with pytest.raises(ValueError):
        store.publish_marts({"other": marts["top_product"]}, folder)


def test_of_two_publishers_from_one_version_the_second_fails(spark, marts, tmp_path):
    folder = str(tmp_path / "marts")
    top = {"top_product": marts["top_product"]}
    store.publish_marts(top, folder)
    start = store.current_version(spark, folder)
    kept = store.read_marts(spark, folder)["top_product"]
    store.publish_marts({"top_product": marts["top_product"].limit(1)}, folder, after=start)
    newest, folders = store.current_version(spark, folder), set((tmp_path / "marts" / "versions").iterdir())
    for stale in (start, None):
        with pytest.raises(store.PublicationConflict, match="has a successor"):
            store.publish_marts(top, folder, after=stale)
    assert store.current_version(spark, folder) == newest != start
    assert set((tmp_path / "marts" / "versions").iterdir()) == folders
    assert rows(kept) == rows(store.read_marts(spark, folder, start)["top_product"]) == rows(marts["top_product"])


def test_old_versions_are_removed_and_kept_ones_stay_readable(spark, marts, tmp_path):
    folder, names = str(tmp_path / "marts"), []
    for _ in range(4):
        store.publish_marts({"top_product": marts["top_product"]}, folder, keep=2)
        names.append(store.current_version(spark, folder))
    assert sorted(p.name for p in (tmp_path / "marts" / "versions").iterdir()) == sorted(names[2:])
    published = store.versions(spark, folder)
    assert [m["version"] for m in published] == names[::-1]
    assert [m["parent"] for m in published] == [*names[-2::-1], None]
    assert store.read_marts(spark, folder, names[2])["top_product"].count() == 2
    with pytest.raises(ValueError, match="no published version"):
        store.read_marts(spark, folder, "unheard-of")
    with pytest.raises(ValueError, match="keep"):
        store.publish_marts({"top_product": marts["top_product"]}, folder, keep=0)


def test_contract_counts_duplicates_nulls_and_misfits(marts):
    contract = MARTS["top_product"]
    bad = marts["top_product"].withColumn("sales_amount", F.lit("much")).withColumn("product_name", F.lit(None).cast("string"))
    assert tuple(store.check_contract(bad, contract).first()) == (2, 1, 2, 2)
    assert tuple(store.check_contract(marts["top_product"], contract).first()) == (2, 0, 0, 0)
