from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators import audit, checks, kpi, warehouse
from tillroll.plans.jobs import build_warehouse, export_warehouse
from tillroll.schemas import FACT, RAW
from tillroll.sources.items import read_basket_items
from tillroll.sources.sample_tables import raw_lines


def line(invoice="1", stock="A", quantity="2", ts="2010-01-05 10:00:00", price="2.5", customer="C1", country="UK", name="n"):
    return ("2010", invoice, stock, name, quantity, ts, price, customer, country, "B")


@pytest.fixture(scope="module")
def classify(spark):
    def run(**fields):
        return warehouse.clean(spark.createDataFrame([line(**fields)], RAW)).first()

    return run


@pytest.mark.parametrize(
    ("fields", "status", "valid"),
    [
        ({}, "VALID", 1),
        ({"invoice": "  "}, "MISSING_KEY", 0),
        ({"stock": None}, "MISSING_KEY", 0),
        ({"ts": ""}, "MISSING_KEY", 0),
        ({"customer": " "}, "MISSING_CUSTOMER", 0),
        ({"customer": "", "invoice": "C1"}, "MISSING_CUSTOMER", 0),
        ({"invoice": " c12"}, "CANCELLED", 0),
        ({"invoice": "C12", "quantity": "-1"}, "CANCELLED", 0),
        ({"quantity": "0"}, "NON_POSITIVE_QUANTITY", 0),
        ({"quantity": "-3", "price": "0"}, "NON_POSITIVE_QUANTITY", 0),
        ({"price": "0"}, "NON_POSITIVE_PRICE", 0),
        # Text that is no number matches no rule, so the status stays plain while the flag is 0.
        ({"quantity": "abc"}, "VALID", 0),
        ({"price": ""}, "VALID", 0),
        # A time that cannot be read is still a key.
        ({"ts": "yesterday"}, "VALID", 1),
    ],
)
def test_status_and_flag(classify, fields, status, valid):
    row = classify(**fields)
    assert (row.quality_status, row.is_valid_analysis) == (status, valid)


def test_conditions_of_valid_lines_are_checked_where_columns_are_read(spark):
    """Each condition on its own table, below the join, and no line without a number counts as valid."""
    left = spark.createDataFrame([("1", "1", "2"), ("C2", "1", "2"), ("3", "1", None), ("4", "1", "abc")], "invoice_no string, k string, quantity string")
    right = spark.createDataFrame([("1", "2.5", "A"), ("1", None, "B"), ("1", "1", None)], "k string, unit_price string, stock_code string")
    rest = {"source_year": "2010", "description": "n", "invoice_ts": "2010-01-05 10:00:00", "customer_id": "c", "country": "UK", "ingest_batch_id": "B"}
    raw = left.join(right, "k").select("*", *[F.lit(text).alias(name) for name, text in rest.items()]).select(*RAW.names)
    kept = warehouse.valid_rows(warehouse.clean(raw)).select("invoice_no", "stock_code", "quantity", "unit_price")
    assert [tuple(r) for r in kept.collect()] == [("1", "A", 2, Decimal("2.5000"))]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "<=> true" not in plan and plan.count("Filter") == 2 and plan.index("Join") < plan.index("Filter")


def test_typed_columns(classify, spark):
    row = classify(invoice=" 7 ", quantity="12.0", price="1.23456", ts=" 2010-01-05 10:00:00 ")
    assert (row.invoice_no, row.quantity, row.unit_price) == ("7", 12, Decimal("1.2346"))
    assert row.line_amount == Decimal("14.8152") and row.invoice_month == "2010-01"
    assert classify(ts="yesterday").invoice_ts is None
    df = warehouse.clean(spark.createDataFrame([line()], RAW))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in FACT.fields]


def test_dimensions_use_all_lines_and_country_only_valid_ones(spark):
    data = [line(), line(invoice="C2", price="9", country="FR"), line(customer="", country="DE"), line(stock="")]
    fact = warehouse.clean(spark.createDataFrame(data, RAW))
    product = warehouse.dim_product(fact).first()
    assert (product.stock_code, product.max_unit_price, product.source_row_count) == ("A", Decimal("9.0000"), 3)
    assert warehouse.dim_customer(fact).first().country == "UK"
    assert [tuple(r) for r in warehouse.dim_country(fact).collect()] == [("UK", 1, 1)]


def test_one_invoice_of_two_customers_gives_two_baskets(spark):
    fact = warehouse.clean(spark.createDataFrame([line(), line(customer="C2"), line(quantity="3")], RAW))
    summary = {r.customer_id: r for r in warehouse.basket_summary(fact).collect()}
    assert summary["C1"].basket_amount == Decimal("12.50") and summary["C1"].product_count == 1
    assert summary["C2"].item_quantity == 2
    assert warehouse.basket_item(fact).count() == 2
    assert warehouse.ads_overview(fact).first().order_count == 1


def test_service_codes_are_no_merchandise(spark, make_items):
    items = make_items([("1", "C1", None, code, "n", 1, 1) for code in ("POST", "post", "Bank Charges", "D", "DX", "M1")])
    assert sorted(r.stock_code for r in warehouse.merchandise(items).collect()) == ["DX", "M1"]


def test_top_products_limits_ties_and_missing_names(make_items):
    data = [(str(n), f"C{n}", None, code, None if code == "Z" else code, 1, 10) for n in range(25) for code in "BAZ"]
    data += [("x", "C", None, "RARE", "rare", 1, 999)]
    top = kpi.top_products(make_items(data), limit=5)
    assert [(r.stock_code, r.order_count, r.sales_amount) for r in top.collect()] == [
        ("A", 25, Decimal("250.00")),
        ("B", 25, Decimal("250.00")),
    ]


def test_top_countries_in_name_order_on_ties(spark):
    raw = spark.createDataFrame([line(country=c) for c in ("B", "A", "C", "C", "", " ")], RAW)
    assert [tuple(r) for r in audit.top_countries(raw, 2).collect()] == [("C", 2), ("A", 1)]


def test_reconciliation_flags_a_lost_basket(spark, sf_dir):
    raw = raw_lines(spark, sf_dir, faults=True)
    fact = warehouse.clean(raw)
    summary, overview = warehouse.basket_summary(fact), warehouse.ads_overview(fact)
    assert {r.passed for r in checks.recon_report(raw, fact, summary, overview).collect()} == {1}
    lost = summary.filter("invoice_no > '2'")
    failed = {r.check_name for r in checks.recon_report(raw, fact, lost, overview).collect() if not r.passed}
    assert failed == {"basket_amount_near_valid_amount"}


def test_warehouse_job_and_exports(spark, sf_dir, tmp_path):
    raw = raw_lines(spark, sf_dir, faults=True)
    frames = build_warehouse(raw, str(tmp_path / "warehouse"))
    assert {r.passed for r in frames["checks"].collect()} == {1}
    assert frames["dwd_order_item"].count() == raw.count()
    export_warehouse(frames, str(tmp_path / "exports"))
    items = frames["dws_basket_item"]
    back = read_basket_items(spark, str(tmp_path / "exports" / "basket_items")).select(*items.columns)
    assert rows(back) == rows(items)
    months = spark.read.csv(str(tmp_path / "exports" / "monthly_sales"), sep="\t").collect()
    assert len(months) == frames["ads_monthly_sales"].count()
