"""Monthly parts of the warehouse tables, and the tables that whole periods of them give.

Every part of a month comes from the fact rows of that month alone. Months merge exactly: sums and extremes as they are,
distinct counts from bitmaps of numbered keys, baskets by their keys, as an invoice can lie in two months.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.quality import month_of
from tillroll.operators import warehouse as wh
from tillroll.operators.bitmaps import key_sets, merged_counts

MONTH = "stored_month"
_KEYS = {"customer": "customer_id", "invoice": "invoice_no", "product": "stock_code"}
KINDS = tuple(_KEYS)
_BASKET = ["invoice_no", "customer_id", "stock_code"]
_AMOUNT = "decimal(30,4)"


def with_month(fact: DataFrame) -> DataFrame:
    """Lines with the month whose parts they belong to, '' where the time cannot be read."""
    return fact.withColumn(MONTH, F.coalesce(month_of(F.col("invoice_ts")), F.lit("")))


# --- parts of a month, from fact rows with their month ---------------------------------------------


def basket_lines(fact: DataFrame) -> DataFrame:
    """Valid lines merged per (month, invoice, customer, product)."""
    return (
        wh.valid_rows(fact)
        .groupBy(MONTH, *_BASKET)
        .agg(
            F.min("invoice_ts").alias("first_ts"),
            F.max("invoice_ts").alias("last_ts"),
            F.max("description").alias("product_name"),
            F.max("country").alias("country"),
            F.sum("quantity").alias("quantity"),
            F.sum("line_amount").cast(_AMOUNT).alias("amount"),
        )
    )


def _of_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce("invoice_month", F.lit("")))


def customer_months(fact: DataFrame) -> DataFrame:
    """Final rows: a customer's month lies in one part."""
    return _of_month(wh.customer_monthly(fact))


def month_sales(fact: DataFrame) -> DataFrame:
    """Final rows, one for each month."""
    return _of_month(wh.ads_monthly(fact))


def products(fact: DataFrame) -> DataFrame:
    return (
        wh.non_blank(fact, "stock_code")
        .groupBy(MONTH, "stock_code")
        .agg(
            F.max("description").alias("product_name"),
            F.min("unit_price").alias("min_unit_price"),
            F.max("unit_price").alias("max_unit_price"),
            F.count("*").alias("source_row_count"),
        )
    )


def customers(fact: DataFrame) -> DataFrame:
    return (
        wh.non_blank(fact, "customer_id")
        .groupBy(MONTH, "customer_id")
        .agg(
            F.max("country").alias("country"),
            F.min("invoice_ts").alias("first_seen_ts"),
            F.max("invoice_ts").alias("last_seen_ts"),
        )
    )


_GROUP = [MONTH, "country", "quality_status", "is_valid_analysis"]
# Keys of one country and first month are numbered next to each other.
NEAR = ("country", MONTH)


def totals(fact: DataFrame) -> DataFrame:
    """Rows, pieces, amount and time span per month, country, status and flag."""
    return fact.groupBy(*_GROUP).agg(
        F.count("*").alias("row_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_amount").cast(_AMOUNT).alias("amount"),
        F.min("invoice_ts").alias("first_ts"),
        F.max("invoice_ts").alias("last_ts"),
    )


def keys_of(fact: DataFrame, kind: str) -> DataFrame:
    """Distinct keys of one kind; merged before they meet the dictionary, so that a key of many lines weighs as one."""
    return fact.select(*_GROUP, F.col(_KEYS[kind]).alias("key")).distinct()


def key_bitmaps(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Customers, invoices and products per month, country, status and flag; `numbers` are (kind, key, key_id)."""
    asked = [keys_of(fact, kind).select(F.lit(kind).alias("kind"), "*") for kind in KINDS]
    rows = reduce(DataFrame.unionByName, asked).join(numbers, ["kind", "key"])
    return key_sets(rows, [*_GROUP, "kind"])


PARTS = {
    "basket_lines": basket_lines,
    "customer_months": customer_months,
    "month_sales": month_sales,
    "products": products,
    "customers": customers,
    "totals": totals,
}


# --- tables from the parts of any months -----------------------------------------------------------


def _basket_items(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_BASKET).agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max("product_name").alias("product_name"),
        F.max("country").alias("country"),
        F.sum("quantity").alias("item_quantity"),
        F.sum("amount").alias("amount"),
    )


def basket_item(lines: DataFrame) -> DataFrame:
    """As `warehouse.basket_item`."""
    return _basket_items(lines).select(
        "invoice_no",
        "customer_id",
        F.col("first_ts").alias("invoice_ts"),
        "stock_code",
        "product_name",
        "item_quantity",
        F.col("amount").cast("decimal(20,4)").alias("item_amount"),
    )


def basket_summary(lines: DataFrame) -> DataFrame:
    """As `warehouse.basket_summary`: a product of a basket is one row once months are merged."""
    return (
        _basket_items(lines)
        .groupBy("invoice_no", "customer_id")
        .agg(
            F.min("first_ts").alias("invoice_ts"),
            F.max("country").alias("country"),
            F.count("*").alias("product_count"),
            F.sum("item_quantity").alias("item_quantity"),
            F.sum("amount").cast("decimal(20,2)").alias("basket_amount"),
        )
    )


def customer_summary(lines: DataFrame) -> DataFrame:
    """As `warehouse.customer_summary`."""
    return lines.groupBy("customer_id").agg(
        F.min("first_ts").alias("first_purchase_ts"),
        F.max("last_ts").alias("latest_purchase_ts"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum("amount").cast("decimal(20,2)").alias("monetary"),
        F.count_distinct("stock_code").alias("distinct_product_count"),
    )


def dim_product(parts: DataFrame) -> DataFrame:
    """As `warehouse.dim_product`."""
    return parts.groupBy("stock_code").agg(
        F.max("product_name").alias("product_name"),
        F.min("min_unit_price").alias("min_unit_price"),
        F.max("max_unit_price").alias("max_unit_price"),
        F.sum("source_row_count").alias("source_row_count"),
    )


def dim_customer(parts: DataFrame) -> DataFrame:
    """As `warehouse.dim_customer`."""
    return parts.groupBy("customer_id").agg(
        F.max("country").alias("country"),
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
    )


def _stacked(sums: DataFrame, sets: DataFrame, by: list[str]) -> DataFrame:
    """Sums and numbers of distinct keys of the groups below each other, for one aggregation over `by`."""
    counted = merged_counts(sets, [*by, "kind"]).drop("bucket")
    return sums.unionByName(counted, allowMissingColumns=True)


def _distinct(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint")


def _overview(rows: DataFrame, *by: str) -> DataFrame:
    amount, orders = F.sum("amount"), _distinct("invoice")
    mean = F.when(orders > 0, F.round(amount / orders.cast("decimal(20,0)"), 2)).cast("decimal(20,2)")
    return rows.groupBy(*by).agg(
        _distinct("customer").alias("customer_count"),
        orders.alias("order_count"),
        _distinct("product").alias("product_count"),
        F.sum("quantity").alias("item_quantity"),
        amount.cast("decimal(20,2)").alias("sales_amount"),
        mean.alias("average_basket_amount"),
        F.min("first_ts").alias("min_invoice_ts"),
        F.max("last_ts").alias("max_invoice_ts"),
    )


def overview(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """As `warehouse.ads_overview`, from `totals` and `key_bitmaps` of all months: work grows with the groups, not the lines."""
    return _overview(_stacked(wh.valid_rows(sums), wh.valid_rows(sets), []))


def period_overview(sums: DataFrame, sets: DataFrame, period: Column) -> DataFrame:
    """The key figures of any periods made of months, `period` being an expression of the stored month."""
    valid = [wh.valid_rows(df).withColumn("period", period) for df in (sums, sets)]
    return _overview(_stacked(*valid, ["period"]), "period")


def dim_country(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """As `warehouse.dim_country`."""
    rows = _stacked(wh.valid_rows(sums), wh.valid_rows(sets).filter("kind <> 'product'"), ["country"])
    return rows.groupBy("country").agg(_distinct("customer").alias("customer_count"), _distinct("invoice").alias("invoice_count"))


def quality_summary(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """As `warehouse.ads_quality`."""
    rows = _stacked(sums, sets.filter("kind = 'invoice'"), ["quality_status"])
    return rows.groupBy("quality_status").agg(
        F.sum("row_count").alias("row_count"),
        _distinct("invoice").alias("invoice_count"),
        F.sum("amount").cast("decimal(20,2)").alias("line_amount"),
    )
