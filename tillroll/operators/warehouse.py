"""Cleaned fact table, dimensions, customer and basket aggregates, business summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import whole
from tillroll.functions import quality as q
from tillroll.schemas import FACT


def clean(raw: DataFrame) -> DataFrame:
    """Typed, classified order items from landing texts; a pure projection, so it needs no shuffle."""
    invoice, stock, ts = F.col("invoice_no"), F.col("stock_code"), F.col("invoice_ts")
    customer, quantity, price = F.col("customer_id"), F.col("quantity"), F.col("unit_price")
    checks = (invoice, stock, ts, customer, quantity, price)
    return raw.select(
        q.filled(invoice).alias("invoice_no"),
        q.filled(stock).alias("stock_code"),
        F.trim("description").alias("description"),
        q.whole_number(quantity).alias("quantity"),
        q.wall_clock(ts).alias("invoice_ts"),
        q.price(price).alias("unit_price"),
        q.line_amount(quantity, price).alias("line_amount"),
        q.filled(customer).alias("customer_id"),
        F.trim("country").alias("country"),
        "source_year",
        "ingest_batch_id",
        q.is_cancelled(invoice).cast("tinyint").alias("is_cancelled"),
        q.quality_status(*checks).alias("quality_status"),
        q.is_valid(*checks).alias("is_valid_analysis"),
        q.invoice_month(ts).alias("invoice_month"),
    ).select(*FACT.names)


def valid_rows(fact: DataFrame) -> DataFrame:
    return fact.filter("is_valid_analysis = 1")


def non_blank(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key) != "")


def merchandise(df: DataFrame) -> DataFrame:
    return df.filter(q.is_merchandise(F.col("stock_code")))


def positive_rows(items: DataFrame) -> DataFrame:
    """Items with all keys and with quantity and amount above zero.

    Unreadable numbers and quantities that are not whole count as absent: pieces are counted, not measured.
    """
    typed = items.withColumns(
        {
            "invoice_ts": F.col("invoice_ts").try_cast("timestamp_ntz"),
            "item_quantity": whole(F.col("item_quantity")),
            "item_amount": F.col("item_amount").try_cast("decimal(20,4)"),
        }
    )
    keys = ["invoice_no", "customer_id", "invoice_ts", "stock_code", "item_quantity", "item_amount"]
    return typed.dropna(subset=keys).filter("item_quantity > 0 AND item_amount > 0")


def _money(total: Column, scale: int = 2) -> Column:
    return total.cast(f"decimal(20,{scale})")


# --- dimensions -----------------------------------------------------------------------------------


def dim_product(fact: DataFrame) -> DataFrame:
    """Products of all lines with a code, valid or not."""
    return (
        non_blank(fact, "stock_code")
        .groupBy("stock_code")
        .agg(
            F.max("description").alias("product_name"),
            F.min("unit_price").alias("min_unit_price"),
            F.max("unit_price").alias("max_unit_price"),
            F.count("*").alias("source_row_count"),
        )
    )


def dim_customer(fact: DataFrame) -> DataFrame:
    """Customers of all lines with a customer, valid or not."""
    return (
        non_blank(fact, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.max("country").alias("country"),
            F.min("invoice_ts").alias("first_seen_ts"),
            F.max("invoice_ts").alias("last_seen_ts"),
        )
    )


def dim_country(fact: DataFrame) -> DataFrame:
    return (
        valid_rows(fact)
        .groupBy("country")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.count_distinct("invoice_no").alias("invoice_count"),
        )
    )


# --- basket and customer aggregates ---------------------------------------------------------------


def basket_summary(fact: DataFrame) -> DataFrame:
    return (
        valid_rows(fact)
        .groupBy("invoice_no", "customer_id")
        .agg(
            F.min("invoice_ts").alias("invoice_ts"),
            F.max("country").alias("country"),
            F.count_distinct("stock_code").alias("product_count"),
            F.sum("quantity").alias("item_quantity"),
            _money(F.sum("line_amount")).alias("basket_amount"),
        )
    )


def basket_item(fact: DataFrame) -> DataFrame:
    return (
        valid_rows(fact)
        .groupBy("invoice_no", "customer_id", "stock_code")
        .agg(
            F.min("invoice_ts").alias("invoice_ts"),
            F.max("description").alias("product_name"),
            F.sum("quantity").alias("item_quantity"),
            _money(F.sum("line_amount"), 4).alias("item_amount"),
        )
        .select(
            "invoice_no", "customer_id", "invoice_ts", "stock_code", "product_name", "item_quantity", "item_amount"
        )
    )


def customer_monthly(fact: DataFrame) -> DataFrame:
    return (
        valid_rows(fact)
        .groupBy(q.month_of(F.col("invoice_ts")).alias("invoice_month"), "customer_id")
        .agg(
            F.count_distinct("invoice_no").alias("order_count"),
            F.count_distinct("stock_code").alias("product_count"),
            F.sum("quantity").alias("item_quantity"),
            _money(F.sum("line_amount")).alias("sales_amount"),
            F.max("invoice_ts").alias("latest_purchase_ts"),
        )
    )


def customer_summary(fact: DataFrame) -> DataFrame:
    return (
        valid_rows(fact)
        .groupBy("customer_id")
        .agg(
            F.min("invoice_ts").alias("first_purchase_ts"),
            F.max("invoice_ts").alias("latest_purchase_ts"),
            F.count_distinct("invoice_no").alias("frequency"),
            _money(F.sum("line_amount")).alias("monetary"),
            F.count_distinct("stock_code").alias("distinct_product_count"),
        )
    )


# --- business summaries ---------------------------------------------------------------------------


def _average_basket(total: Column, baskets: Column) -> Column:
    """Mean basket in cents, half up, from exact decimals."""
    return F.when(baskets > 0, F.round(total / baskets.cast("decimal(20,0)"), 2)).cast("decimal(20,2)")


def ads_overview(fact: DataFrame) -> DataFrame:
    """One row over all valid lines.

    Lines are first merged per (invoice, customer, product), so the three distinct counts expand
    basket items and not raw lines.
    """
    merged = (
        valid_rows(fact)
        .groupBy("invoice_no", "customer_id", "stock_code")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("line_amount").alias("amount"),
            F.min("invoice_ts").alias("first_ts"),
            F.max("invoice_ts").alias("last_ts"),
        )
    )
    total, orders = F.sum("amount"), F.count_distinct("invoice_no")
    return merged.agg(
        F.count_distinct("customer_id").alias("customer_count"),
        orders.alias("order_count"),
        F.count_distinct("stock_code").alias("product_count"),
        F.sum("quantity").alias("item_quantity"),
        _money(total).alias("sales_amount"),
        _average_basket(total, orders).alias("average_basket_amount"),
        F.min("first_ts").alias("min_invoice_ts"),
        F.max("last_ts").alias("max_invoice_ts"),
    )


def ads_monthly(fact: DataFrame) -> DataFrame:
    total, orders = F.sum("line_amount"), F.count_distinct("invoice_no")
    return (
        valid_rows(fact)
        .groupBy(q.month_of(F.col("invoice_ts")).alias("invoice_month"))
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            orders.alias("order_count"),
            _money(total).alias("sales_amount"),
            _average_basket(total, orders).alias("average_basket_amount"),
        )
    )


def ads_quality(fact: DataFrame) -> DataFrame:
    """Rows, invoices and amount per quality status, over all lines."""
    return fact.groupBy("quality_status").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("invoice_no").alias("invoice_count"),
        _money(F.sum("line_amount")).alias("line_amount"),
    )
