"""Key figures over basket items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.quality import month_of
from tillroll.operators.warehouse import merchandise

_CENTS = "decimal(20,2)"


def _cents(amount: Column) -> Column:
    return F.round(amount, 2).cast(_CENTS)


def kpi_overview(items: DataFrame) -> DataFrame:
    """One row; the average basket is the mean of the sums per invoice."""
    total, orders = F.sum("item_amount"), F.count_distinct("invoice_no")
    return items.agg(
        F.count_distinct("customer_id").alias("customer_count"),
        orders.alias("order_count"),
        F.count_distinct("stock_code").alias("product_count"),
        F.sum("item_quantity").alias("item_quantity"),
        _cents(total).alias("sales_amount"),
        _cents(total / F.when(orders > 0, orders).cast("decimal(20,0)")).alias("average_basket_amount"),
        F.min("invoice_ts").alias("min_invoice_ts"),
        F.max("invoice_ts").alias("max_invoice_ts"),
    )


def kpi_monthly(items: DataFrame) -> DataFrame:
    total, orders = F.sum("item_amount"), F.count_distinct("invoice_no")
    return (
        items.groupBy(month_of(F.col("invoice_ts")).alias("invoice_month"))
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            orders.alias("order_count"),
            F.count_distinct("stock_code").alias("product_count"),
            F.sum("item_quantity").alias("item_quantity"),
            _cents(total).alias("sales_amount"),
            _cents(total / F.when(orders > 0, orders).cast("decimal(20,0)")).alias("average_basket_amount"),
        )
        .orderBy("invoice_month")
    )


def top_products(items: DataFrame, limit: int = 100, min_orders: int = 20) -> DataFrame:
    """Best-selling (code, name) pairs among those with enough orders; rows without a name are left out."""
    named = merchandise(items).filter(F.col("product_name").isNotNull())
    return (
        named.groupBy("stock_code", "product_name")
        .agg(
            F.count_distinct("invoice_no").alias("order_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            F.sum("item_quantity").alias("item_quantity"),
            F.sum("item_amount").alias("sales_amount"),
        )
        .filter(F.col("order_count") >= min_orders)
        .orderBy(F.desc("sales_amount"), F.desc("order_count"), "stock_code", "product_name")
        .limit(limit)
        .withColumn("sales_amount", _cents(F.col("sales_amount")))
    )
