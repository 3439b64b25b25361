"""Row-count and amount checks between warehouse layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.warehouse import valid_rows


def check_rows(raw: DataFrame, fact: DataFrame) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("actual_value")).select(F.lit(name).alias("check_name"), "actual_value")
        for name, df in (("ods_row_count", raw), ("dwd_row_count", fact))
    ]
    return reduce(DataFrame.unionByName, counts)


def check_status(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("quality_status").agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "quality_status")


def check_valid(fact: DataFrame) -> DataFrame:
    return valid_rows(fact).agg(
        F.count("*").alias("row_count"),
        F.count_distinct("invoice_no").alias("invoice_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.count_distinct("stock_code").alias("product_count"),
        F.sum("line_amount").cast("decimal(20,2)").alias("sales_amount"),
    ).select(F.lit("valid_analysis").alias("check_name"), "*")


def check_baskets(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("basket_count"),
        F.sum("basket_amount").cast("decimal(20,2)").alias("basket_sales_amount"),
    ).select(F.lit("basket_reconciliation").alias("check_name"), "*")


def check_overview(overview: DataFrame) -> DataFrame:
    return overview.select(F.lit("ads_reconciliation").alias("check_name"), "order_count", "sales_amount")


def recon_report(raw: DataFrame, fact: DataFrame, summary: DataFrame, overview: DataFrame) -> DataFrame:
    """One row per comparison: name, both values, tolerance, 1 when they agree.

    Basket amounts are rounded to cents per basket, so their sum may differ from the line sum by up to
    half a cent per basket. Baskets are (invoice, customer) pairs, so there may be more than invoices.
    """
    c = F.col

    def figures(df: DataFrame, **values: Column) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("figure"), v.cast("decimal(24,4)").alias("value")) for k, v in values.items()]
        return df.select(F.inline(F.array(*pairs)))

    per_status = check_status(fact).groupBy().agg(
        F.sum("row_count").alias("rows"),
        F.sum(F.when(c("quality_status") == "VALID", c("row_count"))).alias("valid"),
    )
    parts = [
        check_rows(raw, fact).select(c("check_name").alias("figure"), c("actual_value").cast("decimal(24,4)").alias("value")),
        figures(per_status, status_rows=c("rows"), valid_status_rows=c("valid")),
        figures(
            check_valid(fact),
            valid_rows=c("row_count"),
            valid_invoices=c("invoice_count"),
            valid_amount=c("sales_amount"),
        ),
        figures(check_baskets(summary), basket_count=c("basket_count"), basket_amount=c("basket_sales_amount")),
        figures(check_overview(overview), ads_orders=c("order_count"), ads_amount=c("sales_amount")),
    ]
    names = ["ods_row_count", "dwd_row_count", "status_rows", "valid_status_rows", "valid_rows", "valid_invoices"]
    names += ["valid_amount", "basket_count", "basket_amount", "ads_orders", "ads_amount"]
    numbers = reduce(DataFrame.unionByName, parts).agg(
        *[F.max(F.when(c("figure") == name, c("value"))).alias(name) for name in names]
    )

    def row(name: str, left: Column, right: Column, tolerance: Column) -> Column:
        wide = "decimal(24,4)"
        return F.struct(
            F.lit(name).alias("check_name"),
            left.cast(wide).alias("left_value"),
            right.cast(wide).alias("right_value"),
            tolerance.cast(wide).alias("tolerance"),
        )

    zero = F.lit(0)
    cents = c("basket_count") * F.lit(0.005).cast("decimal(10,4)")
    rows = [
        row("raw_rows_equal_fact_rows", c("ods_row_count"), c("dwd_row_count"), zero),
        row("status_rows_equal_fact_rows", c("status_rows"), c("dwd_row_count"), zero),
        row("valid_rows_equal_valid_status", c("valid_rows"), c("valid_status_rows"), zero),
        row("ads_orders_equal_valid_invoices", c("ads_orders"), c("valid_invoices"), zero),
        row("ads_amount_equals_valid_amount", c("ads_amount"), c("valid_amount"), zero),
        row("basket_amount_near_valid_amount", c("basket_amount"), c("valid_amount"), cents),
    ]
    report = numbers.select(F.inline(F.array(*rows)))
    agrees = F.abs(c("left_value") - c("right_value")) <= c("tolerance")
    return report.withColumn("passed", F.when(agrees, 1).otherwise(0))
