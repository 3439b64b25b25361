"""Profiles of landing rows before cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import quality as q

TOTAL = "ALL"


def _number(name: str) -> Column:
    return F.col(name).try_cast("decimal(38,10)")


def ingest_audit(raw: DataFrame) -> DataFrame:
    """Counters per source and, under 'ALL', for the whole run; one aggregation with small partials."""
    level = F.grouping("source_year")
    return (
        raw.rollup("source_year")
        .agg(
            level.alias("is_total"),
            F.count("*").alias("row_count"),
            F.count_if(q.filled(F.col("customer_id")) == "").alias("missing_customer_rows"),
            F.count_if(q.is_cancelled(F.col("invoice_no"))).alias("cancelled_rows"),
            F.count_if(F.coalesce(_number("quantity") <= 0, F.lit(False))).alias("non_positive_quantity_rows"),
            F.count_if(F.coalesce(_number("unit_price") <= 0, F.lit(False))).alias("non_positive_price_rows"),
        )
        .withColumn("source_year", F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col("source_year")))
        .drop("is_total")
    )


def with_rejects(audited: DataFrame, rejected: DataFrame) -> DataFrame:
    """The audit with `rejected_rows`: lines of the source that were not landed. A source of rejects alone has a row too."""
    level = F.grouping("source_year")
    counted = rejected.rollup("source_year").agg(level.alias("_total"), F.count("*").alias("rejected_rows"))
    counted = counted.select(F.when(F.col("_total") == 1, TOTAL).otherwise(F.col("source_year")).alias("source_year"), "rejected_rows")
    both = audited.join(counted, "source_year", "full_outer")
    return both.select("source_year", *[F.coalesce(name, F.lit(0)).alias(name) for name in both.columns if name != "source_year"])


def source_profile(raw: DataFrame) -> DataFrame:
    """One row per source and one for all: sizes, distinct keys, dates, valid sales, mean valid basket."""

    def present(name: str) -> Column:
        text = q.filled(F.col(name))
        return F.when(text != "", text)

    ts = q.wall_clock(F.col("invoice_ts"))
    quantity, price = _number("quantity"), _number("unit_price")
    texts = raw.select(
        "source_year",
        present("invoice_no").alias("invoice_no"),
        present("customer_id").alias("customer_id"),
        present("stock_code").alias("stock_code"),
        q.is_cancelled(F.col("invoice_no")).alias("cancelled"),
        ts.alias("ts"),
        quantity.alias("quantity"),
        price.alias("price"),
        q.line_amount(F.col("quantity"), F.col("unit_price")).alias("amount"),
    )
    ok = (
        F.col("invoice_no").isNotNull()
        & ~F.col("cancelled")
        & F.col("customer_id").isNotNull()
        & F.col("stock_code").isNotNull()
        & F.col("ts").isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
    )
    flagged = texts.withColumn("ok", F.coalesce(ok, F.lit(False)))
    # Merge to distinct keys first: distinct counts then expand far fewer rows than the lines.
    merged = flagged.groupBy("source_year", "invoice_no", "customer_id", "stock_code", "ok").agg(
        F.count("*").alias("rows"),
        F.count_if("cancelled").alias("cancelled"),
        F.count_if(F.col("quantity") <= 0).alias("quantity_rows"),
        F.count_if(F.col("price") <= 0).alias("price_rows"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("amount").alias("amount"),
    )

    def when_ok(name: str) -> Column:
        return F.when(F.col("ok"), F.col(name))

    invoices, sales = F.count_distinct(when_ok("invoice_no")), F.sum(when_ok("amount"))
    measures = [
        F.sum("rows").alias("row_count"),
        F.count_distinct("invoice_no").alias("distinct_invoices"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("stock_code").alias("distinct_products"),
        F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("rows"))), F.lit(0)).alias("missing_customer_rows"),
        F.sum("cancelled").alias("cancelled_rows"),
        F.sum("quantity_rows").alias("non_positive_quantity_rows"),
        F.sum("price_rows").alias("non_positive_price_rows"),
        F.min("first_ts").alias("min_invoice_ts"),
        F.max("last_ts").alias("max_invoice_ts"),
        F.coalesce(F.sum(when_ok("rows")), F.lit(0)).alias("valid_rows"),
        invoices.alias("valid_invoices"),
        F.count_distinct(when_ok("customer_id")).alias("valid_customers"),
        F.count_distinct(when_ok("stock_code")).alias("valid_products"),
        F.coalesce(F.round(sales, 2), F.lit(0)).cast("decimal(20,2)").alias("valid_sales_amount"),
        F.when(invoices > 0, F.round(sales / invoices.cast("decimal(20,0)"), 2))
        .otherwise(0)
        .cast("decimal(20,2)")
        .alias("average_valid_basket_amount"),
    ]
    per_source = merged.groupBy("source_year").agg(*measures)
    overall = merged.agg(*measures).select(F.lit(TOTAL).alias("source_year"), "*")
    return per_source.unionByName(overall)


def top_countries(raw: DataFrame, limit: int = 10) -> DataFrame:
    """Countries with the most landing rows; equal counts in name order."""
    country = q.filled(F.col("country"))
    counts = raw.filter(country != "").groupBy(country.alias("country")).agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "country").limit(limit)
