"""Read queries over the marts. `marts` maps mart names to frames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Marts = Mapping[str, DataFrame]


def _in_range(name: str, value: int, most: int) -> None:
    if not 1 <= value <= most:
        raise ValueError(f"{name} must be between 1 and {most}")


def overview(marts: Marts) -> DataFrame:
    return marts["business_overview"].limit(1)


def monthly(marts: Marts) -> DataFrame:
    return marts["monthly_sale"].orderBy("invoice_month")


def latest_snapshot(marts: Marts) -> DataFrame:
    return marts["rfm_segment_summary"].agg(F.max("snapshot_date").alias("snapshot_date"))


def _day(marts: Marts, day: date | str | None) -> Column:
    return latest_snapshot(marts).scalar() if day is None else F.lit(str(day)).cast("date")


def segments(marts: Marts, day: date | str | None = None) -> DataFrame:
    """Segments at a snapshot, the latest by default, by money."""
    rows = marts["rfm_segment_summary"].filter(F.col("snapshot_date") == _day(marts, day))
    return rows.orderBy(F.desc("total_monetary"), "segment_code")


def _matching_customers(marts: Marts, day: date | str | None, segment: str | None) -> DataFrame:
    rows = marts["rfm_customer_snapshot"].filter(F.col("snapshot_date") == _day(marts, day))
    return rows.filter(F.col("segment_code") == segment) if segment else rows


def customers_total(marts: Marts, day: date | str | None = None, segment: str | None = None, size: int = 20) -> DataFrame:
    """One row, also where no customer matches: snapshot date, matching customers, pages."""
    _in_range("size", size, 100)
    total = F.count("*")
    counted = _matching_customers(marts, day, segment).agg(
        total.alias("total_count"), F.ceil(total / size).cast("bigint").alias("total_pages")
    )
    return counted.select(_day(marts, day).alias("snapshot_date"), "total_count", "total_pages")


def customers_after(
    marts: Marts,
    after: tuple | None = None,
    day: date | str | None = None,
    segment: str | None = None,
    size: int = 20,
) -> DataFrame:
    """The next customers by money behind `after`, the (monetary, customer_id) of the last one seen.

    However deep the page, each task keeps only `size` rows.
    """
    _in_range("size", size, 100)
    rows = _matching_customers(marts, day, segment)
    if after:
        money, customer = F.lit(after[0]).cast("decimal(20,2)"), F.lit(after[1])
        same = (F.col("monetary") == money) & (F.col("customer_id") > customer)
        rows = rows.filter((F.col("monetary") < money) | same)
    return rows.orderBy(F.desc("monetary"), "customer_id").limit(size)


def customers(
    marts: Marts, day: date | str | None = None, segment: str | None = None, page: int = 1, size: int = 20
) -> DataFrame:
    """One page of customers by money, with the number of matching customers and pages on every row.

    Pages far from the first are better read with `customers_after`.
    """
    if page < 1 or not 1 <= size <= 100:
        raise ValueError("page must be at least 1 and size between 1 and 100")
    rows = _matching_customers(marts, day, segment)
    total = rows.agg(F.count("*")).scalar()
    shown = rows.orderBy(F.desc("monetary"), "customer_id").offset((page - 1) * size).limit(size)
    return shown.select("*", total.alias("total_count"), F.ceil(total / size).alias("total_pages"))


def migrations(
    marts: Marts, from_day: date | str | None = None, to_day: date | str | None = None, limit: int = 500
) -> DataFrame:
    """Largest movements, all dates or those given."""
    _in_range("limit", limit, 500)
    rows = marts["segment_migration"]
    if from_day:
        rows = rows.filter(F.col("from_snapshot_date") == F.lit(str(from_day)).cast("date"))
    if to_day:
        rows = rows.filter(F.col("to_snapshot_date") == F.lit(str(to_day)).cast("date"))
    ties = ["from_snapshot_date", "to_snapshot_date", "from_segment_code", "to_segment_code"]
    return rows.orderBy(F.desc("customer_count"), *ties).limit(limit)


def _holds(codes: str, product: str) -> Column:
    return F.array_contains(F.split(codes, r"\|"), product)


def rules(
    marts: Marts,
    segment: str = "ALL",
    min_lift: float = 1.05,
    min_confidence: float = 0.25,
    product: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Best rules of a scope; with `product`, those that name it on either side."""
    _in_range("limit", limit, 500)
    if min_lift < 0:
        raise ValueError("min_lift must not be below zero")
    rows = marts["association_rule"].filter(
        (F.col("segment_code") == segment) & (F.col("lift") >= min_lift) & (F.col("confidence") >= min_confidence)
    )
    if product:
        rows = rows.filter(_holds("antecedent_codes", product) | _holds("consequent_codes", product))
    return rows.orderBy(F.desc("rank_score"), "rule_id").limit(limit)


def drift(marts: Marts, status: str | None = None, limit: int = 200) -> DataFrame:
    _in_range("limit", limit, 500)
    rows = marts["rule_drift"]
    if status:
        rows = rows.filter(F.col("drift_status") == status)
    ties = ["segment_code", "antecedent_codes", "consequent_codes"]
    return rows.orderBy(F.desc_nulls_last("current_lift"), *ties).limit(limit)


def top_products(marts: Marts, limit: int = 20) -> DataFrame:
    _in_range("limit", limit, 100)
    return marts["top_product"].orderBy(F.desc("sales_amount"), "stock_code", "product_name").limit(limit)


def augmentation_summary(marts: Marts) -> DataFrame:
    """One row over the generated lines; zeros when there are none."""
    lines = marts["synthetic_transaction"]
    count = F.count("synthetic_line_id")
    return lines.agg(
        (count > 0).cast("int").alias("enabled"),
        count.alias("synthetic_row_count"),
        F.count_distinct("invoice_no").alias("synthetic_order_count"),
        F.count_distinct("customer_id").alias("synthetic_customer_count"),
        F.coalesce(F.round(F.sum("item_amount"), 2), F.lit(0)).cast("decimal(20,2)").alias("predicted_sales_amount"),
        F.coalesce(
            F.round(F.sum("generation_confidence") / F.nullif(count, F.lit(0)).cast("decimal(20,0)"), 6), F.lit(0)
        )
        .cast("decimal(12,6)")
        .alias("average_confidence"),
        F.min("invoice_ts").alias("forecast_start"),
        F.max("invoice_ts").alias("forecast_end"),
        F.max("generation_batch_id").alias("generation_batch_id"),
        F.max("generation_model").alias("generation_model"),
    )
