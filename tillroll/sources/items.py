"""Basket-item and segment files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.fixed_values import ORIGIN_REAL
from tillroll.functions.numbers import whole
from tillroll.schemas import BASKET_ITEM_COLUMNS, SEGMENTS

# Fixed value: how the delimited files write a null.
NULL_TEXT = r"\N"
REQUIRED = ["invoice_no", "customer_id", "invoice_ts", "stock_code", "item_amount"]


def _present(name: str) -> Column:
    return F.when(F.col(name) != "", F.col(name))


def type_basket_items(texts: DataFrame) -> DataFrame:
    """Typed basket items from eleven text columns.

    Numbers that cannot be read become null, and so do quantities that are not whole; origin and confidence
    get their defaults; rows without invoice, customer, time, product or amount are left out.
    """
    typed = texts.select(
        _present("invoice_no").alias("invoice_no"),
        _present("customer_id").alias("customer_id"),
        F.col("invoice_ts").try_cast("timestamp_ntz").alias("invoice_ts"),
        _present("stock_code").alias("stock_code"),
        _present("product_name").alias("product_name"),
        whole(F.col("item_quantity")).alias("item_quantity"),
        F.col("item_amount").try_cast("decimal(20,4)").alias("item_amount"),
        F.coalesce(_present("data_origin"), F.lit(ORIGIN_REAL)).alias("data_origin"),
        _present("source_segment_code").alias("source_segment_code"),
        F.coalesce(F.col("generation_confidence").try_cast("double"), F.lit(1.0)).alias("generation_confidence"),
        _present("generation_batch_id").alias("generation_batch_id"),
    )
    return typed.dropna(subset=REQUIRED)


def read_basket_items(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated basket items; trailing columns may be absent."""
    layout = T.StructType([T.StructField(name, T.StringType()) for name in BASKET_ITEM_COLUMNS])
    texts = spark.read.schema(layout).csv(path, sep="\t", quote='"', escape='"', nullValue=NULL_TEXT, mode="PERMISSIVE")
    return type_basket_items(texts)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Customer segments from CSV with header; the customer id stays text and further columns are ignored.

    A file without one of the columns is refused before any job.
    """
    df = spark.read.csv(path, header=True, quote='"', escape='"', inferSchema=False)
    if absent := [name for name in SEGMENTS.names if name not in df.columns]:
        raise ValueError(f"segment file {path} lacks {absent}")
    return df.select(*[F.col(name).cast("string").alias(name) for name in SEGMENTS.names])


def export_tsv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Headerless tab-separated files; `order` sorts the rows across the files."""
    texts = df.orderBy(*order) if order else df
    texts = texts.select(*[F.col(name).cast("string").alias(name) for name in df.columns])
    texts.write.mode("overwrite").csv(path, sep="\t", quote='"', escape='"', nullValue=NULL_TEXT, emptyValue="")
