"""Period sources and the landing table of raw lines."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.fixed_values import SOURCE_HEADERS
from tillroll.functions.standardise import norm_decimal, norm_id, norm_text, norm_ts
from tillroll.schemas import RAW


#: Text of a CSV line that does not have the columns of its file; null on sound lines.
BROKEN = "_broken_line"
SOURCE_FILE = "_source_file"
REJECT_COLUMNS = ["source_year", "source_file", "reason", "line", "ingest_batch_id"]


def _given(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in (BROKEN, SOURCE_FILE)]


def check_header(df: DataFrame) -> None:
    """Fail before any job when a source's columns are not the expected ones in order."""
    actual = [re.sub(r"\s+", " ", name).strip() for name in _given(df)]
    if actual != SOURCE_HEADERS:
        raise ValueError(f"unexpected source columns {actual}, expected {SOURCE_HEADERS}")


def batch_id(now: datetime | None = None) -> str:
    """Sortable UTC stamp of one ingest run."""
    return (now or datetime.now(UTC)).astimezone(UTC).strftime("%Y%m%dT%H%M%SZ")


def with_batch_id(df: DataFrame, identifier: str) -> DataFrame:
    return df.withColumn("ingest_batch_id", F.lit(identifier))


def read_period_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One period's source lines from CSV files; all columns stay text.

    The columns are those of one file, which `check_header` judges. Reading fails on a file whose header is another.
    `multi_line` allows line ends in quoted texts, at the price of one task per file. A line with too few or too many
    fields, as an unclosed quote makes it, has its text in `BROKEN`; `ingest` leaves it out and `rejects` lists it.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    found = spark.read.csv(path, inferSchema=False, **options)
    texts = T.StructType([T.StructField(name, T.StringType()) for name in (*found.columns, BROKEN)])
    # All fields of a line are parsed whatever is selected, else their number would not be checked.
    reader = spark.read.schema(texts).option("columnPruning", False)
    lines = reader.csv(path, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, **options)
    return lines.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _unreadable(df: DataFrame) -> Column:
    """Whether a sound line's quantity or price is a text that is no number."""
    numbers = [norm_decimal(F.col(name), "null", df.schema[name].dataType) for name in ("Quantity", "Price")]
    return reduce(lambda a, b: a | b, [number.isNull() for number in numbers])


def rejects(df: DataFrame, numbers: bool = False) -> DataFrame:
    """(source_file, reason, line): lines of `read_period_csv` that cannot be landed, as they stand in the file.

    These are broken lines and, with `numbers`, lines whose quantity or price is no number, written anew as CSV.
    """
    given = df.toDF(*SOURCE_HEADERS, BROKEN, SOURCE_FILE)
    line = F.coalesce(BROKEN, F.to_csv(F.struct(*SOURCE_HEADERS), {"quote": '"', "escape": '"'}))
    reason = F.when(F.col(BROKEN).isNotNull(), "BROKEN_LINE")
    if numbers:
        reason = reason.when(_unreadable(given), "UNREADABLE_NUMBER")
    listed = given.select(F.col(SOURCE_FILE).alias("source_file"), reason.alias("reason"), line.alias("line"))
    return listed.filter(F.col("reason").isNotNull())


def standardise(df: DataFrame, on_error: str = "raise") -> DataFrame:
    """Landing-table texts of one period's source lines, without period and batch columns and without broken lines.

    Text that is no number fails the job, is null with 'null', or takes its line out with 'reject'.
    """
    check_header(df)
    if BROKEN in df.columns:
        df = df.filter(F.col(BROKEN).isNull())
    df = df.select(*[F.col(f"`{name}`") for name in _given(df)]).toDF(*SOURCE_HEADERS)
    if on_error == "reject":
        df, on_error = df.filter(~_unreadable(df)), "null"
    kind = {field.name: field.dataType for field in df.schema.fields}
    return df.select(
        norm_id(F.col("Invoice"), kind["Invoice"]).alias("invoice_no"),
        norm_id(F.col("StockCode"), kind["StockCode"]).alias("stock_code"),
        norm_text(F.col("Description")).alias("description"),
        norm_decimal(F.col("Quantity"), on_error, kind["Quantity"]).alias("quantity"),
        norm_ts(F.col("InvoiceDate"), kind["InvoiceDate"]).alias("invoice_ts"),
        norm_decimal(F.col("Price"), on_error, kind["Price"]).alias("unit_price"),
        norm_id(F.col("Customer ID"), kind["Customer ID"]).alias("customer_id"),
        norm_text(F.col("Country")).alias("country"),
    )


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all periods, each tagged with its period name."""
    tagged = [df.withColumn("source_year", F.lit(tag)) for tag, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)


def ingest(sources: Mapping[str, DataFrame], identifier: str | None = None, on_error: str = "raise") -> DataFrame:
    """Landing table from typed period sources."""
    lines = union_sources({tag: standardise(df, on_error) for tag, df in sources.items()})
    return with_batch_id(lines, identifier or batch_id()).select(*RAW.names)


def reject_table(sources: Mapping[str, DataFrame], identifier: str, on_error: str = "raise") -> DataFrame:
    """Lines of all periods that `ingest` leaves out, with period, file, reason and batch."""
    found = union_sources({tag: rejects(df, on_error == "reject") for tag, df in sources.items()})
    return with_batch_id(found, identifier).select(*REJECT_COLUMNS)


def write_raw(df: DataFrame, path: str) -> None:
    """Landing CSV with header, comma and double quotes."""
    df.select(*RAW.names).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Landing CSV: ten text columns, header skipped, absent values as ''."""
    df = spark.read.schema(RAW).csv(path, header=True, quote='"', escape='"')
    return df.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in RAW.names])
