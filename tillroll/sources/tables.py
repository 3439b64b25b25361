"""Warehouse tables: partitioned fact, dimension and aggregate folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import FACT


def write_fact(df: DataFrame, path: str, fmt: str = "orc") -> None:
    """Fact table partitioned by invoice month; only the months present are replaced.

    The rebalance hint lets the adaptive planner cut large months into several files and join small
    ones, so that no month goes through one task.
    """
    rows = df.select(*FACT.names).hint("rebalance", "invoice_month")
    writer = rows.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy("invoice_month").save(path)


def read_fact(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    """Fact table; a blank month, which a folder name cannot hold, is '' again."""
    fact = spark.read.schema(FACT).format(fmt).load(path)
    return fact.withColumn("invoice_month", F.coalesce("invoice_month", F.lit("")))


def write_table(df: DataFrame, path: str, fmt: str = "orc") -> None:
    df.write.mode("overwrite").format(fmt).option("compression", "snappy").save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    return spark.read.format(fmt).load(path)
