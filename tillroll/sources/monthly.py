"""Tables kept in monthly parts: a version writes the parts it touches and names the version of every other."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators.refresh import MONTH
from tillroll.sources.marts import delete_version, publish_version, versions

_NOTHING = {"version": None, "parent": None, "months": {}, "batches": {}, "numbers": {}, "dictionary": []}


def newest(spark: SparkSession, folder: str) -> dict:
    """Manifest of the newest version: `months` names the version that holds each month's parts."""
    published = versions(spark, folder)
    return published[0] if published else dict(_NOTHING)


def write_parts(df: DataFrame, folder: str, version: str, table: str) -> None:
    """One folder per month; the rebalance hint cuts large months into several files and joins small ones."""
    df.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{folder}/versions/{version}/{table}")


def read_parts(
    spark: SparkSession, folder: str, manifest: Mapping, table: str, schema: StructType, months: Iterable[str] | None = None
) -> DataFrame:
    """Rows of one table with their month, of all months or of some; other months' folders are not read."""
    wanted = set(manifest["months"]) if months is None else set(months) & set(manifest["months"])
    held: dict[str, list[str]] = {}
    for month in sorted(wanted):
        held.setdefault(manifest["months"][month], []).append(month)
    parts = []
    for version, names in sorted(held.items()):
        stored = spark.read.schema(schema).parquet(f"{folder}/versions/{version}/{table}")
        # A folder name cannot hold a blank month; it comes back as null.
        here = F.col(MONTH).isin([name for name in names if name])
        parts.append(stored.filter(here | F.col(MONTH).isNull() if "" in names else here))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts).withColumn(MONTH, F.coalesce(MONTH, F.lit("")))


def publish(spark: SparkSession, folder: str, manifest: Mapping, keep: int) -> None:
    """Publish the version and delete those of which neither the newest `keep` nor any month of theirs is left."""
    publish_version(spark, folder, manifest)
    published = versions(spark, folder)
    needed = {version for kept in published[:keep] for version in (kept["version"], *kept["months"].values())}
    for old in published[keep:]:
        if old["version"] not in needed:
            delete_version(spark, folder, old["version"])
