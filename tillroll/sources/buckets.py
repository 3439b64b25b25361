"""Tables stored in sorted buckets by key, so that joins on the key need no shuffle of them."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.stage import materialise

ROWS_PER_BUCKET = 500_000


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None) -> dict:
    """Write `df` in buckets of about `ROWS_PER_BUCKET` rows, one file each, and return what `read_buckets` needs."""
    stored = materialise(df, "to-buckets")
    buckets = buckets or stored.count() // ROWS_PER_BUCKET + 1
    description = {"path": path, "keys": list(keys), "buckets": buckets, "schema": stored.schema.toDDL()}
    table = _register(df.sparkSession, description)
    stored.repartition(buckets, *keys).write.insertInto(table)
    return description


def read_buckets(spark: SparkSession, description: dict) -> DataFrame:
    """The stored table, in any session: its buckets are made known to the session's catalog first."""
    return spark.table(_register(spark, description))


def _register(spark: SparkSession, description: dict) -> str:
    table = "buckets_" + md5(description["path"].encode()).hexdigest()
    keys = ", ".join(f"`{key}`" for key in description["keys"])
    path = description["path"].replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({description['schema']}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(description['buckets'])} BUCKETS LOCATION '{path}'"
    )
    return table
