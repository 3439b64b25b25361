"""Exact medians for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sources.stage import materialise

# Values that share all bits above this many lowest ones form a coarse bucket.
_FINE_BITS = 18


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, per_unit: int | None = None) -> DataFrame:
    """Median of a column per group, as double.

    The built-in median keeps all distinct values of a group in one task. Here a group is first counted
    per coarse bucket; only the one or two buckets that hold the middle are then counted per value. So
    no task sees more than the buckets of a group, or the values of a bucket: 2^18 of a whole-number column,
    those within 1 / `per_unit` of a floating one.
    """
    c = F.col
    counts = df.filter(c(value).isNotNull()).groupBy(*keys, c(value).alias("_value")).agg(F.count("*").alias("_count"))
    bucket = F.shiftright("_value", _FINE_BITS) if per_unit is None else F.floor(c("_value") * per_unit)
    # Stored, as buckets and the values of the middle ones are read from it.
    counts = materialise(counts.withColumn("_bucket", bucket), "value-counts")
    buckets = counts.groupBy(*keys, "_bucket").agg(F.sum("_count").alias("_rows"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("_rows").over(group)
    middle = buckets.select(
        *keys,
        "_bucket",
        (F.sum("_rows").over(upto) - c("_rows")).alias("_before"),
        "_rows",
        F.floor((total + 1) / 2).alias("_low"),
        (F.floor(total / 2) + 1).alias("_high"),
    ).filter((c("_before") < c("_high")) & (c("_before") + c("_rows") >= c("_low")))
    inside = counts.join(middle.drop("_rows"), [*keys, "_bucket"])
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("_upto", c("_before") + F.sum("_count").over(in_bucket))
    ends = reached.filter((c("_upto") - c("_count") < c("_high")) & (c("_upto") >= c("_low")))
    return ends.groupBy(*keys).agg(((F.min("_value") + F.max("_value")) / 2.0).alias(name))
