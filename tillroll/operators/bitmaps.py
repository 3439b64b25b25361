"""Distinct counts that add up exactly: keys get dense numbers from a stored dictionary, sets of them are bitmaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.basket import small
from tillroll.sources.stage import materialise

# Keys whose order is settled by one task at a time.
KEYS_PER_BUCKET = 50_000


def new_numbers(
    keys: DataFrame, known: DataFrame, start: int, per_bucket: int = KEYS_PER_BUCKET, near: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """(key, key_id) of the `keys` that `known` has not, numbered from `start` + 1 without a gap, and how many they are.

    Keys with equal columns `near` (of several rows of a key, the lowest) get numbers next to each other: sets of such keys
    then fill few bitmaps, where numbers in any order would spread each set over all bitmaps there are. `near` has few different values. The keys of
    one place are dealt to buckets by hash; the counts of the buckets before give a bucket's first number, so no task orders all
    keys. Null is no key.
    """
    place = F.min(F.struct(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in near] or [F.lit("").alias("all")]))
    fresh = keys.dropna(subset=["key"]).groupBy("key").agg(place.alias("place")).join(known.select("key"), "key", "left_anti")
    fresh = materialise(fresh, "new-keys")
    sizes = fresh.groupBy("place").agg(F.count("*").alias("n"))
    sizes = materialise(sizes.withColumn("parts", F.floor(F.col("n") / per_bucket) + 1), "key-places")
    total, places = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    dealt = fresh.join(small(sizes.select("place", "parts"), places), "place")
    dealt = dealt.select("place", "key", F.pmod(F.xxhash64("key"), F.col("parts")).alias("part"))
    counts = materialise(dealt.groupBy("place", "part").agg(F.count("*").alias("n")), "key-buckets")
    before = counts.select("place", "part", (F.sum("n").over(Window.orderBy("place", "part")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("place", "part").orderBy("key"))
    numbered = dealt.join(small(before, counts.count()), ["place", "part"]).withColumn("key_id", F.col("before") + nth + start)
    return numbered.select("key", F.col("key_id").cast("bigint").alias("key_id")), total


def key_sets(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by…, bucket, keys): the `key_id`s of each group as bitmaps of 32,768 numbers each. Repeated ids count once.

    Ids are shuffled and not bitmaps, of which every task would make its own with few numbers in each.
    """
    numbers = rows.select(*by, F.bitmap_bucket_number("key_id").alias("bucket"), F.bitmap_bit_position("key_id").alias("_bit"))
    dealt = numbers.repartition(*by, "bucket")
    return dealt.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("keys"))


def merged_counts(sets: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """(by…, bucket, name): distinct keys per bitmap after sets of one group are merged; their sum is the distinct count."""
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    return merged.select(*by, "bucket", F.bitmap_count("keys").alias(name))
