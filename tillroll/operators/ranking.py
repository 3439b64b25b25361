"""Quantile scores by counted values, without sorting the rows or gathering a large group in one task."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.basket import small
from tillroll.sources.stage import materialise

# Buckets of values per factor e; letters by which a run of equal values is cut at a time.
_PER_E = 64
_STEM = 3
#: Rows of one value that a single window may rank.
MOST_RANKED = 100_000


def _directed(score: Column, rows: Column, bins: int, higher_better: bool) -> Column:
    return score if higher_better else (F.least(F.lit(bins), rows) + 1 - score).cast("int")


def _bucket(value: Column) -> Column:
    """Coarse place of a value; never falls as values rise."""
    size = F.floor(F.log1p(F.abs(value).cast("double")) * _PER_E)
    return F.when(value < 0, -size).otherwise(size).cast("int")


def _holding(counts: DataFrame, keys: list[str], order: str, places: DataFrame) -> DataFrame:
    """For each row of `places` (keys, `_bin`, `_place`) the row of `counts` (keys, order, `_n`) that holds that place
    when counted in order; `_place` then counts within that row."""
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    ends = counts.withColumn("_upto", upto)
    inside = (F.col("_place") <= F.col("_upto")) & (F.col("_place") > F.col("_upto") - F.col("_n"))
    held = ends.join(places, keys).filter(inside)
    return held.withColumn("_place", F.col("_place") - F.col("_upto") + F.col("_n")).drop("_upto")


def _bin_ends(rows: DataFrame, counts: DataFrame, sizes: DataFrame, bins: int, tie: str, most: int, most_ranked: int) -> DataFrame:
    """(by, `_metric`, `_bin`, `_value`, `_whole`, `_end`): the value that holds a bin's last row and, unless the bin
    ends with all rows of that value, the tie of that last row. There are `most` at most."""
    group = sizes.columns[:2]
    used = F.least(F.lit(bins), F.col("_rows"))
    last_of_bin = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(bins)), F.lit(1), used - 1),
        lambda j: F.floor((j * (F.col("_rows") - 1)).cast("decimal(38,0)") / used.cast("decimal(38,0)")) + 1,
    )
    places = sizes.select(*group, F.posexplode(last_of_bin).alias("_bin", "_place"))
    coarse = _holding(counts, group, "_bucket", places).drop("_n")

    # A few buckets of each group are left, and of those the distinct values only.
    kept = rows.join(small(coarse.select(*group, "_bucket").distinct(), most), [*group, "_bucket"])
    counts = kept.groupBy(*group, "_bucket", "_value").agg(F.count("*").alias("_n"))
    ends = _holding(counts, [*group, "_bucket"], "_value", coarse).drop("_bucket")
    ends = materialise(ends, "bin-values")
    whole = ends.filter("_place = _n").select(*group, "_bin", "_value", F.lit(True).alias("_whole"), F.lit(None).cast("string").alias("_end"))

    # The other ends lie inside a run of equal values, counted by longer and longer beginnings of the tie.
    split = ends.filter("_place < _n").withColumn("_stem", F.lit(""))
    length, key = 0, [*group, "_value", "_stem"]
    while True:
        begun = rows.withColumn("_stem", F.substring(tie, 1, length))
        run = begun.join(small(split.select(*key).distinct(), most), key)
        if (split.agg(F.max("_n")).first()[0] or 0) <= most_ranked:
            break
        counts = run.select(*key, F.substring(tie, 1, length + _STEM).alias("_longer")).groupBy(*key, "_longer").agg(F.count("*").alias("_n"))
        longer = _holding(counts, key, "_longer", split.drop("_n")).drop("_stem")
        split = materialise(longer.withColumnRenamed("_longer", "_stem"), "bin-stems")
        length += _STEM
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(tie))
    found = run.select(*key, F.col(tie).alias("_end"), nth.alias("_place")).join(small(split.drop("_n"), most), [*key, "_place"])
    return whole.unionByName(found.select(*group, "_bin", "_value", F.lit(False).alias("_whole"), "_end"))


def score(
    df: DataFrame, metrics: dict[str, tuple[str, bool]], bins: int, by: str, tie: str, most_ranked: int = MOST_RANKED
) -> DataFrame:
    """Add one quantile score per entry `score: (metric, higher_better)`, per group of `by` of any size.

    Metrics are numbers and not null, `tie` is a text that is unique in a group and breaks ties. The rows of a group are
    counted by coarse bucket, then by value in the few buckets where a bin ends; only a run of equal values that a bin
    cuts is ranked by `tie`, and counted by beginnings of it first where it has over `most_ranked` rows. Every row of
    `df` is then compared with its group's few bin ends. Only counts are shuffled, never the rows of `df`.
    """
    c = F.col
    value = lambda metric: F.col(metric).cast("decimal(38,4)")
    stacked = F.array(
        *[F.struct(F.lit(at).alias("_metric"), value(m).alias("_value")) for at, (m, _) in enumerate(metrics.values())]
    )
    rows = df.select(by, tie, F.inline(stacked)).withColumn("_bucket", _bucket(c("_value")))
    counts = materialise(rows.groupBy(by, "_metric", "_bucket").agg(F.count("*").alias("_n")), "bucket-counts")
    sizes = counts.groupBy(by, "_metric").agg(F.sum("_n").alias("_rows"))
    most = bins * sizes.count()
    ends = _bin_ends(rows, counts, sizes, bins, tie, most, most_ranked)
    # Casts to double never change an order, so decimals are compared only where their doubles are equal. A row lies
    # behind an end that is a whole run of equal values when its value is larger, behind another one also by its tie.
    whole = [isinstance(df.schema[metric].dataType, T.IntegralType) for metric, _ in metrics.values()]
    place = lambda at, of: [of.cast("bigint")] if whole[at] else [of.cast("double"), of]
    per_metric = [
        F.sort_array(
            F.collect_list(
                F.when(
                    c("_metric") == at,
                    F.struct("_bin", F.struct(*place(at, c("_value")), c("_whole").cast("int"), c("_end")).alias("_last")),
                )
            )
        )["_last"].alias(f"_ends{at}")
        for at in range(len(metrics))
    ]
    groups = sizes.filter("_metric = 0").select(by, "_rows").join(ends.groupBy(by).agg(*per_metric), by, "left")
    own = {
        f"_own{at}": F.struct(*place(at, c(metric) if whole[at] else value(metric)), F.lit(0), c(tie))
        for at, (metric, _) in enumerate(metrics.values())
    }
    scored = df.withColumns(own).join(small(materialise(groups, "bin-ends"), most), by)
    for at, (name, (_, higher_better)) in enumerate(metrics.items()):
        passed = [F.get(c(f"_ends{at}"), F.lit(j)) < c(f"_own{at}") for j in range(bins - 1)]
        reached = reduce(add, [F.coalesce(beyond, F.lit(False)).cast("int") for beyond in passed], F.lit(1))
        scored = scored.withColumn(name, _directed(reached, c("_rows"), bins, higher_better).cast("int"))
    return scored.drop("_rows", *own, *[f"_ends{at}" for at in range(len(metrics))])
