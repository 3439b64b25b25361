"""The warehouse kept up to date: new lines rewrite the months they touch, in every table, and nothing else."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators import refresh
from tillroll.operators import warehouse as wh
from tillroll.operators.bitmaps import new_numbers
from tillroll.operators.refresh import MONTH
from tillroll.schemas import FACT
from tillroll.sources.marts import new_version
from tillroll.sources.monthly import newest, publish, read_parts, write_parts
from tillroll.sources.stage import materialise, scratch

_DICTIONARY = "kind string, key string, key_id bigint"


def _schemas(spark: SparkSession) -> dict[str, StructType]:
    """Schemas of the stored parts; only analysed, nothing runs."""
    empty = refresh.with_month(spark.createDataFrame([], FACT))
    numbers = spark.createDataFrame([], _DICTIONARY)
    found = {"fact": empty.schema, "key_bitmaps": refresh.key_bitmaps(empty, numbers).schema}
    return found | {name: build(empty).schema for name, build in refresh.PARTS.items()}


def refresh_warehouse(raw: DataFrame, folder: str, keep: int = 5) -> dict:
    """Take landing lines into the monthly warehouse under `folder` and return the new version's manifest.

    Lines are filed under the month of their time, '' where that cannot be read. A month with new lines is rewritten from
    its own old and new lines, and so are its parts of all tables; other months keep their files. A batch that comes again
    replaces what it brought before, also in months that it no longer has, so a delivery can be repeated or put right;
    lines without a batch only add. Without lines nothing happens.

    The version is published last and names its parent: readers never see half of it, and of two runs that start from
    one version the second fails. Old versions' files are deleted once neither one of the newest `keep` versions nor a month of
    theirs needs them. The driver sees batches per month and the list of months, never lines or keys.
    """
    spark = raw.sparkSession
    with scratch(spark):
        return _refresh(spark, raw, folder, keep)


def _refresh(spark: SparkSession, raw: DataFrame, folder: str, keep: int) -> dict:
    before, schemas, version = newest(spark, folder), _schemas(spark), new_version()
    lines = materialise(refresh.with_month(wh.clean(raw)), "new-lines")
    brought: dict[str | None, set[str]] = {}
    for row in lines.select("ingest_batch_id", MONTH).distinct().collect():
        brought.setdefault(row["ingest_batch_id"], set()).add(row[MONTH])
    if not brought:
        return before
    again = [batch for batch in brought if batch in before["batches"]]
    touched = set().union(*brought.values(), *(before["batches"][batch] for batch in again))

    old = read_parts(spark, folder, before, "fact", schemas["fact"], touched)
    if again:
        old = old.filter(~F.coalesce(F.col("ingest_batch_id").isin(again), F.lit(False)))
    write_parts(old.unionByName(lines), folder, version, "fact")
    here = {"months": dict.fromkeys(touched, version)}
    fact = read_parts(spark, folder, here, "fact", schemas["fact"])
    left = {row[MONTH] for row in fact.select(MONTH).distinct().collect()}

    for name, build in refresh.PARTS.items():
        write_parts(build(fact), folder, version, name)
    numbers, counts, dictionary = _number(spark, fact, folder, version, before)
    write_parts(refresh.key_bitmaps(fact, numbers), folder, version, "key_bitmaps")

    kept = {month: held for month, held in before["months"].items() if month not in touched}
    manifest = {
        "version": version,
        "parent": before["version"],
        "touched": sorted(touched),
        "months": kept | dict.fromkeys(left, version),
        "batches": before["batches"] | {batch: sorted(months) for batch, months in brought.items() if batch is not None},
        "numbers": counts,
        "dictionary": dictionary,
    }
    publish(spark, folder, manifest, keep)
    return manifest


def _number(spark: SparkSession, fact: DataFrame, folder: str, version: str, before: dict) -> tuple[DataFrame, dict, list]:
    """All numbered keys, how many of each kind there are, and the dictionary's files with those of this version.

    Numbers are given once and never again; a key that a repeated batch no longer has keeps its own.
    """
    stored = before["dictionary"]
    known = spark.read.schema(_DICTIONARY).parquet(*stored) if stored else spark.createDataFrame([], _DICTIONARY)
    fresh, counts = [], {}
    for kind in refresh.KINDS:
        start = before["numbers"].get(kind, 0)
        found, n = new_numbers(refresh.keys_of(fact, kind), known.filter(F.col("kind") == kind), start, near=refresh.NEAR)
        fresh.append(found.select(F.lit(kind).alias("kind"), "key", "key_id"))
        counts[kind] = start + n
    path = f"{folder}/dictionary/{version}"
    reduce(DataFrame.unionByName, fresh).write.parquet(path)
    paths = [*stored, path]
    return spark.read.schema(_DICTIONARY).parquet(*paths), counts, paths


class MonthlyWarehouse:
    """The newest version's tables, all or of some months; a frame stays valid while its version is kept."""

    def __init__(self, spark: SparkSession, folder: str, months: Collection[str] | None = None) -> None:
        self.manifest = newest(spark, folder)
        self._spark, self._folder, self._months, self._schemas = spark, folder, months, _schemas(spark)

    def _read(self, table: str) -> DataFrame:
        return read_parts(self._spark, self._folder, self.manifest, table, self._schemas[table], self._months)

    def tables(self) -> dict[str, DataFrame]:
        """Every table as `jobs.build_warehouse` names it."""
        read = self._read
        lines, sums, sets = read("basket_lines"), read("totals"), read("key_bitmaps")
        return {
            "dwd_order_item": read("fact").drop(MONTH),
            "dim_product": refresh.dim_product(read("products")),
            "dim_customer": refresh.dim_customer(read("customers")),
            "dim_country": refresh.dim_country(sums, sets),
            "dws_basket_summary": refresh.basket_summary(lines),
            "dws_basket_item": refresh.basket_item(lines),
            "dws_customer_monthly_value": read("customer_months").drop(MONTH),
            "dws_customer_purchase_summary": refresh.customer_summary(lines),
            "ads_business_overview": refresh.overview(sums, sets),
            "ads_monthly_sales": read("month_sales").drop(MONTH),
            "ads_data_quality_summary": refresh.quality_summary(sums, sets),
        }

    def by_period(self, length: int) -> DataFrame:
        """Key figures per period, a period being the first `length` characters of a month: 4 for years."""
        return refresh.period_overview(self._read("totals"), self._read("key_bitmaps"), F.substring(MONTH, 1, length))
