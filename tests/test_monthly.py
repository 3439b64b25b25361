"""The warehouse in monthly parts: refreshes against full builds."""

from __future__ import annotations

import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators import bitmaps, refresh, warehouse
from tillroll.plans import jobs
from tillroll.plans.monthly import MonthlyWarehouse, refresh_warehouse
from tillroll.schemas import RAW
from tillroll.sources.marts import PublicationConflict, versions
from tillroll.sources.monthly import publish

FULL = {"dwd_order_item": lambda fact: fact, **jobs._TABLES}


def lines(seed, batch, n=60, first=dt.date(2021, 11, 20), days=90):
    """Few invoices, customers and products over several months, with every kind of fault."""
    rnd = random.Random(seed)
    made = []
    for _ in range(n):
        day = first + dt.timedelta(days=rnd.randint(0, days))
        ts = rnd.choice([f"{day} 10:0{rnd.randint(0, 9)}:00"] * 12 + [f"{day.year}-{day.month}-{day.day}", "soon", "", None])
        made.append(
            (
                "Y",
                rnd.choice([f"{rnd.randint(1, 12)}"] * 9 + ["C7", " ", None]),
                rnd.choice(["A", "B", "D", "E", "", None]),
                rnd.choice(["x", "y", None]),
                rnd.choice(["1", "2", "3", "-1", "2.5", "many"]),
                ts,
                rnd.choice(["1.2345", "2", "0.333", "0", ""]),
                rnd.choice(["K1", "K2", "K3", "K4", "", None]),
                rnd.choice(["UK", "DE", None, ""]),
                batch,
            )
        )
    return made


def compare(spark, folder, raw):
    fact = warehouse.clean(raw)
    for name, table in MonthlyWarehouse(spark, folder).tables().items():
        full = FULL[name](fact)
        assert [(f.name, f.dataType) for f in table.schema.fields] == [(f.name, f.dataType) for f in full.schema.fields], name
        assert rows(table) == rows(full), name


def test_refreshes_give_what_a_full_build_gives(spark, tmp_path):
    folder, raw = str(tmp_path), lambda data: spark.createDataFrame(data, RAW)
    assert rows(MonthlyWarehouse(spark, folder).tables()["ads_business_overview"]) == rows(warehouse.ads_overview(warehouse.clean(raw([]))))
    first, second, late = lines(1, "b1"), lines(2, "b2", first=dt.date(2022, 1, 10)), lines(3, "b3", 15, dt.date(2021, 12, 1), 20)
    nameless = lines(4, None, 5)
    refresh_warehouse(raw(first), folder)
    refresh_warehouse(raw(second + nameless), folder)
    refresh_warehouse(raw(late), folder)
    compare(spark, folder, raw(first + second + nameless + late))
    # The second batch comes again with other lines, and leaves months that it had before.
    mended = lines(5, "b2", 20, dt.date(2022, 2, 1), 10)
    manifest = refresh_warehouse(raw(mended), folder)
    assert {"2022-01", "2022-04"} <= set(manifest["touched"]) and "2022-04" not in manifest["months"]
    compare(spark, folder, raw(first + nameless + late + mended))
    same = refresh_warehouse(raw(mended), folder)
    compare(spark, folder, raw(first + nameless + late + mended))
    assert same["numbers"] == manifest["numbers"]
    assert refresh_warehouse(raw([]), folder) == same


def test_only_touched_months_are_written_and_read(spark, tmp_path):
    folder = str(tmp_path)
    plain = [r for r in lines(6, "b1", 80) if r[5] and r[5][4:5] == "-" and len(r[5]) > 12]
    refresh_warehouse(spark.createDataFrame(plain, RAW), folder)
    late = [("Y", "99", "Z", "z", "1", "2021-12-24 09:00:00", "5", "K9", "UK", "b2")]
    manifest = refresh_warehouse(spark.createDataFrame(late, RAW), folder)
    assert manifest["touched"] == ["2021-12"]
    for table in ("fact", "key_bitmaps", *refresh.PARTS):
        written = [p.name for p in Path(folder, "versions", manifest["version"], table).glob("stored_month=*")]
        assert written == ["stored_month=2021-12"], table
    compare(spark, folder, spark.createDataFrame(plain + late, RAW))
    december = MonthlyWarehouse(spark, folder, ["2021-12", "1999-01"]).tables()["dwd_order_item"]
    assert rows(december.select("invoice_month").distinct()) == [("2021-12",)]
    # The choice of months is one of folders.
    plan = december._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*stored_month", plan)


def test_periods_add_up(spark, tmp_path):
    data = lines(7, "b1", 200, dt.date(2020, 10, 1), 700)
    refresh_warehouse(spark.createDataFrame(data, RAW), str(tmp_path))
    fact = refresh.with_month(warehouse.clean(spark.createDataFrame(data, RAW)))
    found = {r["period"]: tuple(r)[1:] for r in MonthlyWarehouse(spark, str(tmp_path)).by_period(4).collect()}
    assert {"2020", "2021", ""} <= set(found)
    for period, figures in found.items():
        assert figures == tuple(warehouse.ads_overview(fact.filter(F.substring("stored_month", 1, 4) == period)).first())


def test_two_refreshes_from_one_version_and_retention(spark, tmp_path):
    folder = str(tmp_path)
    data = [lines(n, f"b{n}", 10, dt.date(2022, n, 1), 20) for n in (1, 2, 3, 4)]
    manifests = [refresh_warehouse(spark.createDataFrame(d, RAW), folder, keep=2) for d in data[:3]]
    stale = manifests[1] | {"version": "stale", "parent": manifests[1]["version"]}
    with pytest.raises(PublicationConflict):
        publish(spark, folder, stale, 2)
    refresh_warehouse(spark.createDataFrame(data[3], RAW), folder, keep=2)
    assert len(versions(spark, folder)) == 4
    compare(spark, folder, spark.createDataFrame(sum(data, []), RAW))  # months of versions beyond `keep` are still there
    again = [("Y", "1", "A", "x", "1", "2022-01-01 00:00:00", "1", "K", "UK", "b1")]
    for _ in range(3):
        refresh_warehouse(spark.createDataFrame(again, RAW), folder, keep=2)
    compare(spark, folder, spark.createDataFrame(again + sum(data[1:], []), RAW))
    assert not Path(folder, "versions", manifests[0]["version"]).exists()


def test_numbers_are_dense_and_sets_merge(spark):
    known = spark.createDataFrame([(f"k{n}", n) for n in range(1, 31)], "key string, key_id bigint")
    keys = spark.createDataFrame([(f"k{n % 2000}",) for n in range(5000)] + [(None,), ("",)], "key string")
    fresh, total = bitmaps.new_numbers(keys, known, 30, per_bucket=100)
    assert total == 1971 and sorted(r["key_id"] for r in fresh.collect()) == list(range(31, 31 + total))
    assert fresh.select("key").distinct().count() == total
    ids = spark.createDataFrame([("a", n) for n in (1, 32768, 32769, 70000, 1)] + [("b", n) for n in (1, 70000, 5)], "g string, key_id bigint")
    sets = bitmaps.key_sets(ids, ["g"])
    count = lambda by: sorted(tuple(r) for r in bitmaps.merged_counts(sets, by).groupBy(*by).agg(F.sum("n")).collect())
    assert count(["g"]) == [("a", 4), ("b", 3)] and count([]) == [(5,)]


def test_keys_of_one_country_and_month_fill_few_bitmaps(spark):
    groups, each = 20, 5000
    keys = spark.range(groups * each).select(
        F.md5(F.col("id").cast("string")).alias("key"), F.when(F.col("id") % groups > 0, F.concat(F.lit("c"), F.col("id") % groups)).alias("country")
    )
    twice = keys.unionByName(keys.filter("country = 'c1'").withColumn("country", F.lit("c2")))  # the lower place counts
    known = spark.createDataFrame([], "key string, key_id bigint")
    found, total = bitmaps.new_numbers(twice, known, 10, per_bucket=700, near=("country",))
    ids = keys.join(found, "key").groupBy("country").agg(F.min("key_id").alias("low"), F.max("key_id").alias("high"), F.count_distinct("key_id").alias("n"))
    assert total == groups * each and all(r["high"] - r["low"] + 1 == r["n"] == each for r in ids.collect())
    sets = bitmaps.key_sets(twice.join(found, "key"), ["country"])
    assert sets.count() <= groups + total // 32768 + 2  # in any order of numbers: each group in each bitmap's range
    assert bitmaps.merged_counts(sets, []).agg(F.sum("n")).first()[0] == total
    assert found.join(keys.select("key"), "key", "left_anti").isEmpty()
