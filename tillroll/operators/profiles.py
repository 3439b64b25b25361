"""What is known about products and segments before scenario baskets are generated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.config import AugmentationConfig
from tillroll.fixed_values import UNNAMED_IN_PROFILES
from tillroll.operators.basket import one_segment, small
from tillroll.operators.medians import exact_median
from tillroll.operators.warehouse import merchandise
from tillroll.sources.stage import materialise

# Basket amounts are compared in ten-thousandths.
_AMOUNT_UNITS = 10_000.0


def profiles(items: DataFrame) -> DataFrame:
    """Per product: most frequent name, median price and quantity, baskets and sales; priced products only."""
    c = F.col
    price = c("item_amount").cast("double") / c("item_quantity").cast("double")
    goods = merchandise(items).withColumn("_price", price)
    totals = goods.groupBy("stock_code").agg(
        F.count_distinct("invoice_no").alias("basket_count"), F.sum("item_amount").alias("sales_amount")
    )
    per_name = goods.filter(c("product_name").isNotNull()).groupBy("stock_code", "product_name").agg(
        F.count("*").alias("lines")
    )
    names = per_name.groupBy("stock_code").agg(
        F.min(F.struct((-c("lines")).alias("order"), "product_name"))["product_name"].alias("product_name")
    )
    # Both medians come from one pass over (product, measure, value) rows.
    measures = F.array(
        F.struct(F.lit("price").alias("measure"), c("_price").alias("value")),
        F.struct(F.lit("quantity").alias("measure"), c("item_quantity").cast("double").alias("value")),
    )
    values = goods.select("stock_code", F.inline(measures))
    medians = exact_median(values, ["stock_code", "measure"], "value", "median", per_unit=100)
    medians = medians.groupBy("stock_code").agg(
        F.max(F.when(c("measure") == "price", c("median"))).alias("median_price"),
        F.max(F.when(c("measure") == "quantity", c("median"))).alias("median_quantity"),
    )
    joined = totals.join(names, "stock_code", "left").join(medians, "stock_code")
    return joined.select(
        "stock_code",
        F.coalesce("product_name", F.lit(UNNAMED_IN_PROFILES)).alias("product_name"),
        c("median_price").alias("median_unit_price"),
        F.greatest(F.lit(1.0), F.least(F.lit(72.0), c("median_quantity"))).alias("median_quantity"),
        "basket_count",
        "sales_amount",
    ).filter(c("median_unit_price") > 0)


def best_sellers(product_profiles: DataFrame, limit: int) -> DataFrame:
    """Products with the largest sales and their rank; equal sales by baskets, then code."""
    by_sales = [F.desc("sales_amount"), F.desc("basket_count"), F.asc("stock_code")]
    top = product_profiles.orderBy(*by_sales).limit(limit)
    # At most `limit` rows, so ranking them in one task is fine.
    return top.withColumn("sales_rank", F.row_number().over(Window.orderBy(*by_sales)))


def _basket_products(items: DataFrame, goods: DataFrame, cfg: AugmentationConfig) -> DataFrame:
    """(invoice_no, stock_code) of profiled products; with a limit, the most popular of each invoice only. May repeat."""
    known = goods.select("stock_code", F.struct(-F.col("sales_amount"), -F.col("basket_count"), "stock_code").alias("_place"))
    if cfg.relation_products is not None:
        known = known.orderBy("_place").limit(cfg.relation_products)
    places = items.select("invoice_no", "stock_code").join(known, "stock_code")
    if cfg.max_products_per_basket is None:
        return places.select("invoice_no", "stock_code")
    popular = F.slice(F.sort_array(F.collect_set("_place")), 1, cfg.max_products_per_basket)
    return places.groupBy("invoice_no").agg(popular["stock_code"].alias("codes")).select("invoice_no", F.explode("codes").alias("stock_code"))


def cells(places: DataFrame, width: int) -> DataFrame:
    """(low, high, firsts, others): each invoice's products dealt out as the upper triangle of a grid of blocks.

    An invoice of up to `width` products is one cell. A longer one is cut into blocks of about `width` products by hash, and
    every two blocks meet in a cell of their own, so its pairs are spread over tasks and no row holds them all. The products
    of invoices are stored after the one shuffle that all lines go through.
    """
    c = F.col
    products = F.sort_array(F.collect_set("stock_code")).alias("firsts")
    held = materialise(places.groupBy("invoice_no").agg(products), "invoice-products")
    first = F.lit(0)
    narrow = held.filter(F.size("firsts") <= width).select("invoice_no", first.alias("low"), first.alias("high"), "firsts", c("firsts").alias("others"))
    blocks = F.ceil(F.size("firsts") / width).cast("int").alias("_blocks")
    dealt = held.filter(F.size("firsts") > width).select("invoice_no", blocks, F.explode("firsts").alias("stock_code"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("stock_code"), c("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), c("_blocks") - 1)))
    dealt = dealt.select("invoice_no", "stock_code", "_block", F.least("_block", "_other").alias("low"), F.greatest("_block", "_other").alias("high"))
    members = lambda side: F.sort_array(F.collect_set(F.when(c("_block") == c(side), c("stock_code"))))
    wide = dealt.groupBy("invoice_no", "low", "high").agg(members("low").alias("firsts"), members("high").alias("others"))
    return narrow.unionByName(wide)


def pair_counts(items: DataFrame, goods: DataFrame, cfg: AugmentationConfig, width: int = 256) -> tuple[DataFrame, DataFrame]:
    """Baskets per pair (left < right) and per product, over the profiled products of each basket."""
    c = F.col
    dealt = cells(_basket_products(items, goods, cfg), width)
    own = dealt.filter("low = high").select(F.explode("firsts").alias("stock_code"))
    counts = own.groupBy("stock_code").agg(F.count("*").alias("basket_count"))
    apart = dealt.select("low", "high", F.posexplode("firsts").alias("at", "first"), "others")
    later = F.when(c("low") == c("high"), F.slice("others", c("at") + 2, F.size("others"))).otherwise(c("others"))
    met = apart.select("first", F.explode(later).alias("other"))
    pairs = met.select(F.least("first", "other").alias("left_code"), F.greatest("first", "other").alias("right_code"))
    return pairs.groupBy("left_code", "right_code").agg(F.count("*").alias("pair_count")), counts


def relations(pairs: DataFrame, counts: DataFrame, items: DataFrame, cfg: AugmentationConfig) -> DataFrame:
    """Directed relations with rank per anchor. Lift refers to all source invoices."""
    c = F.col
    baskets = items.agg(F.count_distinct("invoice_no")).scalar()
    both = F.array(
        F.struct(c("left_code").alias("anchor_code"), c("right_code").alias("companion_code")),
        F.struct(c("right_code").alias("anchor_code"), c("left_code").alias("companion_code")),
    )
    directed = pairs.filter(c("pair_count") >= cfg.min_pair_baskets).select(F.inline(both), "pair_count")
    directed = directed.join(counts.select(c("stock_code").alias("anchor_code"), c("basket_count").alias("_a")), "anchor_code")
    directed = directed.join(
        counts.select(c("stock_code").alias("companion_code"), c("basket_count").alias("_c")), "companion_code"
    )
    measured = directed.withColumn("confidence", c("pair_count") / c("_a")).withColumn(
        "lift", c("pair_count") * baskets / (c("_a") * c("_c"))
    )
    strength = F.log1p("lift")
    generation = (
        F.lit(0.52)
        + F.least(c("confidence"), F.lit(1.0)) * 0.2
        + F.least(strength / F.log(F.lit(6.0)), F.lit(1.0)) * 0.13
        + F.least(c("pair_count") / 150, F.lit(1.0)) * 0.13
    )
    scored = measured.withColumns(
        {
            "score": c("confidence") * strength * F.log1p("pair_count"),
            "generation_confidence": F.greatest(F.lit(0.58), F.least(F.lit(0.98), generation)),
        }
    )
    best = Window.partitionBy("anchor_code").orderBy(F.desc("score"), "companion_code")
    return scored.select(
        "anchor_code",
        "companion_code",
        "pair_count",
        "confidence",
        "lift",
        "score",
        "generation_confidence",
        F.row_number().over(best).alias("relation_rank"),
    )


def anchors(product_profiles: DataFrame, related: DataFrame, limit: int) -> DataFrame:
    """Best sellers with at least one relation, numbered from 0 in sales order."""
    kept = best_sellers(product_profiles, limit).join(
        related.select(F.col("anchor_code").alias("stock_code")).distinct(), "stock_code", "left_semi"
    )
    number = F.row_number().over(Window.orderBy("sales_rank")) - 1
    return kept.withColumn("anchor_index", number)


# --- segments -------------------------------------------------------------------------------------


def with_segment(items: DataFrame, segments: DataFrame) -> DataFrame:
    """Items of customers that have a segment, with its code."""
    return items.join(one_segment(segments).select("customer_id", "segment_code"), "customer_id")


def customer_weights(segment_items: DataFrame) -> DataFrame:
    """Share of each customer in a segment's draws: square root of orders over the segment's sum."""
    orders = segment_items.groupBy("segment_code", "customer_id").agg(F.count_distinct("invoice_no").alias("order_count"))
    orders = materialise(orders, "customer-orders")
    root = F.sqrt("order_count")
    totals = materialise(orders.groupBy("segment_code").agg(F.sum(root).alias("_total")), "segment-totals")
    return orders.join(small(totals), "segment_code").select(
        "segment_code", "customer_id", "order_count", (root / F.col("_total")).alias("weight")
    )


def _product_baskets(segment_items: DataFrame) -> DataFrame:
    return segment_items.groupBy("segment_code", "stock_code").agg(F.count_distinct("invoice_no").alias("basket_count"))


def segment_products(segment_items: DataFrame, limit: int = 150) -> DataFrame:
    """Products with the most baskets per segment and their rank."""
    popular = Window.partitionBy("segment_code").orderBy(F.desc("basket_count"), "stock_code")
    ranked = _product_baskets(segment_items).withColumn("product_rank", F.row_number().over(popular))
    return ranked.filter(F.col("product_rank") <= limit)


def restrict(products: DataFrame, product_profiles: DataFrame) -> DataFrame:
    """Segment products that have a profile."""
    return products.join(product_profiles.select("stock_code"), "stock_code", "left_semi")


def anchor_segments(segment_items: DataFrame) -> DataFrame:
    """Per product, the share of its baskets in each segment."""
    # A product has one row per segment here, so the window holds a handful of rows.
    product = Window.partitionBy("stock_code")
    share = F.col("basket_count") / F.sum("basket_count").over(product)
    return _product_baskets(segment_items).withColumn("share", share)


def budgets(segment_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Median basket amount per customer and per segment."""
    baskets = segment_items.groupBy("invoice_no", "customer_id", "segment_code").agg(
        (F.sum("item_amount") * 10_000).cast("bigint").alias("_amount")
    )

    def median(key: str) -> DataFrame:
        medians = exact_median(baskets, [key], "_amount", "_median")
        return medians.select(key, (F.col("_median") / _AMOUNT_UNITS).alias("budget"))

    return median("customer_id"), median("segment_code")
