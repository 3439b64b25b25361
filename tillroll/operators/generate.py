"""Scenario baskets drawn from observed relations, segments and budgets.

Everything about a basket follows from its number and the seed, so baskets are generated in parallel
and any lost part is generated again unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import fixed_values as fixed
from tillroll.config import AugmentationConfig
from tillroll.functions import random as rnd
from tillroll.functions.numbers import round_ratio
from tillroll.operators import profiles as pf
from tillroll.operators.basket import small
from tillroll.operators.warehouse import positive_rows
from tillroll.schemas import BASKET_ITEM_COLUMNS, MARTS
from tillroll.sources.stage import materialise

# A draw looks at this many candidates that are left; relations after the first offer this many.
_DRAW_FROM = 30
_OTHER_RELATIONS = 9


@dataclass(frozen=True)
class SizePlan:
    """Basket sizes that add up to the target: equal blocks of all sizes, then a tail."""

    sizes: tuple[int, ...]
    blocks: int
    tail: tuple[int, ...]


def plan_sizes(rows: int, smallest: int, largest: int) -> SizePlan:
    """Sizes that add up to `rows` exactly without a basket of one line."""
    sizes = tuple(range(min(smallest, largest), largest + 1))
    per_block = sum(sizes)
    blocks, rest = divmod(rows, per_block)
    while True:
        baskets = -(-rest // largest)
        tail = tuple(rest // baskets + (i < rest % baskets) for i in range(baskets)) if baskets else ()
        if all(size >= 2 for size in tail):
            return SizePlan(sizes, blocks, tail)
        if not blocks:
            raise ValueError(f"{rows} rows cannot be split into baskets of 2 to {largest} lines")
        blocks, rest = blocks - 1, rest + per_block


def basket_numbers(spark: SparkSession, plan: SizePlan, seed: int) -> DataFrame:
    """One row per basket: number from 1, lines before it, size."""
    c = F.col
    per_block, per_block_baskets = sum(plan.sizes), len(plan.sizes)
    keyed = F.transform(
        F.array(*[F.lit(size) for size in plan.sizes]),
        lambda size: F.struct(rnd.uniform(seed, "size", c("id"), size).alias("key"), size.alias("size")),
    )
    blocks = spark.range(plan.blocks).select("id", F.sort_array(keyed)["size"].alias("sizes"))
    before = F.aggregate(F.slice("sizes", F.lit(1), c("at")), F.lit(0).cast("bigint"), lambda a, s: a + s)
    regular = blocks.select("id", "sizes", F.posexplode("sizes").alias("at", "size")).select(
        (c("id") * per_block_baskets + c("at") + 1).alias("number"), (c("id") * per_block + before).alias("first_line"), "size"
    )
    if not plan.tail:
        return regular
    sizes = F.array(*[F.lit(size) for size in plan.tail])
    last = spark.range(1).select(sizes.alias("sizes"), F.posexplode(sizes).alias("at", "size")).select(
        (F.lit(plan.blocks * per_block_baskets) + c("at") + 1).cast("bigint").alias("number"),
        (F.lit(plan.blocks * per_block) + before).alias("first_line"),
        "size",
    )
    return regular.unionByName(last)


def synthetic_pool(sizes: DataFrame, customers: int) -> DataFrame:
    """First number and size of each segment's range of new customers, in proportion to `customer_count`."""
    c = F.col
    by_code = Window.orderBy("segment_code")  # one row per segment
    upto = F.sum("customer_count").over(by_code.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("customer_count").over(Window.partitionBy())
    ends = sizes.select(
        "segment_code",
        F.round(customers * (upto - c("customer_count")) / total).cast("bigint").alias("_start"),
        F.round(customers * upto / total).cast("bigint").alias("_end"),
    )
    return ends.select("segment_code", (c("_start") + 1).alias("pool_first"), (c("_end") - c("_start")).alias("pool_size"))


def _synthetic_id(number: Column) -> Column:
    return F.format_string("SYN-C%06d", number)


@dataclass(frozen=True)
class Context:
    """Stored inputs of the generator; all but the customers are small."""

    anchor_count: int
    product_count: int
    choices: DataFrame
    candidates: DataFrame
    segments: DataFrame
    customer_buckets: DataFrame
    bucket_count: int
    customer_strata: DataFrame
    customers: DataFrame
    max_basket_size: int
    last_day: Column


def _product(prefix: str = "") -> Column:
    columns = ["stock_code", "product_name", "median_unit_price", "median_quantity"]
    return F.struct(*[F.col(prefix + name).alias(name) for name in columns])


def _candidates(
    anchors: DataFrame, choices: DataFrame, related: DataFrame, segment_best: DataFrame, goods: DataFrame, cfg: AugmentationConfig
) -> DataFrame:
    """Per anchor and segment: the products every basket starts with, and fillers in order of preference.

    A draw never reaches beyond the first candidates that are left, so keeping the first
    `30 + basket size` fillers loses nothing. The best sellers at the end of the list fill it up to
    that number wherever there are so many products.
    """
    c = F.col
    known = goods.select("stock_code", _product().alias("product"))
    by_rank = F.sort_array(F.collect_list(F.struct("relation_rank", "product", "generation_confidence")))
    partners = (
        related.filter(c("relation_rank") <= 1 + _OTHER_RELATIONS)
        .join(known, c("companion_code") == c("stock_code"))
        .groupBy(c("anchor_code").alias("anchor"))
        .agg(by_rank.alias("related"))
    )
    segment_list = (
        segment_best.join(known, "stock_code")
        .groupBy("segment_code")
        .agg(F.sort_array(F.collect_list(F.struct("product_rank", "product")))["product"].alias("popular"))
    )
    fallback = (
        pf.best_sellers(goods, _DRAW_FROM + cfg.max_basket_size + 2)
        .select("sales_rank", _product().alias("product"))
        .agg(F.sort_array(F.collect_list(F.struct("sales_rank", "product")))["product"].alias("products"))
        .scalar()
    )
    pairs = anchors.select("anchor_index", c("stock_code").alias("anchor"), _product().alias("anchor_product"))
    pairs = pairs.join(choices.select("anchor_index", F.explode("choices.segment_code").alias("segment_code")), "anchor_index")
    full = pairs.join(partners, "anchor").join(segment_list, "segment_code", "left")
    start = F.array(c("anchor_product"), c("related")[0]["product"])
    no_products = F.array().cast(full.schema["popular"].dataType)
    wanted = F.concat(
        F.slice(c("related")["product"], 2, _OTHER_RELATIONS), F.coalesce("popular", no_products), fallback
    )
    fillers = F.slice(F.array_except(wanted, start), 1, _DRAW_FROM + cfg.max_basket_size)
    return full.select(
        "anchor_index",
        "segment_code",
        start.alias("start"),
        fillers.alias("fillers"),
        c("related")[0]["generation_confidence"].alias("generation_confidence"),
    )


def _with_running_share(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds `upto`: share of the keys' weight up to and including each row."""
    group = Window.partitionBy(*keys)
    upto = F.sum("weight").over(group.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("upto", upto / F.sum("weight").over(group))


def _cell(share: Column, cells: int) -> Column:
    return F.least(F.floor(share * cells), F.lit(cells - 1))


def _share_cells(shares: DataFrame, cells: int) -> DataFrame:
    """(segment_code, cell, buckets): the range of shares in `cells` equal parts, each with the buckets that reach into it.

    `shares` has each bucket's running share `upto` within its segment. A draw looks at its own cell's few buckets only,
    whatever their number; the last bucket reaches to the end, so a draw beyond all shares finds it.
    """
    c = F.col
    in_order = Window.partitionBy("segment_code").orderBy("bucket")
    reach = shares.select(
        "segment_code",
        "bucket",
        "upto",
        F.lag("upto", 1, 0.0).over(in_order).alias("since"),
        F.lead("bucket").over(in_order).isNull().alias("is_last"),
    )
    until = F.when(c("is_last"), F.lit(cells - 1)).otherwise(_cell(c("upto"), cells))
    apart = reach.select("segment_code", "bucket", "upto", F.explode(F.sequence(_cell(c("since"), cells), until)).alias("cell"))
    return apart.groupBy("segment_code", "cell").agg(F.sort_array(F.collect_list(F.struct("bucket", "upto"))).alias("buckets"))


def prepare_context(items: DataFrame, segments: DataFrame, cfg: AugmentationConfig) -> Context:
    """Profiles, relations, segment pools and budgets for the generator."""
    c = F.col
    goods = materialise(pf.profiles(items), "profiles")
    product_count = goods.count()
    if min(cfg.max_basket_size, product_count) < 2:
        raise ValueError("not enough merchandise products for a valid basket")
    pairs, counts = pf.pair_counts(items, goods, cfg)
    related = materialise(pf.relations(pairs, counts, items, cfg), "relations")
    anchors = materialise(pf.anchors(goods, related, cfg.top_anchors), "anchors")
    anchor_count = anchors.count()
    if not anchor_count:
        raise ValueError("no anchor product has a relation")

    segment_items = materialise(pf.with_segment(items, segments), "segment-items")
    weights = materialise(pf.customer_weights(segment_items), "customer-weights")
    sizes = weights.groupBy("segment_code").agg(F.count("*").alias("customer_count"))
    customer_budget, segment_budget = pf.budgets(segment_items)

    # Segment choices per anchor; an anchor that no segment buys is spread over all segments evenly.
    shares = pf.anchor_segments(segment_items).join(anchors.select("anchor_index", "stock_code"), "stock_code", "right")
    every = sizes.agg(F.sort_array(F.collect_list(F.struct("segment_code", F.lit(1.0).alias("share"))))).scalar()
    listed = shares.groupBy("anchor_index").agg(
        F.sort_array(F.collect_list(F.when(c("segment_code").isNotNull(), F.struct("segment_code", "share")))).alias("own")
    )
    listed = listed.select("anchor_index", F.when(F.size("own") > 0, c("own")).otherwise(every).alias("own"))
    listed = materialise(listed, "anchor-segments")
    choices = listed.select("anchor_index", rnd.running_shares(c("own"), "share").alias("choices"))
    best = pf.restrict(pf.segment_products(segment_items, cfg.segment_products), goods)

    # Existing customers: bucket, then order count, then position, each drawn by its weight. With as many buckets
    # as customers in one, neither the list of buckets nor a bucket's window grows with the customers themselves.
    buckets = math.ceil(math.sqrt(weights.count()))
    place = Window.partitionBy("segment_code", "bucket", "order_count").orderBy("customer_id")
    bucketed = weights.withColumn("bucket", rnd.below(F.lit(buckets), cfg.seed, "customer", c("customer_id")))
    customers = bucketed.withColumn("place", F.row_number().over(place) - 1).join(customer_budget, "customer_id", "left")
    customers = materialise(
        customers.select("segment_code", "bucket", "order_count", "place", "customer_id", "budget"), "customers"
    )
    strata = customers.groupBy("segment_code", "bucket", "order_count").agg(F.count("*").alias("members"))
    strata = _with_running_share(strata.withColumn("weight", c("members") * F.sqrt("order_count")), ["segment_code", "bucket"], "order_count")
    per_bucket = strata.groupBy("segment_code", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("order_count", "members", "upto"))).alias("strata"),
        F.sum("weight").alias("weight"),
    )
    per_bucket = materialise(per_bucket, "customer-buckets")
    bucket_shares = _with_running_share(per_bucket, ["segment_code"], "bucket")
    segment_rows = (
        sizes.join(synthetic_pool(sizes, cfg.synthetic_customers), "segment_code")
        .join(per_bucket.select("segment_code").distinct(), "segment_code", "left_semi")
        .join(segment_budget.select("segment_code", c("budget").alias("segment_budget")), "segment_code", "left")
        .select("segment_code", "pool_first", "pool_size", "segment_budget")
    )
    candidates = materialise(_candidates(anchors, choices, related, best, goods, cfg), "candidates")
    largest = min(cfg.max_basket_size, product_count)
    least = candidates.agg(F.min(F.size("start") + F.size("fillers"))).first()[0]
    if least is None or least < largest:
        raise ValueError(f"baskets of {largest} products cannot be drawn from {least or 0} candidates")
    return Context(
        anchor_count=anchor_count,
        product_count=product_count,
        choices=choices,
        candidates=candidates,
        segments=materialise(segment_rows, "segment-rows"),
        customer_buckets=materialise(_share_cells(bucket_shares, buckets), "bucket-cells"),
        bucket_count=buckets,
        customer_strata=per_bucket.select("segment_code", "bucket", "strata"),
        customers=customers,
        max_basket_size=largest,
        last_day=items.agg(F.max(c("invoice_ts").cast("date"))).scalar(),
    )


def _draw_products(cfg: AugmentationConfig) -> Column:
    """The starting products and as many different fillers as the basket needs."""
    number, c = F.col("number"), F.col

    def draw(state: Column, turn: Column) -> Column:
        rest = state["rest"]

        def take(at: Column) -> Column:
            left = F.concat(F.slice(rest, F.lit(1), at), F.slice(rest, at + 2, F.size(rest)))
            return F.struct(left.alias("rest"), F.concat(state["taken"], F.slice(rest, at + 1, F.lit(1))).alias("taken"))

        at = rnd.below(F.least(F.size(rest), F.lit(_DRAW_FROM)), cfg.seed, "filler", number, turn).cast("int")
        # One-element transform: binds the place once instead of drawing it for every use.
        return F.transform(F.array(at), take)[0]

    first = F.slice("start", F.lit(1), c("size"))
    turns = F.slice(F.sequence(F.lit(0), F.lit(cfg.max_basket_size)), F.lit(1), F.greatest(F.lit(0), c("size") - F.size(first)))
    # Places in the list of fillers are drawn, so that no draw copies the products themselves.
    places = F.slice(F.sequence(F.lit(0), F.size("fillers")), F.lit(1), F.size("fillers"))
    state = F.struct(places.alias("rest"), F.array().cast("array<int>").alias("taken"))
    return F.concat(first, F.transform(F.aggregate(turns, state, draw)["taken"], lambda at: F.get(c("fillers"), at)))


def generate_lines(spark: SparkSession, context: Context, cfg: AugmentationConfig) -> DataFrame:
    """Scenario lines, exactly `target_rows` of them, in the mart layout."""
    c, number, seed = F.col, F.col("number"), cfg.seed
    plan = plan_sizes(cfg.target_rows, cfg.min_basket_size, context.max_basket_size)
    baskets = basket_numbers(spark, plan, seed).withColumn(
        "anchor_index", ((number - 1) % context.anchor_count).cast("int")
    )
    baskets = baskets.join(small(context.choices, context.anchor_count), "anchor_index").withColumn(
        "segment_code", rnd.pick(c("choices"), rnd.uniform(seed, "segment", number))["segment_code"]
    )
    baskets = baskets.drop("choices").join(small(context.segments), "segment_code")
    is_new = (c("pool_size") > 0) & (rnd.uniform(seed, "new-customer", number) < 0.2)
    new_id = _synthetic_id(c("pool_first") + rnd.below(c("pool_size"), seed, "pool", number))
    shared = ["number", "first_line", "size", "anchor_index", "segment_code"]
    fresh = baskets.filter(is_new).select(*shared, new_id.alias("customer_id"), c("segment_budget").alias("budget"))

    drawn = baskets.filter(~is_new).select(*shared, "segment_budget", rnd.uniform(seed, "bucket", number).alias("u"))
    drawn = drawn.withColumn("cell", _cell(c("u"), context.bucket_count))
    drawn = drawn.join(small(context.customer_buckets), ["segment_code", "cell"]).select(
        *shared, "segment_budget", rnd.pick(c("buckets"), c("u"))["bucket"].alias("bucket")
    )
    drawn = drawn.join(small(context.customer_strata), ["segment_code", "bucket"])
    drawn = drawn.withColumn("stratum", rnd.pick(c("strata"), rnd.uniform(seed, "stratum", number)))
    drawn = drawn.select(
        *shared,
        "segment_budget",
        "bucket",
        c("stratum.order_count").alias("order_count"),
        rnd.below(c("stratum.members"), seed, "place", number).cast("int").alias("place"),
    )
    known = drawn.join(context.customers, ["segment_code", "bucket", "order_count", "place"]).select(
        *shared, "customer_id", F.coalesce("budget", "segment_budget").alias("budget")
    )

    filled = fresh.unionByName(known).join(
        small(context.candidates), ["anchor_index", "segment_code"]
    )
    filled = filled.withColumn("products", _draw_products(cfg))
    pieces = F.transform(
        "products",
        lambda product, at: F.greatest(
            F.lit(1.0),
            F.least(
                F.lit(72.0),
                F.rint(F.greatest(product["median_quantity"], F.lit(1.0)) * rnd.log_normal(0.0, 0.25, seed, "pieces", number, at)),
            ),
        ),
    )
    filled = filled.withColumn("pieces", pieces)
    cost = F.aggregate(
        F.zip_with("products", "pieces", lambda product, count: product["median_unit_price"] * count),
        F.lit(0.0),
        lambda a, b: a + b,
    )
    base = F.log(F.greatest(F.coalesce("budget", F.lit(100.0)), F.lit(10.0)))
    target = F.greatest(F.lit(8.0), F.least(F.lit(5000.0), rnd.log_normal(base, 0.32, seed, "budget", number)))
    start = F.date_add(context.last_day, 1)
    days = F.date_diff(F.add_months(start, cfg.forecast_months), start)
    day = F.date_add(start, rnd.below(days, seed, "day", number).cast("int"))
    clock = F.make_dt_interval(
        F.lit(0),
        (rnd.below(F.lit(11), seed, "hour", number) + 8).cast("int"),
        rnd.below(F.lit(60), seed, "minute", number).cast("int"),
        rnd.below(F.lit(60), seed, "second", number).cast("decimal(18,6)"),
    )
    filled = filled.withColumn("scale", target / F.greatest(cost, F.lit(0.01))).withColumn(
        "invoice_ts", day.cast("timestamp_ntz") + clock
    )
    lines = filled.select(
        "*", F.posexplode(F.arrays_zip("products", "pieces")).alias("at", "line")
    ).withColumn("quantity", F.greatest(F.lit(1.0), F.least(F.lit(96.0), F.rint(c("line.pieces") * c("scale")))))
    amount = F.round(c("quantity").cast("decimal(10,0)") * c("line.products.median_unit_price").cast("decimal(20,6)"), 4)
    columns = {
        "synthetic_line_id": F.format_string(f"{cfg.batch_id}-%08d", c("first_line") + c("at") + 1),
        "invoice_no": F.format_string(f"SYN-{cfg.batch_id}-%07d", number),
        "customer_id": c("customer_id"),
        "invoice_ts": c("invoice_ts"),
        "stock_code": c("line.products.stock_code"),
        "product_name": c("line.products.product_name"),
        "item_quantity": c("quantity"),
        "item_amount": amount,
        "source_segment_code": c("segment_code"),
        "generation_confidence": round_ratio(c("generation_confidence"), 6),
        "generation_model": F.lit(fixed.GENERATION_MODEL),
        "generation_batch_id": F.lit(cfg.batch_id),
    }
    kinds = MARTS["synthetic_transaction"].schema
    return lines.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in kinds.fields])


def generate(items: DataFrame, segments: DataFrame, cfg: AugmentationConfig | None = None) -> tuple[DataFrame, Context]:
    """Scenario lines from observed items, and the context they were drawn from."""
    cfg = cfg or AugmentationConfig()
    cfg.validate()
    source = materialise(positive_rows(items), "source-items")
    context = prepare_context(source, segments, cfg)
    return generate_lines(items.sparkSession, context, cfg), context


def quality_report(lines: DataFrame, cfg: AugmentationConfig, anchor_count: int, product_count: int) -> DataFrame:
    """One row that describes generated lines."""
    new_customer = F.when(F.col("customer_id").startswith("SYN-C"), F.col("customer_id"))
    rows = F.count("*")
    mean = F.sum("generation_confidence") / F.nullif(rows, F.lit(0)).cast("decimal(20,0)")
    coverage = anchor_count / max(1, min(cfg.top_anchors, product_count))
    return lines.agg(
        F.lit(cfg.batch_id).alias("generation_batch_id"),
        F.lit(fixed.GENERATION_MODEL).alias("generation_model"),
        rows.alias("synthetic_row_count"),
        F.count_distinct("invoice_no").alias("synthetic_order_count"),
        F.count_distinct("customer_id").alias("synthetic_customer_count"),
        F.count_distinct(new_customer).alias("new_synthetic_customer_count"),
        F.lit(anchor_count).alias("anchor_product_count"),
        F.lit(round(coverage, 6)).alias("relationship_anchor_coverage"),
        F.round(mean, 6).cast("decimal(12,6)").alias("average_generation_confidence"),
        F.min("generation_confidence").alias("minimum_generation_confidence"),
        F.round(F.sum("item_amount"), 2).cast("decimal(20,2)").alias("sales_amount"),
        F.min((F.col("item_amount") > 0).cast("int")).alias("all_amounts_positive"),
        F.min((F.col("item_quantity") > 0).cast("int")).alias("all_quantities_positive"),
        F.min("invoice_ts").alias("forecast_start"),
        F.max("invoice_ts").alias("forecast_end"),
    )


def augment(items: DataFrame, lines: DataFrame, batch: str) -> DataFrame:
    """Observed and generated rows together, each with its origin."""
    observed = items.withColumns(
        {
            "data_origin": F.lit(fixed.ORIGIN_REAL),
            "source_segment_code": F.lit(""),
            "generation_confidence": F.lit(1.0),
            "generation_batch_id": F.lit(""),
        }
    )
    generated = lines.withColumns(
        {
            "data_origin": F.lit(fixed.ORIGIN_GENERATED),
            "item_quantity": F.col("item_quantity").cast("bigint"),
            "generation_confidence": F.col("generation_confidence").cast("double"),
            "generation_batch_id": F.lit(batch),
        }
    )
    return observed.select(*BASKET_ITEM_COLUMNS).unionByName(generated.select(*BASKET_ITEM_COLUMNS))
