"""Market-basket mining: preparation, scopes, frequent itemsets, rules and their drift.

Every step carries `scope` as a key, so all segments, or both periods of a comparison, are mined in one
pass. A small table of scopes holds what belongs to a scope: its segment and its minimum support.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.config import BasketConfig
from tillroll.fixed_values import ALL_SCOPE, ALL_SCOPE_NAME, UNNAMED_IN_RULES
from tillroll.functions import rules as fn
from tillroll.functions.numbers import round_ratio
from tillroll.operators.warehouse import merchandise
from tillroll.sources.stage import materialise

# Broadcast hints are given only to frames with at most this many counted rows, each a few dozen bytes wide.
MAX_BROADCAST_ROWS = 500_000
# Kept products that are looked up inside a basket's row; more of them meet the lines in joins.
MAX_LOOKED_UP = 2_000

RULE_COLUMNS = [
    "rule_id",
    "segment_code",
    "segment_name",
    "antecedent_codes",
    "antecedent_names",
    "consequent_codes",
    "consequent_names",
    "support",
    "confidence",
    "lift",
    "leverage",
    "conviction",
    "coverage_basket_count",
    "scope_basket_count",
    "rank_score",
]


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint for a frame of few rows; else the planner decides.

    `rows` is a count of rows that bounds this frame's; without it a stored frame is counted.
    """
    return F.broadcast(df) if (df.count() if rows is None else rows) <= MAX_BROADCAST_ROWS else df


# --- preparation ----------------------------------------------------------------------------------


def contents(items: DataFrame, min_basket: int = 2, keys: tuple[str, ...] = ("invoice_no",), more: tuple[str, ...] = ()) -> DataFrame:
    """Keys and `content`, an array of (stock_code, customer_id, product_name, further columns): one row per basket.

    Merchandise only, in code order, in baskets with enough distinct products. Where an invoice holds a product for
    several customers, the lowest (customer, name) is kept. Lines are shuffled once.
    """
    lines = merchandise(items).dropna(subset=list(keys)).repartition(*keys)
    first = F.min(F.struct("customer_id", "product_name", *more)).alias("first")
    place = F.struct("stock_code", "first.*")
    baskets = lines.groupBy(*keys, "stock_code").agg(first).groupBy(*keys).agg(F.sort_array(F.collect_list(place)).alias("content"))
    return baskets.filter(F.size("content") >= min_basket)


def prepare(items: DataFrame, min_basket: int = 2, keys: tuple[str, ...] = ("invoice_no",)) -> DataFrame:
    """One row per (basket, product) of the contents of baskets."""
    apart = contents(items, min_basket, keys).select(*keys, F.inline("content"))
    return apart.select(*keys, "customer_id", "stock_code", "product_name")


def one_segment(segments: DataFrame) -> DataFrame:
    """One segment per customer: the lowest when a customer has several."""
    pick = F.min(F.struct("segment_code", "segment_name")).alias("pick")
    return segments.groupBy("customer_id").agg(pick).select("customer_id", "pick.segment_code", "pick.segment_name")


def scope_table(df: DataFrame, segments: DataFrame | None, cfg: BasketConfig) -> DataFrame:
    """Scope, segment code and name, and minimum support, stored: one row per segment and one for all customers."""
    everyone = df.sparkSession.range(1).select(
        F.lit(ALL_SCOPE).alias("scope"),
        F.lit(ALL_SCOPE).alias("segment_code"),
        F.lit(ALL_SCOPE_NAME).alias("segment_name"),
        F.lit(cfg.global_min_support).alias("min_support"),
    )
    if segments is None:
        return everyone
    named = segments.groupBy("segment_code").agg(F.min("segment_name").alias("segment_name"))
    named = named.select(F.col("segment_code").alias("scope"), "*", F.lit(cfg.segment_min_support).alias("min_support"))
    return materialise(everyone.unionByName(named), "scopes")


def prepared_baskets(items: DataFrame, segments: DataFrame | None, cfg: BasketConfig) -> DataFrame:
    """(scope, invoice_no, content), stored: the baskets of all customers, with each customer's segment as `own_scope` in
    `content`.

    Segments are joined to the lines before these are shuffled by invoice; every step up to the kept baskets then reads one
    row per basket, not one per basket and scope.
    """
    lines = items.select("invoice_no", "customer_id", "stock_code", "product_name")
    if segments is not None:
        lines = lines.join(one_segment(segments).select("customer_id", F.col("segment_code").alias("own_scope")), "customer_id", "left")
    baskets = contents(with_own_scope(lines), cfg.min_basket_size, more=("own_scope",))
    return materialise(baskets.select(F.lit(ALL_SCOPE).alias("scope"), "invoice_no", "content"), "prepared-baskets")


def with_own_scope(lines: DataFrame) -> DataFrame:
    """Lines that have a second scope, null where there is none."""
    return lines if "own_scope" in lines.columns else lines.withColumn("own_scope", F.lit(None).cast("string"))


def lines_of(baskets: DataFrame) -> DataFrame:
    """One row per basket and product."""
    return baskets.select("scope", "invoice_no", F.inline("content"))


def own_sizes(baskets: DataFrame, cfg: BasketConfig) -> DataFrame:
    """Segments with enough baskets and their number of baskets."""
    codes = F.array_distinct(F.array_compact("content.own_scope"))
    sizes = baskets.select(F.explode(codes).alias("scope")).groupBy("scope").agg(F.count("*").alias("baskets"))
    return sizes.filter(F.col("baskets") >= cfg.min_segment_baskets)


def basket_counts(baskets: DataFrame, scopes: DataFrame, cfg: BasketConfig) -> DataFrame:
    """Scopes that are mined with their number of baskets, from prepared baskets."""
    sizes = baskets.groupBy("scope").agg(F.count("*").alias("baskets"))
    return sizes.unionByName(own_sizes(baskets, cfg)).join(small(scopes), "scope")


def scoped_lines(items: DataFrame, segments: DataFrame | None, cfg: BasketConfig) -> DataFrame:
    """Prepared lines under every scope that is mined."""
    return expand_scopes(prepared_baskets(items, segments, cfg), cfg)


def expand_scopes(baskets: DataFrame, cfg: BasketConfig) -> DataFrame:
    """Lines of prepared baskets once under the scope of all customers and once under their own, if that is mined."""
    columns = ["scope", "invoice_no", "customer_id", "stock_code", "product_name"]
    lines = lines_of(baskets)
    mined = small(materialise(own_sizes(baskets, cfg).select("scope"), "mined-segments"))
    own = lines.drop("scope").withColumnRenamed("own_scope", "scope").join(mined, "scope", "left_semi")
    return lines.select(*columns).unionByName(own.select(*columns))


def scope_sizes(lines: DataFrame, scopes: DataFrame) -> DataFrame:
    """Scopes with their number of baskets, from lines."""
    sizes = lines.groupBy("scope").agg(F.count_distinct("invoice_no").alias("baskets"))
    return sizes.join(small(scopes), "scope")


def scope_products(lines: DataFrame, sizes: DataFrame, cfg: BasketConfig) -> DataFrame:
    """Products per scope that reach the minimum coverage, numbered in code order.

    The coverage bounds them: at most mean basket width over minimum support, so a window per scope is short.
    """
    needed = F.greatest(F.lit(2), F.ceil(F.col("baskets") * F.col("min_support")))
    both = F.explode(F.array_compact(F.array("scope", "own_scope"))).alias("scope")
    counts = with_own_scope(lines).groupBy("scope", "own_scope", "stock_code").agg(F.count("*").alias("lines"))
    coverage = counts.select(both, "stock_code", "lines").groupBy("scope", "stock_code").agg(F.sum("lines").alias("coverage"))
    enough = coverage.join(sizes, "scope").filter((F.col("baskets") >= 2) & (F.col("coverage") >= needed))
    if cfg.max_products is not None:
        popular = Window.partitionBy("scope").orderBy(F.desc("coverage"), "stock_code")
        enough = enough.withColumn("_rank", F.row_number().over(popular)).filter(F.col("_rank") <= cfg.max_products)
    by_code = Window.partitionBy("scope").orderBy("stock_code")
    return enough.select("scope", "stock_code", "coverage", F.row_number().over(by_code).alias("item"))


def scope_baskets(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Baskets that hold at least two of the stored kept products, as arrays of (item number, name) in code order.

    A line is shuffled once with its numbers in both its scopes; a basket is then dealt out to the scopes it holds.
    """
    c = F.col
    numbers = products.select("scope", "stock_code", "item")
    own = numbers.select(c("scope").alias("own_scope"), "stock_code", c("item").alias("own_item"))
    numbered = with_own_scope(lines).join(small(numbers), ["scope", "stock_code"], "left")
    numbered = numbered.join(small(own), ["own_scope", "stock_code"], "left").filter(F.coalesce("item", "own_item").isNotNull())
    place = F.struct("stock_code", "item", "own_item", "own_scope", "product_name")
    return _dealt(numbered.groupBy("scope", "invoice_no").agg(F.sort_array(F.collect_list(place)).alias("held")))


def kept_baskets(prepared: DataFrame, products: DataFrame, most: int = MAX_LOOKED_UP) -> DataFrame:
    """The same from prepared baskets, whose rows hold a whole basket: products are looked up there and nothing is shuffled.

    Over `most` kept products meet the lines in joins instead.
    """
    rows, scopes = products.agg(F.count("*"), F.count_distinct("scope")).first()
    if rows > most:
        return scope_baskets(lines_of(prepared), products)
    number = _numbers(products, max(1, rows // max(1, scopes)))
    place = lambda at: F.struct(
        number(F.col("scope"), at["stock_code"]).alias("item"),
        number(at["own_scope"], at["stock_code"]).alias("own_item"),
        at["own_scope"].alias("own_scope"),
        at["product_name"].alias("product_name"),
    )
    return _dealt(prepared.select("scope", "invoice_no", F.transform("content", place).alias("held")))


def _numbers(products: DataFrame, buckets: int) -> Callable[[Column, Column], Column]:
    """The number of a kept product in a scope, else null.

    The products of a scope lie in `buckets` small maps by hash, so that a search meets few of them; lambdas cannot hold
    subqueries, so these few rows become a constant.
    """
    bucket = lambda code: F.pmod(F.hash(code), F.lit(buckets))
    table: dict[str, list[dict[str, int]]] = {}
    for row in products.select("scope", "stock_code", "item", bucket(F.col("stock_code")).alias("bucket")).collect():
        table.setdefault(row.scope, [{} for _ in range(buckets)])[row.bucket][row.stock_code] = row.item
    constant = F.from_json(F.lit(json.dumps(table)), "map<string,array<map<string,int>>>")
    return lambda scope, code: F.try_element_at(F.get(F.try_element_at(constant, scope), bucket(code)), code)


def _dealt(held: DataFrame) -> DataFrame:
    """Baskets of all customers, their products numbered in both scopes and in code order, dealt out to the scopes they hold."""
    c = F.col
    named = lambda items, number: F.transform(
        items, lambda at: F.struct(at[number].alias("item"), at["product_name"].alias("product_name"))
    )
    whole = F.struct("scope", named(F.filter("held", lambda at: at["item"].isNotNull()), "item").alias("content"))
    owned = F.filter("held", lambda at: at["own_item"].isNotNull())
    parts = F.transform(
        F.array_distinct(c("owned.own_scope")),
        lambda part: F.struct(part.alias("scope"), named(F.filter("owned", lambda at: at["own_scope"] == part), "own_item").alias("content")),
    )
    dealt = held.withColumn("owned", owned).select("invoice_no", F.inline(F.concat(F.array(whole), parts)))
    return dealt.filter(F.size("content") >= 2).select("scope", "invoice_no", "content")


def product_catalog(baskets: DataFrame, products: DataFrame) -> DataFrame:
    """Last name of every product per scope; a missing name reads as the fixed label and sorts last.

    Names are made distinct first, which combines before the shuffle without a sort of the lines.
    """
    name = F.coalesce("product_name", F.lit(UNNAMED_IN_RULES))
    names = baskets.select("scope", F.inline("content")).select("scope", "item", name.alias("product_name")).distinct()
    names = names.groupBy("scope", "item").agg(F.max("product_name").alias("product_name"))
    return names.join(products.select("scope", "item", "stock_code"), ["scope", "item"])


# --- frequent itemsets ----------------------------------------------------------------------------


def basket_sizes(baskets: DataFrame, scopes: DataFrame) -> DataFrame:
    """Scopes with the baskets that are left and the count an itemset needs there."""
    sizes = baskets.groupBy("scope").agg(F.count("*").alias("baskets")).filter(F.col("baskets") >= 2)
    needed = F.ceil(F.col("baskets") * F.col("min_support")).alias("needed")
    return sizes.join(small(scopes), "scope").select("scope", "baskets", needed)


def _wide_starts(numbers: DataFrame, width: int) -> DataFrame:
    """(scope, invoice_no, item, later, own): the items of wide baskets, each with the later ones of one block.

    A basket is cut into blocks of `width` items in order; every two blocks meet in a cell with a key of its own, so the
    pairs of a basket are spread over tasks. `own` marks the row of an item's own block.
    """
    c = F.col
    last = ((F.size("later") - 1) / width).cast("int")
    blocks = numbers.select("scope", "invoice_no", "later", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("block"))
    blocks = blocks.select("scope", "invoice_no", "last", "block", F.slice("later", c("block") * width + 1, F.lit(width)).alias("part"))
    dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), c("last"))))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    half = lambda side: F.first(F.when(c("block") == c(side), c("part")), ignorenulls=True)
    cells = dealt.groupBy("scope", "invoice_no", "low", "high").agg(half("low").alias("firsts"), half("high").alias("others"))
    apart = cells.select("scope", "invoice_no", (c("low") == c("high")).alias("own"), F.posexplode("firsts").alias("at", "item"), "others")
    later = F.when(c("own"), F.slice("others", c("at") + 2, F.size("others"))).otherwise(c("others"))
    return apart.select("scope", "invoice_no", "item", later.alias("later"), "own")


def itemsets(baskets: DataFrame, sizes: DataFrame, cfg: BasketConfig, width: int = 512) -> DataFrame:
    """Itemsets up to the configured length that reach the minimum support, with counts.

    Level by level. A basket becomes one row per (first item, later items), so a wide basket does not
    stay in one row; one of over `width` items is dealt out as a grid of blocks first. Each level keeps, per row, only
    the later items that form a frequent pair with every item chosen before the last; an item has at most mean basket
    width over minimum support of those. Items are grouping columns of their own until an itemset is frequent. Counting combines on the map side, so distinct itemsets are shuffled and not
    occurrences. `sizes` is stored.
    """
    c = F.col
    few_sizes = small(sizes)

    def frequent(occurrences: DataFrame, keys: list[str], itemset: Column, label: str) -> DataFrame:
        counts = occurrences.groupBy("scope", *keys).agg(F.count("*").alias("support_count"))
        enough = counts.join(few_sizes, "scope").filter(c("support_count") >= c("needed"))
        return materialise(enough.select("scope", itemset.alias("itemset"), "support_count", "baskets"), label)

    def step(rows: DataFrame, *chosen: str) -> DataFrame:
        """Each later item becomes the chosen one, with the items after it as the later ones."""
        apart = rows.select("scope", *chosen, F.posexplode("later").alias("at", "item"), "later")
        return apart.select("scope", *chosen, "item", F.slice("later", c("at") + 2, F.size("later")).alias("later"))

    numbers = baskets.select("scope", "invoice_no", c("content.item").alias("later"))
    starts = step(numbers.filter(F.size("later") <= width))
    wide = _wide_starts(numbers.filter(F.size("later") > width), width)
    every = starts.withColumn("own", F.lit(True)).unionByName(wide.drop("invoice_no"))
    one = F.array(c("item"))
    if cfg.max_itemset_length == 1:
        return frequent(every.filter("own"), ["item"], one, "itemsets-1")
    # One row per chosen item counts the item itself, as 0, and its pairs with the later items.
    others = F.when(c("own"), F.concat(F.array(F.lit(0)), "later")).otherwise(c("later"))
    itemset = F.when(c("other") == 0, one).otherwise(F.array("item", "other"))
    short = frequent(every.select("scope", "item", F.explode(others).alias("other")), ["item", "other"], itemset, "itemsets-2")
    found = [short]
    if cfg.max_itemset_length >= 3:
        pairs = short.filter(F.size("itemset") == 2)
        near = pairs.groupBy("scope", c("itemset")[0].alias("item")).agg(F.collect_list(c("itemset")[1]).alias("near"))
        near = small(near, pairs.count())
        partners = F.array_intersect("later", "near").alias("later")
        # The parts of a wide basket are put together again once frequent pairs have thinned them out.
        parts = wide.join(near, ["scope", "item"]).select("scope", "invoice_no", "item", partners)
        whole = parts.groupBy("scope", "invoice_no", "item").agg(F.sort_array(F.flatten(F.collect_list("later"))).alias("later"))
        grown = starts.filter(F.size("later") >= 2).join(near, ["scope", "item"]).select("scope", c("item").alias("item_1"), partners)
        grown = grown.unionByName(whole.select("scope", c("item").alias("item_1"), "later"))
    for length in range(3, cfg.max_itemset_length + 1):
        chosen = [f"item_{at}" for at in range(1, length)]
        grown = step(grown.filter(F.size("later") >= 2), *chosen[:-1]).filter(F.size("later") > 0).withColumnRenamed("item", chosen[-1])
        counted = grown.select("scope", *chosen, F.explode("later").alias("last"))
        found.append(frequent(counted, [*chosen, "last"], F.array(*chosen, "last"), f"itemsets-{length}"))
        if length < cfg.max_itemset_length:
            # The item just chosen narrows the later items to its own frequent partners.
            grown = grown.withColumnRenamed(chosen[-1], "item").join(near, ["scope", "item"])
            grown = grown.select("scope", *chosen[:-1], c("item").alias(chosen[-1]), partners)
    return reduce(DataFrame.unionByName, found)


def with_texts(frequent: DataFrame, catalog: DataFrame) -> DataFrame:
    """Itemsets with their products' codes and names, each joined by '|' in code order."""
    c = F.col
    apart = frequent.select("scope", "itemset", F.posexplode("itemset").alias("at", "item"))
    texts = apart.join(catalog, ["scope", "item"]).groupBy("scope", "itemset")
    texts = texts.agg(F.sort_array(F.collect_list(F.struct("at", "stock_code", "product_name"))).alias("of"))
    texts = texts.select(
        "scope",
        "itemset",
        F.array_join(c("of")["stock_code"], "|").alias("codes"),
        F.array_join(c("of")["product_name"], "|").alias("names"),
    )
    return frequent.join(texts, ["scope", "itemset"])


def named_itemsets(frequent: DataFrame, catalog: DataFrame) -> DataFrame:
    """Itemsets with product codes joined by '|' in code order."""
    return with_texts(frequent, catalog).select(
        "scope",
        "codes",
        F.size("itemset").alias("length"),
        "support_count",
        F.col("baskets").alias("scope_basket_count"),
    )


# --- rules ----------------------------------------------------------------------------------------


def rules(frequent: DataFrame, cfg: BasketConfig) -> DataFrame:
    """Rules from every split of every itemset with texts, with metrics, above the confidence and lift limits."""
    c = F.col
    whole = frequent.filter(F.size("itemset") >= 2)
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.size("itemset")) - 2).cast("int"))
    splits = whole.select("scope", "itemset", "support_count", "baskets", F.explode(masks).alias("mask")).select(
        "scope",
        "support_count",
        "baskets",
        fn.masked(c("itemset"), c("mask"), 1).alias("antecedent"),
        fn.masked(c("itemset"), c("mask"), 0).alias("consequent"),
    )
    left, right = (
        frequent.select(
            "scope",
            c("itemset").alias(side),
            c("support_count").alias(f"{side}_count"),
            c("codes").alias(f"{side}_codes"),
            c("names").alias(f"{side}_names"),
        )
        for side in ("antecedent", "consequent")
    )
    confident = splits.join(left, ["scope", "antecedent"]).filter(
        fn.confidence(c("support_count"), c("antecedent_count"), c("baskets")) >= cfg.min_confidence
    )
    return fn.with_metrics(confident.join(right, ["scope", "consequent"])).filter(c("lift") >= cfg.min_lift)


def top_rules(measured: DataFrame, scopes: DataFrame, limit: int | None = None) -> DataFrame:
    """Rules in the mart layout, with `scope`: all, or the best `limit` per scope, equal ranks in code order."""
    c = F.col
    kept = measured.join(small(scopes), "scope")
    if limit is not None:
        best = Window.partitionBy("scope").orderBy(
            F.desc("rank_score"), F.desc("lift"), F.desc("support_count"), "antecedent_codes", "consequent_codes"
        )
        kept = kept.withColumn("_position", F.row_number().over(best)).filter(c("_position") <= limit)
    metrics = ["support", "confidence", "lift", "leverage", "conviction", "rank_score"]
    identifier = fn.rule_id(c("segment_code"), c("antecedent_codes"), c("consequent_codes"))
    return kept.withColumns(
        {name: round_ratio(c(name), 6) for name in metrics}
        | {
            "rule_id": identifier,
            "coverage_basket_count": c("support_count"),
            "scope_basket_count": c("baskets"),
        }
    ).select("scope", *RULE_COLUMNS)


def mine_contents(prepared: DataFrame, scopes: DataFrame, cfg: BasketConfig, limit: int | None = None) -> DataFrame:
    """Rules of every scope of prepared baskets."""
    lines = lines_of(prepared)
    products = materialise(scope_products(lines, basket_counts(prepared, scopes, cfg), cfg), "scope-products")
    baskets = materialise(kept_baskets(prepared, products), "scope-baskets")
    sizes = materialise(basket_sizes(baskets, scopes), "basket-sizes")
    frequent = with_texts(itemsets(baskets, sizes, cfg), product_catalog(baskets, products))
    measured = rules(materialise(frequent, "named-itemsets"), cfg)
    return top_rules(measured, scopes, cfg.top_rules_per_scope if limit is None else limit)


def mine(
    items: DataFrame, segments: DataFrame | None = None, cfg: BasketConfig | None = None, limit: int | None = None
) -> DataFrame:
    """Rules for all customers and, with `segments`, for every segment, in one keyed pass."""
    cfg = cfg or BasketConfig()
    prepared = prepared_baskets(items, segments, cfg)
    return mine_contents(prepared, scope_table(items, segments, cfg), cfg, limit).select(*RULE_COLUMNS)


# --- drift ----------------------------------------------------------------------------------------


def mine_periods(previous: DataFrame, current: DataFrame, cfg: BasketConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """All rules of all customers in two periods, mined in one pass with the period as scope.

    A limit per scope would show a rule beyond it as new or dropped, so none is applied here.
    """
    cfg = cfg or BasketConfig()
    periods = {"previous": previous, "current": current}
    both = [df.withColumn("scope", F.lit(name)) for name, df in periods.items()]
    lines = with_own_scope(reduce(DataFrame.unionByName, both))
    prepared = contents(lines, cfg.min_basket_size, ("scope", "invoice_no"), ("own_scope",))
    cfg = replace(cfg, top_rules_per_scope=None)
    everyone = scope_table(previous, None, cfg)
    scopes = everyone.withColumn("scope", F.explode(F.array(*[F.lit(name) for name in periods])))
    found = materialise(mine_contents(materialise(prepared, "period-baskets"), scopes, cfg), "period-rules")
    before, after = (found.filter(F.col("scope") == name).select(*RULE_COLUMNS) for name in periods)
    return before, after


def drift(previous: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Rules of two periods side by side; names come from the current period."""
    keys = ["segment_code", "antecedent_codes", "consequent_codes"]
    metrics = ["support", "confidence", "lift", "coverage_basket_count"]
    names = ["segment_name", "antecedent_names", "consequent_names"]
    before = previous.select(*keys, *[F.col(m).alias(f"previous_{m}") for m in metrics])
    after = current.select(*keys, *names, *[F.col(m).alias(f"current_{m}") for m in metrics])
    both = before.join(after, keys, "full_outer")
    lift_delta = F.col("current_lift") - F.col("previous_lift")
    status = (
        F.when(F.col("previous_lift").isNull(), "NEW")
        .when(F.col("current_lift").isNull(), "DROPPED")
        .when(lift_delta > threshold, "GROWING")
        .when(lift_delta < -threshold, "DECLINING")
        .otherwise("STABLE")
    )
    return (
        both.withColumn("lift_delta", lift_delta)
        .withColumn("support_delta", F.col("current_support") - F.col("previous_support"))
        .withColumn("drift_status", status)
        .orderBy("drift_status", F.desc_nulls_last("current_lift"), *keys)
    )


def drift_counts(drifted: DataFrame) -> DataFrame:
    return drifted.groupBy("drift_status").agg(F.count("*").alias("rule_count"))
