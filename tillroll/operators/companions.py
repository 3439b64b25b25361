"""Companion index: what a prediction needs to know about every anchor, counted once for all requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import fixed_values as fixed
from tillroll.operators.basket import small
from tillroll.operators.profiles import cells
from tillroll.operators.recommend import least_pairs
from tillroll.sources.stage import materialise


def companion_index(lines: DataFrame, width: int = 256) -> DataFrame:
    """(scope, anchor, stock_code, product_name, pair_baskets, anchor_baskets, baskets, total, anchor_name).

    One row for each product and companion of a scope that share enough baskets to be predicted at all; limits of
    confidence and lift are a request's. As a pair has no more baskets than either product, rare products go before any
    pair is made: of a scope, at most mean basket width over the least share are left. A basket of over `width` products
    is cut into a grid of blocks, so that its pairs spread over tasks.
    """
    c = F.col
    scopes = F.explode(F.array_distinct(F.array(F.lit(fixed.ALL_SCOPE), "source_segment_code"))).alias("scope")
    content = (
        lines.select(scopes, "invoice_no", "stock_code", "product_name")
        .dropna(subset=["scope", "invoice_no", "stock_code"])
        .groupBy("scope", "invoice_no", "stock_code")
        .agg(F.sort_array(F.collect_set("product_name")).alias("names"))
    )
    content = materialise(content, "scope-contents")
    totals = small(materialise(content.groupBy("scope").agg(F.count_distinct("invoice_no").alias("total")), "scope-totals"))
    by_code = content.groupBy("scope", "stock_code").agg(F.count("*").alias("anchor_baskets")).join(totals, "scope")
    enough = materialise(by_code.filter(c("anchor_baskets") >= least_pairs(c("total"))), "common-products")
    common = content.join(small(enough.select("scope", "stock_code")), ["scope", "stock_code"], "left_semi")

    places = common.select(F.struct("scope", "invoice_no").alias("invoice_no"), F.struct("stock_code", "names").alias("stock_code"))
    apart = cells(places, width).select("invoice_no", "low", "high", F.posexplode("firsts").alias("at", "first"), "others")
    later = F.when(c("low") == c("high"), F.slice("others", c("at") + 2, F.size("others"))).otherwise(c("others"))
    met = apart.select(c("invoice_no.scope").alias("scope"), "first", F.explode(later).alias("other"))
    both = F.array(*[F.struct(c(a).stock_code.alias("anchor"), c(b).alias("companion")) for a, b in (("first", "other"), ("other", "first"))])
    directed = met.select("scope", F.inline(both)).select(
        "scope", "anchor", c("companion.stock_code").alias("stock_code"), F.explode("companion.names").alias("product_name")
    )
    pairs = directed.groupBy("scope", "anchor", "stock_code", "product_name").agg(F.count("*").alias("pair_baskets"))

    named = common.select("scope", "stock_code", F.explode("names").alias("product_name"))
    coverage = named.groupBy("scope", "stock_code", "product_name").agg(F.count("*").alias("baskets"))
    names = lines.groupBy(c("stock_code").alias("anchor")).agg(F.max("product_name").alias("anchor_name"))
    return (
        pairs.join(small(enough.withColumnRenamed("stock_code", "anchor")), ["scope", "anchor"])
        .filter(c("pair_baskets") >= least_pairs(c("total")))
        .join(coverage, ["scope", "stock_code", "product_name"])
        .join(names, "anchor")
        .select(
            "scope", "anchor", "stock_code", "product_name", "pair_baskets", "anchor_baskets", "baskets", "total", "anchor_name"
        )
    )
