"""Expressions over itemsets and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(itemset: Column, texts: Column) -> Column:
    """Texts of the items in item order, which is code order, joined by '|'."""
    return F.array_join(F.transform(itemset, lambda item: F.element_at(texts, item)), "|")


def masked(itemset: Column, mask: Column, bit: int) -> Column:
    """Items whose bit in `mask` equals `bit`."""
    # Spark's shiftright needs a literal shift; dividing by a power of two does the same here.
    return F.filter(
        itemset, lambda item, at: F.floor(mask / F.pow(F.lit(2), at)) % 2 == bit
    )


def rule_id(scope: Column, antecedent: Column, consequent: Column) -> Column:
    """First 16 hexadecimal digits of the SHA-1 of 'scope:antecedent>consequent'."""
    return F.substring(F.sha1(F.concat(scope, F.lit(":"), antecedent, F.lit(">"), consequent)), 1, 16)


def confidence(both: Column, antecedent: Column, baskets: Column) -> Column:
    """Ratio of the two supports, as floating values."""
    return (both / baskets) / (antecedent / baskets)


def with_metrics(counted: DataFrame) -> DataFrame:
    """Support, confidence, lift, leverage, conviction and rank from basket counts; infinite conviction is null."""
    c = F.col
    support, left, right = (c(n) / c("baskets") for n in ("support_count", "antecedent_count", "consequent_count"))
    conf = confidence(c("support_count"), c("antecedent_count"), c("baskets"))
    lift = conf / right
    return counted.select(
        "*",
        support.alias("support"),
        conf.alias("confidence"),
        lift.alias("lift"),
        (support - left * right).alias("leverage"),
        F.when(conf < 1, (F.lit(1.0) - right) / (F.lit(1.0) - conf)).alias("conviction"),
        (lift * conf * F.log1p("support_count")).alias("rank_score"),
    )
