"""Scores to codes and segments."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.fixed_values import SEGMENT_NAMES


def recency(latest_purchase: Column, snapshot: Column) -> Column:
    """Whole days from the purchase's date to the snapshot."""
    return F.date_diff(snapshot, latest_purchase.cast("date"))


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    return F.concat(*[score.cast("string") for score in (r, f, m)])


def segment_code(r: Column, f: Column, m: Column) -> Column:
    """Segment of a customer; `fm` is twice the mean of the frequency and money scores."""
    fm = f + m
    return (
        F.when((r >= 4) & (fm >= 8), "CHAMPIONS")
        .when((r >= 3) & (fm >= 6), "LOYAL")
        .when((r >= 4) & (fm >= 4), "POTENTIAL")
        .when(r >= 4, "NEW")
        .when((r <= 2) & (fm >= 8), "AT_RISK")
        .when((r <= 2) & (fm >= 4), "HIBERNATING")
        .when(r >= 3, "PROMISING")
        .otherwise("GENERAL")
    )


def segment_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(text) for text in chain.from_iterable(SEGMENT_NAMES.items())])
    return names[code]
