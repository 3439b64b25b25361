"""Thresholds of the analytics, mining and augmentation jobs."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class RfmConfig:
    score_bins: int = 5
    snapshot_frequency: str = "ME"
    minimum_history_days: int = 30


@dataclass(frozen=True)
class BasketConfig:
    global_min_support: float = 0.002
    segment_min_support: float = 0.01
    min_confidence: float = 0.25
    min_lift: float = 1.05
    min_basket_size: int = 2
    min_segment_baskets: int = 200
    max_itemset_length: int = 3
    # Limits that leave results out; none by default. Support alone bounds the products that are mined.
    max_products: int | None = None
    top_rules_per_scope: int | None = None


@dataclass(frozen=True)
class AnalyticsConfig:
    rfm: RfmConfig = field(default_factory=RfmConfig)
    basket: BasketConfig = field(default_factory=BasketConfig)

    @classmethod
    def from_toml(cls, path: str | Path) -> AnalyticsConfig:
        """Read `[rfm]` and `[basket]` tables; absent keys keep their defaults."""
        with Path(path).open("rb") as handle:
            tables = tomllib.load(handle)
        return cls(RfmConfig(**tables.get("rfm", {})), BasketConfig(**tables.get("basket", {})))


@dataclass(frozen=True)
class AugmentationConfig:
    target_rows: int = 60_000
    synthetic_customers: int = 600
    top_anchors: int = 100
    # Limits on what co-occurrence is counted over; none by default.
    relation_products: int | None = None
    max_products_per_basket: int | None = None
    min_pair_baskets: int = 4
    min_basket_size: int = 3
    max_basket_size: int = 6
    forecast_months: int = 6
    seed: int = 20_260_721
    batch_id: str = "AUG-20260721-01"
    segment_products: int = 150

    def validate(self) -> None:
        if self.target_rows < 10_000:
            raise ValueError("target_rows must be at least 10,000")
        if self.min_basket_size < 2:
            raise ValueError("min_basket_size must be at least 2")
        if self.max_basket_size < self.min_basket_size:
            raise ValueError("max_basket_size must not be below min_basket_size")
