"""Snapshots carried from one run to the next: only lines after the last closed snapshot are read."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.config import RfmConfig
from tillroll.operators import rfm
from tillroll.operators.basket import small
from tillroll.sources.stage import materialise

_KEYS = ["customer_id", "invoice_no"]


@dataclass(frozen=True)
class State:
    """What is known at the last closed snapshot.

    `customers` has a customer's running values (customer_id, frequency, monetary, latest_purchase_ts), `invoices` the
    counted invoices (customer_id, invoice_no): one of them may get more lines later and must not count again.
    """

    first_day: date
    closed: date
    snapshots: int
    customers: DataFrame
    invoices: DataFrame


@dataclass(frozen=True)
class Step:
    """Values of the snapshots since the last state, the open one last, the state after those that closed, and the
    invoices that it counts and the last one did not."""

    values: DataFrame
    state: State | None
    counted: DataFrame


def after(items: DataFrame, state: State | None) -> DataFrame:
    """Lines that no closed snapshot has seen; the condition reaches the scan."""
    if state is None:
        return items
    return items.filter(F.col("invoice_ts") >= F.lit((state.closed + timedelta(days=1)).isoformat()).cast("timestamp_ntz"))


def advance(items: DataFrame, cfg: RfmConfig | None = None, state: State | None = None) -> Step:
    """Values at all snapshots since `state`, as `rfm.snapshot_values` over all history gives them.

    `items` are all lines after the last closed snapshot, and from the start without a state. Lines of closed
    snapshots are refused: they would change what has been handed out. Work grows with the new lines, the
    customers and the result; of older lines, only the stored invoice numbers that occur again are looked up.
    """
    cfg, spark = cfg or RfmConfig(), items.sparkSession
    day = F.col("invoice_ts").cast("date")
    first, last = items.agg(F.min(day), F.max(day)).first()
    if state is not None and first is not None and first <= state.closed:
        raise ValueError(f"lines of {first} belong to snapshots closed up to {state.closed}: build these again")
    first_day = state.first_day if state else first
    last_day = last or (state.closed if state else None)
    ends: list[date] = []
    if last_day is not None:
        found = spark.range(1).select(rfm.period_ends(F.lit(first_day), F.lit(last_day), cfg)).first()[0]
        ends = [end for end in found if state is None or end > state.closed]
    span = F.struct(
        F.lit(last_day).cast("date").alias("last_day"), F.array(*[F.lit(end) for end in ends]).cast("array<date>").alias("ends")
    )

    merged = materialise(rfm.sightings(items, span, cfg), "sightings")
    added = rfm.moves(merged)
    new_invoices = merged.filter(F.col("idx") < len(ends)).select(*_KEYS).distinct()
    if state is not None:
        asked = merged.select(*_KEYS).distinct()
        known = materialise(state.invoices.join(small(asked, merged.count()), _KEYS, "left_semi"), "known-invoices")
        flagged = merged.join(known.withColumn("known", F.lit(True)), _KEYS, "left")
        carried = state.customers.select(
            "customer_id",
            F.lit(-1).alias("idx"),
            F.col("frequency").alias("invoices"),
            F.col("monetary").alias("amount"),
            F.col("latest_purchase_ts").alias("last_ts"),
        )
        added = rfm.moves(flagged, F.col("known").isNull()).unionByName(carried)
        new_invoices = new_invoices.join(known, _KEYS, "left_anti")
    values = materialise(rfm.running_values(added, span), "carried-values")
    before = state.snapshots if state else 0
    numbered = values.withColumn("snapshot_index", F.col("snapshot_index") + before)
    if not ends:
        return Step(numbered, state, new_invoices)
    customers = values.filter(F.col("snapshot_index") == len(ends) - 1).select("customer_id", "frequency", "monetary", "latest_purchase_ts")
    invoices = new_invoices if state is None else state.invoices.unionByName(new_invoices)
    return Step(numbered, State(first_day, ends[-1], before + len(ends), customers, invoices), new_invoices)
