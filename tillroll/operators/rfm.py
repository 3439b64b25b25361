"""Customer value over time: snapshot calendar, running aggregates, scores, segments, movements."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.config import RfmConfig
from tillroll.functions import rfm as fn
from tillroll.functions.numbers import round_ratio
from tillroll.operators import ranking
from tillroll.sources.stage import materialise

# Months per snapshot period.
_MONTHS = {"ME": 1, "QE": 3, "YE": 12}
_TRUNC = {"ME": "month", "QE": "quarter", "YE": "year"}

SCORES = {
    "r_score": ("recency_days", False),
    "f_score": ("frequency", True),
    "m_score": ("monetary", True),
}


def _step(frequency: str) -> int:
    if frequency not in _MONTHS:
        raise ValueError(f"snapshot_frequency must be one of {sorted(_MONTHS)}")
    return _MONTHS[frequency]


def _period_end(day: Column, frequency: str) -> Column:
    start = F.trunc(day, _TRUNC[frequency])
    return F.last_day(F.add_months(start, _MONTHS[frequency] - 1))


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def period_ends(first_day: Column, last_day: Column, cfg: RfmConfig) -> Column:
    """Period ends inside the observed history, once it is long enough."""
    eligible = F.date_add(first_day, cfg.minimum_history_days)
    step = F.expr(f"interval {_step(cfg.snapshot_frequency)} month")
    starts = F.sequence(F.trunc(eligible, _TRUNC[cfg.snapshot_frequency]), last_day, step)
    ends = F.transform(starts, lambda start: _period_end(start, cfg.snapshot_frequency))
    inside = F.filter(ends, lambda end: (end >= eligible) & (end <= last_day))
    return F.when(eligible <= last_day, inside).otherwise(F.array().cast("array<date>"))


def _span(items: DataFrame, cfg: RfmConfig) -> DataFrame:
    """One row: last purchase date and the period ends inside the observed history."""
    day = F.col("invoice_ts").cast("date")
    span = items.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return span.select("last_day", period_ends(F.col("first_day"), F.col("last_day"), cfg).alias("ends"))


def calendar(items: DataFrame, cfg: RfmConfig | None = None) -> DataFrame:
    """Snapshot dates with their index: period ends after the history, then the day after the last purchase."""
    cfg = cfg or RfmConfig()
    dates = F.concat("ends", F.array(F.date_add("last_day", 1)))
    span = _span(items, cfg).filter(F.col("last_day").isNotNull())
    return span.select(F.posexplode(dates).alias("snapshot_index", "snapshot_date"))


def observe(items: DataFrame, snapshot: date | str, start: datetime | str | None = None) -> DataFrame:
    """Items up to the end of the snapshot day and, when given, not before `start`."""
    day = date.fromisoformat(str(snapshot)[:10])
    end = (day + timedelta(days=1)).isoformat()
    seen = items.filter(F.col("invoice_ts") < F.lit(end).cast("timestamp_ntz"))
    if start is not None:
        seen = seen.filter(F.col("invoice_ts") >= F.lit(str(start)).cast("timestamp_ntz"))
    return seen


def rfm_base(items: DataFrame, snapshot: date | str, start: datetime | str | None = None) -> DataFrame:
    """Latest purchase, distinct invoices, money and recency per customer at one snapshot; money unrounded."""
    day = F.lit(str(snapshot)[:10]).cast("date")
    base = (
        observe(items, snapshot, start)
        .groupBy("customer_id")
        .agg(
            F.max("invoice_ts").alias("latest_purchase_ts"),
            F.count_distinct("invoice_no").alias("frequency"),
            F.sum("item_amount").alias("monetary"),
        )
    )
    return base.withColumn("snapshot_date", day).withColumn(
        "recency_days", fn.recency(F.col("latest_purchase_ts"), F.col("snapshot_date"))
    )


def sightings(items: DataFrame, span: Column, cfg: RfmConfig) -> DataFrame:
    """(customer_id, invoice_no, idx, amount, last_ts): lines merged by the first snapshot that sees them.

    `span` is a struct of the last purchase date and the period ends; the snapshot after the last end is the open one.
    """
    c = F.col
    day = c("invoice_ts").cast("date")
    first_end, end = F.get("span.ends", F.lit(0)), _period_end(day, cfg.snapshot_frequency)
    distance = (_month_number(end) - _month_number(first_end)) / _step(cfg.snapshot_frequency)
    index = F.when(
        first_end.isNotNull() & (end <= c("span.last_day")), F.greatest(F.lit(0), distance.cast("int"))
    ).otherwise(F.size("span.ends"))
    lines = items.select("customer_id", "invoice_no", "invoice_ts", "item_amount").withColumn("span", span)
    return (
        lines.select("customer_id", "invoice_no", "invoice_ts", "item_amount", index.alias("idx"))
        .groupBy("customer_id", "invoice_no", "idx")
        .agg(F.sum("item_amount").alias("amount"), F.max("invoice_ts").alias("last_ts"))
    )


def moves(merged: DataFrame, counts: Column | None = None) -> DataFrame:
    """(customer_id, idx, invoices, amount, last_ts): what each snapshot adds to a customer.

    An invoice counts once, at the first snapshot that sees any of its lines; where `counts` is false it counts not at all.
    """
    first_idx = F.min("idx").over(Window.partitionBy("customer_id", "invoice_no"))
    new = F.col("idx") == first_idx if counts is None else (F.col("idx") == first_idx) & counts
    return (
        merged.withColumn("is_first", F.when(new, 1).otherwise(0))
        .groupBy("customer_id", "idx")
        .agg(
            F.sum("is_first").alias("invoices"), F.sum("amount").alias("amount"), F.max("last_ts").alias("last_ts")
        )
    )


def running_values(added: DataFrame, span: Column) -> DataFrame:
    """Cumulative values of every customer at every snapshot of `span` since the customer's first row in `added`."""
    c = F.col
    history = Window.partitionBy("customer_id").orderBy("idx")
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = added.select(
        "customer_id",
        "idx",
        F.lead("idx").over(history).alias("next_idx"),
        F.sum("invoices").over(so_far).alias("frequency"),
        F.sum("amount").over(so_far).alias("monetary"),
        F.max("last_ts").over(so_far).alias("latest_purchase_ts"),
    ).withColumn("span", span)
    until = F.coalesce(c("next_idx") - 1, F.size("span.ends"))
    dense = running.withColumn("snapshot_index", F.explode(F.sequence("idx", until))).filter(c("snapshot_index") >= 0)
    dense = dense.withColumn(
        "snapshot_date", F.coalesce(F.get("span.ends", c("snapshot_index")), F.date_add("span.last_day", 1))
    )
    return dense.select(
        "snapshot_index",
        "snapshot_date",
        "customer_id",
        "latest_purchase_ts",
        fn.recency(c("latest_purchase_ts"), c("snapshot_date")).alias("recency_days"),
        "frequency",
        "monetary",
    )


def snapshot_values(items: DataFrame, cfg: RfmConfig | None = None) -> DataFrame:
    """Cumulative values of every customer at every snapshot since the first purchase; money unrounded.

    Each line counts from the first snapshot that sees it. Lines are merged per (customer, snapshot)
    before the running sums, and the sums are repeated for snapshots without purchases only after
    them, so the work grows with lines plus result rows and not with lines times snapshots.
    """
    cfg = cfg or RfmConfig()
    span = _span(items, cfg).select(F.struct(F.col("last_day"), F.col("ends")).alias("span")).scalar()
    return running_values(moves(sightings(items, span, cfg)), span)


def scored(values: DataFrame, cfg: RfmConfig | None = None) -> DataFrame:
    """Scores, segments and rounded money for snapshot values."""
    cfg = cfg or RfmConfig()
    values = materialise(values, "snapshot-values")
    with_scores = ranking.score(values, SCORES, cfg.score_bins, "snapshot_date", "customer_id")
    r, f, m = (F.col(name) for name in SCORES)
    return with_scores.withColumn("segment_code", fn.segment_code(r, f, m)).select(
        "snapshot_date",
        "customer_id",
        "latest_purchase_ts",
        "recency_days",
        "frequency",
        F.round("monetary", 2).cast("decimal(20,2)").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        fn.rfm_code(r, f, m).alias("rfm_score"),
        "segment_code",
        fn.segment_name(F.col("segment_code")).alias("segment_name"),
    )


def snapshots(items: DataFrame, cfg: RfmConfig | None = None) -> DataFrame:
    """Scored customers at every snapshot."""
    return scored(snapshot_values(items, cfg), cfg)


def latest(snapshot_rows: DataFrame) -> DataFrame:
    """Rows of the last snapshot."""
    last = snapshot_rows.agg(F.max("snapshot_date")).scalar()
    return snapshot_rows.filter(F.col("snapshot_date") == last)


def current(items: DataFrame, cfg: RfmConfig | None = None) -> DataFrame:
    """Scored customers at the last snapshot only, without building the earlier ones."""
    cfg = cfg or RfmConfig()
    day_after = items.agg(F.date_add(F.max(F.col("invoice_ts").cast("date")), 1)).scalar()
    base = items.groupBy("customer_id").agg(
        F.max("invoice_ts").alias("latest_purchase_ts"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum("item_amount").alias("monetary"),
    )
    values = base.withColumn("snapshot_date", day_after).withColumn(
        "recency_days", fn.recency(F.col("latest_purchase_ts"), F.col("snapshot_date"))
    )
    return scored(values, cfg)


def summarize(snapshot_rows: DataFrame) -> DataFrame:
    """Size, money, means and shares of every segment at every snapshot, largest money first."""
    per_segment = snapshot_rows.groupBy("snapshot_date", "segment_code", "segment_name").agg(
        F.count("*").alias("customer_count"),
        F.sum("monetary").alias("total_monetary"),
        F.sum("recency_days").alias("_recency"),
        F.sum("frequency").alias("_frequency"),
    )
    snapshot = Window.partitionBy("snapshot_date")
    c, customers = F.col, F.col("customer_count")

    def share(part: str) -> Column:
        return round_ratio(c(part).cast("double") / F.sum(part).over(snapshot).cast("double"), 6)

    def mean(total: str) -> Column:
        return round_ratio(c(total).cast("double") / customers, 2)

    return per_segment.select(
        "snapshot_date",
        "segment_code",
        "segment_name",
        "customer_count",
        c("total_monetary").cast("decimal(20,2)").alias("total_monetary"),
        mean("_recency").alias("average_recency_days"),
        mean("_frequency").alias("average_frequency"),
        mean("total_monetary").alias("average_monetary"),
        share("customer_count").alias("customer_share"),
        share("total_monetary").alias("monetary_share"),
    ).orderBy("snapshot_date", F.desc("total_monetary"), "segment_code")


def migrations(snapshot_rows: DataFrame) -> DataFrame:
    """Customers per movement between each pair of consecutive snapshots.

    A customer's next row is found in one window over its few snapshots, and counts only when it is of
    the very next snapshot; customers missing there drop out.
    """
    customer = Window.partitionBy("customer_id").orderBy("snapshot_date")
    arrival = F.struct("snapshot_date", "segment_code", "segment_name")
    moves = snapshot_rows.select(
        F.col("snapshot_date").alias("from_snapshot_date"),
        F.col("segment_code").alias("from_segment_code"),
        F.col("segment_name").alias("from_segment_name"),
        F.lead(arrival).over(customer).alias("to"),
    ).filter(F.col("to").isNotNull())
    counted = moves.groupBy(
        "from_segment_code",
        "from_segment_name",
        F.col("to.segment_code").alias("to_segment_code"),
        F.col("to.segment_name").alias("to_segment_name"),
        "from_snapshot_date",
        F.col("to.snapshot_date").alias("to_snapshot_date"),
    ).agg(F.count("*").alias("customer_count"))
    # One row per snapshot date, so this window is as small as the calendar.
    dates = snapshot_rows.groupBy("snapshot_date").agg(F.count("*").alias("_customers"))
    pairs = dates.select(
        F.col("snapshot_date").alias("from_snapshot_date"),
        F.lead("snapshot_date").over(Window.orderBy("snapshot_date")).alias("to_snapshot_date"),
    )
    return counted.join(pairs, ["from_snapshot_date", "to_snapshot_date"]).select(
        "from_segment_code",
        "from_segment_name",
        "to_segment_code",
        "to_segment_name",
        "customer_count",
        "from_snapshot_date",
        "to_snapshot_date",
    )


def year_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the year before last and of the last year, counted back from the last purchase."""
    last = items.agg(F.max("invoice_ts")).scalar()
    year = F.expr("interval 1 year")
    ts, current_start = F.col("invoice_ts"), last - year
    previous_start = current_start - year
    return items.filter((ts >= previous_start) & (ts < current_start)), items.filter(ts >= current_start)
