from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.config import RfmConfig
from tillroll.functions.rfm import segment_code
from tillroll.operators import ranking, rfm
from tillroll.plans.registry import _items

D = dt.datetime


def test_scores_at_one_snapshot(value_items):
    scored = rfm.scored(rfm.rfm_base(value_items, "2022-07-15"))
    found = {r.customer_id: r for r in scored.collect()}
    assert len(found) == 12
    assert {r.r_score for r in found.values()} == {r.f_score for r in found.values()} == {1, 2, 3, 4, 5}
    assert (found["K12"].m_score, found["K01"].m_score) == (5, 1)
    assert found["K12"].frequency == 12 and float(found["K12"].monetary) == 720.0
    assert all(r.segment_name for r in found.values())


def test_summary_reconciles(value_items):
    scored = rfm.scored(rfm.rfm_base(value_items, "2022-07-15"))
    summary = rfm.summarize(scored).collect()
    assert sum(r.customer_count for r in summary) == 12
    assert sum(r.customer_share for r in summary) == pytest.approx(1.0, abs=1e-5)
    assert sum(r.monetary_share for r in summary) == pytest.approx(1.0, abs=1e-5)
    assert sum(r.total_monetary for r in summary) == sum(r.monetary for r in scored.collect())


@pytest.mark.parametrize("rows_in_group", [1, 2, 3, 5, 6, 7, 12, 99, 250])
def test_scores_equal_quantile_cut_of_ranks(spark, rows_in_group):
    values = [(1, i * 7 % 5, f"K{i:03d}") for i in range(rows_in_group)]
    df = spark.createDataFrame(values, "g int, v int, k string")
    found = {r.k: (r.up, r.down) for r in ranking.score(df, {"up": ("v", True), "down": ("v", False)}, 5, "g", "k").collect()}
    bins = min(5, rows_in_group)
    ordered = pd.Series({k: v for _, v, k in sorted(values, key=lambda r: r[2])})
    cut = pd.qcut(ordered.rank(method="first"), q=bins, labels=list(range(1, bins + 1))).astype(int)
    assert found == {k: (s, bins + 1 - s) for k, s in cut.items()}


@pytest.mark.parametrize("most_ranked", [1, 7, 100_000])
def test_runs_of_equal_values_are_cut_by_counts_of_ties(spark, most_ranked):
    """Ties of unequal length, a bin end in every second run, and values below zero."""
    values = [(g, (i * i) % 3 - 1, f"{'AB'[i % 2]}{i * 37 % 1000}") for g in (1, 2) for i in range(400 * g)]
    df = spark.createDataFrame(values, "g int, v int, k string")
    found = {(r.g, r.k): r.s for r in ranking.score(df, {"s": ("v", True)}, 5, "g", "k", most_ranked).collect()}
    for g in (1, 2):
        ordered = pd.Series({k: v for _, v, k in sorted((r for r in values if r[0] == g), key=lambda r: r[2])})
        cut = pd.qcut(ordered.rank(method="first"), q=5, labels=False) + 1
        assert {k: s for (h, k), s in found.items() if h == g} == cut.to_dict()


def test_a_million_equal_values(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("g"), F.lit(3).alias("v"), F.format_string("K%07d", "id").alias("k"))
    scored = ranking.score(df, {"s": ("v", True)}, 5, "g", "k", most_ranked=5_000)
    ends = {r.s: (r.low, r.high, r.n) for r in scored.groupBy("s").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n")).collect()}
    cut = [j * 999_999 // 5 + 1 for j in range(1, 5)]
    first, last = [0, *cut], [*[c - 1 for c in cut], 999_999]
    assert ends == {j + 1: (f"K{a:07d}", f"K{b:07d}", b - a + 1) for j, (a, b) in enumerate(zip(first, last, strict=True))}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_decimals_that_are_one_double_are_scored_in_their_own_order(spark):
    """Scores compare doubles first; values that differ beyond a double's digits still fall apart, ties by text."""
    base = Decimal("12345678901234567890.0000")
    values = [base + Decimal(i // 2) / 10_000 for i in range(20)]
    assert len({float(v) for v in values}) == 1
    df = spark.createDataFrame([("a", f"{i:02}", v, i // 8) for i, v in enumerate(values)], "g string, k string, v decimal(30,4), n bigint")
    scored = ranking.score(df.repartition(4), {"s": ("v", True), "t": ("n", False)}, 5, "g", "k")
    places = [pd.cut(pd.Series(range(1, 21)), [-1, 4.8, 8.6, 12.4, 16.2, 20], labels=False) + 1][0]
    assert [(r.s, r.t) for r in scored.orderBy("k").collect()] == [(p, 6 - p) for p in places]
    assert "< _own0#" in scored._jdf.queryExecution().optimizedPlan().toString()


def test_scores_of_snapshots_with_heavy_ties(spark, sf_dir):
    scored = rfm.snapshots(_items(spark, sf_dir)).toPandas()
    for _, day in scored.groupby("snapshot_date"):
        ranks = day.sort_values("customer_id")["frequency"].rank(method="first")
        cut = pd.qcut(ranks, q=min(5, len(day)), labels=False) + 1 if len(day) > 1 else ranks
        assert (day["f_score"] == cut.reindex(day.index)).all()


def test_wide_rows_are_not_shuffled_for_scores(spark, sf_dir):
    plan = rfm.snapshots(_items(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(snapshot_date" not in plan and "BroadcastHashJoin" in plan


def test_segment_rules(spark):
    def expected(r, f, m):
        fm = (f + m) / 2
        table = [
            (r >= 4 and fm >= 4, "CHAMPIONS"),
            (r >= 3 and fm >= 3, "LOYAL"),
            (r >= 4 and fm >= 2, "POTENTIAL"),
            (r >= 4, "NEW"),
            (r <= 2 and fm >= 4, "AT_RISK"),
            (r <= 2 and fm >= 2, "HIBERNATING"),
            (r >= 3, "PROMISING"),
        ]
        return next((name for holds, name in table if holds), "GENERAL")

    one_to_five = F.explode(F.sequence(F.lit(1), F.lit(5)))
    grid = spark.range(1).withColumn("r", one_to_five).withColumn("f", one_to_five).withColumn("m", one_to_five)
    found = grid.select("r", "f", "m", segment_code(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert len(found) == 125 and all(x.s == expected(x.r, x.f, x.m) for x in found)
    assert {x.s for x in found} == {"CHAMPIONS", "LOYAL", "POTENTIAL", "NEW", "AT_RISK", "HIBERNATING", "PROMISING", "GENERAL"}


def dates(items, **config):
    return [r.snapshot_date.isoformat() for r in rfm.calendar(items, RfmConfig(**config)).orderBy("snapshot_index").collect()]


@pytest.mark.parametrize(
    ("first", "last", "expected"),
    [
        (D(2020, 1, 1, 9), D(2020, 3, 15, 9), ["2020-01-31", "2020-02-29", "2020-03-16"]),
        (D(2020, 1, 2), D(2020, 3, 31, 23), ["2020-02-29", "2020-03-31", "2020-04-01"]),
        (D(2020, 1, 10), D(2020, 1, 20), ["2020-01-21"]),
        (D(2020, 1, 15), D(2020, 2, 20), ["2020-02-21"]),
    ],
)
def test_calendar(make_items, first, last, expected):
    items = make_items([("1", "C", first, "A", "n", 1, 1), ("2", "C", last, "A", "n", 1, 1)])
    assert dates(items) == expected
    by_hand = [d.date().isoformat() for d in pd.date_range(first.date() + dt.timedelta(30), last.date(), freq="ME")]
    assert expected[:-1] == by_hand


def test_calendar_of_no_items_and_other_periods(make_items):
    assert dates(make_items([])) == []
    items = make_items([("1", "C", D(2020, 1, 5), "A", "n", 1, 1), ("2", "C", D(2021, 2, 1), "A", "n", 1, 1)])
    assert dates(items, snapshot_frequency="QE") == ["2020-03-31", "2020-06-30", "2020-09-30", "2020-12-31", "2021-02-02"]
    with pytest.raises(ValueError):
        rfm.calendar(items, RfmConfig(snapshot_frequency="W"))


def naive(data):
    """Snapshot values by filtering all lines once per snapshot."""
    frame = pd.DataFrame(data, columns=["i", "c", "t", "s", "n", "q", "a"])
    first, last = frame.t.min().normalize(), frame.t.max().normalize()
    days = [*pd.date_range(first + pd.Timedelta(30, "D"), last, freq="ME"), last + pd.Timedelta(1, "D")]
    out = []
    for day in days:
        seen = frame[frame.t < day + pd.Timedelta(1, "D")]
        for customer, lines in seen.groupby("c"):
            latest = lines.t.max()
            out.append((day.date(), customer, (day - latest.normalize()).days, lines.i.nunique(), lines.a.sum()))
    return sorted(out)


line_strategy = st.tuples(
    st.integers(1, 6), st.integers(1, 3), st.integers(0, 130), st.integers(0, 23), st.integers(1, 9)
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(line_strategy, min_size=1, max_size=25))
def test_running_sums_equal_naive_snapshots(make_items, lines):
    # Few invoice numbers over many days: invoices span month ends, and several customers share one.
    data = [
        (f"I{i}", f"C{c}", D(2021, 11, 20) + dt.timedelta(days=d, hours=h), f"S{n}", "x", 1, a)
        for n, (i, c, d, h, a) in enumerate(lines)
    ]
    found = rfm.snapshot_values(make_items(data)).collect()
    got = sorted((r.snapshot_date, r.customer_id, r.recency_days, r.frequency, int(r.monetary)) for r in found)
    assert got == naive(data)


def test_current_equals_the_last_of_all_snapshots(spark, sf_dir):
    items = _items(spark, sf_dir)
    assert rows(rfm.current(items)) == rows(rfm.latest(rfm.snapshots(items)))


def test_migrations_count_only_consecutive_snapshots(spark):
    def row(day, customer, code):
        return (dt.date.fromisoformat(day), customer, code, code.title())

    data = [row("2020-01-31", "A", "NEW"), row("2020-02-29", "A", "LOYAL"), row("2020-03-31", "A", "LOYAL")]
    data += [row("2020-01-31", "B", "NEW"), row("2020-03-31", "B", "LOYAL"), row("2020-02-29", "C", "NEW")]
    df = spark.createDataFrame(data, "snapshot_date date, customer_id string, segment_code string, segment_name string")
    found = rfm.migrations(df).select("from_segment_code", "to_segment_code", "customer_count", "from_snapshot_date")
    assert rows(found) == [
        ("LOYAL", "LOYAL", 1, dt.date(2020, 2, 29)),
        ("NEW", "LOYAL", 1, dt.date(2020, 1, 31)),
    ]


def test_migration_totals_equal_customers_in_both(spark, sf_dir):
    rows_ = rfm.snapshots(_items(spark, sf_dir))
    per_date = {r.snapshot_date: r["count"] for r in rows_.groupBy("snapshot_date").count().collect()}
    moved = rfm.migrations(rows_).groupBy("from_snapshot_date").agg(F.sum("customer_count").alias("n")).collect()
    # History is cumulative, so every customer of a snapshot is in the next one.
    assert {r.from_snapshot_date: r.n for r in moved} == {d: n for d, n in per_date.items() if d != max(per_date)}


def test_year_windows_keep_time_of_day(make_items):
    stamps = [D(2020, 2, 29, 13, 5), D(2019, 2, 28, 13, 5), D(2019, 2, 28, 13, 4), D(2018, 2, 28, 13, 5), D(2018, 2, 28, 13, 4)]
    items = make_items([(str(n), "C", t, "A", "n", 1, 1) for n, t in enumerate(stamps)])
    previous, current = rfm.year_windows(items)
    assert sorted(r.invoice_no for r in current.collect()) == ["0", "1"]
    assert sorted(r.invoice_no for r in previous.collect()) == ["2", "3"]
