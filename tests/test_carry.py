"""Snapshots carried from run to run."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.conftest import rows
from tillroll.config import RfmConfig
from tillroll.operators import carry, rfm
from tillroll.plans import jobs
from tillroll.sources.marts import read_manifest

D = dt.datetime


def history(seed, n=90, days=200):
    """Few invoice numbers over many days: invoices span month ends, and several customers share one."""
    rnd = random.Random(seed)
    return [
        (f"I{rnd.randint(1, 25)}", f"C{rnd.randint(1, 7)}", D(2021, 11, 3) + dt.timedelta(days=rnd.randint(0, days), hours=rnd.randint(0, 23)), "S", "x", 1, rnd.randint(1, 90))
        for _ in range(n)
    ]


def upto(data, day):
    return [r for r in data if r[2] < day]


def values(df):
    return rows(df, "snapshot_index", "snapshot_date", "customer_id", "latest_purchase_ts", "recency_days", "frequency", "monetary")


@pytest.mark.parametrize(("seed", "frequency"), [(1, "ME"), (2, "ME"), (3, "QE")])
def test_steps_give_what_a_full_run_gives(make_items, seed, frequency):
    data, cfg, state = history(seed), RfmConfig(snapshot_frequency=frequency), None
    # Within the minimum history, twice in one month, on a month end, after three months at once.
    for until in (D(2021, 11, 20), D(2021, 12, 12), D(2021, 12, 25), D(2022, 2, 1), D(2022, 5, 9), D(2023, 1, 1)):
        seen = make_items(upto(data, until))
        step = carry.advance(carry.after(seen, state), cfg, state)
        full = rfm.snapshot_values(seen, cfg)
        known = -1 if state is None else state.snapshots - 1
        assert values(step.values) == values(full.filter(f"snapshot_index > {known}"))
        state = step.state
    assert state.snapshots >= 2 and state.invoices.count() == state.invoices.distinct().count()


def test_no_new_lines_and_customers_who_do_not_return(make_items):
    items = make_items([("1", "A", D(2022, 1, 1), "S", "n", 1, 5), ("2", "B", D(2022, 3, 31), "S", "n", 1, 7)])
    first = carry.advance(items)
    assert first.state.closed == dt.date(2022, 3, 31) and first.state.snapshots == 3
    again = carry.advance(carry.after(items, first.state), state=first.state)
    assert again.state is first.state
    assert [(r.snapshot_date, r.customer_id, r.recency_days) for r in again.values.orderBy("customer_id").collect()] == [
        (dt.date(2022, 4, 1), "A", 90),
        (dt.date(2022, 4, 1), "B", 1),
    ]
    assert carry.advance(make_items([])).values.count() == 0


def test_lines_of_closed_snapshots_are_refused(make_items):
    items = make_items([("1", "A", D(2022, 1, 1), "S", "n", 1, 5), ("2", "B", D(2022, 3, 31), "S", "n", 1, 7)])
    state = carry.advance(items).state
    with pytest.raises(ValueError, match="closed up to 2022-03-31"):
        carry.advance(make_items([("3", "C", D(2022, 3, 31, 23), "S", "n", 1, 5)]), state=state)


def test_job_reads_only_new_lines_and_keeps_the_last_run_after_a_failure(spark, make_items, tmp_path, monkeypatch):
    data, folder, table = history(7), str(tmp_path / "snapshots"), str(tmp_path / "items")
    for n, until in enumerate((D(2021, 11, 20), D(2022, 1, 15), D(2022, 1, 20), D(2022, 4, 10), D(2023, 1, 1))):
        make_items(upto(data, until)).write.mode("overwrite").parquet(table)
        manifest = jobs.run_snapshots(spark.read.parquet(table), folder)
        assert rows(jobs.read_snapshots(spark, folder)) == rows(rfm.snapshots(make_items(upto(data, until))))
        if n == 1:
            assert manifest["closed"] == "2021-12-31"
            plan = carry.after(spark.read.parquet(table), carry.State(dt.date(2021, 11, 3), dt.date(2021, 12, 31), 1, None, None))
            assert "PushedFilters: [IsNotNull(invoice_ts), GreaterThanOrEqual(invoice_ts,2022-01-01" in plan._jdf.queryExecution().executedPlan().toString()
    closed = manifest["closed_rows"]
    assert manifest["read_lines_after"] == "2022-03-31" and len(closed) == len(set(closed)) == 3

    def fail(*_):
        raise RuntimeError("half-way")

    monkeypatch.setattr(jobs.rfm, "scored", fail)
    with pytest.raises(RuntimeError):
        jobs.run_snapshots(spark.read.parquet(table), folder)
    assert read_manifest(spark, folder) == manifest
    with pytest.raises(ValueError, match="other settings"):
        jobs.run_snapshots(spark.read.parquet(table), folder, RfmConfig(score_bins=4))
