"""The jobs: ingest, warehouse, analytics, mart load and scenario augmentation.

Ingest, analytics and augmentation write into a folder of their own run and the run's manifest last, so readers never
meet the outputs of a run that failed. Intermediate tables are deleted when a job ends.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.config import AnalyticsConfig, AugmentationConfig, RfmConfig
from tillroll.operators import audit, basket, carry, checks, generate, kpi, rfm
from tillroll.operators import warehouse as wh
from tillroll.operators.companions import companion_index
from tillroll.operators.warehouse import positive_rows
from tillroll.schemas import MARTS
from tillroll.sources.buckets import write_buckets
from tillroll.sources.items import export_tsv
from tillroll.sources.marts import new_run, publish_marts, read_manifest, store_output, to_contract, write_manifest
from tillroll.sources.raw import batch_id, ingest, read_period_csv, read_raw, reject_table, write_raw
from tillroll.sources.stage import scratch
from tillroll.sources.tables import read_fact, read_table, write_fact, write_table

# Warehouse tables after the fact table, in build order.
_TABLES = {
    "dim_product": wh.dim_product,
    "dim_customer": wh.dim_customer,
    "dim_country": wh.dim_country,
    "dws_basket_summary": wh.basket_summary,
    "dws_basket_item": wh.basket_item,
    "dws_customer_monthly_value": wh.customer_monthly,
    "dws_customer_purchase_summary": wh.customer_summary,
    "ads_business_overview": wh.ads_overview,
    "ads_monthly_sales": wh.ads_monthly,
    "ads_data_quality_summary": wh.ads_quality,
}

# Analytic outputs and the marts they fill.
_OUTPUT_MARTS = {
    "business_overview": "business_overview",
    "monthly_sales": "monthly_sale",
    "rfm_snapshots": "rfm_customer_snapshot",
    "rfm_segment_summary": "rfm_segment_summary",
    "segment_migrations": "segment_migration",
    "association_rules": "association_rule",
    "rule_drift": "rule_drift",
    "top_products": "top_product",
}


def run_ingest(
    spark: SparkSession,
    periods: Mapping[str, str],
    folder: str,
    identifier: str | None = None,
    multi_line: bool = False,
    on_error: str = "raise",
    most_rejected: int | None = None,
) -> dict:
    """Landing files from the CSV files of each period, the lines that could not be landed, and an audit of both.

    Every file's header is checked. Lines that are broken go to the reject table; text that is no number fails the job, or
    goes there with `on_error` 'reject'. With more than `most_rejected` of them the run fails before its manifest, and
    its reject table stays to be looked at. The manifest has the batch, both paths and the audit per period and in all.
    """
    run, identifier = new_run(folder), identifier or batch_id()
    sources = {tag: read_period_csv(spark, path, multi_line) for tag, path in periods.items()}
    write_raw(ingest(sources, identifier, on_error), f"{run}/raw")
    rejected = store_output(reject_table(sources, identifier, on_error), run, "rejects")
    counted = audit.with_rejects(audit.ingest_audit(read_raw(spark, f"{run}/raw")), rejected)
    counted = store_output(counted, run, "audit")
    rows = [row.asDict() for row in counted.orderBy("source_year").collect()]
    lost = sum(row["rejected_rows"] for row in rows if row["source_year"] == audit.TOTAL)
    if most_rejected is not None and lost > most_rejected:
        raise ValueError(f"{lost} lines rejected, {most_rejected} allowed: see {run}/rejects")
    manifest = {"ingest_batch_id": identifier, "raw": f"{run}/raw", "rejects": f"{run}/rejects", "audit": rows}
    write_manifest(spark, run, manifest)
    return manifest


def build_warehouse(raw: DataFrame, folder: str, fmt: str = "orc") -> dict[str, DataFrame]:
    """Write the fact table, then all dimensions, aggregates and summaries from it; return them read back.

    `checks` in the result compares the layers.
    """
    spark = raw.sparkSession
    write_fact(wh.clean(raw), f"{folder}/dwd_order_item", fmt)
    fact = read_fact(spark, f"{folder}/dwd_order_item", fmt)
    frames = {"dwd_order_item": fact}
    for name, build in _TABLES.items():
        write_table(build(fact), f"{folder}/{name}", fmt)
        frames[name] = read_table(spark, f"{folder}/{name}", fmt)
    frames["checks"] = checks.recon_report(raw, fact, frames["dws_basket_summary"], frames["ads_business_overview"])
    return frames


def export_warehouse(frames: dict[str, DataFrame], folder: str) -> None:
    """Tab-separated exports: basket items, monthly sales by month, quality by row count."""
    export_tsv(frames["dws_basket_item"], f"{folder}/basket_items")
    export_tsv(frames["ads_monthly_sales"], f"{folder}/monthly_sales", [F.col("invoice_month")])
    export_tsv(
        frames["ads_data_quality_summary"], f"{folder}/data_quality", [F.desc("row_count"), F.col("quality_status")]
    )


def run_analytics(items: DataFrame, folder: str, cfg: AnalyticsConfig | None = None) -> dict:
    """All analytic outputs of stored basket items, each written once and read back where it feeds another."""
    with scratch(items.sparkSession):
        return _run_analytics(items, new_run(folder), cfg or AnalyticsConfig())


def _run_analytics(items: DataFrame, folder: str, cfg: AnalyticsConfig) -> dict:
    spark = items.sparkSession
    out: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        out[name] = store_output(df, folder, name)
        return out[name]

    snapshots = store("rfm_snapshots", rfm.snapshots(items, cfg.rfm))
    customers = store("rfm_customers", rfm.latest(snapshots))
    store("rfm_segment_summary", rfm.summarize(snapshots))
    store("segment_migrations", rfm.migrations(snapshots))
    segments = customers.select("customer_id", "segment_code", "segment_name")
    store("association_rules", basket.mine(items, segments, cfg.basket))
    previous, current = rfm.year_windows(items)
    store("rule_drift", basket.drift(*basket.mine_periods(previous, current, cfg.basket)))
    store("monthly_sales", kpi.kpi_monthly(items))
    store("top_products", kpi.top_products(items))
    store("business_overview", kpi.kpi_overview(items))
    manifest = {
        "output_folder": folder,
        "final_snapshot_date": customers.agg(F.max("snapshot_date")).first()[0],
        "transaction_row_count": items.count(),
        "rfm_customer_count": customers.count(),
        "association_rule_count": out["association_rules"].count(),
        "rule_drift_count": out["rule_drift"].count(),
        "config": asdict(cfg),
        "outputs": {name: f"{folder}/{name}" for name in out},
    }
    write_manifest(spark, folder, manifest)
    return manifest


def run_snapshots(items: DataFrame, folder: str, cfg: RfmConfig | None = None) -> dict:
    """Scored customers at the snapshots since the last run, from the lines since then; the first run does all.

    `items` is the whole stored table; the filter on time reaches its scan. A run appends the scored rows of the
    snapshots that closed, the running values and the newly counted invoices, and replaces the rows of the open snapshot. A
    failed run leaves the last one's manifest, and the next starts from there.
    """
    with scratch(items.sparkSession):
        return _run_snapshots(items, folder, cfg or RfmConfig())


def _run_snapshots(items: DataFrame, folder: str, cfg: RfmConfig) -> dict:
    spark, run = items.sparkSession, new_run(folder)
    before = read_manifest(spark, folder, {"closed": None, "closed_rows": [], "invoices": []})
    if before["closed"] and before["config"] != asdict(cfg):
        raise ValueError("snapshots were started with other settings: use another folder")
    state = None
    if before["closed"]:
        days = (date.fromisoformat(before[name]) for name in ("first_day", "closed"))
        state = carry.State(*days, before["snapshots"], spark.read.parquet(before["customers"]), spark.read.parquet(*before["invoices"]))
    step = carry.advance(carry.after(items, state), cfg, state)
    is_open = F.col("snapshot_date") > F.lit(step.state.closed if step.state else None)
    scored = store_output(rfm.scored(step.values, cfg).withColumn("is_open", F.coalesce(is_open, F.lit(True))), run, "scored")
    manifest = before | {"config": asdict(cfg), "open_rows": f"{run}/scored", "read_lines_after": before["closed"]}
    if step.state is not None and step.state is not state:
        store_output(step.state.customers, run, "customers")
        store_output(step.counted, run, "invoices")
        manifest |= {
            "first_day": step.state.first_day,
            "closed": step.state.closed,
            "snapshots": step.state.snapshots,
            "customers": f"{run}/customers",
            "invoices": [*before["invoices"], f"{run}/invoices"],
            "closed_rows": [*before["closed_rows"], f"{run}/scored"],
        }
    manifest["new_rows"] = scored.count()
    write_manifest(spark, run, manifest)
    return read_manifest(spark, folder)


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Scored customers at every closed snapshot and at the open one of the newest run."""
    manifest = read_manifest(spark, folder)
    open_rows = spark.read.parquet(manifest["open_rows"]).filter("is_open")
    if not manifest["closed_rows"]:
        return open_rows.drop("is_open")
    return spark.read.parquet(*manifest["closed_rows"]).filter("NOT is_open").unionByName(open_rows).drop("is_open")


def load_marts(spark: SparkSession, outputs: str, marts: str, synthetic: str | None = None) -> dict[str, int]:
    """Publish the marts from the newest finished analytics run and, if given, generated lines."""
    paths = read_manifest(spark, outputs)["outputs"]
    frames = {mart: spark.read.parquet(paths[name]) for name, mart in _OUTPUT_MARTS.items()}
    if synthetic:
        frames["synthetic_transaction"] = spark.read.schema(MARTS["synthetic_transaction"].schema).parquet(synthetic)
    return publish_marts(frames, marts)


def run_augmentation(
    items: DataFrame, segments: DataFrame, folder: str, cfg: AugmentationConfig | None = None
) -> dict:
    """Generated lines, their companion index, the augmented basket items and a manifest with the quality report.

    `real_row_count` counts the rows as given, `clean_row_count` those that were positive and complete;
    `augmented_row_count` is the latter plus the generated lines.
    """
    with scratch(items.sparkSession):
        return _run_augmentation(items, segments, new_run(folder), cfg or AugmentationConfig())


def _run_augmentation(items: DataFrame, segments: DataFrame, folder: str, cfg: AugmentationConfig) -> dict:
    spark = items.sparkSession
    lines, context = generate.generate(items, segments, cfg)
    lines = store_output(to_contract(lines, MARTS["synthetic_transaction"]), folder, "synthetic_transactions")
    clean = positive_rows(items)
    augmented = generate.augment(clean, lines, cfg.batch_id)
    export_tsv(augmented, f"{folder}/augmented_items")
    index = write_buckets(companion_index(lines), f"{folder}/companion_index", ["scope", "anchor"])
    report = generate.quality_report(lines, cfg, context.anchor_count, context.product_count).first().asDict()
    clean_rows = clean.count()
    manifest = {
        **report,
        "config": asdict(cfg),
        "real_row_count": items.count(),
        "clean_row_count": clean_rows,
        "augmented_row_count": clean_rows + report["synthetic_row_count"],
        "augmented_items": f"{folder}/augmented_items",
        "synthetic_transactions": f"{folder}/synthetic_transactions",
        "companion_index": index,
    }
    write_manifest(spark, folder, manifest)
    return manifest


__all__ = [
    "build_warehouse",
    "export_warehouse",
    "load_marts",
    "read_snapshots",
    "run_analytics",
    "run_augmentation",
    "run_ingest",
    "run_snapshots",
]
