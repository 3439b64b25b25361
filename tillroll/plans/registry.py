"""Queries over the sample tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import standardise as std
from tillroll.functions.numbers import round_ratio
from tillroll.config import AugmentationConfig, BasketConfig
from tillroll.operators import audit, basket, carry, checks, generate, kpi, profiles, recommend, rfm, serving, warehouse
from tillroll.operators.companions import companion_index
from tillroll.plans.monthly import MonthlyWarehouse, refresh_warehouse
from tillroll.schemas import MARTS
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import items as item_files
from tillroll.sources import raw as raw_files
from tillroll.sources import sample_tables as sample
from tillroll.sources.buckets import read_buckets, write_buckets
from tillroll.sources.marts import contract_report, to_contract
from tillroll.sources.stage import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _portable(column: str, kind: T.DataType) -> Column:
    """Plain result types: decimals as double, dates as ISO text, flags as int."""
    if isinstance(kind, T.DecimalType):
        return F.col(column).cast("double").alias(column)
    if isinstance(kind, T.DateType):
        return F.col(column).cast("string").alias(column)
    if isinstance(kind, (T.ByteType, T.BooleanType)):
        return F.col(column).cast("int").alias(column)
    return F.col(column)


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under `name`; its result gets plain types."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            return df.select(*[_portable(field.name, field.dataType) for field in df.schema.fields])

        if name in QUERIES:
            raise ValueError(f"there is a query {name} already")
        QUERIES[name] = run
        return run

    return register


def _on_fact(name: str, operator: Callable[[DataFrame], DataFrame], product: str = "brand", faults: bool = True) -> None:
    query(name)(lambda spark, sf_dir: operator(sample.fact(spark, sf_dir, product, faults)))


def _on_items(name: str, operator: Callable[[DataFrame], DataFrame], product: str = "brand") -> None:
    query(name)(lambda spark, sf_dir: operator(sample.basket_items(spark, sf_dir, product)))


# --- standardisation and ingest -------------------------------------------------------------------


@query("std_identifier")
def std_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        std.norm_id(F.col("o_custkey").cast("double"), T.DoubleType()).alias("whole_double"),
        std.norm_id(F.col("o_orderkey"), T.LongType()).alias("whole_number"),
        std.norm_id(F.col("o_totalprice"), T.DoubleType()).alias("fraction"),
        std.norm_id(F.concat(F.lit("\t "), "o_orderpriority", F.lit("  ")), T.StringType()).alias("padded_text"),
        std.norm_id(F.expr("nullif(o_orderstatus, 'F')"), T.StringType()).alias("nullable_text"),
    )


@query("std_text")
def std_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = sample.table(spark, sf_dir, "documents")
    return documents.select("doc_id", std.norm_text(F.col("text")).alias("std_text"))


@query("std_decimal")
def std_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    lines = sample.table(spark, sf_dir, "lineitem").withColumn("cents", cents)
    pieces = F.col("l_quantity").cast("bigint")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        std.norm_decimal(pieces).alias("plain"),
        std.norm_decimal(F.concat(F.lit(" +0"), pieces, F.lit("E2 "))).alias("exponent_up"),
        std.norm_decimal(F.concat("cents", F.lit("e-2"))).alias("exponent_down"),
        std.norm_decimal(F.concat("cents", F.lit("0e-3"))).alias("kept_scale"),
        std.norm_decimal(F.lit(" ")).alias("blank"),
        std.norm_decimal(F.col("l_extendedprice") * 1e6, data_type=T.DoubleType()).alias("from_double"),
    )


@query("std_timestamp")
def std_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        std.norm_ts(ts, T.TimestampNTZType()).alias("from_timestamp"),
        std.norm_ts(ts.cast("date"), T.DateType()).alias("from_date"),
        std.norm_ts(F.concat(F.lit("  "), ts.cast("string"), F.lit(" ")), T.StringType()).alias("from_text"),
        std.norm_ts(F.when(F.col("o_orderstatus") != "F", ts), T.TimestampNTZType()).alias("nullable_ts"),
    )


@query("std_union")
def std_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sample.raw_lines(spark, sf_dir).select(
        F.col("invoice_no").alias("Invoice"),
        F.col("stock_code").alias("StockCode"),
        F.concat(F.lit(" "), F.regexp_replace("description", " ", "  ")).alias("Description"),
        F.col("quantity").cast("int").alias("Quantity"),
        F.col("invoice_ts").cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("unit_price").cast("decimal(18,4)").alias("Price"),
        F.col("customer_id").cast("double").alias("Customer ID"),
        F.col("country").alias("Country"),
    )
    early = F.col("InvoiceDate") < F.lit("1998-01-01").cast("timestamp_ntz")
    periods = {"Years to 1997": lines.filter(early), "Years from 1998": lines.filter(~early)}
    return raw_files.ingest(periods, sample.BATCH)


query("ingest_audit")(lambda spark, sf_dir: audit.ingest_audit(sample.raw_lines(spark, sf_dir, faults=True)))


@query("ingest_rejects")
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of period files of which some lines are broken or hold a quantity that is no number."""
    files = sample.period_files(spark, sf_dir, f"{ensure_checkpoint_dir(spark)}/period-files-{uuid4().hex}")
    sources = {tag: raw_files.read_period_csv(spark, path) for tag, path in files.items()}
    rejected = raw_files.reject_table(sources, sample.BATCH, "reject")
    landed = raw_files.ingest(sources, sample.BATCH, "reject")
    return audit.with_rejects(audit.ingest_audit(landed), rejected)


query("source_profile")(lambda spark, sf_dir: audit.source_profile(sample.raw_lines(spark, sf_dir, faults=True)))
query("top_countries")(lambda spark, sf_dir: audit.top_countries(sample.raw_lines(spark, sf_dir, faults=True)))


def _broken_quantity(number: Column) -> Column:
    """Quantity as text, unreadable on some lines and with half a piece on others."""
    text = F.col("item_quantity").cast("string")
    return F.when(number % 13 == 0, "n/a").when(number % 11 == 0, F.concat(text, F.lit(".5"))).otherwise(
        F.concat(text, F.lit(".0"))
    )


@query("load_basket_items")
def load_basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("invoice_no").cast("bigint")
    items = sample.basket_items(spark, sf_dir)
    texts = items.select(
        "invoice_no",
        "customer_id",
        F.col("invoice_ts").cast("string").alias("invoice_ts"),
        "stock_code",
        F.when(number % 19 == 0, "").otherwise(F.col("product_name")).alias("product_name"),
        _broken_quantity(number).alias("item_quantity"),
        F.when(number % 17 == 0, "").otherwise(F.col("item_amount").cast("string")).alias("item_amount"),
        *[
            F.lit(None).cast("string").alias(name)
            for name in ("data_origin", "source_segment_code", "generation_confidence", "generation_batch_id")
        ],
    )
    return item_files.type_basket_items(texts)


# --- warehouse ------------------------------------------------------------------------------------

_on_fact("dwd_clean", lambda fact: fact.drop("quality_status", "is_valid_analysis"), faults=False)
_on_fact(
    "dwd_quality",
    lambda fact: fact.select(
        "invoice_no", "stock_code", "quantity", "unit_price", "customer_id", "quality_status", "is_valid_analysis"
    ),
)
_on_fact("dim_product", warehouse.dim_product, product="part")
_on_fact("dim_customer", warehouse.dim_customer)
_on_fact("dim_country", warehouse.dim_country)
_on_fact("dws_basket_summary", warehouse.basket_summary)
_on_items("dws_basket_item", lambda items: items)
_on_fact("dws_customer_monthly", warehouse.customer_monthly, faults=False)
_on_fact("dws_customer_summary", warehouse.customer_summary, faults=False)
_on_fact("ads_overview", warehouse.ads_overview)
_on_fact("ads_monthly_sales", warehouse.ads_monthly)
_on_fact("ads_quality_summary", warehouse.ads_quality)
_on_fact("check_status_dist", checks.check_status)
_on_fact("check_valid_kpis", checks.check_valid)
_on_fact("check_basket_recon", lambda fact: checks.check_baskets(warehouse.basket_summary(fact)))
_on_fact("check_ads_recon", lambda fact: checks.check_overview(warehouse.ads_overview(fact)))


def _monthly(spark: SparkSession, sf_dir: str) -> MonthlyWarehouse:
    """Monthly parts of two refreshes: all lines but some of 1998, then those, which come late."""
    folder = f"{ensure_checkpoint_dir(spark)}/monthly-{uuid4().hex}"
    order = F.regexp_replace("invoice_no", "^C", "").cast("bigint")
    late = (order % 7 == 0) & F.col("invoice_ts").startswith("1998")
    batch = F.when(late, "late").otherwise("main")
    lines = materialise(sample.raw_lines(spark, sf_dir, faults=True).withColumn("ingest_batch_id", batch), "raw-lines")
    for name in ("main", "late"):
        refresh_warehouse(lines.filter(F.col("ingest_batch_id") == name), folder)
    return MonthlyWarehouse(spark, folder)


query("monthly_overview")(lambda spark, sf_dir: _monthly(spark, sf_dir).tables()["ads_business_overview"])
query("monthly_countries")(lambda spark, sf_dir: _monthly(spark, sf_dir).tables()["dim_country"])
query("monthly_baskets")(lambda spark, sf_dir: _monthly(spark, sf_dir).tables()["dws_basket_summary"])
query("overview_by_year")(lambda spark, sf_dir: _monthly(spark, sf_dir).by_period(4))


@query("check_row_counts")
def check_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.raw_lines(spark, sf_dir, faults=True)
    return checks.check_rows(raw, warehouse.clean(raw))


@query("recon_report")
def recon_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.raw_lines(spark, sf_dir, faults=True)
    fact = warehouse.clean(raw)
    return checks.recon_report(raw, fact, warehouse.basket_summary(fact), warehouse.ads_overview(fact))


@query("merchandise_items")
def merchandise_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("item_quantity") % 7 == 0, "post").otherwise(F.col("stock_code"))
    items = sample.basket_items(spark, sf_dir).withColumn("stock_code", code)
    return warehouse.merchandise(items).select("invoice_no", "customer_id", "stock_code", "item_quantity")


@query("positive_transactions")
def positive_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("invoice_no").cast("bigint")
    items = sample.basket_items(spark, sf_dir).withColumns(
        {
            "item_quantity": _broken_quantity(number),
            "item_amount": F.when(number % 17 == 0, -F.col("item_amount")).otherwise(F.col("item_amount")),
        }
    )
    kept = warehouse.positive_rows(items)
    return kept.select("invoice_no", "customer_id", "stock_code", "item_quantity", "item_amount")


_on_items("kpi_overview", kpi.kpi_overview)
_on_items("kpi_monthly", kpi.kpi_monthly)
_on_items("top_products", kpi.top_products)
_on_items("top_products_by_part", kpi.top_products, product="part")


# --- customer value -------------------------------------------------------------------------------

_on_items(
    "rfm_observation_window",
    lambda items: rfm.observe(items, "1999-12-31", "1998-06-15").select(
        "invoice_no", "customer_id", "stock_code", "invoice_ts", "item_amount"
    ),
)
_on_items("rfm_calendar", rfm.calendar)
_on_items("rfm_base", lambda items: rfm.rfm_base(items, "1999-12-31"))
query("rfm_snapshots")(lambda spark, sf_dir: rfm.snapshot_values(_items(spark, sf_dir)))


@query("rfm_snapshots_carried")
def rfm_snapshots_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshots from three runs, each of which reads the lines since the last closed snapshot only."""
    items, state, closed = _items(spark, sf_dir), None, []
    for until in ("1997-05-20", "1999-09-30", None):
        seen = items if until is None else items.filter(F.col("invoice_ts") < F.lit(until).cast("timestamp_ntz"))
        step = carry.advance(carry.after(seen, state), state=state)
        state = step.state
        closed.append(step.values if until is None or state is None else step.values.filter(F.col("snapshot_date") <= F.lit(state.closed)))
    return reduce(DataFrame.unionByName, closed)


@query("year_windows")
def year_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["invoice_no", "customer_id", "stock_code", "invoice_ts"]
    previous, current = rfm.year_windows(sample.basket_items(spark, sf_dir).select(*columns))
    tagged = [df.select(F.lit(name).alias("window_name"), *columns) for name, df in (("current", current), ("previous", previous))]
    return tagged[0].unionByName(tagged[1])


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.snapshots(_items(spark, sf_dir))


def _on_snapshots(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: operator(_snapshots(spark, sf_dir)))


_on_snapshots(
    "rfm_scores",
    lambda rows: rows.select("snapshot_date", "customer_id", "monetary", "r_score", "f_score", "m_score", "rfm_score"),
)
_on_snapshots("rfm_segments", lambda rows: rows)
_on_snapshots("rfm_latest", rfm.latest)
_on_snapshots("rfm_segment_summary", rfm.summarize)
_on_snapshots("segment_migrations", rfm.migrations)


# --- baskets and rules ----------------------------------------------------------------------------

# Confidence limits under which the evenly spread sample tables have rules at all.
_RULES = BasketConfig(min_confidence=0.15)
_WIDE_RULES = BasketConfig(min_confidence=0.005)
_SCOPE_RULES = BasketConfig(min_confidence=0.05)


def _items(spark: SparkSession, sf_dir: str, product: str = "brand") -> DataFrame:
    """Basket items as a stored table, the way jobs after the warehouse get them."""
    return materialise(sample.basket_items(spark, sf_dir, product), "items")


def _on_stored_items(name: str, operator: Callable[[DataFrame], DataFrame], product: str = "brand") -> None:
    query(name)(lambda spark, sf_dir: operator(_items(spark, sf_dir, product)))


def _segments(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    scored = rfm.current(items)
    return materialise(scored.select("customer_id", "segment_code", "segment_name"), "segments")


Mining = tuple[DataFrame, DataFrame, DataFrame]


def _mining(spark: SparkSession, sf_dir: str) -> Mining:
    """Prepared baskets, the scope table and the kept products."""
    items = _items(spark, sf_dir)
    segments = _segments(spark, sf_dir, items)
    prepared = basket.prepared_baskets(items, segments, _RULES)
    scopes = basket.scope_table(items, segments, _RULES)
    return prepared, scopes, basket.scope_products(basket.lines_of(prepared), basket.basket_counts(prepared, scopes, _RULES), _RULES)


@query("basket_items")
def basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket.prepare(sample.basket_items(spark, sf_dir))


@query("basket_scopes")
def basket_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, scopes, _ = _mining(spark, sf_dir)
    named = basket.expand_scopes(prepared, _RULES).join(scopes.select("scope", F.col("segment_name").alias("scope_name")), "scope")
    return named.select("scope", "scope_name", "invoice_no", "customer_id", "stock_code", "product_name")


@query("scope_products")
def scope_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mining(spark, sf_dir)[2].select("scope", "stock_code", "coverage")


def _baskets(spark: SparkSession, sf_dir: str) -> Mining:
    prepared, scopes, products = _mining(spark, sf_dir)
    products = materialise(products, "scope-products")
    return materialise(basket.kept_baskets(prepared, products), "scope-baskets"), scopes, products


@query("scope_baskets")
def scope_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets, _, products = _baskets(spark, sf_dir)
    wide = baskets.select("scope", "invoice_no", F.explode("content.item").alias("item"))
    codes = basket.small(products.select("scope", "item", "stock_code"))
    grouped = wide.join(codes, ["scope", "item"]).groupBy("scope", "invoice_no")
    by_code = F.sort_array(F.collect_list("stock_code"))
    return grouped.agg(F.array_join(by_code, "|").alias("codes"), F.count("*").alias("width"))


@query("frequent_itemsets")
def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets, scopes, products = _baskets(spark, sf_dir)
    found = basket.itemsets(baskets, materialise(basket.basket_sizes(baskets, scopes), "basket-sizes"), _RULES)
    return basket.named_itemsets(found, basket.product_catalog(baskets, products))


@query("product_catalog")
def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets, _, products = _baskets(spark, sf_dir)
    return basket.product_catalog(baskets, products).select("scope", "stock_code", "product_name")


_on_items("association_rules", lambda items: basket.mine(items, cfg=_RULES))
_on_items("association_rules_wide", lambda items: basket.mine(items, cfg=_WIDE_RULES))


@query("top_rules_per_scope")
def top_rules_per_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return basket.mine(items, _segments(spark, sf_dir, items), _SCOPE_RULES, limit=10)


@query("segment_rules")
def segment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return basket.mine(items, _segments(spark, sf_dir, items), _RULES)


def _drift(items: DataFrame) -> DataFrame:
    previous, current = rfm.year_windows(items)
    return basket.drift(*basket.mine_periods(previous, current, _WIDE_RULES))


_on_stored_items("rule_drift", _drift)
_on_stored_items("drift_counts", lambda items: basket.drift_counts(_drift(items)))


# --- marts and serving ----------------------------------------------------------------------------


def _on_marts(name: str, mart: str, build: Callable[[DataFrame], DataFrame], ask: Callable[[serving.Marts], DataFrame]) -> None:
    """Query over one mart that is built from stored basket items."""
    query(name)(lambda spark, sf_dir: ask({mart: to_contract(build(_items(spark, sf_dir)), MARTS[mart])}))


def _on_snapshot_marts(name: str, ask: Callable[[serving.Marts], DataFrame]) -> None:
    """Query over the customer, segment and movement marts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialise(_snapshots(spark, sf_dir), "snapshots")
        frames = {
            "rfm_customer_snapshot": rows,
            "rfm_segment_summary": rfm.summarize(rows),
            "segment_migration": rfm.migrations(rows),
        }
        return ask({mart: to_contract(df, MARTS[mart]) for mart, df in frames.items()})

    query(name)(run)


_on_marts("q_overview", "business_overview", kpi.kpi_overview, serving.overview)
_on_marts("q_monthly", "monthly_sale", kpi.kpi_monthly, serving.monthly)
_on_marts("q_top_products", "top_product", kpi.top_products, serving.top_products)
_on_snapshot_marts("q_latest_snapshot", serving.latest_snapshot)
_on_snapshot_marts("q_segments", serving.segments)
_on_snapshot_marts("q_customers_page", lambda marts: serving.customers(marts, segment="LOYAL", page=2, size=25))
_on_snapshot_marts("q_customers_total", lambda marts: serving.customers_total(marts, segment="LOYAL", size=25))
_on_snapshot_marts("q_customers_after", lambda marts: serving.customers_after(marts, ("500000.00", "0"), size=50))
_on_snapshot_marts("q_migrations", serving.migrations)
_on_marts(
    "q_rules",
    "association_rule",
    lambda items: basket.mine(items, cfg=_WIDE_RULES),
    lambda marts: serving.rules(marts, min_confidence=0.01, product="Brand#7", limit=50),
)
_on_marts("q_drift", "rule_drift", _drift, lambda marts: serving.drift(marts, status="GROWING", limit=100))


@query("mart_key_duplicates")
def mart_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    rows = materialise(rfm.snapshots(items), "snapshots")
    frames = {
        "monthly_sale": kpi.kpi_monthly(items),
        "top_product": kpi.top_products(items),
        "rfm_customer_snapshot": rows,
        "rfm_segment_summary": rfm.summarize(rows),
        "segment_migration": rfm.migrations(rows),
    }
    return contract_report(frames)


def _scenario(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Basket items, customer segments and scenario lines, all stored."""
    items = _items(spark, sf_dir)
    segments = _segments(spark, sf_dir, items)
    lines = to_contract(sample.scenario_lines(items, segments), MARTS["synthetic_transaction"])
    return items, segments, materialise(lines, "scenario")


@query("q_augmentation_summary")
def q_augmentation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.augmentation_summary({"synthetic_transaction": _scenario(spark, sf_dir)[2]})


# Confidence limit for predictions that the evenly spread sample tables can reach.
_PREDICTION_CONFIDENCE = 0.1


@query("q_companions")
def q_companions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, segments, lines = _scenario(spark, sf_dir)
    asked = materialise(sample.requests(items, segments), "requests")
    return recommend.companions(lines, asked, _PREDICTION_CONFIDENCE)


@query("q_companions_indexed")
def q_companions_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, segments, lines = _scenario(spark, sf_dir)
    asked = materialise(sample.requests(items, segments), "requests")
    return recommend.predictions(_index(lines), asked, _PREDICTION_CONFIDENCE)


def _index(lines: DataFrame) -> DataFrame:
    """The companion index as it is read again from its buckets."""
    path = f"{ensure_checkpoint_dir(lines.sparkSession)}/companion-index-{uuid4().hex}"
    return read_buckets(lines.sparkSession, write_buckets(companion_index(lines), path, ["scope", "anchor"]))


@query("recommendations_indexed")
def recommendations_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, segments, lines = _scenario(spark, sf_dir)
    rules = materialise(to_contract(basket.mine(items, segments, _RULES), MARTS["association_rule"]), "rules")
    asked = materialise(sample.requests(items, segments, min_lift=1.1), "requests")
    marts = {"association_rule": rules, "companion_index": _index(lines)}
    return recommend.recommend(marts, asked, min_prediction_confidence=_PREDICTION_CONFIDENCE)


@query("recommendations")
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, segments, lines = _scenario(spark, sf_dir)
    rules = materialise(to_contract(basket.mine(items, segments, _RULES), MARTS["association_rule"]), "rules")
    asked = materialise(sample.requests(items, segments, min_lift=1.1), "requests")
    marts = {"association_rule": rules, "synthetic_transaction": lines}
    return recommend.recommend(marts, asked, min_prediction_confidence=_PREDICTION_CONFIDENCE)


# --- profiles and scenario lines ------------------------------------------------------------------

_SCENARIO = AugmentationConfig(batch_id=sample.SCENARIO_BATCH)


def _relations(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product profiles and directed relations."""
    goods = materialise(profiles.profiles(warehouse.positive_rows(items)), "profiles")
    pairs, counts = profiles.pair_counts(items, goods, _SCENARIO)
    return goods, profiles.relations(pairs, counts, items, _SCENARIO)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: round_ratio(F.col(name), digits) for name in names})


_on_stored_items(
    "product_profiles",
    lambda items: _rounded(profiles.profiles(warehouse.positive_rows(items)), 9, "median_unit_price"),
    product="part",
)


@query("cooccurrence_pairs")
def cooccurrence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return profiles.pair_counts(items, profiles.profiles(items), _SCENARIO)[0]


_on_stored_items(
    "product_relations",
    lambda items: _rounded(_relations(items)[1], 6, "confidence", "lift", "score", "generation_confidence"),
)


@query("anchor_products")
def anchor_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchors = profiles.anchors(*_relations(_items(spark, sf_dir)), _SCENARIO.top_anchors)
    return anchors.select("stock_code", "sales_rank", "anchor_index")


def _on_segment_items(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        items = _items(spark, sf_dir)
        return operator(materialise(profiles.with_segment(items, _segments(spark, sf_dir, items)), "segment-items"))

    query(name)(run)


def _budgets(segment_items: DataFrame) -> DataFrame:
    per_customer, per_segment = profiles.budgets(segment_items)
    parts = {"customer": per_customer, "segment": per_segment}
    rows = [df.toDF("key", "budget").select(F.lit(level).alias("level"), "*") for level, df in parts.items()]
    return rows[0].unionByName(rows[1])


_on_segment_items("segment_customer_weights", lambda items: _rounded(profiles.customer_weights(items), 9, "weight"))
_on_segment_items(
    "segment_top_products", lambda items: profiles.segment_products(items, _SCENARIO.segment_products)
)
_on_segment_items("anchor_segment_share", lambda items: _rounded(profiles.anchor_segments(items), 9, "share"))
_on_segment_items("basket_budgets", _budgets)
_on_segment_items(
    "segment_candidates",
    lambda items: profiles.restrict(
        profiles.segment_products(items, _SCENARIO.segment_products), profiles.profiles(warehouse.positive_rows(items))
    ),
)


@query("augmentation_report")
def augmentation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _, lines = _scenario(spark, sf_dir)
    goods, related = _relations(items)
    anchors = profiles.anchors(goods, related, _SCENARIO.top_anchors)
    return generate.quality_report(lines, _SCENARIO, anchors.count(), goods.count())


@query("augmented_union")
def augmented_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _, lines = _scenario(spark, sf_dir)
    return generate.augment(items, lines, _SCENARIO.batch_id)


@query("synthetic_transactions")
def synthetic_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated lines as observed ones."""
    items = _items(spark, sf_dir)
    cfg = replace(_SCENARIO, target_rows=max(10_000, items.count()))
    return generate.generate(items, _segments(spark, sf_dir, items), cfg)[0]
