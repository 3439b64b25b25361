"""Raw invoice lines, basket items and scenario lines derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.fixed_values import ALL_SCOPE, GENERATION_MODEL, SOURCE_HEADERS
from tillroll.operators import warehouse
from tillroll.schemas import RAW

BATCH = "20260101T000000Z"
SCENARIO_BATCH = "SCENARIO-TABLES"

# Price per piece with four decimals, rounded half up in whole numbers, as text.
_PIECES = "CAST(l_quantity AS BIGINT)"
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_UNITS = f"(({_CENTS} * 200 + {_PIECES}) DIV (2 * {_PIECES}))"
_PRICE = f"CAST(CAST({_UNITS} AS DECIMAL(14,0)) * 0.0001 AS STRING)"

_PRODUCT = {"brand": "p_brand", "part": "CAST(l_partkey AS STRING)"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_lines(spark: SparkSession, sf_dir: str, product: str = "brand", faults: bool = False) -> DataFrame:
    """Landing table built from the order tables.

    Returned lines become cancellations. With `faults`, order numbers decide which lines get a blank
    customer, a negative quantity, a zero price or a blank product, so that every status occurs.
    """
    # Orders meet their customers first: they are fewer than lines, which are then shuffled for two joins only.
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    texts = {
        "source_year": "CAST(year(o_orderdate) AS STRING)",
        "invoice_no": "concat(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END, l_orderkey)",
        "stock_code": _PRODUCT[product],
        "description": "p_name",
        "quantity": f"CAST({_PIECES} AS STRING)",
        "invoice_ts": "substring(CAST(o_orderdate AS STRING), 1, 19)",
        "unit_price": _PRICE,
        "customer_id": "CAST(c_custkey AS STRING)",
        "country": "n_name",
        "ingest_batch_id": f"'{BATCH}'",
    }
    if faults:
        overlay = {
            "customer_id": "CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE {} END",
            "quantity": "CASE WHEN l_orderkey % 89 = 0 THEN concat('-', {}) ELSE {} END",
            "unit_price": "CASE WHEN l_orderkey % 83 = 0 THEN '0' ELSE {} END",
            "stock_code": "CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE {} END",
        }
        texts |= {name: form.replace("{}", texts[name]) for name, form in overlay.items()}
    return lines.select(*[F.expr(texts[name]).alias(name) for name in RAW.names])


def period_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """CSV files per period, as a source system exports them. Order numbers decide which lines have an unclosed quote,
    a field too many, a field too few, or a quantity that is no number."""
    lines = raw_lines(spark, sf_dir)
    order = F.regexp_replace("invoice_no", "^C", "").cast("bigint")
    fields = [F.concat(F.lit('"'), c, F.lit('"')) if c == "description" else F.col(c) for c in RAW.names if c not in ("source_year", "ingest_batch_id")]
    quantity = RAW.names.index("quantity") - 1
    fields[quantity] = F.when(order % 67 == 0, "n/a").otherwise(fields[quantity])
    text = F.concat_ws(",", *fields)
    text = (
        F.when(order % 53 == 0, F.regexp_replace(text, '^([^"]*"[^"]*)"', "$1"))
        .when(order % 59 == 0, F.concat(text, F.lit(",extra")))
        .when(order % 61 == 0, F.regexp_replace(text, ",[^,]*$", ""))
        .otherwise(text)
    )
    early = F.col("invoice_ts") < "1998"
    paths = {}
    for tag, rows in (("Years to 1997", lines.filter(early)), ("Years from 1998", lines.filter(~early))):
        paths[tag] = f"{folder}/{tag}"
        # The writer of texts knows no header; with these options, the CSV writer leaves lines as they are.
        as_is = {"sep": "\u0001", "quote": "\u0000", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.select(text.alias(",".join(SOURCE_HEADERS))).write.csv(paths[tag], header=True, **as_is)
    return paths


def fact(spark: SparkSession, sf_dir: str, product: str = "brand", faults: bool = False) -> DataFrame:
    return warehouse.clean(raw_lines(spark, sf_dir, product, faults))


def basket_items(spark: SparkSession, sf_dir: str, product: str = "brand") -> DataFrame:
    return warehouse.basket_item(fact(spark, sf_dir, product))


def scenario_lines(items: DataFrame, segments: DataFrame) -> DataFrame:
    """Basket items in the layout of generated lines: one name per product, the customer's segment as source."""
    source = segments.select("customer_id", F.col("segment_code").alias("source_segment_code"))
    # Distinct first, which combines before the shuffle without a sort of the items.
    names = items.select("stock_code", "product_name").distinct().groupBy("stock_code").agg(F.max("product_name").alias("product_name"))
    return items.drop("product_name").join(names, "stock_code").join(source, "customer_id").select(
        F.concat_ws("-", "invoice_no", "customer_id", "stock_code").alias("synthetic_line_id"),
        "invoice_no",
        "customer_id",
        "invoice_ts",
        "stock_code",
        "product_name",
        F.col("item_quantity").cast("int").alias("item_quantity"),
        "item_amount",
        "source_segment_code",
        ((F.col("item_quantity") % 40 + 58) / F.lit(100)).cast("decimal(10,6)").alias("generation_confidence"),
        F.lit(GENERATION_MODEL).alias("generation_model"),
        F.lit(SCENARIO_BATCH).alias("generation_batch_id"),
    )


def requests(items: DataFrame, segments: DataFrame, min_lift: float = 1.05, max_results: int = 5) -> DataFrame:
    """One recommendation request per product and segment that buys it, and per product for all customers."""
    bought = items.select("customer_id", "stock_code").join(segments.select("customer_id", "segment_code"), "customer_id")
    scope = F.explode(F.array(F.col("segment_code"), F.lit(ALL_SCOPE))).alias("segment_code")
    asked = bought.select(scope, F.col("stock_code").alias("product_code")).distinct()
    return asked.select(
        F.concat_ws(":", "segment_code", "product_code").alias("request_id"),
        "segment_code",
        "product_code",
        F.lit(min_lift).alias("min_lift"),
        F.lit(max_results).alias("max_results"),
    )
