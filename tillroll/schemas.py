"""Column layouts of raw input, warehouse layers and marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "tinyint": T.ByteType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    """Schema from `name="kind"` pairs; works without a session."""

    def kind_of(text: str) -> T.DataType:
        if text.startswith("decimal("):
            precision, scale = text.removeprefix("decimal(").removesuffix(")").split(",")
            return T.DecimalType(int(precision), int(scale))
        return _KINDS[text]

    return T.StructType([T.StructField(name, kind_of(kind)) for name, kind in columns.items()])


RAW = _schema(
    source_year="string",
    invoice_no="string",
    stock_code="string",
    description="string",
    quantity="string",
    invoice_ts="string",
    unit_price="string",
    customer_id="string",
    country="string",
    ingest_batch_id="string",
)

FACT = _schema(
    invoice_no="string",
    stock_code="string",
    description="string",
    quantity="int",
    invoice_ts="timestamp_ntz",
    unit_price="decimal(18,4)",
    line_amount="decimal(20,4)",
    customer_id="string",
    country="string",
    source_year="string",
    ingest_batch_id="string",
    is_cancelled="tinyint",
    quality_status="string",
    is_valid_analysis="tinyint",
    invoice_month="string",
)

BASKET_ITEM_COLUMNS = [
    "invoice_no",
    "customer_id",
    "invoice_ts",
    "stock_code",
    "product_name",
    "item_quantity",
    "item_amount",
    "data_origin",
    "source_segment_code",
    "generation_confidence",
    "generation_batch_id",
]

SEGMENTS = _schema(customer_id="string", segment_code="string", segment_name="string")


@dataclass(frozen=True)
class Contract:
    """Typed layout of a mart, its unique key and the columns that may be null."""

    schema: T.StructType
    key: tuple[str, ...]
    nullable: frozenset[str] = frozenset()


MARTS: dict[str, Contract] = {
    "business_overview": Contract(
        _schema(
            customer_count="int",
            order_count="int",
            product_count="int",
            item_quantity="bigint",
            sales_amount="decimal(20,2)",
            average_basket_amount="decimal(20,2)",
            min_invoice_ts="timestamp_ntz",
            max_invoice_ts="timestamp_ntz",
        ),
        key=(),
    ),
    "monthly_sale": Contract(
        _schema(
            invoice_month="string",
            customer_count="int",
            order_count="int",
            product_count="int",
            item_quantity="bigint",
            sales_amount="decimal(20,2)",
            average_basket_amount="decimal(20,2)",
        ),
        key=("invoice_month",),
    ),
    "rfm_customer_snapshot": Contract(
        _schema(
            snapshot_date="date",
            customer_id="string",
            latest_purchase_ts="timestamp_ntz",
            recency_days="int",
            frequency="int",
            monetary="decimal(20,2)",
            r_score="int",
            f_score="int",
            m_score="int",
            rfm_score="string",
            segment_code="string",
            segment_name="string",
        ),
        key=("snapshot_date", "customer_id"),
    ),
    "rfm_segment_summary": Contract(
        _schema(
            snapshot_date="date",
            segment_code="string",
            segment_name="string",
            customer_count="int",
            total_monetary="decimal(20,2)",
            average_recency_days="decimal(12,2)",
            average_frequency="decimal(12,2)",
            average_monetary="decimal(20,2)",
            customer_share="decimal(12,6)",
            monetary_share="decimal(12,6)",
        ),
        key=("snapshot_date", "segment_code"),
    ),
    "segment_migration": Contract(
        _schema(
            from_segment_code="string",
            from_segment_name="string",
            to_segment_code="string",
            to_segment_name="string",
            customer_count="int",
            from_snapshot_date="date",
            to_snapshot_date="date",
        ),
        key=("from_snapshot_date", "to_snapshot_date", "from_segment_code", "to_segment_code"),
    ),
    "association_rule": Contract(
        _schema(
            rule_id="string",
            segment_code="string",
            segment_name="string",
            antecedent_codes="string",
            antecedent_names="string",
            consequent_codes="string",
            consequent_names="string",
            support="decimal(14,8)",
            confidence="decimal(14,8)",
            lift="decimal(18,8)",
            leverage="decimal(18,8)",
            conviction="decimal(18,8)",
            coverage_basket_count="int",
            scope_basket_count="int",
            rank_score="decimal(18,8)",
        ),
        key=("rule_id",),
        nullable=frozenset({"leverage", "conviction"}),
    ),
    "rule_drift": Contract(
        _schema(
            segment_code="string",
            segment_name="string",
            antecedent_codes="string",
            antecedent_names="string",
            consequent_codes="string",
            consequent_names="string",
            previous_support="decimal(14,8)",
            previous_confidence="decimal(14,8)",
            previous_lift="decimal(18,8)",
            previous_coverage_basket_count="int",
            current_support="decimal(14,8)",
            current_confidence="decimal(14,8)",
            current_lift="decimal(18,8)",
            current_coverage_basket_count="int",
            lift_delta="decimal(18,8)",
            support_delta="decimal(14,8)",
            drift_status="string",
        ),
        key=("segment_code", "antecedent_codes", "consequent_codes"),
        nullable=frozenset(
            {
                "segment_name",
                "antecedent_names",
                "consequent_names",
                "previous_support",
                "previous_confidence",
                "previous_lift",
                "previous_coverage_basket_count",
                "current_support",
                "current_confidence",
                "current_lift",
                "current_coverage_basket_count",
                "lift_delta",
                "support_delta",
            }
        ),
    ),
    "top_product": Contract(
        _schema(
            stock_code="string",
            product_name="string",
            order_count="int",
            customer_count="int",
            item_quantity="bigint",
            sales_amount="decimal(20,2)",
        ),
        key=("stock_code", "product_name"),
    ),
    "synthetic_transaction": Contract(
        _schema(
            synthetic_line_id="string",
            invoice_no="string",
            customer_id="string",
            invoice_ts="timestamp_ntz",
            stock_code="string",
            product_name="string",
            item_quantity="int",
            item_amount="decimal(20,4)",
            source_segment_code="string",
            generation_confidence="decimal(10,6)",
            generation_model="string",
            generation_batch_id="string",
        ),
        key=("synthetic_line_id",),
    ),
}
