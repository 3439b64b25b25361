"""Row rules of the cleaned fact table. Inputs are the landing table's texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.fixed_values import NON_MERCHANDISE_CODES

# Shortest text with year, month and day; casts alone would also read a bare year or month.
_SHORTEST_DAY = len("2010-1-1")


def filled(text: Column) -> Column:
    """Text trimmed of blanks, with null as ''."""
    return F.coalesce(F.trim(text), F.lit(""))


def whole_number(text: Column) -> Column:
    """Integer part of a number text, null when it is no number or too large."""
    return text.try_cast("decimal(38,10)").try_cast("int")


def price(text: Column) -> Column:
    return text.try_cast("decimal(18,4)")


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return (quantity.try_cast("decimal(20,4)") * price(unit_price)).try_cast("decimal(20,4)")


def wall_clock(text: Column) -> Column:
    """Timestamp without time zone, null when the text is none."""
    return F.when(F.length(F.trim(text)) >= _SHORTEST_DAY, text.try_cast("timestamp_ntz"))


def is_cancelled(invoice_no: Column) -> Column:
    return F.upper(filled(invoice_no)).startswith("C")


def quality_status(
    invoice_no: Column,
    stock_code: Column,
    invoice_ts: Column,
    customer_id: Column,
    quantity: Column,
    unit_price: Column,
) -> Column:
    """First matching reason why a line is not plain; text that is no number matches no number rule."""
    blank_key = (filled(invoice_no) == "") | (filled(stock_code) == "") | (filled(invoice_ts) == "")
    return (
        F.when(blank_key, "MISSING_KEY")
        .when(filled(customer_id) == "", "MISSING_CUSTOMER")
        .when(is_cancelled(invoice_no), "CANCELLED")
        .when(whole_number(quantity) <= 0, "NON_POSITIVE_QUANTITY")
        .when(price(unit_price) <= 0, "NON_POSITIVE_PRICE")
        .otherwise("VALID")
    )


def is_valid(
    invoice_no: Column,
    stock_code: Column,
    invoice_ts: Column,
    customer_id: Column,
    quantity: Column,
    unit_price: Column,
) -> Column:
    """1 when keys and customer are present, the line is no cancellation, and both numbers are positive.

    No part of it is null, so that a filter on it falls apart into conditions on single columns, which Spark checks where
    the columns are read instead of once more behind every join.
    """
    present = [filled(c) != "" for c in (invoice_no, stock_code, invoice_ts, customer_id)]
    holds = present[0] & present[1] & present[2] & present[3]
    positive = [F.coalesce(number > 0, F.lit(False)) for number in (whole_number(quantity), price(unit_price))]
    holds = holds & ~is_cancelled(invoice_no) & positive[0] & positive[1]
    return F.when(holds, 1).otherwise(0).cast("tinyint")


def invoice_month(invoice_ts: Column) -> Column:
    return F.substring(filled(invoice_ts), 1, 7)


def is_merchandise(stock_code: Column) -> Column:
    return ~F.upper(stock_code).isin(NON_MERCHANDISE_CODES)


def month_of(ts: Column) -> Column:
    """'yyyy-MM' of a timestamp."""
    return F.substring(ts.cast("string"), 1, 7)
