"""Standardisation, cleaning, dimensions, aggregates, summaries, checks and key figures."""

from __future__ import annotations

from textwrap import dedent

from duck_sql.base import SERVICE_CODES, fact_sql, items_sql, raw, raw_sql, with_

# White-space characters as a regular-expression class.
_WS = r"[\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_SUMMARY = """
    summary AS (
        SELECT invoice_no, customer_id, min(invoice_ts) AS invoice_ts, max(country) AS country,
               count(DISTINCT stock_code) AS product_count, CAST(sum(quantity) AS BIGINT) AS item_quantity,
               CAST(sum(line_amount) AS DECIMAL(20,2)) AS basket_amount
        FROM valid GROUP BY invoice_no, customer_id
    )"""

_OVERVIEW = """
    overview AS (
        SELECT count(DISTINCT customer_id) AS customer_count, count(DISTINCT invoice_no) AS order_count,
               count(DISTINCT stock_code) AS product_count, CAST(sum(quantity) AS BIGINT) AS item_quantity,
               CAST(sum(line_amount) AS DECIMAL(20,2)) AS sales_amount,
               round(CAST(sum(line_amount) AS DOUBLE) / count(DISTINCT invoice_no), 2) AS average_basket_amount,
               min(invoice_ts) AS min_invoice_ts, max(invoice_ts) AS max_invoice_ts
        FROM valid
    )"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["std_identifier"] = r"""
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS whole_double, CAST(o_orderkey AS VARCHAR) AS whole_number,
               regexp_replace(CAST(o_totalprice AS VARCHAR), '\.0$', '') AS fraction, trim(o_orderpriority) AS padded_text,
               CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS nullable_text
        FROM orders"""
    sql["std_text"] = f"""
        SELECT doc_id, trim(regexp_replace(text, '{_WS}', ' ', 'g'), ' ') AS std_text FROM documents"""
    sql["std_decimal"] = """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS plain,
               CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '00' AS exponent_up,
               (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS exponent_down,
               (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '0' AS kept_scale,
               '' AS blank, CAST(l_extendedprice * 1e6 AS VARCHAR) AS from_double
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)"""
    sql["std_timestamp"] = """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS from_timestamp,
               strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS from_date,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS from_text,
               CASE WHEN o_orderstatus = 'F' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS nullable_ts
        FROM orders"""
    sql["std_union"] = raw_sql(
        """
        SELECT CASE WHEN invoice_ts < '1998-01-01' THEN 'Years to 1997' ELSE 'Years from 1998' END AS source_year,
               invoice_no, stock_code, description, quantity, invoice_ts, unit_price, customer_id, country,
               ingest_batch_id
        FROM raw"""
    )
    audit = """
        SELECT {source} AS source_year, count(*) AS row_count,
               count(*) FILTER (WHERE trim(customer_id) = '') AS missing_customer_rows,
               count(*) FILTER (WHERE upper(trim(invoice_no)) LIKE 'C%') AS cancelled_rows,
               count(*) FILTER (WHERE TRY_CAST(quantity AS DECIMAL(18,4)) <= 0) AS non_positive_quantity_rows,
               count(*) FILTER (WHERE TRY_CAST(unit_price AS DECIMAL(18,4)) <= 0) AS non_positive_price_rows
        FROM raw {group}"""
    both = audit.format(source="source_year", group="GROUP BY source_year") + " UNION ALL "
    order = "CAST(ltrim(invoice_no, 'C') AS BIGINT)"
    counted = """
        SELECT {source} AS source_year, count(*) FILTER (WHERE sound) AS row_count,
               count(*) FILTER (WHERE sound AND trim(customer_id) = '') AS missing_customer_rows,
               count(*) FILTER (WHERE sound AND invoice_no LIKE 'C%') AS cancelled_rows,
               count(*) FILTER (WHERE sound AND CAST(quantity AS BIGINT) <= 0) AS non_positive_quantity_rows,
               count(*) FILTER (WHERE sound AND CAST(unit_price AS DECIMAL(18,4)) <= 0) AS non_positive_price_rows,
               count(*) FILTER (WHERE NOT sound) AS rejected_rows
        FROM exported {group}"""
    exported = f"""
    exported AS (
        SELECT *, CASE WHEN invoice_ts < '1998-01-01' THEN 'Years to 1997' ELSE 'Years from 1998' END AS period,
               {order} % 53 <> 0 AND {order} % 59 <> 0 AND {order} % 61 <> 0 AND {order} % 67 <> 0 AS sound
        FROM raw
    )"""
    body = counted.format(source="period", group="GROUP BY period") + " UNION ALL " + counted.format(source="'ALL'", group="")
    sql["ingest_rejects"] = with_(raw(), exported) + dedent(body).strip()
    sql["ingest_audit"] = raw_sql(both + audit.format(source="'ALL'", group=""), faults=True)
    profile = """
        SELECT {source} AS source_year, count(*) AS row_count,
               count(DISTINCT nullif(trim(invoice_no), '')) AS distinct_invoices,
               count(DISTINCT nullif(trim(customer_id), '')) AS distinct_customers,
               count(DISTINCT nullif(trim(stock_code), '')) AS distinct_products,
               count(*) FILTER (WHERE trim(customer_id) = '') AS missing_customer_rows,
               count(*) FILTER (WHERE is_cancelled = 1) AS cancelled_rows,
               count(*) FILTER (WHERE quantity <= 0) AS non_positive_quantity_rows,
               count(*) FILTER (WHERE unit_price <= 0) AS non_positive_price_rows,
               min(invoice_ts) AS min_invoice_ts, max(invoice_ts) AS max_invoice_ts,
               CAST(sum(is_valid_analysis) AS BIGINT) AS valid_rows,
               count(DISTINCT invoice_no) FILTER (WHERE is_valid_analysis = 1) AS valid_invoices,
               count(DISTINCT customer_id) FILTER (WHERE is_valid_analysis = 1) AS valid_customers,
               count(DISTINCT stock_code) FILTER (WHERE is_valid_analysis = 1) AS valid_products,
               CAST(CAST(sum(line_amount) FILTER (WHERE is_valid_analysis = 1) AS DECIMAL(20,2)) AS DOUBLE) AS valid_sales_amount,
               round(CAST(sum(line_amount) FILTER (WHERE is_valid_analysis = 1) AS DOUBLE)
                     / count(DISTINCT invoice_no) FILTER (WHERE is_valid_analysis = 1), 2) AS average_valid_basket_amount
        FROM fact {group}"""
    both = profile.format(source="source_year", group="GROUP BY source_year") + " UNION ALL "
    sql["source_profile"] = fact_sql(both + profile.format(source="'ALL'", group=""), "brand", True)
    sql["top_countries"] = raw_sql(
        """
        SELECT trim(country) AS country, count(*) AS row_count FROM raw WHERE trim(country) <> ''
        GROUP BY 1 ORDER BY row_count DESC, country LIMIT 10""",
        faults=True,
    )
    sql["load_basket_items"] = items_sql(
        """
        SELECT invoice_no, customer_id, invoice_ts, stock_code,
               CASE WHEN CAST(invoice_no AS BIGINT) % 19 = 0 THEN NULL ELSE product_name END AS product_name,
               CASE WHEN CAST(invoice_no AS BIGINT) % 13 > 0 AND CAST(invoice_no AS BIGINT) % 11 > 0 THEN item_quantity END
                   AS item_quantity,
               CAST(item_amount AS DOUBLE) AS item_amount, 'REAL' AS data_origin,
               CAST(NULL AS VARCHAR) AS source_segment_code, 1.0::DOUBLE AS generation_confidence,
               CAST(NULL AS VARCHAR) AS generation_batch_id
        FROM items WHERE CAST(invoice_no AS BIGINT) % 17 <> 0"""
    )
    sql["dwd_clean"] = fact_sql(
        """
        SELECT invoice_no, stock_code, description, quantity, invoice_ts, CAST(unit_price AS DOUBLE) AS unit_price,
               CAST(line_amount AS DOUBLE) AS line_amount, customer_id, country, source_year, ingest_batch_id,
               is_cancelled, invoice_month
        FROM fact"""
    )
    sql["dwd_quality"] = fact_sql(
        """
        SELECT invoice_no, stock_code, quantity, CAST(unit_price AS DOUBLE) AS unit_price, customer_id,
               quality_status, is_valid_analysis
        FROM fact""",
        "brand",
        True,
    )
    sql["dim_product"] = fact_sql(
        """
        SELECT stock_code, max(description) AS product_name, CAST(min(unit_price) AS DOUBLE) AS min_unit_price,
               CAST(max(unit_price) AS DOUBLE) AS max_unit_price, count(*) AS source_row_count
        FROM fact WHERE stock_code <> '' GROUP BY stock_code""",
        "part",
        True,
    )
    sql["dim_customer"] = fact_sql(
        """
        SELECT customer_id, max(country) AS country, min(invoice_ts) AS first_seen_ts, max(invoice_ts) AS last_seen_ts
        FROM fact WHERE customer_id <> '' GROUP BY customer_id""",
        "brand",
        True,
    )
    sql["dim_country"] = fact_sql(
        """
        SELECT country, count(DISTINCT customer_id) AS customer_count, count(DISTINCT invoice_no) AS invoice_count
        FROM valid GROUP BY country""",
        "brand",
        True,
    )
    sql["dws_basket_summary"] = fact_sql(
        """
        SELECT invoice_no, customer_id, invoice_ts, country, product_count, item_quantity,
               CAST(basket_amount AS DOUBLE) AS basket_amount
        FROM summary""",
        "brand",
        True,
        _SUMMARY,
    )
    sql["dws_basket_item"] = items_sql(
        """
        SELECT invoice_no, customer_id, invoice_ts, stock_code, product_name, item_quantity,
               CAST(item_amount AS DOUBLE) AS item_amount
        FROM items"""
    )
    sql["dws_customer_monthly"] = fact_sql(
        """
        SELECT strftime(invoice_ts, '%Y-%m') AS invoice_month, customer_id, count(DISTINCT invoice_no) AS order_count,
               count(DISTINCT stock_code) AS product_count, CAST(sum(quantity) AS BIGINT) AS item_quantity,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               max(invoice_ts) AS latest_purchase_ts
        FROM valid GROUP BY 1, 2"""
    )
    sql["dws_customer_summary"] = fact_sql(
        """
        SELECT customer_id, min(invoice_ts) AS first_purchase_ts, max(invoice_ts) AS latest_purchase_ts,
               count(DISTINCT invoice_no) AS frequency,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS monetary,
               count(DISTINCT stock_code) AS distinct_product_count
        FROM valid GROUP BY customer_id"""
    )
    sql["ads_overview"] = fact_sql(
        "SELECT * REPLACE (CAST(sales_amount AS DOUBLE) AS sales_amount) FROM overview", "brand", True, _OVERVIEW
    )
    # The monthly parts give what a full build gives.
    sql["monthly_overview"] = sql["ads_overview"]
    sql["monthly_countries"] = sql["dim_country"]
    sql["monthly_baskets"] = sql["dws_basket_summary"]
    sql["overview_by_year"] = fact_sql(
        """
        SELECT strftime(invoice_ts, '%Y') AS period, count(DISTINCT customer_id) AS customer_count,
               count(DISTINCT invoice_no) AS order_count, count(DISTINCT stock_code) AS product_count,
               CAST(sum(quantity) AS BIGINT) AS item_quantity,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               round(CAST(sum(line_amount) AS DOUBLE) / count(DISTINCT invoice_no), 2) AS average_basket_amount,
               min(invoice_ts) AS min_invoice_ts, max(invoice_ts) AS max_invoice_ts
        FROM valid GROUP BY 1""",
        "brand",
        True,
    )
    sql["ads_monthly_sales"] = fact_sql(
        """
        SELECT strftime(invoice_ts, '%Y-%m') AS invoice_month, count(DISTINCT customer_id) AS customer_count,
               count(DISTINCT invoice_no) AS order_count,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               round(CAST(sum(line_amount) AS DOUBLE) / count(DISTINCT invoice_no), 2) AS average_basket_amount
        FROM valid GROUP BY 1""",
        "brand",
        True,
    )
    sql["ads_quality_summary"] = fact_sql(
        """
        SELECT quality_status, count(*) AS row_count, count(DISTINCT invoice_no) AS invoice_count,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS line_amount
        FROM fact GROUP BY quality_status""",
        "brand",
        True,
    )
    sql["check_row_counts"] = fact_sql(
        """
        SELECT 'ods_row_count' AS check_name, count(*) AS actual_value FROM raw
        UNION ALL SELECT 'dwd_row_count', count(*) FROM fact""",
        "brand",
        True,
    )
    sql["check_status_dist"] = fact_sql(
        "SELECT quality_status, count(*) AS row_count FROM fact GROUP BY 1 ORDER BY 2 DESC, 1", "brand", True
    )
    sql["check_valid_kpis"] = fact_sql(
        """
        SELECT 'valid_analysis' AS check_name, count(*) AS row_count, count(DISTINCT invoice_no) AS invoice_count,
               count(DISTINCT customer_id) AS customer_count, count(DISTINCT stock_code) AS product_count,
               CAST(CAST(sum(line_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount
        FROM valid""",
        "brand",
        True,
    )
    sql["check_basket_recon"] = fact_sql(
        """
        SELECT 'basket_reconciliation' AS check_name, count(*) AS basket_count,
               CAST(CAST(sum(basket_amount) AS DECIMAL(20,2)) AS DOUBLE) AS basket_sales_amount
        FROM summary""",
        "brand",
        True,
        _SUMMARY,
    )
    sql["check_ads_recon"] = fact_sql(
        """
        SELECT 'ads_reconciliation' AS check_name, order_count, CAST(sales_amount AS DOUBLE) AS sales_amount
        FROM overview""",
        "brand",
        True,
        _OVERVIEW,
    )
    figures = """
    figures AS (
        SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM fact) AS fact_rows,
               (SELECT count(*) FROM fact WHERE quality_status = 'VALID') AS valid_status_rows,
               (SELECT count(*) FROM valid) AS valid_rows, (SELECT count(DISTINCT invoice_no) FROM valid) AS valid_invoices,
               (SELECT CAST(sum(line_amount) AS DECIMAL(20,2)) FROM valid) AS valid_amount,
               (SELECT count(*) FROM summary) AS baskets, (SELECT sum(basket_amount) FROM summary) AS basket_amount,
               (SELECT order_count FROM overview) AS ads_orders, (SELECT sales_amount FROM overview) AS ads_amount
    ),
    pairs AS (
        SELECT 'raw_rows_equal_fact_rows' AS check_name, CAST(raw_rows AS DOUBLE) AS left_value, CAST(fact_rows AS DOUBLE) AS right_value, 0.0::DOUBLE AS tolerance FROM figures
        UNION ALL SELECT 'status_rows_equal_fact_rows', fact_rows, fact_rows, 0 FROM figures
        UNION ALL SELECT 'valid_rows_equal_valid_status', valid_rows, valid_status_rows, 0 FROM figures
        UNION ALL SELECT 'ads_orders_equal_valid_invoices', ads_orders, valid_invoices, 0 FROM figures
        UNION ALL SELECT 'ads_amount_equals_valid_amount', ads_amount, valid_amount, 0 FROM figures
        UNION ALL SELECT 'basket_amount_near_valid_amount', basket_amount, valid_amount, baskets * 0.005 FROM figures
    )"""
    sql["recon_report"] = fact_sql(
        "SELECT *, CASE WHEN abs(left_value - right_value) <= tolerance THEN 1 ELSE 0 END AS passed FROM pairs",
        "brand",
        True,
        _SUMMARY,
        _OVERVIEW,
        figures,
    )
    sql["merchandise_items"] = items_sql(
        f"""
        SELECT invoice_no, customer_id, code AS stock_code, item_quantity
        FROM (SELECT *, CASE WHEN item_quantity % 7 = 0 THEN 'post' ELSE stock_code END AS code FROM items)
        WHERE upper(code) NOT IN {SERVICE_CODES}"""
    )
    sql["positive_transactions"] = items_sql(
        """
        SELECT invoice_no, customer_id, stock_code, item_quantity, CAST(item_amount AS DOUBLE) AS item_amount
        FROM items
        WHERE CAST(invoice_no AS BIGINT) % 13 > 0 AND CAST(invoice_no AS BIGINT) % 11 > 0 AND CAST(invoice_no AS BIGINT) % 17 > 0"""
    )
    sql["kpi_overview"] = items_sql(
        """
        SELECT count(DISTINCT customer_id) AS customer_count, count(DISTINCT invoice_no) AS order_count,
               count(DISTINCT stock_code) AS product_count, CAST(sum(item_quantity) AS BIGINT) AS item_quantity,
               CAST(CAST(sum(item_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               (SELECT round(avg(CAST(amount AS DOUBLE)), 2)
                FROM (SELECT sum(item_amount) AS amount FROM items GROUP BY invoice_no)) AS average_basket_amount,
               min(invoice_ts) AS min_invoice_ts, max(invoice_ts) AS max_invoice_ts
        FROM items"""
    )
    sql["kpi_monthly"] = items_sql(
        """
        SELECT strftime(invoice_ts, '%Y-%m') AS invoice_month, count(DISTINCT customer_id) AS customer_count,
               count(DISTINCT invoice_no) AS order_count, count(DISTINCT stock_code) AS product_count,
               CAST(sum(item_quantity) AS BIGINT) AS item_quantity,
               CAST(CAST(sum(item_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               round(CAST(sum(item_amount) AS DOUBLE) / count(DISTINCT invoice_no), 2) AS average_basket_amount
        FROM items GROUP BY 1 ORDER BY 1"""
    )
    best = f"""
        SELECT stock_code, product_name, count(DISTINCT invoice_no) AS order_count,
               count(DISTINCT customer_id) AS customer_count, CAST(sum(item_quantity) AS BIGINT) AS item_quantity,
               CAST(CAST(sum(item_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount
        FROM items WHERE upper(stock_code) NOT IN {SERVICE_CODES} AND product_name IS NOT NULL
        GROUP BY 1, 2 HAVING count(DISTINCT invoice_no) >= 20
        ORDER BY sum(item_amount) DESC, order_count DESC, stock_code, product_name LIMIT 100"""
    sql["top_products"] = items_sql(best)
    sql["top_products_by_part"] = items_sql(best, "part")
    return sql
