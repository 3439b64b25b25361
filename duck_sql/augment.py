"""Product profiles, co-occurrence, segment context and reports over scenario lines."""

from __future__ import annotations

from duck_sql import basket, rfm, serving
from duck_sql.base import SERVICE_CODES, items_sql, rnd

MIN_PAIR, TOP_ANCHORS, SEGMENT_PRODUCTS = 4, 100, 150

_PROFILES = f"""
    goods AS (
        SELECT *, CAST(item_amount AS DOUBLE) / item_quantity AS unit_price
        FROM items WHERE upper(stock_code) NOT IN {SERVICE_CODES} AND item_quantity > 0 AND item_amount > 0
    ),
    name_counts AS (
        SELECT stock_code, product_name, row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, product_name) AS pos
        FROM goods WHERE product_name IS NOT NULL GROUP BY 1, 2
    ),
    profiles AS (
        SELECT g.stock_code, coalesce(max(n.product_name), 'UNKNOWN PRODUCT') AS product_name,
               median(unit_price) AS median_unit_price,
               greatest(1.0::DOUBLE, least(72.0::DOUBLE, median(item_quantity))) AS median_quantity,
               count(DISTINCT invoice_no) AS basket_count, sum(item_amount) AS sales_amount
        FROM goods g LEFT JOIN name_counts n ON n.stock_code = g.stock_code AND n.pos = 1
        GROUP BY g.stock_code HAVING median(unit_price) > 0
    ),
    ranked_profiles AS (
        SELECT *, row_number() OVER (ORDER BY sales_amount DESC, basket_count DESC, stock_code) AS sales_rank FROM profiles
    )"""

_PAIRS = """
    bought AS (SELECT DISTINCT invoice_no, stock_code FROM items JOIN ranked_profiles USING (stock_code)),
    pair_counts AS (
        SELECT a.stock_code AS left_code, b.stock_code AS right_code, count(*) AS pair_count
        FROM bought a JOIN bought b ON a.invoice_no = b.invoice_no AND a.stock_code < b.stock_code GROUP BY 1, 2
    ),
    product_counts AS (SELECT stock_code, count(*) AS basket_count FROM bought GROUP BY 1)"""

_RELATIONS = f"""
    directed AS (
        SELECT left_code AS anchor_code, right_code AS companion_code, pair_count FROM pair_counts WHERE pair_count >= {MIN_PAIR}
        UNION ALL SELECT right_code, left_code, pair_count FROM pair_counts WHERE pair_count >= {MIN_PAIR}
    ),
    measured_relations AS (
        SELECT d.*, CAST(pair_count AS DOUBLE) / a.basket_count AS confidence,
               CAST(pair_count * (SELECT count(DISTINCT invoice_no) FROM items) AS DOUBLE) / (a.basket_count * c.basket_count) AS lift
        FROM directed d JOIN product_counts a ON a.stock_code = anchor_code JOIN product_counts c ON c.stock_code = companion_code
    ),
    relations AS (
        SELECT *, confidence * ln(1 + lift) * ln(1 + pair_count) AS score,
               greatest(0.58::DOUBLE, least(0.98::DOUBLE, 0.52::DOUBLE + least(confidence, 1.0::DOUBLE) * 0.2::DOUBLE
                   + least(ln(1 + lift) / ln(6.0::DOUBLE), 1.0::DOUBLE) * 0.13::DOUBLE
                   + least(pair_count / 150.0::DOUBLE, 1.0::DOUBLE) * 0.13::DOUBLE)) AS generation_confidence
        FROM measured_relations
    )"""

_SEGMENT_ITEMS = """
    segment_items AS (SELECT i.*, s.segment_code FROM items i JOIN one_segment s USING (customer_id)),
    product_baskets AS (
        SELECT segment_code, stock_code, count(DISTINCT invoice_no) AS basket_count FROM segment_items GROUP BY 1, 2
    ),
    segment_best AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_code ORDER BY basket_count DESC, stock_code) AS product_rank
                       FROM product_baskets)
        WHERE product_rank <= {limit}
    )"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    context = (*rfm.SNAPSHOT_PARTS, basket.SEGMENTS, _SEGMENT_ITEMS.format(limit=SEGMENT_PRODUCTS))
    sql["product_profiles"] = items_sql(
        f"""
        SELECT * REPLACE (CAST(sales_amount AS DOUBLE) AS sales_amount, {rnd("median_unit_price", 9)} AS median_unit_price)
        FROM profiles""",
        "part",
        _PROFILES,
    )
    sql["cooccurrence_pairs"] = items_sql("SELECT * FROM pair_counts", "brand", _PROFILES, _PAIRS)
    sql["product_relations"] = items_sql(
        f"""
        SELECT anchor_code, companion_code, pair_count, {rnd("confidence", 6)} AS confidence, {rnd("lift", 6)} AS lift,
               {rnd("score", 6)} AS score, {rnd("generation_confidence", 6)} AS generation_confidence,
               row_number() OVER (PARTITION BY anchor_code ORDER BY score DESC, companion_code) AS relation_rank
        FROM relations""",
        "brand",
        _PROFILES,
        _PAIRS,
        _RELATIONS,
    )
    sql["anchor_products"] = items_sql(
        f"""
        SELECT stock_code, sales_rank, row_number() OVER (ORDER BY sales_rank) - 1 AS anchor_index
        FROM ranked_profiles WHERE sales_rank <= {TOP_ANCHORS} AND stock_code IN (SELECT anchor_code FROM relations)""",
        "brand",
        _PROFILES,
        _PAIRS,
        _RELATIONS,
    )
    sql["segment_customer_weights"] = items_sql(
        f"""
        SELECT segment_code, customer_id, order_count,
               {rnd("sqrt(order_count) / sum(sqrt(order_count)) OVER (PARTITION BY segment_code)", 9)} AS weight
        FROM (SELECT segment_code, customer_id, count(DISTINCT invoice_no) AS order_count FROM segment_items GROUP BY 1, 2)""",
        "brand",
        *context,
    )
    sql["segment_top_products"] = items_sql(
        "SELECT segment_code, stock_code, basket_count, product_rank FROM segment_best", "brand", *context
    )
    sql["segment_candidates"] = items_sql(
        """
        SELECT segment_code, stock_code, basket_count, product_rank FROM segment_best
        WHERE stock_code IN (SELECT stock_code FROM profiles)""",
        "brand",
        *context,
        _PROFILES,
    )
    sql["anchor_segment_share"] = items_sql(
        f"""
        SELECT segment_code, stock_code, basket_count,
               {rnd("CAST(basket_count AS DOUBLE) / sum(basket_count) OVER (PARTITION BY stock_code)", 9)} AS share
        FROM product_baskets""",
        "brand",
        *context,
    )
    sql["basket_budgets"] = items_sql(
        """
        SELECT 'customer' AS level, customer_id AS key, median(units) / 1e4 AS budget FROM basket_amounts GROUP BY 2
        UNION ALL
        SELECT 'segment', segment_code, median(units) / 1e4 FROM basket_amounts GROUP BY 2""",
        "brand",
        *context,
        """
    basket_amounts AS (
        SELECT invoice_no, customer_id, segment_code, CAST(sum(item_amount) * 10000 AS BIGINT) AS units
        FROM segment_items GROUP BY 1, 2, 3
    )""",
    )
    scenario = (*rfm.SNAPSHOT_PARTS, basket.SEGMENTS, serving._SCENARIO)
    sql["augmentation_report"] = items_sql(
        f"""
        SELECT 'SCENARIO-TABLES' AS generation_batch_id, 'segmentAwareCooccurrenceV1' AS generation_model,
               count(*) AS synthetic_row_count, count(DISTINCT invoice_no) AS synthetic_order_count,
               count(DISTINCT customer_id) AS synthetic_customer_count, 0 AS new_synthetic_customer_count,
               (SELECT count(*) FROM ranked_profiles WHERE sales_rank <= {TOP_ANCHORS}
                  AND stock_code IN (SELECT anchor_code FROM relations)) AS anchor_product_count,
               round((SELECT count(*) FROM ranked_profiles WHERE sales_rank <= {TOP_ANCHORS}
                  AND stock_code IN (SELECT anchor_code FROM relations))
                  / CAST(least({TOP_ANCHORS}, (SELECT count(*) FROM profiles)) AS DOUBLE), 6) AS relationship_anchor_coverage,
               round(CAST(sum(item_quantity % 40 + 58) AS DOUBLE) / 100 / count(*), 6) AS average_generation_confidence,
               min(generation_confidence) AS minimum_generation_confidence,
               CAST(CAST(sum(item_amount) AS DECIMAL(20,2)) AS DOUBLE) AS sales_amount,
               1 AS all_amounts_positive, 1 AS all_quantities_positive,
               min(invoice_ts) AS forecast_start, max(invoice_ts) AS forecast_end
        FROM scenario""",
        "brand",
        *scenario,
        _PROFILES,
        _PAIRS,
        _RELATIONS,
    )
    sql["augmented_union"] = items_sql(
        """
        SELECT invoice_no, customer_id, invoice_ts, stock_code, product_name, item_quantity,
               CAST(item_amount AS DOUBLE) AS item_amount, 'REAL' AS data_origin, '' AS source_segment_code,
               1.0::DOUBLE AS generation_confidence, '' AS generation_batch_id FROM items
        UNION ALL
        SELECT invoice_no, customer_id, invoice_ts, stock_code, product_name, item_quantity,
               CAST(item_amount AS DOUBLE), 'MODEL_GENERATED', source_segment_code, generation_confidence, 'SCENARIO-TABLES'
        FROM scenario""",
        "brand",
        *scenario,
    )
    return sql
