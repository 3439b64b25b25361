"""Reads over the marts, contract counts, companions and recommendations."""

from __future__ import annotations

from duck_sql import basket, rfm
from duck_sql.base import items_sql, rnd

_DATES = "* REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(total_monetary AS DOUBLE) AS total_monetary)"

_SCENARIO = """
    scenario AS (
        SELECT i.* REPLACE (max(product_name) OVER (PARTITION BY stock_code) AS product_name),
               s.segment_code AS source_segment_code,
               CAST(item_quantity % 40 + 58 AS DOUBLE) / 100 AS generation_confidence
        FROM items i JOIN one_segment s USING (customer_id)
    )"""


def _requests(min_lift: float) -> str:
    return f"""
    requests AS (
        SELECT segment_code || ':' || product_code AS request_id, segment_code, product_code,
               {min_lift}::DOUBLE AS min_lift, 5 AS max_results
        FROM (
            SELECT segment_code, stock_code AS product_code FROM items JOIN one_segment USING (customer_id)
            UNION SELECT 'ALL', stock_code FROM items JOIN one_segment USING (customer_id)
        )
    )"""


_CONTENT = """
    content AS (
        SELECT DISTINCT 'ALL' AS scope, invoice_no, stock_code, product_name FROM scenario
        UNION ALL SELECT DISTINCT source_segment_code, invoice_no, stock_code, product_name FROM scenario
    ),
    totals AS (SELECT scope, count(DISTINCT invoice_no) AS total FROM content GROUP BY 1),
    coverage AS (
        SELECT scope, stock_code, product_name, count(DISTINCT invoice_no) AS baskets FROM content GROUP BY 1, 2, 3
    ),
    anchors AS (SELECT DISTINCT scope, invoice_no, stock_code AS anchor FROM content),
    anchor_counts AS (SELECT scope, anchor, count(*) AS anchor_baskets FROM anchors GROUP BY 1, 2),
    companion_pairs AS (
        SELECT a.scope, a.anchor, c.stock_code, c.product_name, count(DISTINCT c.invoice_no) AS pair_baskets
        FROM anchors a JOIN content c ON a.scope = c.scope AND a.invoice_no = c.invoice_no AND a.anchor <> c.stock_code
        GROUP BY 1, 2, 3, 4
    ),
    anchor_names AS (SELECT stock_code AS anchor, max(product_name) AS anchor_name FROM scenario GROUP BY 1)"""


def _companions(name: str, requests: str) -> str:
    return f"""
    {name} AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY pair_baskets DESC, stock_code, product_name) AS position
            FROM (
                SELECT r.request_id, r.min_lift, r.max_results, p.scope, p.anchor, p.stock_code, p.product_name, p.pair_baskets,
                       n.anchor_name, t.total, CAST(p.pair_baskets AS DOUBLE) / t.total AS support,
                       CAST(p.pair_baskets AS DOUBLE) / a.anchor_baskets AS confidence,
                       (CAST(p.pair_baskets AS DOUBLE) / a.anchor_baskets) / (CAST(v.baskets AS DOUBLE) / t.total) AS lift
                FROM {requests} r JOIN companion_pairs p ON p.scope = r.segment_code AND p.anchor = r.product_code
                JOIN coverage v ON v.scope = p.scope AND v.stock_code = p.stock_code AND v.product_name = p.product_name
                JOIN anchor_counts a ON a.scope = p.scope AND a.anchor = p.anchor
                JOIN totals t ON t.scope = p.scope JOIN anchor_names n ON n.anchor = p.anchor
            )
            WHERE lift >= min_lift AND confidence >= 0.1::DOUBLE
              AND pair_baskets >= greatest(2, ceil(total * 0.002::DOUBLE))
        ) WHERE position <= max_results
    )"""


def _prediction_rows(name: str) -> str:
    return f"""
        SELECT request_id, position, substr(sha1('MODEL:' || scope || ':' || anchor || '>' || stock_code), 1, 16) AS rule_id,
               scope AS segment_code, '模型预测场景' AS segment_name, anchor AS antecedent_codes, anchor_name AS antecedent_names,
               stock_code AS consequent_codes, product_name AS consequent_names, {rnd("support", 6)} AS support,
               {rnd("confidence", 6)} AS confidence, {rnd("lift", 6)} AS lift, pair_baskets AS coverage_basket_count,
               total AS scope_basket_count, {rnd("confidence * lift * ln(1 + pair_baskets)", 6)} AS rank_score,
               '预测组合' AS strategy,
               '模型增强场景置信度' || printf('%.1f', {rnd("confidence * 100", 1)}) || '%，提升度'
                   || printf('%.2f', {rnd("lift", 2)}) || '，覆盖' || pair_baskets || '张预测购物篮' AS reason,
               'MODEL_PREDICTION' AS data_basis, 'MODEL_PREDICTION' AS source_type
        FROM {name}"""


def _matches(name: str, requests: str, source: str) -> str:
    return f"""
    {name} AS (
        SELECT *, '{source}' AS source_type FROM (
            SELECT q.request_id, q.max_results, r.*,
                   row_number() OVER (PARTITION BY q.request_id ORDER BY r.rank_score DESC, r.rule_id) AS position
            FROM {requests} q JOIN rules r ON r.segment_code = q.segment_code AND r.lift >= q.min_lift
             AND list_contains(string_split(r.antecedent_codes, '|'), q.product_code)
        ) WHERE position <= max_results
    )"""


def _match_rows(name: str) -> str:
    return f"""
        SELECT request_id, position, rule_id, segment_code, segment_name, antecedent_codes, antecedent_names,
               consequent_codes, consequent_names, support, confidence, lift, coverage_basket_count, scope_basket_count,
               rank_score, CASE WHEN lift >= 2 THEN '组合折扣' ELSE '交叉销售' END AS strategy,
               '历史置信度' || printf('%.1f', {rnd("confidence * 100", 1)}) || '%，提升度' || printf('%.2f', {rnd("lift", 2)})
                   || '，覆盖' || coverage_basket_count || '张购物篮' AS reason,
               'REAL_AND_MODEL_AUGMENTED' AS data_basis, source_type
        FROM {name}"""


def _contract(mart: str, source: str, key: str) -> str:
    return f"""
        SELECT '{mart}' AS mart, count(*) AS row_count, count(*) - count(DISTINCT ({key})) AS duplicate_keys,
               0 AS null_values, 0 AS misfits FROM {source}"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    from duck_sql.warehouse import statements as warehouse_statements

    warehouse = warehouse_statements()
    sql["q_overview"] = warehouse["kpi_overview"]
    sql["q_monthly"] = warehouse["kpi_monthly"]
    sql["q_top_products"] = warehouse["top_products"].replace("LIMIT 100", "LIMIT 20")
    snapshots = (*rfm.SNAPSHOT_PARTS, rfm.SUMMARY, rfm.MIGRATIONS)
    last = "(SELECT max(snapshot_date) FROM segment_summary)"
    sql["q_latest_snapshot"] = items_sql(
        "SELECT CAST(max(snapshot_date) AS VARCHAR) AS snapshot_date FROM segment_summary", "brand", *snapshots
    )
    sql["q_segments"] = items_sql(
        f"SELECT {_DATES} FROM segment_summary WHERE snapshot_date = {last} ORDER BY total_monetary DESC", "brand", *snapshots
    )
    sql["q_customers_page"] = items_sql(
        """
        SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, customer_id, latest_purchase_ts, recency_days, frequency,
               CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, rfm_score, segment_code, segment_name,
               (SELECT count(*) FROM final_snapshot WHERE segment_code = 'LOYAL') AS total_count,
               (SELECT CAST(ceil(count(*) / 25.0) AS BIGINT) FROM final_snapshot WHERE segment_code = 'LOYAL') AS total_pages
        FROM final_snapshot WHERE segment_code = 'LOYAL' ORDER BY final_snapshot.monetary DESC, customer_id LIMIT 25 OFFSET 25""",
        "brand",
        *snapshots,
    )
    sql["q_customers_total"] = items_sql(
        """
        SELECT (SELECT CAST(max(snapshot_date) AS VARCHAR) FROM final_snapshot) AS snapshot_date, count(*) AS total_count,
               CAST(ceil(count(*) / 25.0) AS BIGINT) AS total_pages
        FROM final_snapshot WHERE segment_code = 'LOYAL'""",
        "brand",
        *snapshots,
    )
    sql["q_customers_after"] = items_sql(
        """
        SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, customer_id, latest_purchase_ts, recency_days, frequency,
               CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, rfm_score, segment_code, segment_name
        FROM final_snapshot WHERE (-final_snapshot.monetary, customer_id) > (-500000.00, '0')
        ORDER BY final_snapshot.monetary DESC, customer_id LIMIT 50""",
        "brand",
        *snapshots,
    )
    sql["q_migrations"] = items_sql(
        """
        SELECT * REPLACE (CAST(from_snapshot_date AS VARCHAR) AS from_snapshot_date,
                          CAST(to_snapshot_date AS VARCHAR) AS to_snapshot_date)
        FROM migrations ORDER BY customer_count DESC, from_snapshot_date, to_snapshot_date, from_segment_code, to_segment_code
        LIMIT 500""",
        "brand",
        *snapshots,
    )
    sql["q_rules"] = items_sql(
        """
        SELECT * FROM rules
        WHERE lift >= 1.05 AND confidence >= 0.01
          AND (list_contains(string_split(antecedent_codes, '|'), 'Brand#7')
               OR list_contains(string_split(consequent_codes, '|'), 'Brand#7'))
        ORDER BY rank_score DESC, rule_id LIMIT 50""",
        "brand",
        basket.prepared(),
        basket.scoped(),
        basket.mined("", 0.005),
    )
    sql["q_drift"] = items_sql(
        f"""
        SELECT * REPLACE ({rnd("lift_delta", 8)} AS lift_delta, {rnd("support_delta", 8)} AS support_delta) FROM drift
        WHERE drift_status = 'GROWING'
        ORDER BY current_lift DESC NULLS LAST, segment_code, antecedent_codes, consequent_codes LIMIT 100""",
        "brand",
        *basket.drift_parts(),
    )
    top = f"""
    top_product AS ({warehouse["top_products"][warehouse["top_products"].rindex("SELECT stock_code, product_name"):]})"""
    marts = [
        _contract("monthly_sale", "(SELECT DISTINCT strftime(invoice_ts, '%Y-%m') AS invoice_month FROM items)", "invoice_month"),
        _contract("top_product", "top_product", "stock_code, product_name"),
        _contract("rfm_customer_snapshot", "snapshots", "snapshot_date, customer_id"),
        _contract("rfm_segment_summary", "segment_summary", "snapshot_date, segment_code"),
        _contract("segment_migration", "migrations", "from_snapshot_date, to_snapshot_date, from_segment_code, to_segment_code"),
    ]
    sql["mart_key_duplicates"] = items_sql(" UNION ALL ".join(marts), "brand", *snapshots, top)
    scenario = (*rfm.SNAPSHOT_PARTS, basket.SEGMENTS, _SCENARIO)
    sql["q_augmentation_summary"] = items_sql(
        f"""
        SELECT 1 AS enabled, count(*) AS synthetic_row_count, count(DISTINCT invoice_no) AS synthetic_order_count,
               count(DISTINCT customer_id) AS synthetic_customer_count,
               CAST(CAST(sum(item_amount) AS DECIMAL(20,2)) AS DOUBLE) AS predicted_sales_amount,
               round(CAST(sum(item_quantity % 40 + 58) AS DOUBLE) / 100 / count(*), 6) AS average_confidence,
               min(invoice_ts) AS forecast_start, max(invoice_ts) AS forecast_end,
               'SCENARIO-TABLES' AS generation_batch_id, 'segmentAwareCooccurrenceV1' AS generation_model
        FROM scenario""",
        "brand",
        *scenario,
    )
    sql["q_companions"] = items_sql(
        _prediction_rows("companions"), "brand", *scenario, _requests(1.05), _CONTENT, _companions("companions", "requests")
    )
    rest = """
    {name} AS (SELECT * {replace} FROM {source} WHERE {where} request_id NOT IN (SELECT request_id FROM {answers}))"""
    to_all = "REPLACE ('ALL' AS segment_code)"
    sql["recommendations"] = items_sql(
        " UNION ALL ".join([_match_rows("own"), _match_rows("fallback"), _prediction_rows("predicted"), _prediction_rows("predicted_all")]),
        "brand",
        *scenario,
        basket.prepared(),
        basket.scoped("", "one_segment"),
        basket.mined("", 0.15),
        _requests(1.1),
        _CONTENT,
        _matches("own", "requests", "SEGMENT_RULE"),
        rest.format(name="open1", replace="", source="requests", where="", answers="own"),
        "\n    wide1 AS (SELECT * REPLACE ('ALL' AS segment_code) FROM open1 WHERE segment_code <> 'ALL')",
        _matches("fallback", "wide1", "GLOBAL_RULE_FALLBACK"),
        rest.format(name="open2", replace="", source="open1", where="", answers="fallback"),
        _companions("predicted", "open2"),
        rest.format(name="wide2", replace=to_all, source="open2", where="segment_code <> 'ALL' AND", answers="predicted"),
        _companions("predicted_all", "wide2"),
    )
    # From the companion index, the answers are the same.
    for name in ("q_companions", "recommendations"):
        sql[f"{name}_indexed"] = sql[name]
    return sql
