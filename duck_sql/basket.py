"""Baskets, itemsets, rules and drift by self-joins of basket lines."""

from __future__ import annotations

from duck_sql.base import SERVICE_CODES, items_sql, rnd
from duck_sql.rfm import SNAPSHOT_PARTS


def prepared(source: str = "items", suffix: str = "") -> str:
    return f"""
    lines{suffix} AS (
        SELECT invoice_no, stock_code, customer_id, product_name
        FROM (
            SELECT *, row_number() OVER (PARTITION BY invoice_no, stock_code
                                         ORDER BY customer_id, product_name NULLS FIRST) AS pick
            FROM {source} WHERE upper(stock_code) NOT IN {SERVICE_CODES}
        ) WHERE pick = 1
    ),
    prepared{suffix} AS (
        SELECT * FROM lines{suffix}
        WHERE invoice_no IN (SELECT invoice_no FROM lines{suffix} GROUP BY 1 HAVING count(*) >= 2)
    )"""


def scoped(suffix: str = "", segments: str | None = None, min_segment_baskets: int = 200) -> str:
    own = ""
    if segments:
        own = f"UNION ALL SELECT s.segment_code, s.segment_name, p.* FROM prepared{suffix} p JOIN {segments} s USING (customer_id)"
    return f"""
    every_scope{suffix} AS (
        SELECT 'ALL' AS scope, '全部客户' AS scope_name, p.* FROM prepared{suffix} p {own}
    ),
    scoped{suffix} AS (
        SELECT * FROM every_scope{suffix}
        WHERE scope = 'ALL' OR scope IN (SELECT scope FROM every_scope{suffix} GROUP BY 1
                                         HAVING count(DISTINCT invoice_no) >= {min_segment_baskets})
    )"""


def mined(suffix: str = "", min_confidence: float = 0.15, min_lift: float = 1.05) -> str:
    support = "CASE WHEN scope = 'ALL' THEN 0.002::DOUBLE ELSE 0.01::DOUBLE END"
    s = suffix
    return f"""
    sizes{s} AS (SELECT scope, count(DISTINCT invoice_no) AS baskets FROM scoped{s} GROUP BY 1),
    products{s} AS (
        SELECT scope, stock_code, coverage
        FROM (SELECT scope, stock_code, count(DISTINCT invoice_no) AS coverage FROM scoped{s} GROUP BY 1, 2)
        JOIN sizes{s} USING (scope)
        WHERE baskets >= 2 AND coverage >= greatest(2, ceil(baskets * ({support})))
    ),
    in_products{s} AS (SELECT l.* FROM scoped{s} l JOIN products{s} USING (scope, stock_code)),
    kept{s} AS (
        SELECT * FROM in_products{s}
        WHERE (scope, invoice_no) IN (SELECT (scope, invoice_no) FROM in_products{s} GROUP BY scope, invoice_no
                                      HAVING count(DISTINCT stock_code) >= 2)
    ),
    kept_sizes{s} AS (
        SELECT scope, baskets, ceil(baskets * ({support})) AS needed
        FROM (SELECT scope, count(DISTINCT invoice_no) AS baskets FROM kept{s} GROUP BY 1) WHERE baskets >= 2
    ),
    catalog{s} AS (
        SELECT scope, stock_code, max(coalesce(product_name, '未知商品')) AS product_name, max(scope_name) AS scope_name
        FROM kept{s} GROUP BY 1, 2
    ),
    singles{s} AS (
        SELECT scope, [stock_code] AS itemset, n FROM (SELECT scope, stock_code, count(*) AS n FROM kept{s} GROUP BY 1, 2)
        JOIN kept_sizes{s} USING (scope) WHERE n >= needed
    ),
    pair_lines{s} AS (
        SELECT a.scope, a.invoice_no, a.stock_code AS a, b.stock_code AS b
        FROM kept{s} a JOIN kept{s} b
          ON a.scope = b.scope AND a.invoice_no = b.invoice_no AND a.stock_code < b.stock_code
    ),
    pairs{s} AS (
        SELECT scope, [a, b] AS itemset, n FROM (SELECT scope, a, b, count(*) AS n FROM pair_lines{s} GROUP BY 1, 2, 3)
        JOIN kept_sizes{s} USING (scope) WHERE n >= needed
    ),
    triples{s} AS (
        SELECT scope, [a, b, c] AS itemset, n FROM (
            SELECT p.scope, p.a, p.b, k.stock_code AS c, count(*) AS n
            FROM pair_lines{s} p JOIN kept{s} k
              ON p.scope = k.scope AND p.invoice_no = k.invoice_no AND p.b < k.stock_code
            GROUP BY 1, 2, 3, 4
        ) JOIN kept_sizes{s} USING (scope) WHERE n >= needed
    ),
    frequent{s} AS (SELECT * FROM singles{s} UNION ALL SELECT * FROM pairs{s} UNION ALL SELECT * FROM triples{s}),
    splits{s} AS (
        SELECT scope, n, itemset, list_filter(itemset, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS ant,
               list_filter(itemset, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 0) AS con
        FROM (SELECT *, unnest(generate_series(1, CAST(pow(2, len(itemset)) AS BIGINT) - 2)) AS mask
              FROM frequent{s} WHERE len(itemset) >= 2)
    ),
    counted{s} AS (
        SELECT p.scope, p.n, p.ant, p.con, z.baskets, CAST(p.n AS DOUBLE) / z.baskets AS support,
               CAST(a.n AS DOUBLE) / z.baskets AS ant_support, CAST(c.n AS DOUBLE) / z.baskets AS con_support
        FROM splits{s} p JOIN kept_sizes{s} z USING (scope)
        JOIN frequent{s} a ON a.scope = p.scope AND a.itemset = p.ant
        JOIN frequent{s} c ON c.scope = p.scope AND c.itemset = p.con
    ),
    measured{s} AS (
        SELECT *, support / ant_support AS confidence, (support / ant_support) / con_support AS lift,
               support - ant_support * con_support AS leverage,
               CASE WHEN support / ant_support < 1
                    THEN (1.0::DOUBLE - con_support) / (1.0::DOUBLE - support / ant_support) END AS conviction,
               ((support / ant_support) / con_support) * (support / ant_support) * ln(1 + n) AS rank_score
        FROM counted{s}
        WHERE support / ant_support >= {min_confidence}::DOUBLE
          AND (support / ant_support) / con_support >= {min_lift}::DOUBLE
    ),
    sides{s} AS (
        SELECT m.scope, m.ant, m.con, array_to_string(m.ant, '|') AS antecedent_codes, array_to_string(m.con, '|') AS consequent_codes,
               (SELECT string_agg(c.product_name, '|' ORDER BY c.stock_code) FROM catalog{s} c
                WHERE c.scope = m.scope AND list_contains(m.ant, c.stock_code)) AS antecedent_names,
               (SELECT string_agg(c.product_name, '|' ORDER BY c.stock_code) FROM catalog{s} c
                WHERE c.scope = m.scope AND list_contains(m.con, c.stock_code)) AS consequent_names
        FROM measured{s} m
    ),
    ranked{s} AS (
        SELECT m.*, d.antecedent_codes, d.consequent_codes, d.antecedent_names, d.consequent_names,
               row_number() OVER (PARTITION BY m.scope ORDER BY m.rank_score DESC, m.lift DESC, m.n DESC,
                                  d.antecedent_codes, d.consequent_codes) AS position
        FROM measured{s} m JOIN sides{s} d ON m.scope = d.scope AND m.ant = d.ant AND m.con = d.con
    ),
    all_rules{s} AS (
        SELECT position, substr(sha1(scope || ':' || antecedent_codes || '>' || consequent_codes), 1, 16) AS rule_id,
               scope AS segment_code,
               (SELECT max(scope_name) FROM catalog{s} c WHERE c.scope = ranked{s}.scope) AS segment_name,
               antecedent_codes, antecedent_names, consequent_codes, consequent_names,
               {rnd("support", 6)} AS support, {rnd("confidence", 6)} AS confidence, {rnd("lift", 6)} AS lift,
               {rnd("leverage", 6)} AS leverage, {rnd("conviction", 6)} AS conviction, n AS coverage_basket_count,
               baskets AS scope_basket_count, {rnd("rank_score", 6)} AS rank_score
        FROM ranked{s}
    ),
    rules{s} AS (SELECT * EXCLUDE (position) FROM all_rules{s})"""


SEGMENTS = """
    one_segment AS (SELECT customer_id, min(segment_code) AS segment_code, min(segment_name) AS segment_name
                    FROM final_snapshot GROUP BY 1)"""

YEARS = """
    current_items AS (
        SELECT * FROM items WHERE invoice_ts >= (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR
    ),
    previous_items AS (
        SELECT * FROM items
        WHERE invoice_ts >= (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR - INTERVAL 1 YEAR
          AND invoice_ts < (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR
    )"""

DRIFT = """
    drift AS (
        SELECT *, CASE WHEN previous_lift IS NULL THEN 'NEW' WHEN current_lift IS NULL THEN 'DROPPED'
                       WHEN lift_delta > 0.1::DOUBLE THEN 'GROWING' WHEN lift_delta < -0.1::DOUBLE THEN 'DECLINING'
                       ELSE 'STABLE' END AS drift_status
        FROM (
            SELECT coalesce(p.segment_code, c.segment_code) AS segment_code,
                   coalesce(p.antecedent_codes, c.antecedent_codes) AS antecedent_codes,
                   coalesce(p.consequent_codes, c.consequent_codes) AS consequent_codes,
                   c.segment_name, c.antecedent_names, c.consequent_names,
                   p.support AS previous_support, p.confidence AS previous_confidence, p.lift AS previous_lift,
                   p.coverage_basket_count AS previous_coverage_basket_count,
                   c.support AS current_support, c.confidence AS current_confidence, c.lift AS current_lift,
                   c.coverage_basket_count AS current_coverage_basket_count,
                   c.lift - p.lift AS lift_delta, c.support - p.support AS support_delta
            FROM rules_p p FULL OUTER JOIN rules_c c
              ON p.segment_code = c.segment_code AND p.antecedent_codes = c.antecedent_codes
             AND p.consequent_codes = c.consequent_codes
        )
    )"""


def drift_parts(min_confidence: float = 0.005) -> tuple[str, ...]:
    return (
        YEARS,
        prepared("previous_items", "_p"),
        scoped("_p"),
        mined("_p", min_confidence),
        prepared("current_items", "_c"),
        scoped("_c"),
        mined("_c", min_confidence),
        DRIFT,
    )


def segment_parts(min_confidence: float = 0.15) -> tuple[str, ...]:
    return (*SNAPSHOT_PARTS, SEGMENTS, prepared(), scoped("", "one_segment"), mined("", min_confidence))


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["basket_items"] = items_sql(
        "SELECT invoice_no, customer_id, stock_code, product_name FROM prepared", "brand", prepared()
    )
    scopes = (*SNAPSHOT_PARTS, SEGMENTS, prepared(), scoped("", "one_segment"))
    sql["basket_scopes"] = items_sql(
        "SELECT scope, scope_name, invoice_no, customer_id, stock_code, product_name FROM scoped", "brand", *scopes
    )
    mining = (*scopes, mined())
    sql["scope_products"] = items_sql("SELECT scope, stock_code, coverage FROM products", "brand", *mining)
    sql["scope_baskets"] = items_sql(
        """
        SELECT scope, invoice_no, string_agg(stock_code, '|' ORDER BY stock_code) AS codes, count(*) AS width
        FROM kept GROUP BY 1, 2""",
        "brand",
        *mining,
    )
    sql["frequent_itemsets"] = items_sql(
        """
        SELECT scope, array_to_string(itemset, '|') AS codes, len(itemset) AS length, n AS support_count,
               baskets AS scope_basket_count
        FROM frequent JOIN kept_sizes USING (scope)""",
        "brand",
        *mining,
    )
    sql["product_catalog"] = items_sql("SELECT scope, stock_code, product_name FROM catalog", "brand", *mining)
    everyone = (prepared(), scoped())
    sql["association_rules"] = items_sql("SELECT * FROM rules", "brand", *everyone, mined())
    sql["association_rules_wide"] = items_sql("SELECT * FROM rules", "brand", *everyone, mined("", 0.005))
    sql["top_rules_per_scope"] = items_sql(
        "SELECT * EXCLUDE (position) FROM all_rules WHERE position <= 10", "brand", *segment_parts(0.05)
    )
    sql["segment_rules"] = items_sql("SELECT * FROM rules", "brand", *segment_parts())
    sql["rule_drift"] = items_sql("SELECT * FROM drift", "brand", *drift_parts())
    sql["drift_counts"] = items_sql(
        "SELECT drift_status, count(*) AS rule_count FROM drift GROUP BY 1", "brand", *drift_parts()
    )
    return sql
