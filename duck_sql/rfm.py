"""Snapshots, scores, segments and movements, computed snapshot by snapshot."""

from __future__ import annotations

from duck_sql.base import items_sql, rnd

CALENDAR = """
    span AS (
        SELECT CAST(min(invoice_ts) AS DATE) AS first_day, CAST(max(invoice_ts) AS DATE) AS final_day FROM items
    ),
    ends AS (
        SELECT CAST(last_day(CAST(m AS DATE)) AS DATE) AS snapshot_date
        FROM (SELECT unnest(generate_series(date_trunc('month', first_day), final_day, INTERVAL 1 MONTH)) AS m FROM span)
    ),
    calendar AS (
        SELECT row_number() OVER (ORDER BY snapshot_date) - 1 AS snapshot_index, snapshot_date
        FROM (
            SELECT snapshot_date FROM ends, span WHERE snapshot_date >= first_day + 30 AND snapshot_date <= final_day
            UNION ALL SELECT final_day + 1 FROM span
        )
    )"""

VALUES = """
    snapshot_values AS (
        SELECT snapshot_index, snapshot_date, customer_id, max(invoice_ts) AS latest_purchase_ts,
               date_diff('day', CAST(max(invoice_ts) AS DATE), snapshot_date) AS recency_days,
               count(DISTINCT invoice_no) AS frequency, sum(item_amount) AS monetary
        FROM calendar JOIN items ON CAST(items.invoice_ts AS DATE) <= calendar.snapshot_date
        GROUP BY snapshot_index, snapshot_date, customer_id
    )"""


def _score(metric: str, name: str, reverse: bool = False) -> str:
    rank = f"(row_number() OVER (PARTITION BY snapshot_date ORDER BY {metric}, customer_id))"
    rows = "(count(*) OVER (PARTITION BY snapshot_date))"
    score = f"CASE WHEN {rows} = 1 THEN 1 ELSE greatest(1, (({rank} - 1) * least(5, {rows}) + {rows} - 2) // ({rows} - 1)) END"
    return f"least(5, {rows}) + 1 - ({score}) AS {name}" if reverse else f"{score} AS {name}"


SCORED = f"""
    scores AS (
        SELECT *, {_score("recency_days", "r_score", True)}, {_score("frequency", "f_score")},
               {_score("monetary", "m_score")}
        FROM snapshot_values
    ),
    codes AS (
        SELECT * REPLACE (CAST(round(monetary, 2) AS DECIMAL(20,2)) AS monetary),
               CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
               CASE WHEN r_score >= 4 AND (f_score + m_score) / 2.0 >= 4 THEN 'CHAMPIONS'
                    WHEN r_score >= 3 AND (f_score + m_score) / 2.0 >= 3 THEN 'LOYAL'
                    WHEN r_score >= 4 AND (f_score + m_score) / 2.0 >= 2 THEN 'POTENTIAL'
                    WHEN r_score >= 4 THEN 'NEW'
                    WHEN r_score <= 2 AND (f_score + m_score) / 2.0 >= 4 THEN 'AT_RISK'
                    WHEN r_score <= 2 AND (f_score + m_score) / 2.0 >= 2 THEN 'HIBERNATING'
                    WHEN r_score >= 3 THEN 'PROMISING'
                    ELSE 'GENERAL' END AS segment_code
        FROM scores
    ),
    snapshots AS (
        SELECT *, CASE segment_code WHEN 'CHAMPIONS' THEN '重要价值客户' WHEN 'LOYAL' THEN '重要保持客户'
                       WHEN 'POTENTIAL' THEN '重要发展客户' WHEN 'NEW' THEN '新客户' WHEN 'AT_RISK' THEN '重要挽留客户'
                       WHEN 'HIBERNATING' THEN '流失风险客户' WHEN 'PROMISING' THEN '潜力客户' ELSE '一般客户' END AS segment_name
        FROM codes
    ),
    final_snapshot AS (SELECT * FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots))"""

SUMMARY = f"""
    segment_summary AS (
        SELECT snapshot_date, segment_code, segment_name, customer_count, total_monetary,
               {rnd("recency / CAST(customer_count AS DOUBLE)", 2)} AS average_recency_days,
               {rnd("orders / CAST(customer_count AS DOUBLE)", 2)} AS average_frequency,
               {rnd("CAST(total_monetary AS DOUBLE) / customer_count", 2)} AS average_monetary,
               {rnd("customer_count / CAST(sum(customer_count) OVER (PARTITION BY snapshot_date) AS DOUBLE)", 6)} AS customer_share,
               {rnd("CAST(total_monetary AS DOUBLE) / CAST(sum(total_monetary) OVER (PARTITION BY snapshot_date) AS DOUBLE)", 6)} AS monetary_share
        FROM (
            SELECT snapshot_date, segment_code, segment_name, count(*) AS customer_count, sum(monetary) AS total_monetary,
                   CAST(sum(recency_days) AS DOUBLE) AS recency, CAST(sum(frequency) AS DOUBLE) AS orders
            FROM snapshots GROUP BY ALL
        )
    )"""

MIGRATIONS = """
    migrations AS (
        SELECT a.segment_code AS from_segment_code, a.segment_name AS from_segment_name,
               b.segment_code AS to_segment_code, b.segment_name AS to_segment_name, count(*) AS customer_count,
               a.snapshot_date AS from_snapshot_date, b.snapshot_date AS to_snapshot_date
        FROM snapshots a JOIN snapshots b ON a.customer_id = b.customer_id AND b.snapshot_index = a.snapshot_index + 1
        GROUP BY ALL
    )"""

SNAPSHOT_PARTS = (CALENDAR, VALUES, SCORED)

_CUSTOMER_COLUMNS = """CAST(snapshot_date AS VARCHAR) AS snapshot_date, customer_id, latest_purchase_ts, recency_days,
               frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, rfm_score, segment_code, segment_name"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["rfm_observation_window"] = items_sql(
        """
        SELECT invoice_no, customer_id, stock_code, invoice_ts, CAST(item_amount AS DOUBLE) AS item_amount
        FROM items WHERE invoice_ts < TIMESTAMP '2000-01-01' AND invoice_ts >= TIMESTAMP '1998-06-15'"""
    )
    sql["year_windows"] = items_sql(
        """
        SELECT 'current' AS window_name, invoice_no, customer_id, stock_code, invoice_ts FROM items
        WHERE invoice_ts >= (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR
        UNION ALL
        SELECT 'previous', invoice_no, customer_id, stock_code, invoice_ts FROM items
        WHERE invoice_ts >= (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR - INTERVAL 1 YEAR
          AND invoice_ts < (SELECT max(invoice_ts) FROM items) - INTERVAL 1 YEAR"""
    )
    sql["rfm_calendar"] = items_sql(
        "SELECT snapshot_index, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM calendar", "brand", CALENDAR
    )
    sql["rfm_base"] = items_sql(
        """
        SELECT '1999-12-31' AS snapshot_date, customer_id, max(invoice_ts) AS latest_purchase_ts,
               date_diff('day', CAST(max(invoice_ts) AS DATE), DATE '1999-12-31') AS recency_days,
               count(DISTINCT invoice_no) AS frequency, CAST(sum(item_amount) AS DOUBLE) AS monetary
        FROM items WHERE invoice_ts < TIMESTAMP '2000-01-01' GROUP BY customer_id"""
    )
    sql["rfm_snapshots"] = items_sql(
        """
        SELECT snapshot_index, CAST(snapshot_date AS VARCHAR) AS snapshot_date, customer_id, latest_purchase_ts,
               recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary
        FROM snapshot_values""",
        "brand",
        CALENDAR,
        VALUES,
    )
    sql["rfm_snapshots_carried"] = sql["rfm_snapshots"]
    sql["rfm_scores"] = items_sql(
        """
        SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, customer_id, CAST(monetary AS DOUBLE) AS monetary,
               r_score, f_score, m_score, rfm_score
        FROM snapshots""",
        "brand",
        *SNAPSHOT_PARTS,
    )
    sql["rfm_segments"] = items_sql(
        f"SELECT {_CUSTOMER_COLUMNS} FROM snapshots", "brand", *SNAPSHOT_PARTS
    )
    sql["rfm_latest"] = items_sql(f"SELECT {_CUSTOMER_COLUMNS} FROM final_snapshot", "brand", *SNAPSHOT_PARTS)
    sql["rfm_segment_summary"] = items_sql(
        """
        SELECT * REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(total_monetary AS DOUBLE) AS total_monetary)
        FROM segment_summary""",
        "brand",
        *SNAPSHOT_PARTS,
        SUMMARY,
    )
    sql["segment_migrations"] = items_sql(
        """
        SELECT * REPLACE (CAST(from_snapshot_date AS VARCHAR) AS from_snapshot_date,
                          CAST(to_snapshot_date AS VARCHAR) AS to_snapshot_date)
        FROM migrations""",
        "brand",
        *SNAPSHOT_PARTS,
        MIGRATIONS,
    )
    return sql
