"""Scenario baskets, drawn by the digests that `tillroll.functions.random` defines."""

from __future__ import annotations

from duck_sql import augment, basket, rfm
from duck_sql.base import items_sql, rnd

SEED, BATCH = 20_260_721, "SCENARIO-TABLES"
CUSTOMERS, SMALLEST, LARGEST, MONTHS = 600, 3, 6, 6
# A draw looks at so many candidates; each anchor offers so many relations after the first.
DRAW_FROM, RELATIONS = 30, 9


def uniform(purpose: str, *keys: str) -> str:
    text = f"concat_ws('|', '{SEED}|{purpose}', {', '.join(keys)})"
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496::DOUBLE)"


def below(limit: str, purpose: str, *keys: str) -> str:
    return f"CAST(floor({uniform(purpose, *keys)} * {limit}) AS BIGINT)"


def log_normal(mean: str, sigma: str, purpose: str, *keys: str) -> str:
    radius = f"sqrt(ln(1.0::DOUBLE - {uniform(purpose + '-radius', *keys)}) * -2.0::DOUBLE)"
    return f"exp({radius} * cos({uniform(purpose + '-angle', *keys)} * (2 * pi())) * {sigma}::DOUBLE + {mean})"


def pick(choices: str, number: str) -> str:
    return f"coalesce(list_filter({choices}, lambda x: x.upto > {number})[1], {choices}[-1])"


def upto(weight: str, keys: str, order: str) -> str:
    """Share of the keys' weight up to and including each row."""
    return f"sum({weight}) OVER (PARTITION BY {keys} ORDER BY {order}) / sum({weight}) OVER (PARTITION BY {keys})"


_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

_CONTEXT = f"""
    ranked_relations AS (
        SELECT *, row_number() OVER (PARTITION BY anchor_code ORDER BY score DESC, companion_code) AS relation_rank FROM relations
    ),
    anchors AS (
        SELECT stock_code, row_number() OVER (ORDER BY sales_rank) - 1 AS anchor_index FROM ranked_profiles
        WHERE sales_rank <= {augment.TOP_ANCHORS} AND stock_code IN (SELECT anchor_code FROM relations)
    ),
    customer_orders AS (
        SELECT segment_code, customer_id, count(DISTINCT invoice_no) AS order_count FROM segment_items GROUP BY 1, 2
    ),
    basket_amounts AS (
        SELECT invoice_no, customer_id, segment_code, CAST(sum(item_amount) * 10000 AS BIGINT) AS units
        FROM segment_items GROUP BY 1, 2, 3
    ),
    customer_budgets AS (SELECT customer_id, median(units) / 1e4 AS budget FROM basket_amounts GROUP BY 1),
    segment_budgets AS (SELECT segment_code, median(units) / 1e4 AS segment_budget FROM basket_amounts GROUP BY 1),
    segment_sizes AS (
        SELECT segment_code, count(*) AS customer_count, sum(count(*)) OVER (ORDER BY segment_code) AS so_far,
               sum(count(*)) OVER () AS total
        FROM customer_orders GROUP BY 1
    ),
    pools AS (
        SELECT segment_code, CAST(round({CUSTOMERS} * (so_far - customer_count) / total) AS BIGINT) + 1 AS pool_first,
               CAST(round({CUSTOMERS} * so_far / total) AS BIGINT)
                   - CAST(round({CUSTOMERS} * (so_far - customer_count) / total) AS BIGINT) AS pool_size
        FROM segment_sizes
    ),
    own_choices AS (
        SELECT anchor_index, b.segment_code,
               CAST(b.basket_count AS DOUBLE) / sum(b.basket_count) OVER (PARTITION BY anchor_index) AS share
        FROM anchors JOIN product_baskets b USING (stock_code)
    ),
    all_choices AS (
        SELECT * FROM own_choices
        UNION ALL
        SELECT anchor_index, segment_code, 1.0::DOUBLE FROM anchors, segment_sizes
        WHERE anchor_index NOT IN (SELECT anchor_index FROM own_choices)
    ),
    choice_lists AS (
        SELECT anchor_index, list({{'upto': upto, 'segment_code': segment_code}} ORDER BY segment_code) AS choices
        FROM (SELECT *, {upto("share", "anchor_index", "segment_code")} AS upto FROM all_choices) GROUP BY 1
    ),
    customers AS (
        SELECT *, row_number() OVER (PARTITION BY segment_code, bucket, order_count ORDER BY customer_id) - 1 AS place
        FROM (SELECT *, {below("(SELECT ceil(sqrt(count(*))) FROM customer_orders)", "customer", "customer_id")} AS bucket
              FROM customer_orders)
        LEFT JOIN customer_budgets USING (customer_id)
    ),
    strata AS (
        SELECT segment_code, bucket, order_count, count(*) AS members, count(*) * sqrt(order_count) AS weight
        FROM customers GROUP BY 1, 2, 3
    ),
    strata_lists AS (
        SELECT segment_code, bucket, sum(weight) AS weight,
               list({{'upto': upto, 'order_count': order_count, 'members': members}} ORDER BY order_count) AS strata
        FROM (SELECT *, {upto("weight", "segment_code, bucket", "order_count")} AS upto FROM strata) GROUP BY 1, 2
    ),
    bucket_lists AS (
        SELECT segment_code, list({{'upto': upto, 'bucket': bucket}} ORDER BY bucket) AS buckets
        FROM (SELECT *, {upto("weight", "segment_code", "bucket")} AS upto FROM strata_lists) GROUP BY 1
    ),
    starts AS (
        SELECT anchor_code, companion_code, generation_confidence FROM ranked_relations WHERE relation_rank = 1
    ),
    wanted AS (
        SELECT anchor_index, segment_code, companion_code AS stock_code, 1 AS source, relation_rank AS place
        FROM all_choices JOIN anchors USING (anchor_index) JOIN ranked_relations r ON r.anchor_code = anchors.stock_code
        WHERE relation_rank BETWEEN 2 AND {1 + RELATIONS}
        UNION ALL
        SELECT anchor_index, segment_code, b.stock_code, 2, product_rank
        FROM all_choices JOIN segment_best b USING (segment_code) WHERE b.stock_code IN (SELECT stock_code FROM profiles)
        UNION ALL
        SELECT anchor_index, segment_code, stock_code, 3, sales_rank
        FROM all_choices, ranked_profiles WHERE sales_rank <= {DRAW_FROM + LARGEST + 2}
    ),
    fillers AS (
        SELECT anchor_index, segment_code, list(stock_code ORDER BY place)[1:{DRAW_FROM + LARGEST}] AS rest
        FROM (SELECT anchor_index, segment_code, w.stock_code, min((source, place)) AS place
              FROM wanted w JOIN anchors a USING (anchor_index) JOIN starts s ON s.anchor_code = a.stock_code
              WHERE w.stock_code NOT IN (a.stock_code, s.companion_code) GROUP BY 1, 2, 3)
        GROUP BY 1, 2
    ),
    -- A single row left over would be a basket of one line, so a block less is taken then.
    size_plan AS (
        SELECT *, lines - blocks * per_block AS rest, CAST(ceil((lines - blocks * per_block) / largest) AS BIGINT) AS tail
        FROM (SELECT *, lines // per_block - CASE WHEN lines % per_block = 1 THEN 1 ELSE 0 END AS blocks
              FROM (SELECT *, (largest - least({SMALLEST}, largest) + 1) AS n_sizes,
                           (least({SMALLEST}, largest) + largest) * (largest - least({SMALLEST}, largest) + 1) // 2 AS per_block
                    FROM (SELECT greatest(10000, (SELECT count(*) FROM items)) AS lines,
                                 least({LARGEST}, (SELECT count(*) FROM profiles)) AS largest)))
    ),
    sized AS (
        SELECT id * n_sizes + row_number() OVER block AS number,
               id * per_block + coalesce(sum(size) OVER (block {_BEFORE}), 0) AS first_line, size
        FROM (SELECT *, {uniform("size", "id", "size")} AS key
              FROM (SELECT *, unnest(range(least({SMALLEST}, largest), largest + 1)) AS size
                    FROM (SELECT *, unnest(range(blocks)) AS id FROM size_plan)))
        WINDOW block AS (PARTITION BY id ORDER BY key, size)
        UNION ALL
        SELECT blocks * n_sizes + spot + 1, blocks * per_block + spot * (rest // tail) + least(spot, rest % tail),
               rest // tail + CASE WHEN spot < rest % tail THEN 1 ELSE 0 END
        FROM (SELECT *, unnest(range(tail)) AS spot FROM size_plan)
    ),
    baskets AS (
        SELECT number, first_line, size, anchor_index, {pick("choices", uniform("segment", "number"))}.segment_code AS segment_code
        FROM (SELECT *, (number - 1) % (SELECT count(*) FROM anchors) AS anchor_index FROM sized) JOIN choice_lists USING (anchor_index)
    ),
    placed AS (
        SELECT *, pool_size > 0 AND {uniform("new-customer", "number")} < 0.2::DOUBLE AS is_new
        FROM baskets JOIN pools USING (segment_code) JOIN bucket_lists USING (segment_code) LEFT JOIN segment_budgets USING (segment_code)
    ),
    drawn AS (
        SELECT *, stratum.order_count AS order_count, {below("stratum.members", "place", "number")} AS place
        FROM (SELECT *, {pick("strata", uniform("stratum", "number"))} AS stratum
              FROM (SELECT *, {pick("buckets", uniform("bucket", "number"))}.bucket AS bucket FROM placed WHERE NOT is_new)
              JOIN strata_lists USING (segment_code, bucket))
    ),
    owned AS (
        SELECT number, first_line, size, anchor_index, segment_code, segment_budget AS budget,
               printf('SYN-C%06d', pool_first + {below("pool_size", "pool", "number")}) AS customer_id
        FROM placed WHERE is_new
        UNION ALL
        SELECT number, first_line, size, anchor_index, segment_code, coalesce(c.budget, segment_budget), c.customer_id
        FROM drawn JOIN customers c USING (segment_code, bucket, order_count, place)
    ),
    turns AS (
        SELECT number, size, 0 AS turn, rest, [a.stock_code, s.companion_code][1:size] AS taken
        FROM owned JOIN fillers USING (anchor_index, segment_code) JOIN anchors a USING (anchor_index)
        JOIN starts s ON s.anchor_code = a.stock_code
        UNION ALL
        SELECT number, size, turn + 1, rest[:spot] || rest[spot + 2:], list_append(taken, rest[spot + 1])
        FROM (SELECT *, {below(f"least(len(rest), {DRAW_FROM})", "filler", "number", "turn")} AS spot FROM turns WHERE len(taken) < size)
    ),
    drawn_lines AS (
        SELECT *, greatest(1.0::DOUBLE, least(72.0::DOUBLE, round_even(greatest(median_quantity, 1.0::DOUBLE)
                      * {log_normal("0.0::DOUBLE", "0.25", "pieces", "number", "spot")}, 0))) AS pieces
        FROM (SELECT number, unnest(taken) AS stock_code, unnest(range(len(taken))) AS spot FROM turns WHERE len(taken) = size)
        JOIN profiles USING (stock_code)
    ),
    scaled AS (
        SELECT *, greatest(8.0::DOUBLE, least(5000.0::DOUBLE, {
    log_normal("ln(greatest(coalesce(budget, 100.0::DOUBLE), 10.0::DOUBLE))", "0.32", "budget", "number")
})) / greatest(sum(median_unit_price * pieces) OVER (PARTITION BY number), 0.01::DOUBLE) AS scale
        FROM drawn_lines JOIN owned USING (number)
    ),
    first_day AS (SELECT CAST(max(invoice_ts) AS DATE) + 1 AS start FROM items)"""


def statements() -> dict[str, str]:
    parts = (
        *rfm.SNAPSHOT_PARTS,
        basket.SEGMENTS,
        augment._SEGMENT_ITEMS.format(limit=augment.SEGMENT_PRODUCTS),
        augment._PROFILES,
        augment._PAIRS,
        augment._RELATIONS,
        _CONTEXT,
    )
    days = f"date_diff('day', start, CAST(start + INTERVAL {MONTHS} MONTH AS DATE))"
    clock = " + ".join(
        f"to_{unit}s({below(limit, unit, 'number')}{start})" for unit, limit, start in (("hour", "11", " + 8"), ("minute", "60", ""), ("second", "60", ""))
    )
    statement = items_sql(
        f"""
        SELECT printf('{BATCH}-%08d', CAST(first_line + spot + 1 AS BIGINT)) AS synthetic_line_id,
               printf('SYN-{BATCH}-%07d', number) AS invoice_no, customer_id,
               CAST(start + CAST({below(days, "day", "number")} AS INTEGER) AS TIMESTAMP) + {clock} AS invoice_ts,
               line.stock_code, product_name, CAST(quantity AS INTEGER) AS item_quantity,
               CAST(round(CAST(quantity AS DECIMAL(10,0)) * CAST(median_unit_price AS DECIMAL(20,6)), 4) AS DOUBLE) AS item_amount,
               segment_code AS source_segment_code, {rnd("generation_confidence", 6)} AS generation_confidence,
               'segmentAwareCooccurrenceV1' AS generation_model, '{BATCH}' AS generation_batch_id
        FROM (SELECT *, greatest(1.0::DOUBLE, least(96.0::DOUBLE, round_even(pieces * scale, 0))) AS quantity FROM scaled) line
        JOIN anchors a USING (anchor_index) JOIN starts ON anchor_code = a.stock_code, first_day""",
        "brand",
        *parts,
    )
    return {"synthetic_transactions": statement.replace("WITH raw AS", "WITH RECURSIVE raw AS", 1)}
