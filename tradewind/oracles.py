"""The same results in plain SQL over the given tables, for an independent check.

Nothing here shares code with the Spark side; the parameters are repeated as values.
"""

from __future__ import annotations

RUN_1, RUN_2 = "TIMESTAMP '2024-06-01 12:00:00'", "TIMESTAMP '2024-06-02 12:00:00'"


def _key(key: str, run: int | None) -> str:
    return {None: key, 1: f"({key} * 9 // 10)", 2: f"({key} * 4 // 5 * 2)"}[run]


def _fixed(x: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', {x}) AS DOUBLE)"


def _item_id(key: str) -> str:
    return f"'MLB' || lpad(CAST({key} AS VARCHAR), 12, '0')"


def _items(run: int | None = None) -> str:
    """Flat listings of a run, before enrichment."""
    price = "p_retailprice * (100 - (p_partkey % 6) * 5) / 100"
    original = "CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END"
    title = "p_name"
    if run == 2:
        price, original = f"{price} * 1.1", "CAST(NULL AS DOUBLE)"
        title = "CASE WHEN p_partkey % 10 <> 0 THEN p_name END"
    attributes = "p_partkey % 11 <> 0"
    return f"""
    SELECT p_partkey AS k, {_item_id(_key('p_partkey', run))} AS id, {title} AS title,
      p_type AS category_id, {price} AS price, {original} AS list_price,
      p_size AS available_quantity, sold, views,
      CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE 'used' END AS condition,
      CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE p_partkey // 18 END AS seller_id,
      CASE WHEN p_partkey % 7 = 0 THEN 'paused' ELSE 'active' END AS status,
      CASE WHEN {attributes} THEN p_brand END AS brand,
      CASE WHEN {attributes} THEN CAST(p_size AS VARCHAR) END AS size,
      CASE WHEN {attributes} AND p_partkey % 3 <> 0 THEN split_part(p_name, ' ', 1) END AS color
    FROM part LEFT JOIN (
      SELECT user_id, count(*) FILTER (event_type = 'view') AS views,
             count(*) FILTER (event_type = 'purchase') AS sold
      FROM events GROUP BY user_id) ON user_id = p_partkey"""


def _enriched(run: int | None, as_of: str, source: str | None = None) -> str:
    """Enriched listings with their order ``k``."""
    return f"""
    SELECT k, id AS item_id, title, category_id, price AS current_price,
      coalesce(list_price, price) AS original_price, available_quantity,
      coalesce(sold, 0) AS sold_quantity, condition, brand, size, color,
      CAST(NULL AS VARCHAR) AS gender, coalesce(views, 0) AS views,
      CASE WHEN coalesce(views, 0) = 0 THEN 0.0
           ELSE {_fixed('coalesce(sold, 0) / views', 4)} END AS conversion_rate,
      seller_id, {as_of} AS created_at, {as_of} AS updated_at,
      CASE WHEN coalesce(list_price, price) <= price THEN 0.0
           ELSE {_fixed('(list_price - price) / list_price * 100', 2)}
      END AS discount_percentage
    FROM ({source or _items(run)})"""


ITEM_COLUMNS = """title, category_id, current_price, original_price, available_quantity,
  sold_quantity, condition, brand, size, color, gender, views, conversion_rate, seller_id"""

# A fifth of the listings came again later, with another price and status.
DELIVERED = f"""SELECT * REPLACE (
    CASE WHEN k % 5 = 0 THEN price * 2 ELSE price END AS price,
    CASE WHEN k % 5 <> 0 THEN status WHEN k % 2 = 0 THEN 'paused' ELSE 'active' END AS status),
    CASE WHEN k % 5 = 0 THEN k + 1000000000000 ELSE k END AS arrival
  FROM ({_items()})"""
ACTIVE = "SELECT * FROM ({items}) WHERE status = 'active'"
CURRENT = ACTIVE.format(items=DELIVERED)


def _last(source: str, key: str) -> str:
    return f"""SELECT * FROM ({source})
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY k DESC) = 1"""


def _items_after(first: str, second: str) -> str:
    """Item table after two runs of enriched records."""
    merged = ", ".join(
        f"CASE WHEN b.item_id IS NOT NULL THEN b.{c} ELSE a.{c} END AS {c}"
        for c in (x.strip() for x in ITEM_COLUMNS.split(","))
    )
    return f"""
    WITH a AS ({_last(first, 'item_id')}), b AS ({_last(second, 'item_id')})
    SELECT coalesce(a.item_id, b.item_id) AS item_id, {merged},
      coalesce(a.created_at, b.created_at) AS created_at,
      coalesce(b.updated_at, a.updated_at) AS updated_at
    FROM a FULL JOIN b ON a.item_id = b.item_id"""


def _extras(run: int, as_of: str) -> str:
    return f"""
    SELECT k, seller_id,
      CASE WHEN seller_id % 4 = 0 THEN 'shop-' || seller_id END AS nickname,
      CASE WHEN seller_id % 4 = 0 AND k % 2 = 0 THEN k / 8 END AS reputation_score,
      CASE WHEN seller_id % 4 = 0 THEN k END AS transactions_completed,
      CASE WHEN seller_id % 8 = 0 THEN true END AS is_competitor
    FROM ({_items(run)}) WHERE seller_id <> 0"""


ORDER_LINES = """
    SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS element_id,
      CAST(l_quantity AS INTEGER) AS quantity,
      CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price, l_partkey AS partkey,
      CASE WHEN l_linestatus = 'O' THEN nullif(CAST(l_suppkey AS VARCHAR), '0')
      END AS variation_id, l_returnflag
    FROM lineitem"""


def _orders(run: int | None = None) -> str:
    """Flat orders of a run with their order ``k``."""
    status = "'X'" if run == 2 else "o_orderstatus"
    closed = "CASE WHEN o_orderkey % 17 <> 0 THEN shipped END"
    return f"""
    SELECT o_orderkey AS k, o_custkey AS custkey,
      CAST({_key('o_orderkey', run)} AS VARCHAR) AS id,
      CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey // 15 END AS seller_id,
      CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS buyer_id,
      CASE WHEN o_orderkey % 13 <> 0 THEN c_name END AS buyer_nickname,
      {status} AS status, o_orderpriority AS status_detail,
      o_orderdate AS date_created, {closed} AS date_closed,
      CAST(NULL AS TIMESTAMP) AS date_last_updated, CAST(NULL AS TIMESTAMP) AS expiration_date,
      CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
      CAST(o_totalprice AS DECIMAL(10,2)) AS paid_amount, 'BRL' AS currency_id,
      CAST(NULL AS DECIMAL(10,2)) AS shipping_cost, CAST(NULL AS VARCHAR) AS pack_id,
      o_orderstatus = 'F' AS fulfilled, CAST(NULL AS VARCHAR) AS comment,
      '["' || o_orderpriority || '"]' AS tags, CAST(NULL AS VARCHAR) AS feedback_data,
      '{{"segment":"' || c_mktsegment || '"}}' AS context_data,
      CAST(date_diff('second', o_orderdate, {closed}) / 3600 AS DECIMAL(10,2))
        AS processing_time_hours, CAST(c_acctbal AS DECIMAL(10,2)) AS balance
    FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey"""


ORDER_COLUMNS = """id, seller_id, buyer_id, buyer_nickname, status, status_detail, date_created,
  date_closed, date_last_updated, expiration_date, total_amount, paid_amount, currency_id,
  shipping_cost, pack_id, fulfilled, comment, tags, feedback_data, context_data,
  processing_time_hours"""

LINE_COLUMNS = f"""element_id, {_item_id('partkey')} AS item_id, p_name AS title,
  p_type AS category_id, variation_id, p_brand AS seller_sku, quantity, unit_price,
  CAST(p_retailprice AS DECIMAL(10,2)) AS full_unit_price,
  CAST(NULL AS DECIMAL(10,2)) AS sale_fee, l_returnflag AS listing_type_id,
  'new' AS condition, CAST(NULL AS VARCHAR) AS warranty,
  CAST(NULL AS VARCHAR) AS variation_attributes"""


def _lines(orders: str, most: int | None = None) -> str:
    """Flat lines of some orders (columns id, k), all or those with the lowest numbers."""
    few = f"WHERE element_id <= {most}" if most else ""
    return f"""SELECT o.id AS order_id, {LINE_COLUMNS}
    FROM ({orders}) o JOIN ({ORDER_LINES}) l ON l.l_orderkey = o.k
    JOIN part ON p_partkey = l.partkey {few}"""


def _payments(orders: str, prefix: str = "", key: str = "k") -> str:
    """Flat payments of some orders."""
    return f"""SELECT '{prefix}' || ({key} * 10 + n) AS id, id AS order_id, custkey AS payer_id,
      seller_id AS collector_id, 'approved' AS status, CAST(NULL AS VARCHAR) AS status_detail,
      CASE WHEN n = 1 THEN 'pix' ELSE 'card' END AS payment_method_id,
      'bank_transfer' AS payment_type, 'regular_payment' AS operation_type,
      CASE WHEN n = 1 THEN total_amount ELSE balance END AS transaction_amount,
      CASE WHEN n = 1 THEN total_amount ELSE balance END AS total_paid_amount,
      CAST(NULL AS DECIMAL(10,2)) AS transaction_amount_refunded, date_created,
      CAST(NULL AS TIMESTAMP) AS date_approved, CAST(NULL AS TIMESTAMP) AS date_last_modified,
      1 AS installments, CAST(NULL AS DECIMAL(10,2)) AS installment_amount,
      CAST(NULL AS VARCHAR) AS issuer_id, CAST(NULL AS VARCHAR) AS reason,
      CAST(NULL AS DECIMAL(10,2)) AS shipping_cost, CAST(NULL AS DECIMAL(10,2)) AS taxes_amount,
      CAST(NULL AS DECIMAL(10,2)) AS coupon_amount
    FROM ({orders}) CROSS JOIN (VALUES (1), (2)) t(n)"""


FIRST, SECOND = _last(_orders(1), "id"), _last(_orders(2), "id")
FIRST_LEFT = f"SELECT * FROM ({FIRST}) WHERE id NOT IN (SELECT id FROM ({SECOND}))"

BAD_ORDER = "(k % 31 = 0 OR k % 29 = 0)"
REASON = "CASE WHEN k % 31 = 0 THEN 'no currency' ELSE 'no valid paid_amount' END"

STATE = f"""
    SELECT seller_id, count(*) AS total_processed, arg_max(id, k) AS last_order_id
    FROM ({_orders()}) GROUP BY seller_id"""


def _state(run: int) -> str:
    return f"""SELECT seller_id, count(*) AS total_processed, arg_max(id, k) AS last_order_id
    FROM ({_orders(run)}) GROUP BY seller_id"""


def _span(column: str, fn: str) -> str:
    return f"strftime({fn}({column}), '%Y-%m-%dT%H:%M:%S')"


OUTCOMES = f"""
    SELECT s_suppkey AS seller_id, coalesce(n, 0) AS n_loaded, n IS NOT NULL AS success
    FROM supplier LEFT JOIN (
      SELECT seller_id, count(*) AS n FROM ({CURRENT}) GROUP BY 1
    ) ON seller_id = s_suppkey"""

NICKNAME = "coalesce(CASE WHEN s_acctbal >= 0 THEN s_name END, 'N/A') AS nickname"
EARLY_END = "date_created >= TIMESTAMP '1996-01-01' AND date_created <= TIMESTAMP '1997-06-30'"

def _partial() -> str:
    """Items after two runs of records that lack fields: per field the last record that has it."""
    def runs(run: int, as_of: str) -> str:
        return f"""SELECT {run} AS run, (k + {run}) % 3 <> 0 AS has_title, k % 4 <> {run} AS has_current_price,
          k % 5 >= {run} AS has_views, NOT (k % 2 = 0 AND {run} = 2) AS has_brand, *
        FROM ({_enriched(run, as_of)})"""

    fields = []
    for c in (x.strip() for x in ITEM_COLUMNS.split(",")):
        having = f"FILTER (WHERE has_{c})" if c in ("title", "current_price", "views", "brand") else ""
        value = f"last({c} ORDER BY run, k) {having}"
        if c == "views":
            # All of them are numbers; only an item that no record has views of is left.
            value = f"coalesce({value}, 0)"
        fields.append(f"{value} AS {c}")
    return f"""SELECT item_id, {', '.join(fields)}, min(created_at) AS created_at
    FROM ({runs(1, RUN_1)} UNION ALL {runs(2, RUN_2)}) GROUP BY item_id"""


# After the second of two runs, of which some orders have no currency.
WHOLE = f"SELECT * FROM ({_orders(2)}) WHERE k % 31 <> 0"
LOADED = _last(WHOLE, "id")
LEFT = f"SELECT * FROM ({FIRST}) WHERE id NOT IN (SELECT id FROM ({LOADED}))"


def _progress(orders: str) -> str:
    return f"""SELECT seller_id, count(*) AS total_processed, arg_max(id, k) AS last_order_id
    FROM ({orders}) GROUP BY seller_id"""


def _totals(by: str, more: str = "") -> str:
    return f"""
        SELECT {by}, count(*) AS n_items, CAST(sum(sold_quantity) AS BIGINT) AS sold_quantity,
          CAST(sum(views) AS BIGINT) AS views {more},
          CASE WHEN sum(views) = 0 THEN 0.0
               ELSE {_fixed('sum(sold_quantity) / sum(views)', 4)} END AS conversion_rate
        FROM ({_enriched(None, RUN_1)}) GROUP BY {by}"""


AVG_PRICE = f""", {_fixed(
    "CAST(sum(CAST(current_price AS DECIMAL(28,10))) AS DOUBLE) / count(current_price)", 2
)} AS avg_price"""

ORACLES = {
    "attr_extract": f"""
        SELECT id, brand, size, color, CAST(NULL AS VARCHAR) AS gender FROM ({_items()})""",
    "enrich_items": f"SELECT * EXCLUDE (k) FROM ({_enriched(None, RUN_1)})",
    "items_active_limit": f"""
        SELECT id, seller_id, title, status, CAST(price AS VARCHAR) AS price FROM ({CURRENT})
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY arrival) <= 5""",
    "items_active": f"""
        SELECT id, seller_id, title, status, CAST(price AS VARCHAR) AS price FROM ({CURRENT})""",
    "item_details": f"""
        SELECT id, seller_id, title, category_id, available_quantity, condition,
          CASE WHEN brand IS NOT NULL THEN 4 END AS n_attributes
        FROM ({CURRENT})""",
    "item_lookup": f"""
        SELECT id, title, category_id, seller_id FROM ({_items()})
        WHERE id = 'MLB000000000042'""",
    "item_search_page": f"""
        SELECT id, title, category_id, seller_id FROM ({_items()})
        WHERE contains(lower(title), 'ring') ORDER BY id LIMIT 20 OFFSET 20""",
    "items_with_descriptions": f"""
        SELECT id, title, coalesce(text, 'N/A') AS description
        FROM ({_items()}) LEFT JOIN documents ON doc_id = k""",
    "items_with_reviews": f"""
        SELECT id, title, CAST(coalesce(quality, 0) AS DOUBLE) AS rating_average,
          CAST(coalesce(toxic, 0) AS BIGINT) AS total_reviews
        FROM ({_items()}) LEFT JOIN labels ON doc_id = k""",
    "items_extract": f"""
        SELECT id, seller_id, title, coalesce(text, 'N/A') AS description,
          CAST(coalesce(quality, 0) AS DOUBLE) AS rating_average,
          CAST(coalesce(toxic, 0) AS BIGINT) AS total_reviews
        FROM ({CURRENT}) LEFT JOIN documents ON documents.doc_id = k
        LEFT JOIN labels ON labels.doc_id = k""",
    "item_questions": f"""
        SELECT {_item_id('conv_id')} AS item_id, turn AS question_id, text,
          count(*) OVER (PARTITION BY conv_id) AS total FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 3""",
    "user_lookup": """
        SELECT s_suppkey AS id, CASE WHEN s_acctbal >= 0 THEN s_name END AS nickname
        FROM supplier WHERE s_suppkey = 7""",
    "category_trends": """
        SELECT 'MLB' AS site_id, p_type AS category_id, p_name AS keyword
        FROM part WHERE p_type = 'PROMO'""",
    "price_quarantine": f"""
        SELECT id AS item_id, CASE WHEN available_quantity <> 50 THEN price END AS current_price,
          CASE WHEN available_quantity <> 50 THEN 'loaded' ELSE 'quarantined' END AS outcome
        FROM ({_items()})""",
    "sellers_of_category": f"""
        SELECT seller_id, {NICKNAME} FROM (
          SELECT DISTINCT seller_id FROM ({_items()})
          WHERE category_id = 'PROMO' AND seller_id <> 0)
        LEFT JOIN supplier ON s_suppkey = seller_id""",
    "sellers_quick10": f"""
        SELECT seller_id, {NICKNAME} FROM (
          SELECT DISTINCT seller_id FROM (
            SELECT * FROM ({_items()}) WHERE category_id = 'PROMO' ORDER BY id LIMIT 10)
          WHERE seller_id <> 0)
        LEFT JOIN supplier ON s_suppkey = seller_id""",
    "category_seller_counts": f"""
        SELECT category_id, count(DISTINCT seller_id) AS n_sellers
        FROM ({_items()}) WHERE seller_id <> 0 GROUP BY category_id""",
    "seller_outcomes": OUTCOMES,
    "seller_run_summary": f"""
        SELECT count(*) FILTER (success) AS successful, count(*) AS total FROM ({OUTCOMES})""",
    "orders_flat": f"SELECT {ORDER_COLUMNS} FROM ({_orders()})",
    "orders_json": f"""
        SELECT id AS order_id, c_mktsegment AS segment, status_detail AS first_tag, 0 AS n_unparsed,
          tags AS tags_text, feedback_data AS feedback_text, context_data AS context_text
        FROM ({_orders()}) JOIN customer ON c_custkey = custkey""",
    "order_tag_counts": f"""
        SELECT seller_id, status_detail AS tag, count(*) AS n_orders
        FROM ({_orders()}) GROUP BY seller_id, status_detail""",
    "order_items_flat": _lines(_orders()),
    "payments_flat": _payments(_orders()),
    "orders_date_range": f"""
        SELECT id, seller_id, date_created FROM ({_orders()}) WHERE {EARLY_END}""",
    "orders_of_seller": f"""
        SELECT id, seller_id, buyer_id, date_created FROM ({_orders()}) WHERE seller_id = 1""",
    "orders_new_only": f"""
        SELECT id, seller_id, status, total_amount FROM ({_orders(2)}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_orders(1)}) s WHERE s.id = n.id)""",
    "orders_quarantine": f"""
        SELECT 'orders' AS source, id AS record_id, {REASON} AS reason
        FROM ({_orders()}) WHERE {BAD_ORDER}""",
    "orders_accepted": f"""
        SELECT id, paid_amount, currency_id FROM ({_orders()}) WHERE NOT {BAD_ORDER}""",
    "payment_conflicts": f"""
        WITH p AS ({_payments(_orders(), key='(CASE WHEN k % 19 = 0 THEN custkey ELSE k END)')})
        SELECT DISTINCT order_id FROM p
        WHERE id IN (SELECT id FROM p GROUP BY id HAVING count(*) > 1)""",
    "last_two_orders": f"""
        SELECT seller_id, id, date_created, total_amount FROM ({_orders()})
        QUALIFY row_number() OVER (
          PARTITION BY seller_id ORDER BY date_created DESC, id DESC) <= 2""",
    "orders_by_status": f"""
        SELECT seller_id, status, count(id) AS n_orders FROM ({_orders()})
        GROUP BY seller_id, status""",
    "orders_date_span": f"""
        SELECT seller_id, {_span('date_created', 'min')} AS earliest,
          {_span('date_created', 'max')} AS latest FROM ({_orders()}) GROUP BY seller_id""",
    "seller_stats": f"""
        WITH o AS ({_orders()})
        SELECT c.seller_id, 'completed' AS run_status, total_processed,
          '2024-06-01T12:00:00' AS last_run, last_order_id, earliest, latest, c.status, n_orders
        FROM (SELECT seller_id, status, count(*) AS n_orders FROM o GROUP BY 1, 2) c
        JOIN ({STATE}) s ON s.seller_id = c.seller_id
        JOIN (SELECT seller_id, {_span('date_created', 'min')} AS earliest,
                {_span('date_created', 'max')} AS latest FROM o GROUP BY 1) d
          ON d.seller_id = c.seller_id""",
    "seller_stats_json": f"""
        WITH o AS ({_orders()})
        SELECT c.seller_id, '{{"etl_state":{{"status":"completed","total_processed":'
          || total_processed || ',"last_run":"2024-06-01T12:00:00","last_order_id":"'
          || last_order_id || '"}},"order_counts":{{'
          || string_agg('"' || c.status || '":' || n, ',' ORDER BY c.status)
          || '}},"date_range":{{"earliest":"' || {_span('lo', 'min')}
          || '","latest":"' || {_span('hi', 'max')} || '"}}}}' AS stats
        FROM (SELECT seller_id, status, count(*) AS n, min(date_created) AS lo,
                max(date_created) AS hi FROM o GROUP BY 1, 2) c
        JOIN ({STATE}) s ON s.seller_id = c.seller_id
        GROUP BY c.seller_id, total_processed, last_order_id""",
    "order_details": f"""
        WITH l AS ({_lines(_orders())}), p AS ({_payments(_orders())})
        SELECT id AS order_id, seller_id, coalesce(n_lines, 0) AS n_lines, units, lines_amount,
          coalesce(n_payments, 0) AS n_payments, payments_amount
        FROM ({_orders()})
        LEFT JOIN (SELECT order_id, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS units,
            CAST(sum(CAST(unit_price * quantity AS DECIMAL(18,2))) AS DECIMAL(28,2))
              AS lines_amount FROM l GROUP BY 1) x ON x.order_id = id
        LEFT JOIN (SELECT order_id, count(*) AS n_payments,
            CAST(sum(total_paid_amount) AS DECIMAL(20,2)) AS payments_amount
          FROM p GROUP BY 1) y ON y.order_id = id""",
    "order_lines": f"""
        SELECT l.order_id, seller_id, status, date_created, item_id, quantity, unit_price
        FROM ({_orders()}) o JOIN ({_lines(_orders())}) l ON l.order_id = o.id""",
    "items_upsert": _items_after(_enriched(1, RUN_1), _enriched(2, RUN_2)),
    "sellers_upsert": f"""
        WITH r AS (SELECT 1 AS run, * FROM ({_extras(1, RUN_1)})
                   UNION ALL SELECT 2, * FROM ({_extras(2, RUN_2)}))
        SELECT seller_id, arg_max(nickname, run * 1e12 + k) AS nickname,
          arg_max(reputation_score, run * 1e12 + k) AS reputation_score,
          arg_max(transactions_completed, run * 1e12 + k) AS transactions_completed,
          coalesce(bool_or(is_competitor), false) AS is_competitor,
          CAST(NULL AS DOUBLE) AS market_share_pct
        FROM r GROUP BY seller_id""",
    "price_history_append": " UNION ALL ".join(
        f"""SELECT item_id, current_price AS price, discount_percentage,
          CAST(NULL AS INTEGER) AS competitor_rank, CAST(NULL AS VARCHAR) AS price_position,
          {as_of} AS recorded_at, CAST({as_of} AS DATE) AS recorded_date
        FROM ({_enriched(run, as_of)})"""
        for run, as_of in ((1, RUN_1), (2, RUN_2))
    ),
    "orders_upsert": f"""
        SELECT {ORDER_COLUMNS} FROM ({FIRST_LEFT})
        UNION ALL SELECT {ORDER_COLUMNS} FROM ({SECOND})""",
    "order_items_replace": f"{_lines(FIRST_LEFT)} UNION ALL {_lines(SECOND, 2)}",
    "payments_replace": f"{_payments(FIRST_LEFT, '1-')} UNION ALL {_payments(SECOND, '2-')}",
    "etl_state_upsert": f"""
        SELECT coalesce(a.seller_id, b.seller_id) AS seller_id,
          CAST(NULL AS TIMESTAMP) AS last_processed_date, CAST(0 AS BIGINT) AS last_offset,
          coalesce(b.total_processed, a.total_processed) AS total_processed,
          CASE WHEN b.seller_id IS NULL THEN {RUN_1} ELSE {RUN_2} END AS last_run_date,
          'completed' AS status, coalesce(b.last_order_id, a.last_order_id) AS last_order_id
        FROM ({_state(1)}) a FULL JOIN ({_state(2)}) b ON a.seller_id = b.seller_id""",
    "price_positions": f"""
        SELECT item_id, category_id,
          CASE WHEN current_price > m * 1.10 THEN 'premium'
               WHEN current_price < m * 0.90 THEN 'discount'
               ELSE 'competitive' END AS price_position
        FROM (SELECT *, median(current_price) OVER (PARTITION BY category_id) AS m
              FROM ({_enriched(None, RUN_1)}))""",
    "competitor_ranks": f"""
        SELECT item_id, category_id, rank() OVER (
          PARTITION BY category_id ORDER BY current_price) AS competitor_rank
        FROM ({_enriched(None, RUN_1)})""",
    "market_shares": f"""
        SELECT seller_id, CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue,
          {_fixed('CAST(sum(total_amount) AS DOUBLE) / any_value(total) * 100', 2)}
            AS market_share_pct
        FROM (SELECT *, (SELECT CAST(sum(total_amount) AS DOUBLE) FROM ({_orders()})) AS total
              FROM ({_orders()}))
        GROUP BY seller_id""",
    "trend_growth": f"""
        WITH t AS (
          SELECT p_name AS keyword, p_type AS category_id,
            CAST(date_trunc('month', l_shipdate) AS DATE) AS trend_date,
            count(*) AS search_volume
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3),
        g AS (SELECT *, lag(search_volume) OVER (
            PARTITION BY keyword, category_id ORDER BY trend_date) AS last FROM t)
        SELECT keyword, category_id, trend_date, search_volume,
          CASE WHEN last <> 0 THEN {_fixed('(search_volume - last) / last * 100', 2)} END
            AS growth_rate FROM g""",
    "price_changes": f"""
        SELECT b.item_id, {RUN_2} AS recorded_at, a.current_price AS previous_price,
          b.current_price AS price
        FROM ({_last(_enriched(1, RUN_1), 'item_id')}) a
        JOIN ({_last(_enriched(2, RUN_2), 'item_id')}) b ON a.item_id = b.item_id
        WHERE a.current_price <> b.current_price""",
    "sales_velocity": f"""
        SELECT *, {_fixed('units / days', 4)} AS units_per_day FROM (
          SELECT item_id, CAST(sum(quantity) AS BIGINT) AS units,
            CAST(max(CAST(date_created AS DATE)) - min(CAST(date_created AS DATE)) + 1 AS INTEGER)
              AS days
          FROM ({_lines(_orders())}) l JOIN ({_orders()}) o ON o.id = l.order_id
          GROUP BY item_id)""",
    "variant_performance": _totals("brand, size, color"),
    "category_segments": _totals("category_id", AVG_PRICE),
    "items_run": _items_after(
        _enriched(1, RUN_1, ACTIVE.format(items=_last(_items(1), "id"))),
        _enriched(2, RUN_2, ACTIVE.format(items=_last(_items(2), "id"))),
    ),
    "orders_run": f"""
        SELECT {ORDER_COLUMNS} FROM ({FIRST_LEFT})
        UNION ALL SELECT {ORDER_COLUMNS} FROM ({SECOND})""",
    "orders_stream": f"""
        SELECT l.*, status FROM ({_lines(_orders())}) l
        JOIN ({_orders()}) o ON o.id = l.order_id""",
    "last_order_documents": f"""
        SELECT seller_id, id, date_created, CASE WHEN k % 7 = 0 THEN 'again' ELSE status END AS status
        FROM ({_orders()})
        QUALIFY row_number() OVER (
          PARTITION BY seller_id ORDER BY date_created DESC, id DESC) <= 2""",
    "orders_unreadable": f"""
        SELECT 'orders' AS source, 'unreadable document' AS reason,
          '{{"id": "' || id || '", "seller": {{"id": 5' AS raw_json
        FROM ({_orders()}) WHERE k % 23 = 0""",
    "items_of_sellers": f"""
        SELECT id, seller_id, title, CAST(price AS VARCHAR) AS price FROM (
          SELECT * REPLACE (CASE WHEN k % 5 = 0 THEN seller_id + 1 ELSE seller_id END AS seller_id)
          FROM ({_items()}))
        WHERE status = 'active' AND seller_id IN (1, 2, 3)""",
    "items_partial_upsert": _partial(),
    "orders_out_of_order": f"""
        SELECT id, seller_id, total_amount, CASE WHEN k % 3 = 0 THEN 'third'
            WHEN k % 2 = 0 THEN 'second' ELSE status END AS status,
          CASE WHEN k % 3 = 0 THEN least(n, 3) WHEN k % 2 = 0 THEN least(n, 2) ELSE n END AS n_lines
        FROM (SELECT o.*, coalesce(n, 0) AS n FROM ({_orders()}) o LEFT JOIN (
          SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = k)""",
    "seller_stats_maintained": f"""
        WITH o AS ({LEFT} UNION ALL {LOADED}),
        s AS (
          SELECT coalesce(a.seller_id, b.seller_id) AS seller_id, 'completed' AS run_status,
            coalesce(b.total_processed, a.total_processed) AS total_processed,
            CASE WHEN b.seller_id IS NULL THEN '2024-06-01T12:00:00' ELSE '2024-06-02T12:00:00' END
              AS last_run,
            coalesce(b.last_order_id, a.last_order_id) AS last_order_id
          FROM ({_progress(FIRST)}) a FULL JOIN ({_progress(LOADED)}) b ON a.seller_id = b.seller_id)
        SELECT s.*, earliest, latest, status, n_orders FROM s
        LEFT JOIN (SELECT seller_id, {_span('date_created', 'min')} AS earliest,
            {_span('date_created', 'max')} AS latest FROM o GROUP BY 1) d
          ON d.seller_id = s.seller_id
        LEFT JOIN (SELECT seller_id, status, count(*) AS n_orders FROM o GROUP BY 1, 2) c
          ON c.seller_id = s.seller_id""",
    "orders_run_tables": f"""
        SELECT 'payments' AS stored, id, order_id, CAST(total_paid_amount AS VARCHAR) AS value
        FROM ({_payments(LEFT, '1-')} UNION ALL {_payments(LOADED, '2-')})
        UNION ALL SELECT 'quarantine', NULL, id, 'no currency' FROM ({_orders(2)}) WHERE k % 31 = 0""",
    "items_run_tables": f"""
        WITH r AS (
          SELECT *, 1 AS run, '2024-06-01 12:00:00' AS moment FROM ({_items(1)})
          UNION ALL SELECT *, 2, '2024-06-02 12:00:00' FROM ({_items(2)})),
        loaded AS (
          SELECT * FROM (SELECT * FROM r WHERE k % 37 <> 0
            QUALIFY row_number() OVER (PARTITION BY run, id ORDER BY k DESC) = 1)
          WHERE status = 'active')
        SELECT 'price_history' AS stored, id AS key, moment AS value FROM loaded
        UNION ALL SELECT DISTINCT 'sellers', CAST(seller_id AS VARCHAR), 'false' FROM loaded
          WHERE seller_id <> 0
        UNION ALL SELECT 'quarantine', id, 'price is not a number' FROM r WHERE k % 37 = 0""",
    "orders_replayed": f"""
        WITH d AS (
          SELECT id, k, status, CASE WHEN k % 2 = 0 THEN k % 8 = 0 ELSE k % 5 = 0 END AS was_open,
            CASE WHEN k % 8 = 0 THEN 'no status' ELSE 'no currency' END AS reason,
            (k % 5 = 0)::INT + (k % 8 = 0)::INT AS n
          FROM ({_orders()}))
        SELECT 'orders' AS stored, id, CASE WHEN k % 3 = 0 THEN 'third'
            WHEN was_open AND k % 3 = 1 AND k % 7 <> 0 AND reason = 'no status' THEN 'mended'
            WHEN k % 2 = 0 AND k % 8 <> 0 THEN 'second' ELSE status END AS value,
          CAST(NULL AS BIGINT) AS n
        FROM d WHERE k % 3 = 0 OR (was_open AND k % 3 = 1 AND k % 7 <> 0)
          OR (k % 2 = 0 AND k % 8 <> 0) OR k % 5 <> 0
        UNION ALL SELECT 'quarantine_open', id, reason, n + (k % 3 = 1)::INT FROM d
          WHERE was_open AND (k % 3 = 2 OR (k % 3 = 1 AND k % 7 = 0))
        UNION ALL SELECT 'quarantine_closed', id, CASE WHEN NOT was_open THEN 'run-1'
            WHEN k % 3 = 0 THEN 'run-2' ELSE 'replay' END, n FROM d
          WHERE (k % 10 = 0 AND k % 8 <> 0) OR (was_open AND (k % 3 = 0 OR (k % 3 = 1 AND k % 7 <> 0)))""",
    "orders_pending": f"""
        SELECT 'orders' AS stored, id, seller_id, status FROM ({_orders()}) WHERE k % 23 <> 0
        UNION ALL SELECT 'quarantine', '{{"id": "' || id || '", "seller": {{"id": 5', NULL,
          'unreadable document' FROM ({_orders()}) WHERE k % 23 = 0""",
    "item_search_indexed": f"""
        SELECT query, id, title FROM ({_items()})
        JOIN (VALUES ('ring'), ('Blue'), ('old p'), ('zzz'), ('re')) q(query)
          ON contains(lower(title), lower(query))""",
    "item_pages": f"""
        SELECT CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS INTEGER) AS page, id, title, seller_id
        FROM ({_items()}) WHERE seller_id = 1""",
    "category_sellers_maintained": f"""
        SELECT category_id, count(DISTINCT seller_id) AS n_sellers FROM ({_items_after(
        _enriched(1, RUN_1, ACTIVE.format(items=_last(_items(1), "id"))),
        _enriched(2, RUN_2, ACTIVE.format(items=_last(_items(2), "id"))),
    )}) WHERE seller_id <> 0 GROUP BY category_id""",
}
