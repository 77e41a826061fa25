"""Schemas of the landed documents and of the target tables, as DDL strings.

Money is read as text so that coercion is decided in one place
(``functions.numeric``), and free-form JSON stays JSON text.  Ids are 64 bit.
All times are wall-clock ``TIMESTAMP_NTZ``; load times are UTC wall clock.
"""

# --- landed documents ------------------------------------------------------

RAW_ITEM = """
    id STRING, title STRING, category_id STRING, price STRING, original_price STRING,
    available_quantity INT, sold_quantity BIGINT, condition STRING, views BIGINT,
    seller_id BIGINT, seller STRUCT<id: BIGINT>, status STRING,
    attributes ARRAY<STRUCT<id: STRING, value_name: STRING, value_id: STRING>>
"""

RAW_DESCRIPTION = "item_id STRING, plain_text STRING"

RAW_REVIEW = "item_id STRING, rating_average DOUBLE, total_reviews BIGINT"

RAW_QUESTION = "item_id STRING, question_id BIGINT, text STRING"

RAW_USER = "id BIGINT, nickname STRING, site_id STRING"

RAW_TREND = "site_id STRING, category_id STRING, keyword STRING"

_RAW_LINE = """STRUCT<
    element_id: INT, quantity: INT, unit_price: STRING, full_unit_price: STRING,
    sale_fee: STRING, listing_type_id: STRING,
    item: STRUCT<id: STRING, title: STRING, category_id: STRING, variation_id: STRING,
                 seller_sku: STRING, condition: STRING, warranty: STRING,
                 variation_attributes: STRING>>"""

_RAW_PAYMENT = """STRUCT<
    id: STRING, payer_id: BIGINT, collector: STRUCT<id: BIGINT>, status: STRING,
    status_detail: STRING, payment_method_id: STRING, payment_type: STRING,
    operation_type: STRING, transaction_amount: STRING, total_paid_amount: STRING,
    transaction_amount_refunded: STRING, date_created: STRING, date_approved: STRING,
    date_last_modified: STRING, installments: INT, installment_amount: STRING,
    issuer_id: STRING, reason: STRING, shipping_cost: STRING, taxes_amount: STRING,
    coupon_amount: STRING>"""

RAW_ORDER = f"""
    id STRING, seller STRUCT<id: BIGINT>, buyer STRUCT<id: BIGINT, nickname: STRING>,
    status STRING, status_detail STRING, date_created STRING, date_closed STRING,
    date_last_updated STRING, expiration_date STRING, total_amount STRING,
    paid_amount STRING, shipping_cost STRING, currency_id STRING, pack_id STRING,
    fulfilled BOOLEAN, comment STRING, tags STRING, feedback STRING, context STRING,
    order_items ARRAY<{_RAW_LINE}>, payments ARRAY<{_RAW_PAYMENT}>
"""

#: An enriched record, as a loader gets it; each may lack any field.
RECORD = """
    item_id STRING, title STRING, category_id STRING, current_price DOUBLE,
    original_price DOUBLE, available_quantity INT, sold_quantity BIGINT, condition STRING,
    brand STRING, size STRING, color STRING, gender STRING, views BIGINT,
    conversion_rate DOUBLE, seller_id BIGINT, created_at TIMESTAMP_NTZ,
    updated_at TIMESTAMP_NTZ, discount_percentage DOUBLE, competitor_rank INT,
    price_position STRING, seller_nickname STRING, seller_reputation DOUBLE,
    seller_transactions BIGINT, is_competitor BOOLEAN, market_share_pct DOUBLE
"""

# --- target tables ---------------------------------------------------------

ITEMS = """
    item_id STRING, title STRING, category_id STRING, current_price DOUBLE,
    original_price DOUBLE, available_quantity INT, sold_quantity BIGINT,
    condition STRING, brand STRING, size STRING, color STRING, gender STRING,
    views BIGINT, conversion_rate DOUBLE, seller_id BIGINT,
    created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
"""

PRICE_HISTORY = """
    id STRING, item_id STRING, price DOUBLE, discount_percentage DOUBLE,
    competitor_rank INT, price_position STRING, recorded_at TIMESTAMP_NTZ,
    recorded_date DATE
"""

SELLERS = """
    seller_id BIGINT, nickname STRING, reputation_score DOUBLE,
    transactions_completed BIGINT, is_competitor BOOLEAN, market_share_pct DOUBLE
"""

MARKET_TRENDS = """
    id BIGINT, keyword STRING, search_volume BIGINT, category_id STRING,
    trend_date DATE, growth_rate DOUBLE
"""

ORDERS = """
    id STRING, seller_id BIGINT, buyer_id BIGINT, buyer_nickname STRING, status STRING,
    status_detail STRING, date_created TIMESTAMP_NTZ, date_closed TIMESTAMP_NTZ,
    date_last_updated TIMESTAMP_NTZ, expiration_date TIMESTAMP_NTZ,
    total_amount DECIMAL(10,2), paid_amount DECIMAL(10,2), currency_id STRING,
    shipping_cost DECIMAL(10,2), pack_id STRING, fulfilled BOOLEAN, comment STRING,
    tags STRING, feedback_data STRING, context_data STRING,
    processing_time_hours DECIMAL(10,2)
"""

ORDER_ITEMS = """
    id STRING, order_id STRING, element_id INT, item_id STRING, title STRING,
    category_id STRING, variation_id STRING, seller_sku STRING, quantity INT,
    unit_price DECIMAL(10,2), full_unit_price DECIMAL(10,2), sale_fee DECIMAL(10,2),
    listing_type_id STRING, condition STRING, warranty STRING,
    variation_attributes STRING
"""

PAYMENTS = """
    id STRING, order_id STRING, payer_id BIGINT, collector_id BIGINT, status STRING,
    status_detail STRING, payment_method_id STRING, payment_type STRING,
    operation_type STRING, transaction_amount DECIMAL(10,2),
    total_paid_amount DECIMAL(10,2), transaction_amount_refunded DECIMAL(10,2),
    date_created TIMESTAMP_NTZ, date_approved TIMESTAMP_NTZ,
    date_last_modified TIMESTAMP_NTZ, installments INT,
    installment_amount DECIMAL(10,2), issuer_id STRING, reason STRING,
    shipping_cost DECIMAL(10,2), taxes_amount DECIMAL(10,2), coupon_amount DECIMAL(10,2)
"""

#: When the stored copy of each order arrived; see ``operators.arrivals``.
ORDER_ARRIVALS = """
    order_id STRING,
    arrived STRUCT<time: TIMESTAMP, file: STRING, offset: BIGINT, row: BIGINT>
"""

#: The order of each stored payment, by the payment's id.
PAYMENT_OWNERS = "payment_id STRING, order_id STRING"

#: How many stored listings a seller has in a category.
CATEGORY_SELLERS = "category_id STRING, seller_id BIGINT, n BIGINT"

#: How many stored orders of a seller are in a status and of a day, and the first and last of them.
ORDER_DAYS = """
    seller_id BIGINT, status STRING, day DATE, n BIGINT,
    first TIMESTAMP_NTZ, last TIMESTAMP_NTZ
"""

ETL_STATE = """
    seller_id BIGINT, last_processed_date TIMESTAMP_NTZ, last_offset BIGINT,
    total_processed BIGINT, last_run_date TIMESTAMP_NTZ, status STRING,
    last_order_id STRING
"""

QUARANTINE = "source STRING, record_id STRING, reason STRING, raw_json STRING"

#: Rejected documents of which no later copy was loaded; see ``operators.quarantine``.
QUARANTINE_OPEN = """
    entry STRING, record_id STRING, reason STRING, raw_json STRING, n_attempts BIGINT,
    opened_by STRING,
    arrived STRUCT<time: TIMESTAMP, file: STRING, offset: BIGINT, row: BIGINT>
"""

QUARANTINE_CLOSED = "entry STRING, n_attempts BIGINT, opened_by STRING, closed_by STRING"

RUN_OUTCOMES = "run_id STRING, seller_id BIGINT, n_loaded BIGINT, success BOOLEAN"
