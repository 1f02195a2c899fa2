"""The catalog's queries as plain SQL over the parquet tables, for cross-checking.

Written independently of the Spark code: windows instead of nested arrays, the
range frame replaced by rows handed forward, CASE lists instead of mapping tables. Money is
DECIMAL until the final output; ratios round half up on the decimal value.
"""

from __future__ import annotations

import re

from tallymart import schemas
from tallymart.operators import rules
from tallymart.plans import lakehouse
from tallymart.sources import warehouse


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _nth(values, index: str) -> str:
    return f"({_list(values)})[({index}) + 1]"


def _round(x: str, digits: int = 2) -> str:
    """Half up on the decimal value; enough decimals to tell a tie from a near tie."""
    scale = {2: 9, 4: 14, 6: 12}[digits]
    return f"CAST(round(CAST({x} AS DECIMAL(38,{scale})), {digits}) AS DOUBLE)"


def _ratio(num: str, den: str, digits: int = 2, scale: str = "") -> str:
    return _round(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0.0){scale}", digits)


def _pct(num: str, den: str) -> str:
    return _ratio(num, den, 2, " * 100")


def _latest(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


_STEPS = " ".join(f"WHEN {_text(k)} THEN {_list(v)}" for k, v in warehouse.STEPS.items())
_PAY_TYPE = " ".join(f"WHEN {k} THEN {_text(t)}" for k, (t, _) in warehouse.PAYMENTS.items())
_PAY_PROV = " ".join(f"WHEN {k} THEN {_text(p)}" for k, (_, p) in warehouse.PAYMENTS.items())
_REGION = " ".join(
    f"WHEN c.address IN {_in(v)} THEN {_text(k)}" for k, v in schemas.REGION_PROVINCES.items()
)
_REGION = f"CASE {_REGION} ELSE {_text(schemas.SOUTH)} END"
_FLAGS = ",\n".join(
    f"CASE WHEN kind = '{a}' THEN 1 ELSE 0 END AS is_{a}" for a in schemas.FLAGGED_ACTIONS
)
_LOGIT = "".join(
    f" + {w!r}::DOUBLE * COALESCE(CAST({c} AS DOUBLE), 0.0)"
    for c, w in schemas.RULE_WEIGHTS.items()
)


def _score(intercept: float) -> str:
    return _round(f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({intercept!r}::DOUBLE{_LOGIT})))", 4)


def _tier(field: int) -> str:
    return (
        "CASE WHEN purchase_probability >= 0.70 THEN " + _text(schemas.LEAD_TIERS[0][field])
        + " WHEN purchase_probability >= 0.40 THEN " + _text(schemas.LEAD_TIERS[1][field])
        + " ELSE " + _text(schemas.LEAD_TIERS[2][field]) + " END"
    )


def _campaign(source: str) -> str:
    return f"""SELECT l.customer_id, campaign_date, purchase_probability,
      {_tier(1)} AS customer_segment, {_tier(2)} AS campaign_action, {_tier(3)} AS campaign_channel,
      COALESCE(c.first_name, 'Unknown') AS first_name, COALESCE(c.last_name, 'Customer') AS last_name,
      c.email, c.phone_number AS phone, CAST(year(campaign_date) AS INT) AS year,
      CAST(month(campaign_date) AS INT) AS month, CAST(day(campaign_date) AS INT) AS day
      FROM {source} l LEFT JOIN silver_customers c ON l.customer_id = c.customer_id"""


_GENDER = " ".join(
    f"WHEN lower(gender) IN {_in(words)} THEN {_text(name)}"
    for name, words in schemas.GENDER_SYNONYMS.items()
)


# --- common table expressions: name -> SQL; dependencies are found by name -------------
CTES: dict[str, str] = {
    "raw_customers": f"""SELECT c_custkey AS customer_id, ' ' || split_part(c_name, '#', 1) AS first_name,
      split_part(c_name, '#', 2) || ' ' AS last_name,
      ' Customer' || c_custkey || '@Example.COM' AS email,
      CASE WHEN c_acctbal < 0 THEN '12-' || c_custkey ELSE '09-' || (c_custkey + 10000000) END AS phone_number,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Nam' WHEN 'BUILDING' THEN 'F'
        WHEN 'FURNITURE' THEN 'Nữ' WHEN 'HOUSEHOLD' THEN 'x' END AS gender,
      CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2500 THEN 'Bronze'
        WHEN c_acctbal < 5000 THEN ' Silver' WHEN c_acctbal < 7500 THEN 'GOLD'
        WHEN c_acctbal < 9500 THEN 'Platinum ' ELSE 'vip' END AS tire,
      {_nth(warehouse.PROVINCES, 'c_nationkey')} AS address,
      TIMESTAMP '2015-01-01' + to_days(CAST(c_custkey % 3000 AS INT)) AS created_at,
      TIMESTAMP '2015-01-01' + to_days(CAST(c_custkey % 3000 + c_nationkey AS INT)) AS updated_at FROM customer""",
    "stg_customers": """SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
      lower(trim(email)) AS email, trim(phone_number) AS phone_number, trim(gender) AS gender,
      lower(trim(tire)) AS tire, trim(address) AS address, created_at, updated_at FROM raw_customers""",
    "silver_customers": f"""SELECT customer_id, first_name, last_name, email,
      CASE WHEN length(digits) >= 9 THEN digits END AS phone_number,
      CASE {_GENDER} ELSE 'Other' END AS gender,
      CASE WHEN tire IN {_in(schemas.TIERS)} THEN tire ELSE 'bronze' END AS tire,
      address, created_at, updated_at
      FROM (SELECT *, regexp_replace(phone_number, '[^0-9]', '', 'g') AS digits FROM stg_customers)""",
    "stg_brands": """SELECT DISTINCT p_brand AS brand_id, p_brand AS brand_name, n_name AS brand_origin
      FROM part LEFT JOIN nation ON n_nationkey = CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) - 1""",
    "silver_brands": """SELECT brand_id, brand_name, COALESCE(brand_origin, 'Unknown') AS brand_origin
      FROM stg_brands""",
    "stg_categories": f"""SELECT DISTINCT CAST(list_position({_list(warehouse.CATEGORIES)}, p_type) AS INT)
      AS category_id, p_type AS category_display_name, p_type || ' products' AS category_description FROM part""",
    "silver_categories": "SELECT * FROM stg_categories WHERE category_id IS NOT NULL",
    "stg_payment_methods": f"""SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INT) AS payment_method_id,
      substr(o_orderpriority, 3) AS display_name,
      CASE CAST(left(o_orderpriority, 1) AS INT) {_PAY_TYPE} ELSE 'OTHER' END AS type,
      CASE CAST(left(o_orderpriority, 1) AS INT) {_PAY_PROV} END AS provider FROM orders""",
    "silver_payment_methods": "SELECT * FROM stg_payment_methods WHERE payment_method_id IS NOT NULL",
    "stg_products": f"""SELECT p_partkey AS product_id, p_name AS product_name,
      p_type || ' size ' || p_size AS product_description, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
      CAST(list_position({_list(warehouse.CATEGORIES)}, p_type) AS INT) AS category_id, p_brand AS brand_id,
      TIMESTAMP '2015-01-01' + to_days(CAST(p_partkey % 3000 AS INT)) AS created_at,
      TIMESTAMP '2015-01-01' + to_days(CAST(p_partkey % 3000 + p_size AS INT)) AS updated_at FROM part""",
    "silver_products": "SELECT * FROM stg_products WHERE price > 0",
    "stg_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_timestamp,
      CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
      CAST(left(o_orderpriority, 1) AS INT) AS payment_method_id, o_orderdate AS created_at,
      o_orderdate + to_days(CASE o_orderstatus WHEN 'F' THEN 7 WHEN 'P' THEN 3 ELSE 0 END) AS updated_at
      FROM orders""",
    "silver_orders": "SELECT * EXCLUDE (order_timestamp) FROM ("
    + _latest("stg_orders", "order_id", "updated_at DESC NULLS LAST, created_at DESC NULLS LAST, "
              "customer_id, order_date, total_amount, payment_method_id")
    + ") WHERE order_id IS NOT NULL AND total_amount >= 0",
    "raw_items": """SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
      l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
      CAST(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
        // NULLIF(CAST(l_quantity AS INT), 0) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS price,
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS discount
      FROM lineitem""",
    "stg_order_items": """SELECT * REPLACE (COALESCE(discount, 0) AS discount),
      CAST(quantity * price - COALESCE(discount, 0) AS DECIMAL(18,2)) AS line_total_amount FROM raw_items""",
    "silver_order_items": "SELECT * REPLACE (greatest(line_total_amount, CAST(0 AS DECIMAL(18,2))) AS line_total_amount) FROM ("
    + _latest("stg_order_items", "order_item_id", "order_id NULLS FIRST, product_id NULLS FIRST, "
              "quantity NULLS FIRST, price NULLS FIRST, discount NULLS FIRST")
    + ") WHERE order_item_id IS NOT NULL AND quantity > 0 AND price >= 0",
    # web sessions
    "raw_click": f"""SELECT CAST(event_id AS VARCHAR) AS event_id,
      's-' || user_id || '-' || strftime(ts, '%Y%m%d%H') AS session_id, ts, user_id, event_type,
      CAST(value AS DECIMAL(12,2)) AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      CASE event_type {_STEPS} END AS steps FROM events""",
    "stg_clickstream": f"""SELECT event_id, session_id, ts AS event_timestamp, CAST(ts AS DATE) AS event_date, user_id,
      {_nth(warehouse.SEGMENTS, 'user_id % 4')} AS user_segment,
      {_nth(warehouse.DEVICES, 'user_id % 3')} AS device_type, {_nth(warehouse.SYSTEMS, 'user_id % 3')} AS device_os,
      'Chrome' AS device_browser, 'v' || (k % 10) AS device_version,
      {_nth(warehouse.PROVINCES, 'user_id % 25')} AS city, 'Vietnam' AS country,
      CAST(user_id % 16 + 8 AS DOUBLE) AS latitude, CAST(user_id % 8 + 102 AS DOUBLE) AS longitude,
      'https://ref.example/' || event_type AS referrer,
      CASE WHEN k < 50 THEN 'search' ELSE 'social' END AS referrer_type,
      CASE WHEN k < 50 THEN 'google' ELSE 'facebook' END AS utm_source,
      CASE WHEN k < 10 THEN 'camp-' || k END AS utm_campaign,
      CAST(CASE WHEN event_type = 'error' AND k < 10 THEN k ELSE (len(steps) - 1) * 30 + k + 10 END AS INT) AS duration_seconds,
      CAST(len(steps) AS INT) AS page_views,
      CAST(CASE WHEN event_type = 'error' AND k > 50 THEN len(steps) + 1 ELSE len(steps) END AS INT) AS actions_count,
      event_type = 'purchase' AS has_purchase,
      CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DECIMAL(12,2)) END AS revenue,
      user_id % 3 = 0 AS is_mobile, 'vi' AS language,
      CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS ab_test, CAST(ts AS DATE) AS ingest_date,
      CAST(len(steps) AS INT) AS n_actions FROM raw_click""",
    "latest_event": _latest("raw_click", "session_id", "ts DESC NULLS LAST, event_id"),
    "silver_sessions": """SELECT s.session_id, s.user_id, event_timestamp AS timestamp, device_type, device_os,
      device_browser AS browser, city, country, latitude, longitude, duration_seconds, page_views, actions_count,
      has_purchase, revenue, user_segment, referrer, referrer_type, utm_source, utm_campaign, is_mobile, language,
      ab_test, CAST(year(event_timestamp) AS INT) AS year, CAST(month(event_timestamp) AS INT) AS month,
      CAST(day(event_timestamp) AS INT) AS day FROM stg_clickstream s JOIN latest_event l ON s.event_id = l.event_id""",
    "action_rows": """SELECT session_id, user_id, event_id, ts, event_type, value, k,
      unnest(steps) AS kind, unnest(range(len(steps))) AS i FROM latest_event""",
    "action_offsets": """SELECT *, CASE WHEN event_type = 'error' THEN 1 - i ELSE i END * 30 + k AS time_offset
      FROM action_rows""",
    "silver_actions": f"""SELECT session_id || '-act-' || row_number() OVER
        (PARTITION BY session_id ORDER BY time_offset, kind, i) AS action_id, session_id, user_id,
      date_trunc('second', ts) + to_seconds(time_offset) AS action_timestamp, kind AS action_type,
      CASE WHEN kind <> 'search' THEN k END AS product_id,
      CASE WHEN kind = 'search' THEN 'term-' || k END AS search_term,
      CASE WHEN kind = 'purchase' THEN 'web-' || event_id END AS order_id,
      CASE WHEN kind = 'purchase' THEN value ELSE CAST(0 AS DECIMAL(12,2)) END AS revenue,
      CASE WHEN kind <> 'search' THEN value END AS product_price,
      CASE WHEN kind <> 'search' THEN {_nth(warehouse.CATEGORIES, 'k % 6')} END AS product_category,
      {_FLAGS}, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day
      FROM action_offsets""",
    # star schema
    "dim_date": f"""SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS calendar_date,
      CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, strftime(d, '%m-%Y') AS month_year,
      CAST(quarter(d) AS INT) AS quarter, 'Q' || quarter(d) AS quarter_name,
      'Q' || quarter(d) || '-' || year(d) AS quarter_year, strftime(d, '%B') AS month_name,
      strftime(d, '%A') AS day_name, CAST(dayofweek(d) IN (0, 6) AS INT) AS is_weekend,
      CAST(dayofweek(d) NOT IN (0, 6) AS INT) AS is_weekday
      FROM (SELECT unnest(generate_series(TIMESTAMP '{lakehouse.CALENDAR[0]}',
        TIMESTAMP '{lakehouse.CALENDAR[1]}', INTERVAL 1 DAY)) AS d)""",
    "dim_product": """SELECT product_id, product_name, product_description, price AS unit_price,
      COALESCE(c.category_display_name, 'Uncategorized') AS category,
      COALESCE(b.brand_name, 'Generic') AS brand_name, COALESCE(b.brand_origin, 'Unknown') AS brand_origin
      FROM silver_products p LEFT JOIN silver_categories c ON p.category_id = c.category_id
      LEFT JOIN silver_brands b ON p.brand_id = b.brand_id""",
    "fact_order": """SELECT o.order_id, customer_id AS customer_key, payment_method_id AS payment_method_key,
      CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_key, CAST(COALESCE(q, 0) AS BIGINT) AS quantity,
      CAST(COALESCE(gross, total_amount) AS DECIMAL(18,2)) AS price,
      CAST(COALESCE(discounts, 0) AS DECIMAL(18,2)) AS discount_amt,
      CAST(COALESCE(net, total_amount) AS DECIMAL(18,2)) AS sub_total
      FROM silver_orders o LEFT JOIN (SELECT order_id, sum(quantity) AS q, sum(quantity * price) AS gross,
        sum(discount) AS discounts, sum(line_total_amount) AS net FROM silver_order_items GROUP BY order_id) i
      ON o.order_id = i.order_id""",
    "fact_items": """SELECT order_item_id, i.order_id, customer_id AS customer_key, product_id AS product_key,
      payment_method_id AS payment_method_key, CAST(strftime(order_date, '%Y%m%d') AS INT) AS order_date_key,
      quantity, price, discount AS discount_amt, line_total_amount AS sub_total
      FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id""",
    "sold": """SELECT f.*, p.* FROM fact_items f JOIN dim_product p ON f.product_key = p.product_id""",
    "dated": """SELECT f.*, d.* EXCLUDE (date_key) FROM fact_order f JOIN dim_date d ON f.date_key = d.date_key""",
    "paid": """SELECT f.*, m.display_name, m.type AS payment_type, m.provider, m.payment_method_id
      FROM fact_order f JOIN silver_payment_methods m ON f.payment_method_key = m.payment_method_id""",
    "located": f"""SELECT f.*, c.customer_id, c.address, COALESCE(c.tire, 'Standard') AS loyalty_tier,
      COALESCE(c.address, 'Unknown Province') AS province, {_REGION} AS macro_region
      FROM fact_order f JOIN silver_customers c ON f.customer_key = c.customer_id""",
    # features
    # Fixed values, here and below: the names of the daily and the three-day columns.
    "daily_sessions": """SELECT user_id, CAST(timestamp AS DATE) AS activity_date,
      count(DISTINCT session_id) AS sessions,
      CAST(sum(duration_seconds) AS BIGINT) AS duration,
      CAST(sum(page_views) AS BIGINT) AS page_views,
      CAST(sum(actions_count) AS BIGINT) AS actions,
      count(*) FILTER (WHERE has_purchase) AS purchase_sessions,
      CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
      FROM silver_sessions WHERE user_id IS NOT NULL GROUP BY ALL""",
    "daily_actions": f"""SELECT user_id, CAST(action_timestamp AS DATE) AS activity_date,
      CAST(sum(is_view) AS BIGINT) AS view_count,
      CAST(sum(is_add_to_cart) AS BIGINT) AS add_to_cart_count,
      CAST(sum(is_purchase) AS BIGINT) AS purchase_count,
      CAST(sum(is_search) AS BIGINT) AS search_count,
      CAST(sum(is_wishlist) AS BIGINT) AS wishlist_count,
      CAST(sum(is_checkout_view) AS BIGINT) AS checkout_view_count,
      count(DISTINCT product_id) AS distinct_products,
      CAST({_ratio('sum(product_price)', 'count(product_price)', 6)} AS DECIMAL(18,6)) AS avg_product_price
      FROM silver_actions JOIN (SELECT session_id FROM silver_sessions) USING (session_id)
      WHERE user_id IS NOT NULL GROUP BY ALL""",
    "daily_activity": """SELECT user_id, activity_date,
      COALESCE(sessions, 0) AS sessions,
      COALESCE(duration, 0) AS duration,
      COALESCE(page_views, 0) AS page_views,
      COALESCE(actions, 0) AS actions,
      COALESCE(purchase_sessions, 0) AS purchase_sessions,
      COALESCE(view_count, 0) AS view_count,
      COALESCE(add_to_cart_count, 0) AS add_to_cart_count,
      COALESCE(purchase_count, 0) AS purchase_count,
      COALESCE(search_count, 0) AS search_count,
      COALESCE(wishlist_count, 0) AS wishlist_count,
      COALESCE(checkout_view_count, 0) AS checkout_view_count,
      COALESCE(distinct_products, 0) AS distinct_products,
      COALESCE(revenue, 0) AS revenue,
      COALESCE(avg_product_price, 0) AS avg_product_price
      FROM daily_sessions FULL JOIN daily_actions USING (user_id, activity_date)""",
    "anchor": """SELECT DISTINCT user_id, activity_date AS prediction_date,
      CAST(CASE WHEN purchase_sessions > 0 OR purchase_count > 0 THEN 1 ELSE 0 END AS INT) AS label_purchase_tomorrow
      FROM daily_activity""",
    # every active day is handed on to the three days after it
    "carried": """SELECT * REPLACE (activity_date + n AS activity_date)
      FROM daily_activity, (VALUES (1), (2), (3)) AS later(n)""",
    "carried_sums": """SELECT user_id, activity_date AS prediction_date,
      CAST(sum(sessions) AS BIGINT) AS sessions_3d,
      CAST(sum(duration) AS BIGINT) AS total_duration_3d,
      CAST(sum(page_views) AS BIGINT) AS total_page_views_3d,
      CAST(sum(actions) AS BIGINT) AS total_actions_3d,
      CAST(sum(purchase_sessions) AS BIGINT) AS purchase_sessions_3d,
      CAST(sum(view_count) AS BIGINT) AS view_count_3d,
      CAST(sum(add_to_cart_count) AS BIGINT) AS add_to_cart_count_3d,
      CAST(sum(purchase_count) AS BIGINT) AS purchase_count_3d,
      CAST(sum(search_count) AS BIGINT) AS search_count_3d,
      CAST(sum(wishlist_count) AS BIGINT) AS wishlist_count_3d,
      CAST(sum(checkout_view_count) AS BIGINT) AS checkout_view_count_3d,
      max(distinct_products) AS distinct_products_3d,
      CAST(sum(revenue) AS DOUBLE) AS total_revenue_3d,
      CAST(sum(avg_product_price) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_product_price_3d
      FROM carried GROUP BY ALL""",
    "rolling": """SELECT user_id, prediction_date, label_purchase_tomorrow,
      COALESCE(sessions_3d, 0) AS sessions_3d,
      COALESCE(total_duration_3d, 0) AS total_duration_3d,
      COALESCE(total_page_views_3d, 0) AS total_page_views_3d,
      COALESCE(total_actions_3d, 0) AS total_actions_3d,
      COALESCE(purchase_sessions_3d, 0) AS purchase_sessions_3d,
      COALESCE(view_count_3d, 0) AS view_count_3d,
      COALESCE(add_to_cart_count_3d, 0) AS add_to_cart_count_3d,
      COALESCE(purchase_count_3d, 0) AS purchase_count_3d,
      COALESCE(search_count_3d, 0) AS search_count_3d,
      COALESCE(wishlist_count_3d, 0) AS wishlist_count_3d,
      COALESCE(checkout_view_count_3d, 0) AS checkout_view_count_3d,
      COALESCE(distinct_products_3d, 0) AS distinct_products_3d,
      COALESCE(total_revenue_3d, 0.0) AS total_revenue_3d,
      COALESCE(avg_product_price_3d, 0.0) AS avg_product_price_3d
      FROM anchor LEFT JOIN carried_sums USING (user_id, prediction_date)""",
    "behaviour": f"""SELECT *,
      COALESCE({_ratio('total_duration_3d', 'sessions_3d', 2)}, 0.0) AS avg_session_duration_3d,
      COALESCE({_ratio('purchase_count_3d', 'add_to_cart_count_3d', 4)}, 0.0) AS cart_conversion_rate_3d,
      COALESCE({_ratio('purchase_count_3d', 'total_actions_3d', 4)}, 0.0) AS purchase_conversion_rate_3d,
      COALESCE({_ratio('total_actions_3d', 'sessions_3d', 4)}, 0.0) AS actions_per_session_3d,
      COALESCE({_ratio('purchase_sessions_3d', 'sessions_3d', 4)}, 0.0) AS purchase_session_rate_3d
      FROM rolling""",
    "scored": f"""SELECT user_id, user_id AS customer_id, prediction_date, prediction_date AS campaign_date,
      label_purchase_tomorrow, {_score(schemas.RULE_INTERCEPT)} AS purchase_probability FROM behaviour""",
    "scored_cold": f"""SELECT user_id AS customer_id, prediction_date AS campaign_date,
      {_score(-2.5)} AS purchase_probability FROM behaviour""",
    "campaign": _campaign("scored"),
    "campaign_cold": _campaign("scored_cold"),
    "confusion": """SELECT
      count(*) FILTER (WHERE label_purchase_tomorrow = 1 AND purchase_probability >= 0.5) AS true_positive,
      count(*) FILTER (WHERE label_purchase_tomorrow = 0 AND purchase_probability >= 0.5) AS false_positive,
      count(*) FILTER (WHERE label_purchase_tomorrow = 0 AND purchase_probability < 0.5) AS true_negative,
      count(*) FILTER (WHERE label_purchase_tomorrow = 1 AND purchase_probability < 0.5) AS false_negative
      FROM scored""",
}

_MEASURES = """CAST(sum(sub_total) AS DECIMAL(18,2)) AS net, count(DISTINCT order_id) AS orders,
  CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(price) AS DECIMAL(18,2)) AS gross,
  CAST(sum(discount_amt) AS DECIMAL(18,2)) AS discount"""
_AOV = _ratio("net", "orders")


def _kpi(source: str) -> str:
    return f"""SELECT CAST(gross AS DOUBLE) AS gross_revenue, CAST(discount AS DOUBLE) AS total_discount,
      CAST(net AS DOUBLE) AS net_revenue, {_pct('discount', 'gross')} AS discount_rate_pct,
      orders AS total_orders, units AS total_units_sold, {_AOV} AS average_order_value,
      {_ratio('units', 'orders')} AS units_per_transaction FROM (SELECT {_MEASURES} FROM {source})"""


def _period(keys: str, order: str, lag: int, extra: str) -> str:
    prev = f"lag({{}}, {lag}) OVER (ORDER BY {order})"
    return f"""SELECT {keys}, CAST(net AS DOUBLE) AS net_revenue, orders AS order_count,
      units AS units_sold, {_AOV} AS aov, {extra.format(prev_net=prev.format('net'),
      net_growth=_pct('net - ' + prev.format('net'), prev.format('net')),
      order_growth=_pct('orders - ' + prev.format('orders'), prev.format('orders')))}
      FROM (SELECT {keys}, {_MEASURES} FROM dated GROUP BY {keys})"""


def _category(where: str = "") -> str:
    return f"""SELECT category, CAST(net AS DOUBLE) AS category_net_revenue, units AS category_units_sold,
      orders AS category_orders, {_ratio('net', 'units')} AS revenue_per_unit,
      {_pct('net', 'sum(net) OVER ()')} AS category_revenue_share_pct
      FROM (SELECT category, {_MEASURES} FROM sold {where} GROUP BY category)"""


def _payment_type() -> str:
    return f"""SELECT payment_type AS payment_channel_type, orders AS total_orders,
      CAST(net AS DOUBLE) AS total_net_revenue, {_AOV} AS aov, {_pct('net', 'sum(net) OVER ()')} AS revenue_share_pct
      FROM (SELECT payment_type, {_MEASURES} FROM paid GROUP BY payment_type)"""


_ORIGIN = "COALESCE(b.brand_origin, s.brand_origin, 'Unknown Origin')"
_PROVINCE = f"""SELECT province, {_MEASURES}, count(DISTINCT customer_id) AS buyers
  FROM located GROUP BY province"""
_DELIVERY_DAYS = " ".join(
    f"WHEN province IN {_in(p)} THEN {d}::DOUBLE" for d, _, p in schemas.DELIVERY_TIERS
)
_DELIVERY_TIER = " ".join(
    f"WHEN province IN {_in(p)} THEN {_text(t)}" for _, t, p in schemas.DELIVERY_TIERS
)
_RELATIONS = [
    ("fact_order.customer", "fact_order", "customer_key", "silver_customers", "customer_id"),
    ("fact_order.payment", "fact_order", "payment_method_key", "silver_payment_methods", "payment_method_id"),
    ("fact_order.date", "fact_order", "date_key", "dim_date", "date_key"),
    ("fact_items.order", "fact_items", "order_id", "fact_order", "order_id"),
    ("fact_items.customer", "fact_items", "customer_key", "silver_customers", "customer_id"),
    ("fact_items.product", "fact_items", "product_key", "dim_product", "product_id"),
    ("fact_items.payment", "fact_items", "payment_method_key", "silver_payment_methods", "payment_method_id"),
    ("fact_items.date", "fact_items", "order_date_key", "dim_date", "date_key"),
    ("orders.customer", "silver_orders", "customer_id", "silver_customers", "customer_id"),
    ("orders.payment", "silver_orders", "payment_method_id", "silver_payment_methods", "payment_method_id"),
    ("items.order", "silver_order_items", "order_id", "silver_orders", "order_id"),
    ("items.product", "silver_order_items", "product_id", "silver_products", "product_id"),
    ("products.category", "silver_products", "category_id", "silver_categories", "category_id"),
    ("products.brand", "silver_products", "brand_id", "silver_brands", "brand_id"),
    ("actions.session", "silver_actions", "session_id", "silver_sessions", "session_id"),
]
_RECONCILED = """SELECT o.order_id, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(COALESCE(t, 0) AS DOUBLE) AS items_total, CAST(total_amount - COALESCE(t, 0) AS DOUBLE) AS difference
  FROM silver_orders o LEFT JOIN (SELECT order_id, sum(line_total_amount) AS t FROM silver_order_items
    GROUP BY order_id) i ON o.order_id = i.order_id WHERE total_amount <> COALESCE(t, 0)"""
_OFFSETS = """SELECT event_id, session_id, duration_seconds, actions_count, n_actions,
  [CASE WHEN event_type = 'error' THEN 1 - i ELSE i END * 30 + k FOR i IN range(len(steps))] AS o
  FROM stg_clickstream JOIN raw_click USING (event_id, session_id)"""
_COHERENCE = f"""SELECT event_id, session_id, 'offsets_decrease' AS violation FROM ({_OFFSETS}) WHERE o <> list_sort(o)
  UNION ALL SELECT event_id, session_id, 'count_differs' FROM ({_OFFSETS}) WHERE actions_count <> n_actions
  UNION ALL SELECT event_id, session_id, 'duration_too_short' FROM ({_OFFSETS}) WHERE duration_seconds < list_max(o)"""
_LAST4 = """CASE WHEN length({0}) <= 4 THEN repeat('x', length({0}))
  ELSE repeat('x', length({0}) - 4) || right({0}, 4) END"""
_REDACT = r"regexp_replace(regexp_replace(regexp_replace({0}, '\p{{Ll}}', 'x', 'g'), '\p{{Lu}}', 'X', 'g'), '[0-9]', 'n', 'g')"
_CONTACT = "customer_id, first_name, last_name, email, phone_number, tire, address"


def _dup(keys: str, source: str) -> str:
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"SELECT {keys}, count(*) AS rows FROM {source} WHERE {present} GROUP BY {keys} HAVING count(*) > 1"


def _checks(items: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {_text(n)} AS check_name, count(*) AS violations, count(*) = 0 AS passed FROM ({q}) t"
        for n, q in items.items()
    )


def _describe() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(count(x) AS DOUBLE) AS count, round(avg(x), 6) AS mean,
        round(stddev_samp(x), 6) AS stddev, min(x) AS min, max(x) AS max, quantile_disc(x, 0.25) AS q1,
        quantile_disc(x, 0.5) AS median, quantile_disc(x, 0.75) AS q3
        FROM (SELECT CAST({c} AS DOUBLE) AS x FROM behaviour)"""
        for c in schemas.FEATURES
    )


#: Tables of the declared rules that have another name here.
_CALLED = {
    "stg_clickstream_events": "(SELECT *, [] AS actions FROM stg_clickstream)", "silver_user_sessions": "silver_sessions",
    "silver_session_actions": "silver_actions",
    "dim_customer": "(SELECT customer_id, first_name, last_name, gender, tire, address FROM silver_customers)",
    "dim_date": """(SELECT * FROM dim_date WHERE calendar_date BETWEEN (SELECT min(CAST(order_date AS DATE)) FROM silver_orders)
      AND (SELECT max(CAST(order_date AS DATE)) FROM silver_orders))""",
    "dim_payment_method": """(SELECT *, DATE '2025-01-01' AS effective_start_date, true AS is_current
      FROM silver_payment_methods)""",
    "fact_order_items": "fact_items", "user_behavior_3d": "behaviour",
}


def _declared() -> str:
    out = []
    for table, declared in rules.DECLARED.items():
        source = _CALLED.get(table, table)
        has_created = table in ("stg_customers", "stg_products", "stg_orders", "silver_customers", "silver_products", "silver_orders")
        checks = []
        for c in declared.not_null:
            stored = c in rules.AUDIT and not (c == "created_at" and has_created)
            checks.append(("not_null", c, "0" if stored else f"count(*) FILTER (WHERE {c} IS NULL)"))
        for key in declared.unique:
            value = key[0] if len(key) == 1 else f"({', '.join(key)})"
            checks.append(("unique", "+".join(key), f"count({value}) - count(DISTINCT {value})"))
        for c, values in declared.accepted.items():
            allowed = _in(values) if isinstance(values[0], str) else f"({', '.join(map(str, values))})"
            checks.append(("accepted_values", c, f"count(*) FILTER (WHERE {c} NOT IN {allowed})"))
        rows = ", ".join(f"('{rule}', '{c}', CAST({count} AS BIGINT))" for rule, c, count in checks)
        out.append(f"""SELECT '{table}' AS table_name, u.r[1] AS rule, u.r[2] AS column_name, rows_checked, u.r[3] AS violations
          FROM (SELECT count(*) AS rows_checked, [{rows}] AS found FROM {source} t), unnest(found) u(r)""")
    return " UNION ALL ".join(out)


_SESSION_COLUMNS = "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM silver_sessions"
_CLICK_COLUMNS = "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM stg_clickstream"
_FACT_ORDER = """SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(discount_amt AS DOUBLE) AS discount_amt,
  CAST(sub_total AS DOUBLE) AS sub_total) FROM fact_order"""
_BUCKET = "CAST('0x' || substr(md5(user_id || '|' || prediction_date), 1, 8) AS BIGINT) % 100"
# The fitted model. The features in the order of the weights, standardised by the training rows.
CTES["ml_rows"] = f"""SELECT user_id, prediction_date, label_purchase_tomorrow AS y, {_BUCKET} < 80 AS train,
  [CAST(sessions_3d AS DOUBLE), total_duration_3d, avg_session_duration_3d, total_page_views_3d, total_actions_3d,
   total_revenue_3d, view_count_3d, add_to_cart_count_3d, purchase_count_3d, search_count_3d,
   checkout_view_count_3d, cart_conversion_rate_3d] AS raw FROM behaviour"""
CTES["ml_long"] = """SELECT user_id, prediction_date, train, j, raw[j] AS v FROM ml_rows, range(1, 13) t(j)"""
CTES["ml_scale"] = "SELECT j, avg(v) AS m, stddev_samp(v) AS d FROM ml_long WHERE train GROUP BY j"
# x[1] = 1 stands for the intercept
CTES["ml_x"] = """SELECT user_id, prediction_date, any_value(y) AS y, any_value(r.train) AS train,
  list_prepend(1.0::DOUBLE, list(CASE WHEN d > 0 THEN (v - m) / d ELSE 0.0::DOUBLE END ORDER BY j)) AS x
  FROM ml_long JOIN ml_scale USING (j) JOIN ml_rows r USING (user_id, prediction_date) GROUP BY user_id, prediction_date"""
CTES["ml_train"] = "SELECT y, x FROM ml_x WHERE train"
# Nesterov's accelerated descent: step 1 / 3.3 bounds the curvature of 13 standardised columns, momentum from 0.01
CTES["ml_descent"] = """SELECT 0, list_transform(range(13), lambda k: 0.0::DOUBLE), list_transform(range(13), lambda k: 0.0::DOUBLE)
  UNION ALL
  SELECT it + 1, list(u ORDER BY j), list(u + 0.8957 * (u - old) ORDER BY j) FROM (
    SELECT it, j, any_value(old) AS old, any_value(here) - (avg(r * xj) + any_value(pull)) / 3.3 AS u FROM (
      SELECT it, j, x[j] AS xj, w[j] AS old, z[j] AS here, CASE WHEN j > 1 THEN 0.01 * z[j] ELSE 0 END AS pull,
        1.0 / (1.0 + exp(-list_dot_product(x, z))) - y AS r
      FROM ml_descent, ml_train, range(1, 14) t(j) WHERE it < 500) GROUP BY it, j) GROUP BY it"""
_RECURSIVE = {"ml_descent": "(it, w, z)"}
CTES["ml_weights"] = "SELECT w FROM ml_descent WHERE it = 500"
CTES["ml_slopes"] = """SELECT j, avg((1.0 / (1.0 + exp(-list_dot_product(x, w))) - y) * x[j])
  + any_value(CASE WHEN j > 1 THEN 0.01 * w[j] ELSE 0 END) AS slope FROM ml_train, ml_weights, range(1, 14) t(j) GROUP BY j"""
CTES["ml_scored"] = """SELECT user_id, user_id AS customer_id, prediction_date, prediction_date AS campaign_date, train,
  y AS label_purchase_tomorrow, 1.0 / (1.0 + exp(-list_dot_product(x, w))) AS p FROM ml_x, ml_weights"""
CTES["ml_tested"] = "SELECT label_purchase_tomorrow, p AS purchase_probability FROM ml_scored WHERE NOT train"
_IMPORTANCE = f"""SELECT unnest({_list(schemas.FEATURES)}) AS feature, round(unnest(w[2:]), 4) AS coefficient
  FROM ml_weights"""


CTES["ml_confused"] = CTES["confusion"].replace("FROM scored", "FROM ml_tested")
CTES["ml_last_day"] = f"""SELECT customer_id, campaign_date, {_round('p', 4)} AS purchase_probability FROM ml_scored
  WHERE prediction_date = (SELECT max(prediction_date) FROM behaviour)"""


def _class_metrics(source: str) -> str:
    weighted = "(coalesce({}, 0) * (tp + fn) + coalesce({}, 0) * (tn + fp)) / n"
    f1 = weighted.format("2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0)", "2.0::DOUBLE * tn / nullif(2 * tn + fn + fp, 0)")
    precision = weighted.format("tp::DOUBLE / nullif(tp + fp, 0)", "tn::DOUBLE / nullif(tn + fn, 0)")
    recall = weighted.format("tp::DOUBLE / nullif(tp + fn, 0)", "tn::DOUBLE / nullif(tn + fp, 0)")
    return f"""SELECT {_round(f1, 4)} AS f1, {_round(precision, 4)} AS "precision", {_round(recall, 4)} AS recall,
      {_round('(tp + tn)::DOUBLE / n', 4)} AS accuracy FROM (SELECT true_positive AS tp, false_positive AS fp,
      true_negative AS tn, false_negative AS fn,
      true_positive + false_positive + true_negative + false_negative AS n FROM {source})"""


def _areas(source: str) -> str:
    return f"""SELECT round(CAST(sum(neg * (2 * above + pos)) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)), 4) AS auc_roc,
      round(sum(pos * (here + back) / 2) / sum(pos), 4) AS auc_pr FROM (
      SELECT pos, neg, above, (above + pos)::DOUBLE / (above + false_above + pos + neg) AS here,
        CASE WHEN above + false_above = 0 THEN (above + pos)::DOUBLE / (above + false_above + pos + neg)
          ELSE above::DOUBLE / (above + false_above) END AS back FROM (
        SELECT pos, neg, coalesce(sum(pos) OVER earlier, 0) AS above, coalesce(sum(neg) OVER earlier, 0) AS false_above FROM (
          SELECT purchase_probability AS p, count(*) FILTER (WHERE label_purchase_tomorrow = 1) AS pos,
            count(*) FILTER (WHERE label_purchase_tomorrow = 0) AS neg FROM {source} GROUP BY 1)
        WINDOW earlier AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


_AVG_ORDERS = "(SELECT avg(n) FROM method_orders)"
CTES["method_orders"] = "SELECT payment_method_id, count(order_id) AS n FROM silver_orders GROUP BY 1"
CTES["later_methods"] = f"""SELECT m.* REPLACE (CASE WHEN n > {_AVG_ORDERS} THEN 'Preferred ' || provider
  ELSE provider END AS provider), m.provider AS old_provider
  FROM silver_payment_methods m LEFT JOIN method_orders o USING (payment_method_id)"""
CTES["later_tiers"] = """SELECT c.customer_id, c.tire AS old_tire, s.tire IS NOT NULL AS known, c.address,
  CASE WHEN spend >= 3000000 THEN 'platinum' ELSE c.tire END AS tire
  FROM silver_customers c JOIN stg_customers s USING (customer_id)
  LEFT JOIN (SELECT customer_id, sum(total_amount) AS spend FROM silver_orders GROUP BY 1) o USING (customer_id)"""

BODIES: dict[str, str] = {
    "src_csv_roundtrip": """SELECT order_id, customer_id, order_timestamp AS order_date,
      CAST(total_amount AS DOUBLE) AS total_amount, payment_method_id, created_at, updated_at FROM stg_orders""",
    "src_ndjson_scan": """SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM stg_clickstream""",
    "sink_partitioned_sessions": _SESSION_COLUMNS,
    "compact_partition": _SESSION_COLUMNS,
    "compact_small_files": _SESSION_COLUMNS,
    "zorder_cluster": _FACT_ORDER,
    "stg_brands": "SELECT * FROM stg_brands",
    "stg_categories": "SELECT * FROM stg_categories",
    "stg_payment_methods": "SELECT * FROM stg_payment_methods",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_products": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM stg_products",
    "stg_orders": "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM stg_orders",
    "stg_order_items": """SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(discount AS DOUBLE) AS discount,
      CAST(line_total_amount AS DOUBLE) AS line_total_amount) FROM stg_order_items""",
    "stg_clickstream": _CLICK_COLUMNS,
    "silver_brands": "SELECT * FROM silver_brands",
    "silver_categories": "SELECT * FROM silver_categories",
    "silver_payment_methods": "SELECT * FROM silver_payment_methods",
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_products": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM silver_products",
    "silver_orders": "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM silver_orders",
    "silver_order_items": """SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(discount AS DOUBLE) AS discount,
      CAST(line_total_amount AS DOUBLE) AS line_total_amount) FROM silver_order_items""",
    "silver_user_sessions": _SESSION_COLUMNS,
    "silver_session_actions": """SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue,
      CAST(product_price AS DOUBLE) AS product_price) FROM silver_actions""",
    "dim_customer": "SELECT customer_id, first_name, last_name, gender, tire, address FROM silver_customers",
    "dim_date": """SELECT * FROM dim_date WHERE calendar_date BETWEEN
      (SELECT min(order_date) FROM stg_orders) AND (SELECT max(order_date) FROM stg_orders)""",
    "dim_payment_method": """SELECT payment_method_id, display_name, provider, type,
      DATE '2025-01-01' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, TRUE AS is_current
      FROM silver_payment_methods""",
    "scd2_payment_method": """SELECT payment_method_id, display_name, old_provider AS provider, type,
      DATE '2025-01-01' AS effective_start_date,
      CASE WHEN provider IS DISTINCT FROM old_provider THEN DATE '2025-07-01' END AS effective_end_date,
      provider IS NOT DISTINCT FROM old_provider AS is_current FROM later_methods
      UNION ALL SELECT payment_method_id, display_name, provider, type, DATE '2025-07-01', NULL, TRUE
      FROM later_methods WHERE provider IS DISTINCT FROM old_provider""",
    "scd2_monthly_tier": """WITH monthly AS (
      SELECT customer_id, CAST(date_trunc('month', order_date) + INTERVAL 1 MONTH AS DATE) AS day, sum(total_amount) AS spent
      FROM silver_orders GROUP BY ALL),
      tiers AS (SELECT customer_id, day, CASE WHEN so_far >= 2000000 THEN 'platinum' WHEN so_far >= 1000000 THEN 'gold'
        WHEN so_far >= 500000 THEN 'silver' ELSE 'bronze' END AS tire
        FROM (SELECT *, sum(spent) OVER (PARTITION BY customer_id ORDER BY day) AS so_far FROM monthly)),
      begun AS (SELECT * FROM tiers
        QUALIFY tire IS DISTINCT FROM lag(tire) OVER (PARTITION BY customer_id ORDER BY day))
      SELECT customer_id, tire, day AS effective_start_date,
        lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS effective_end_date,
        lead(day) OVER (PARTITION BY customer_id ORDER BY day) IS NULL AS is_current FROM begun""",
    "scd2_customer_tier": """SELECT customer_id, old_tire AS tire, address, DATE '2000-01-01' AS effective_start_date,
      CASE WHEN tire <> old_tire THEN DATE '2002-01-01' END AS effective_end_date, tire = old_tire AS is_current
      FROM later_tiers WHERE known
      UNION ALL SELECT customer_id, tire, address, DATE '2002-01-01', NULL, TRUE
      FROM later_tiers WHERE NOT known OR tire <> old_tire""",
    "dim_product": "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM dim_product",
    "fact_order": _FACT_ORDER,
    "fact_order_items": """SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(discount_amt AS DOUBLE) AS discount_amt,
      CAST(sub_total AS DOUBLE) AS sub_total) FROM fact_items""",
    "feat_daily_sessions": "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM daily_sessions",
    "feat_daily_actions": """SELECT * REPLACE (CAST(avg_product_price AS DOUBLE) AS avg_product_price)
      FROM daily_actions""",
    "feat_daily_activity": """SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue,
      CAST(avg_product_price AS DOUBLE) AS avg_product_price) FROM daily_activity""",
    "feat_activity_from_log": """SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue,
      CAST(avg_product_price AS DOUBLE) AS avg_product_price) FROM daily_activity""",
    "feat_label": "SELECT * FROM anchor",
    "feat_rolling_3d": "SELECT * FROM rolling",
    "feat_user_behavior_3d": "SELECT * FROM behaviour",
    "feat_top_spenders": """SELECT * FROM behaviour WHERE prediction_date = (SELECT max(prediction_date) FROM behaviour)
      ORDER BY total_revenue_3d DESC, user_id LIMIT 20""",
    "bi_kpi": _kpi("dated"),
    "bi_kpi_filtered": _kpi("""(SELECT d.* FROM dated d JOIN silver_customers c ON d.customer_key = c.customer_id
      WHERE calendar_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND c.address = 'Hà Nội')"""),
    "bi_monthly_mom": _period("year, month, month_year, month_name", "year, month", 1,
        "CAST({prev_net} AS DOUBLE) AS prev_month_revenue, {net_growth} AS mom_revenue_growth_pct, "
        "{order_growth} AS mom_order_growth_pct"),
    "bi_quarterly_yoy": _period("year, quarter, quarter_name, quarter_year", "year, quarter", 4,
        "CAST({prev_net} AS DOUBLE) AS prev_year_same_quarter_revenue, {net_growth} AS yoy_revenue_growth_pct"),
    "bi_daily_ma7": f"""SELECT calendar_date, CAST(net AS DOUBLE) AS daily_net_revenue, orders AS daily_orders,
      units AS daily_units, {_ratio('sum(net) OVER w', 'count(net) OVER w')} AS moving_avg_7d_net_revenue,
      {_ratio('sum(orders) OVER w', 'count(orders) OVER w')} AS moving_avg_7d_orders
      FROM (SELECT calendar_date, {_MEASURES} FROM dated GROUP BY calendar_date)
      WINDOW w AS (ORDER BY calendar_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "bi_dow_profile": f"""SELECT day_name, CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
      CAST(net AS DOUBLE) AS net_revenue, orders AS order_count, units AS units_sold, {_AOV} AS aov,
      {_pct('net', 'sum(net) OVER ()')} AS revenue_share_pct
      FROM (SELECT day_name, is_weekend, {_MEASURES} FROM dated GROUP BY day_name, is_weekend)""",
    "bi_monthly_purchasers": f"""SELECT year, month, month_name, orders AS total_orders, CAST(net AS DOUBLE) AS revenue,
      {_AOV} AS average_order_value, buyers AS unique_purchasers FROM (SELECT year, month, month_name, {_MEASURES},
      count(DISTINCT customer_key) AS buyers FROM dated GROUP BY year, month, month_name)""",
    "bi_top_products": f"""SELECT product_id, product_name, category, brand_name, brand_origin,
      CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(sub_total) AS DOUBLE) AS total_net_revenue,
      {_ratio('sum(price)', 'count(price)')} AS avg_unit_selling_price, count(DISTINCT order_id) AS total_order_appearances
      FROM sold GROUP BY ALL ORDER BY sum(sub_total) DESC, product_id LIMIT 10""",
    "bi_top_products_filtered": f"""SELECT product_id, product_name, category, brand_name, brand_origin,
      CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(sub_total) AS DOUBLE) AS total_net_revenue,
      {_ratio('sum(price)', 'count(price)')} AS avg_unit_selling_price, count(DISTINCT order_id) AS total_order_appearances
      FROM sold WHERE category = 'SMALL' AND order_date_key BETWEEN 19970101 AND 19981231
      GROUP BY ALL ORDER BY sum(sub_total) DESC, product_id LIMIT 10""",
    "bi_top_product_names": """SELECT product_name, CAST(sum(sub_total) AS DOUBLE) AS total_net_revenue,
      CAST(sum(quantity) AS BIGINT) AS units_sold FROM sold GROUP BY product_name
      ORDER BY sum(sub_total) DESC, product_name LIMIT 10""",
    "bi_category_share": _category(),
    "bi_category_filtered": _category("WHERE category = 'PROMO'"),
    "bi_brand_origin": f"""SELECT COALESCE(b.brand_name, s.brand_name, 'Unknown Brand') AS brand_name,
      {_ORIGIN} AS country_of_origin, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
      CAST(sum(sub_total) AS DOUBLE) AS total_net_revenue, count(DISTINCT product_id) AS distinct_skus_sold,
      {_ratio('sum(sub_total)', 'sum(quantity)')} AS avg_revenue_per_unit
      FROM sold s LEFT JOIN stg_brands b ON s.brand_name = b.brand_name GROUP BY 1, 2""",
    "bi_origin_share": f"""SELECT country_of_origin, CAST(net AS DOUBLE) AS origin_net_revenue, units AS origin_units_sold,
      orders AS origin_orders, {_pct('net', 'sum(net) OVER ()')} AS origin_revenue_share_pct
      FROM (SELECT {_ORIGIN} AS country_of_origin, {_MEASURES} FROM sold s
        LEFT JOIN stg_brands b ON s.brand_name = b.brand_name GROUP BY 1)""",
    "bi_payment_share": f"""SELECT payment_method_id, display_name, payment_type, provider, orders AS total_orders,
      CAST(net AS DOUBLE) AS total_net_revenue, {_AOV} AS aov,
      {_pct('orders', 'sum(orders) OVER ()')} AS transaction_volume_share_pct,
      {_pct('net', 'sum(net) OVER ()')} AS revenue_market_share_pct
      FROM (SELECT payment_method_id, display_name, payment_type, provider, {_MEASURES} FROM paid GROUP BY ALL)""",
    "bi_payment_type": _payment_type(),
    "bi_payment_type_by_orders": _payment_type(),
    "bi_payment_monthly": f"""SELECT year, month, month_year, display_name AS payment_method, payment_type,
      orders AS monthly_orders, CAST(net AS DOUBLE) AS monthly_revenue,
      {_pct('net', 'sum(net) OVER (PARTITION BY year, month)')} AS monthly_revenue_share_pct
      FROM (SELECT year, month, month_year, display_name, payment_type, {_MEASURES}
        FROM paid JOIN dim_date USING (date_key) GROUP BY ALL)""",
    "bi_aov_by_payment": f"""SELECT display_name, {_AOV} AS aov
      FROM (SELECT display_name, {_MEASURES} FROM paid GROUP BY display_name)""",
    "bi_province_heatmap": f"""SELECT province, orders AS total_orders, buyers AS active_customers,
      units AS total_units_sold, CAST(net AS DOUBLE) AS total_net_revenue, {_AOV} AS average_order_value,
      {_pct('net', 'sum(net) OVER ()')} AS revenue_share_pct FROM ({_PROVINCE})""",
    "bi_top_provinces": f"""SELECT province, CAST(net AS DOUBLE) AS total_net_revenue, orders AS total_orders,
      buyers AS total_customers, {_AOV} AS aov FROM ({_PROVINCE}) ORDER BY net DESC, province LIMIT 10""",
    "bi_macro_region": f"""SELECT macro_region, orders AS total_orders, buyers AS total_customers, units AS units_sold,
      CAST(net AS DOUBLE) AS regional_net_revenue, {_AOV} AS aov,
      {_pct('net', 'sum(net) OVER ()')} AS regional_revenue_share_pct
      FROM (SELECT macro_region, {_MEASURES}, count(DISTINCT customer_id) AS buyers FROM located GROUP BY macro_region)""",
    "bi_region_tier": f"""SELECT macro_region, loyalty_tier, orders AS tier_orders, CAST(net AS DOUBLE) AS tier_revenue,
      {_AOV} AS tier_aov FROM (SELECT macro_region, loyalty_tier, {_MEASURES} FROM located GROUP BY ALL)""",
    "bi_delivery_sla": f"""SELECT province, orders AS total_orders, CAST(net AS DOUBLE) AS net_revenue,
      CASE {_DELIVERY_DAYS} ELSE 2.4::DOUBLE END AS estimated_delivery_days,
      CASE {_DELIVERY_TIER} ELSE {_text(schemas.DELIVERY_DEFAULT[1])} END AS delivery_service_tier FROM ({_PROVINCE})""",
    "bi_aov_by_region": f"""SELECT macro_region, {_AOV} AS aov
      FROM (SELECT macro_region, {_MEASURES} FROM located GROUP BY macro_region)""",
    "bi_reconciliation": """SELECT 'Source orders' AS source_system, count(*) AS total_orders,
      CAST(COALESCE(sum(total_amount), 0) AS DOUBLE) AS gross_revenue FROM stg_orders
      UNION ALL SELECT 'Order mart', count(*), CAST(COALESCE(sum(sub_total), 0) AS DOUBLE) FROM fact_order""",
    "campaign_rule_scored": "SELECT * FROM campaign",
    "campaign_segments": f"""SELECT user_id, prediction_date, purchase_probability, {_tier(1)} AS customer_segment,
      {_tier(2)} AS campaign_action, {_tier(3)} AS campaign_channel FROM scored""",
    "campaign_enrich": """SELECT * REPLACE ('Unknown' AS first_name, 'Customer' AS last_name,
      CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone) FROM campaign""",
    "campaign_metrics": f"""SELECT customer_segment, count(*) AS lead_count,
      {_round('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100')} AS percentage,
      {_ratio('sum(CAST(purchase_probability AS DECIMAL(9,4)))', 'count(*)', 4)} AS avg_probability
      FROM campaign GROUP BY customer_segment""",
    "campaign_upsert": """WITH mark AS (SELECT max(campaign_date) AS m FROM campaign_cold
        WHERE campaign_date <= (SELECT max(campaign_date) FROM campaign) - 10)
      SELECT * FROM campaign_cold WHERE campaign_date < (SELECT m FROM mark)
      UNION ALL SELECT * FROM campaign WHERE campaign_date >= (SELECT m FROM mark)""",
    "stream_campaign_upsert": "SELECT * FROM campaign",
    "inc_high_water_mark": """SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM stg_orders
      WHERE updated_at > (SELECT max(updated_at) FROM stg_orders WHERE order_date < DATE '2000-01-01')""",
    "inc_order_items": """SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(discount AS DOUBLE) AS discount,
      CAST(line_total_amount AS DOUBLE) AS line_total_amount) FROM stg_order_items
      WHERE order_item_id > (SELECT max(order_item_id) FROM stg_order_items WHERE order_id < 1000)""",
    "inc_click_events": """WITH days AS (SELECT min(event_date) + 10 AS half FROM stg_clickstream),
      loaded AS (SELECT event_id, event_timestamp FROM stg_clickstream, days
        WHERE event_date < half OR (event_date = half AND user_id % 2 = 0))
      SELECT * EXCLUDE (n_actions) REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM stg_clickstream
      WHERE event_timestamp >= (SELECT max(event_timestamp) FROM loaded)
        AND (event_timestamp, event_id) NOT IN (SELECT event_timestamp, event_id FROM loaded)""",
    "ml_impute": "SELECT user_id, prediction_date, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.FEATURES) + " FROM behaviour",
    "ml_scaled_features": "SELECT user_id, prediction_date, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}"
        for c in schemas.FEATURES) + " FROM behaviour",
    "ml_split": f"""SELECT user_id, prediction_date, label_purchase_tomorrow,
      CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS part FROM anchor""",
    "ml_model_roundtrip": f"""SELECT count(*) AS scored_rows, count(*) AS same_rows FROM anchor
      WHERE {_BUCKET} >= 80""",
    "ml_confusion": "SELECT * FROM confusion",
    "ml_class_metrics": _class_metrics("confusion"),
    "ml_rule_auc": _areas("scored"),
    "ml_train_lr": f"""SELECT i.*, round(w[1], 4) AS intercept, (SELECT max(abs(slope)) < 1e-5 FROM ml_slopes) AS optimal
      FROM ({_IMPORTANCE}) i, ml_weights""",
    "ml_importance": _IMPORTANCE,
    "ml_metrics": f"""SELECT * FROM ({_areas("ml_tested")}), ({_class_metrics("ml_confused")})""",
    "ml_batch_score": f"""{_campaign("ml_last_day")}""",
    "ml_label_balance": f"""SELECT label_purchase_tomorrow, count(*) AS rows,
      {_pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct FROM behaviour GROUP BY label_purchase_tomorrow""",
    "ml_describe": _describe(),
    "dq_not_null": " UNION ALL ".join(
        f"""SELECT 'customers' AS table_name, count(*) AS rows_checked, '{c}' AS column_name,
        count(*) FILTER (WHERE {c} IS NULL) AS violations FROM stg_customers"""
        for c in ["customer_id", "email", "gender", "tire", "address", "created_at"]),
    "dq_declared_rules": _declared(),
    "dq_unique": _dup("order_item_id", "stg_order_items"),
    "dq_unique_composite": _dup("order_id, product_id", "stg_order_items"),
    "dq_accepted_values": f"""SELECT tire AS value, count(*) AS rows FROM stg_customers
      WHERE tire NOT IN {_in(schemas.TIERS)} GROUP BY tire""",
    "dq_relationships": " UNION ALL ".join(
        f"""SELECT '{label}' AS relation, count(*) AS rows_checked,
        count(*) FILTER (WHERE {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) AS orphans
        FROM {child} WHERE {fk} IS NOT NULL""" for label, child, fk, parent, pk in _RELATIONS),
    "dq_orphans": """SELECT customer_id AS value, count(*) AS rows FROM silver_customers c
      WHERE NOT EXISTS (SELECT 1 FROM silver_sessions o WHERE o.user_id = c.customer_id) GROUP BY customer_id""",
    "dq_positive_revenue": """SELECT 'fact_order' AS model_name, order_id AS record_id, CAST(sub_total AS DOUBLE) AS sub_total,
      CAST(price AS DOUBLE) AS price, CAST(discount_amt AS DOUBLE) AS discount_amt FROM fact_order
      WHERE sub_total < 0 OR price < 0 OR discount_amt < 0
      UNION ALL SELECT 'fact_order_items', order_item_id, CAST(sub_total AS DOUBLE), CAST(price AS DOUBLE),
      CAST(discount_amt AS DOUBLE) FROM fact_items WHERE sub_total < 0 OR price < 0 OR discount_amt < 0""",
    "dq_order_total_reconcile": _RECONCILED,
    "dq_temporal_range": """SELECT order_id, order_date FROM silver_orders
      WHERE order_date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    "dq_domain": f"""SELECT address AS value, count(*) AS rows FROM silver_customers
      WHERE address NOT IN {_in([p for v in schemas.REGION_PROVINCES.values() for p in v])} GROUP BY address""",
    "dq_session_coherence": _COHERENCE,
    "dq_landing_counts": """SELECT ingest_date, count(DISTINCT session_id) AS landed_rows, count(*) AS expected_rows,
      count(DISTINCT session_id) >= count(*) AS complete FROM stg_clickstream GROUP BY ingest_date""",
    "dq_report": _checks({
        "order_item_id unique": _dup("order_item_id", "stg_order_items"),
        "clean order_item_id unique": _dup("order_item_id", "silver_order_items"),
        "one feature row per user and day": _dup("user_id, prediction_date", "behaviour"),
        "tier known": f"SELECT DISTINCT tire FROM stg_customers WHERE tire NOT IN {_in(schemas.TIERS)}",
        "clean tier known": f"SELECT DISTINCT tire FROM silver_customers WHERE tire NOT IN {_in(schemas.TIERS)}",
        "device known": f"""SELECT DISTINCT device_type FROM stg_clickstream
          WHERE device_type NOT IN {_in(schemas.DEVICE_TYPES)}""",
        "segment known": f"""SELECT DISTINCT user_segment FROM stg_clickstream
          WHERE user_segment NOT IN {_in(schemas.USER_SEGMENTS)}""",
        "order total matches lines": _RECONCILED,
        "sessions coherent": _COHERENCE,
    }),
    "mask_email": "SELECT customer_id, sha256(email) AS email FROM silver_customers",
    "mask_phone": f"SELECT customer_id, {_LAST4.format('phone_number')} AS phone_number FROM stg_customers",
    "mask_generic": f"""SELECT customer_id, first_name, last_name, {_REDACT.format('email')} AS email,
      CAST(NULL AS VARCHAR) AS phone_number, tire, {_REDACT.format('address')} AS address FROM silver_customers""",
    "mask_persona_view": f"""SELECT customer_id, first_name, last_name, sha256(email) AS email,
      {_LAST4.format('phone_number')} AS phone_number, tire, address, 'analyst' AS persona FROM silver_customers
      UNION ALL SELECT {_CONTACT}, 'admin' FROM silver_customers""",
    "ingest_clickstream_stream": """SELECT ingest_date, count(*) AS records, CAST(sum(n_actions) AS BIGINT) AS actions
      FROM stg_clickstream GROUP BY ingest_date""",
    "stream_dedup_sessions": _SESSION_COLUMNS,
}
BODIES["table_fact_order"] = BODIES["fact_order"]
BODIES["table_fact_order_items"] = BODIES["fact_order_items"]
BODIES["stream_daily_activity"] = BODIES["feat_daily_activity"]


def _needed(sql: str, found: dict[str, str], within: tuple[str, ...] = ()) -> None:
    for name in CTES:
        if name not in found and name not in within and re.search(rf"\b{name}\b", sql):
            _needed(CTES[name], found, (*within, name))
            found[name] = CTES[name]


def sql_for(name: str) -> str:
    """One statement: the query body preceded by the common tables it needs."""
    found: dict[str, str] = {}
    body = BODIES[name]
    _needed(body, found)
    ctes = ",\n".join(
        f"{n} {_RECURSIVE[n]} AS ({q})" if n in _RECURSIVE
        else f"{n} AS {'MATERIALIZED ' if n.startswith('ml_') else ''}({q})" for n, q in found.items()
    )
    again = "RECURSIVE " if _RECURSIVE.keys() & found.keys() else ""
    return f"WITH {again}{ctes}\nSELECT * FROM ({body})" if ctes else body


def oracle() -> dict[str, str]:
    return {name: sql_for(name) for name in BODIES}
