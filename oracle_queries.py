"""DuckDB SQL giving the expected rows of every registered query.

Each query is a SELECT over named building blocks; the blocks it needs, directly
or through others, are put in front of it as a WITH list. Amounts are handled in
whole cents and spans in whole microseconds, and every rounded quotient is taken
on whole numbers, so no result depends on floating-point order.
"""

from __future__ import annotations

import re

from bazaarlens.schemas import RAW_COLUMNS

DAY = 86400000000  # microseconds


def ratio(top: str, bottom: str, digits: int) -> str:
    """top / bottom (whole numbers, bottom > 0), half away from zero, as a double."""
    t, b, p = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)", 10**digits
    units = f"((2 * abs({t}) * {p} + {b}) // (2 * {b}))"
    signed = f"(CASE WHEN {t} < 0 THEN -{units} ELSE {units} END)"
    return f"(CASE WHEN {b} > 0 THEN CAST({signed} AS DOUBLE) / {p} END)"


def pct(part: str, whole: str) -> str:
    return ratio(f"100 * {part}", whole, 1)


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS BIGINT)"


def mean_cents(amount: str, digits: int = 2) -> str:
    return ratio(f"sum({cents(amount)})", f"100 * count({amount})", digits)


def mean_days(micros: str) -> str:
    return ratio(f"sum({micros})", f"{DAY} * count({micros})", 1)


def title(text: str) -> str:
    parts = rf"regexp_extract_all(lower({text}), '[\pL\pN]+|[^\pL\pN]+')"
    return f"array_to_string(list_transform({parts}, lambda w: upper(w[1]) || w[2:]), '')"


def days(start: str, end: str) -> str:
    micros = f"(epoch_us({end}) - epoch_us({start}))"
    return f"CAST({micros} AS DOUBLE) / CAST({DAY} AS DOUBLE)"


def _state(code: str) -> str:
    return (
        f"CASE {code} WHEN 0 THEN ' sp' WHEN 1 THEN 'RJ ' WHEN 2 THEN 'mg' "
        f"ELSE concat('n', {code}) END"
    )


_CITY = "concat(' ', lower(replace(n_name, '_', '-')), ' ')"

BLOCKS: dict[str, str] = {
    # The nine raw tables, all text.
    "r_customers": f"""
        SELECT concat('c', o_orderkey) AS customer_id, concat('u', o_custkey) AS customer_unique_id,
               CAST(10000 + o_custkey % 500 AS VARCHAR) AS customer_zip_code_prefix,
               {_CITY} AS customer_city, {_state("c_nationkey")} AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "r_bought": """
        SELECT *, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS bought FROM orders""",
    "r_orders": """
        SELECT concat('o', o_orderkey) AS order_id, concat('c', o_orderkey) AS customer_id,
               CASE o_orderstatus WHEN 'O' THEN 'shipped' ELSE 'delivered' END AS order_status,
               CAST(bought AS VARCHAR) AS order_purchase_timestamp,
               CAST(bought + to_seconds(3600) AS VARCHAR) AS order_approved_at,
               CAST(bought + to_seconds(86400) AS VARCHAR) AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 97 <> 0 THEN CAST(bought
                    + to_seconds((1 + (o_orderkey * 31) % 20) * 86400 + o_orderkey % 3600)
                    AS VARCHAR) END AS order_delivered_customer_date,
               CAST(o_orderdate + to_seconds(14 * 86400) AS VARCHAR) AS order_estimated_delivery_date
        FROM r_bought""",
    "r_priced": """
        SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(10,2))
                  * (CASE WHEN l_suppkey % 10 = 0 THEN 10 ELSE 1 END) AS DECIMAL(10,2)) AS unit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "r_order_items": """
        SELECT concat('o', l_orderkey) AS order_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                    l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax,
                    l_returnflag, l_linestatus) AS VARCHAR) AS order_item_id,
               concat('p', l_partkey) AS product_id, concat('s', CASE WHEN l_suppkey = 0 THEN 1
                    WHEN (l_suppkey + year(o_orderdate) * 12 + month(o_orderdate)) % 5 <> 0
                    THEN l_suppkey WHEN l_suppkey = 1 THEN 2 ELSE l_suppkey - 1 END) AS seller_id,
               CAST(o_orderdate + to_seconds(432000) AS VARCHAR) AS shipping_limit_date,
               CAST(unit AS VARCHAR) AS price,
               CAST(CAST(unit * CAST(l_tax AS DECIMAL(4,2)) * (CASE WHEN p_type IN ('LARGE', 'SMALL')
                    THEN 16 ELSE 8 END) AS DECIMAL(10,2)) AS VARCHAR) AS freight_value
        FROM r_priced""",
    "r_order_payments": """
        SELECT concat('o', o_orderkey) AS order_id, '1' AS payment_sequential,
               CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
                    WHEN 2 THEN 'voucher' ELSE 'debit_card' END AS payment_type,
               CAST(1 + o_orderkey % 10 AS VARCHAR) AS payment_installments,
               CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS payment_value
        FROM orders
        UNION ALL
        SELECT concat('o', o_orderkey), '2', 'voucher', '1', '10.00'
        FROM orders WHERE o_orderkey % 10 = 0""",
    "r_order_reviews": """
        SELECT concat('r', o_orderkey) AS review_id, concat('o', o_orderkey) AS order_id,
               CAST(CASE WHEN (o_orderkey * 31) % 20 >= 13 THEN 1 + o_orderkey % 4
                    ELSE 3 + o_orderkey % 3 END AS VARCHAR) AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title,
               CAST(NULL AS VARCHAR) AS review_comment_message,
               CAST(o_orderdate + to_seconds(20 * 86400) AS VARCHAR) AS review_creation_date,
               CAST(o_orderdate + to_seconds(21 * 86400) AS VARCHAR) AS review_answer_timestamp
        FROM orders WHERE o_orderkey % 17 <> 0
        UNION ALL
        SELECT concat('q', o_orderkey), concat('o', o_orderkey), '1', NULL, NULL,
               CAST(o_orderdate + to_seconds(25 * 86400) AS VARCHAR),
               CAST(o_orderdate + to_seconds(26 * 86400) AS VARCHAR)
        FROM orders WHERE o_orderkey % 13 = 0""",
    "r_products": """
        SELECT concat('p', p_partkey) AS product_id,
               CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 49 = 0 THEN 'sem_traducao'
                    WHEN p_type = 'ECONOMY' THEN 'cama_mesa_banho'
                    WHEN p_type = 'LARGE' THEN 'beleza_saude'
                    WHEN p_type = 'PROMO' THEN 'esporte_lazer'
                    ELSE lower(p_type) END AS product_category_name,
               CAST(length(p_name) AS VARCHAR) AS product_name_length,
               CAST(p_size * 10 AS VARCHAR) AS product_description_length,
               CAST(1 + p_size % 5 AS VARCHAR) AS product_photos_qty,
               CASE WHEN p_partkey % 20 = 0 THEN '' ELSE CAST(p_size * 100 AS VARCHAR) END
                    AS product_weight_g,
               CAST(p_size AS VARCHAR) AS product_length_cm,
               CAST(p_size AS VARCHAR) AS product_height_cm,
               CAST(p_size AS VARCHAR) AS product_width_cm
        FROM part""",
    "r_sellers": f"""
        SELECT concat('s', s_suppkey) AS seller_id,
               CAST(10000 + s_suppkey % 500 AS VARCHAR) AS seller_zip_code_prefix,
               {_CITY} AS seller_city, {_state("s_nationkey")} AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "r_geolocation": f"""
        SELECT CAST(10000 + c_custkey % 500 AS VARCHAR) AS geolocation_zip_code_prefix,
               CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.001 AS DECIMAL(14,5)) AS VARCHAR)
                    AS geolocation_lat,
               CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * -0.002 AS DECIMAL(14,5)) AS VARCHAR)
                    AS geolocation_lng,
               {_CITY} AS geolocation_city, {_state("c_nationkey")} AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "r_category_translation": """
        SELECT t.* FROM (VALUES ('cama_mesa_banho', 'bed_bath_table'),
            ('beleza_saude', 'health_beauty'), ('esporte_lazer', 'sports_leisure'),
            ('medium', 'medium_goods'), ('small', 'small_goods'), ('standard', 'standard_goods'))
            AS t(product_category_name, product_category_name_english)
        WHERE t.product_category_name IN (SELECT product_category_name FROM r_products)""",
    # Staging.
    "s_customers": f"""
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
               {title("trim(customer_city)")} AS customer_city,
               upper(trim(customer_state)) AS customer_state
        FROM r_customers""",
    "s_orders": """
        SELECT order_id, customer_id, order_status,
               CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
               CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
               CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
               CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
               CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
        FROM r_orders""",
    "s_order_items": """
        SELECT order_id, CAST(order_item_id AS INTEGER) AS order_item_id, product_id, seller_id,
               CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
               CAST(price AS DECIMAL(10,2)) AS price,
               CAST(freight_value AS DECIMAL(10,2)) AS freight_value
        FROM r_order_items""",
    "s_order_payments": """
        SELECT order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
               CAST(payment_installments AS INTEGER) AS payment_installments,
               CAST(payment_value AS DECIMAL(10,2)) AS payment_value
        FROM r_order_payments""",
    "s_order_reviews": """
        SELECT review_id, order_id, CAST(review_score AS INTEGER) AS review_score,
               review_comment_title, review_comment_message,
               CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
               CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
        FROM r_order_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY CAST(review_creation_date AS TIMESTAMP) DESC NULLS FIRST, review_id) = 1""",
    "s_products": """
        SELECT product_id,
               coalesce(product_category_name_english, p.product_category_name, 'unknown')
                    AS product_category,
               CAST(nullif(product_name_length, '') AS INTEGER) AS product_name_length,
               CAST(nullif(product_description_length, '') AS INTEGER) AS product_description_length,
               CAST(nullif(product_photos_qty, '') AS INTEGER) AS product_photos_qty,
               CAST(nullif(product_weight_g, '') AS DECIMAL(18,4)) AS product_weight_g,
               CAST(nullif(product_length_cm, '') AS DECIMAL(18,4)) AS product_length_cm,
               CAST(nullif(product_height_cm, '') AS DECIMAL(18,4)) AS product_height_cm,
               CAST(nullif(product_width_cm, '') AS DECIMAL(18,4)) AS product_width_cm
        FROM r_products p LEFT JOIN r_category_translation c
          ON c.product_category_name = p.product_category_name""",
    "s_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, {title("trim(seller_city)")} AS seller_city,
               upper(trim(seller_state)) AS seller_state
        FROM r_sellers""",
    "g_points": f"""
        SELECT geolocation_zip_code_prefix AS zip_code_prefix,
               CAST(CAST(geolocation_lat AS DECIMAL(14,5)) * 100000 AS BIGINT) AS lat,
               CAST(CAST(geolocation_lng AS DECIMAL(14,5)) * 100000 AS BIGINT) AS lng,
               {title("trim(geolocation_city)")} AS city,
               upper(trim(geolocation_state)) AS state
        FROM r_geolocation""",
    "g_city": """
        SELECT zip_code_prefix, city FROM g_points GROUP BY zip_code_prefix, city
        QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY count(*) DESC, city) = 1""",
    "g_state": """
        SELECT zip_code_prefix, state FROM g_points GROUP BY zip_code_prefix, state
        QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY count(*) DESC, state) = 1""",
    "s_geolocation": f"""
        SELECT zip_code_prefix, latitude, longitude, city, state
        FROM (SELECT zip_code_prefix, {ratio("sum(lat)", "100000 * count(lat)", 6)} AS latitude,
                     {ratio("sum(lng)", "100000 * count(lng)", 6)} AS longitude
              FROM g_points GROUP BY zip_code_prefix)
        JOIN g_city USING (zip_code_prefix) JOIN g_state USING (zip_code_prefix)""",
    # Intermediate.
    "i_items": """
        SELECT order_id, count(*) AS total_items, count(DISTINCT product_id) AS total_products,
               CAST(sum(price) AS DECIMAL(20,2)) AS total_price,
               CAST(sum(freight_value) AS DECIMAL(20,2)) AS total_freight
        FROM s_order_items GROUP BY order_id""",
    "i_payments": """
        SELECT order_id, CAST(sum(payment_value) AS DECIMAL(20,2)) AS total_payment_value,
               string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_methods,
               max(payment_installments) AS max_installments
        FROM s_order_payments GROUP BY order_id""",
    "i_orders": f"""
        SELECT o.order_id, o.customer_id, customer_unique_id, customer_city, customer_state,
               order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date,
               order_estimated_delivery_date,
               CAST(order_purchase_timestamp AS DATE) AS order_date,
               CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
               rpad(strftime(order_purchase_timestamp, '%A'), 9, ' ') AS order_day_of_week,
               total_items, total_products, total_price, total_freight,
               total_price + total_freight AS total_order_value,
               total_payment_value, payment_methods, max_installments, review_score,
               {days("order_purchase_timestamp", "order_delivered_customer_date")} AS delivery_days,
               {days("order_delivered_customer_date", "order_estimated_delivery_date")}
                    AS delivery_vs_estimate_days,
               CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'on_time'
                    WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 'late'
                    ELSE 'not_delivered' END AS delivery_status,
               epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp) AS micros
        FROM s_orders o
        LEFT JOIN s_customers c ON c.customer_id = o.customer_id
        LEFT JOIN i_items i ON i.order_id = o.order_id
        LEFT JOIN i_payments p ON p.order_id = o.order_id
        LEFT JOIN s_order_reviews v ON v.order_id = o.order_id""",
    "i_lines": """
        SELECT l.*, o.order_id AS known_order, o.order_status, o.review_score,
               o.order_purchase_timestamp, o.micros
        FROM s_order_items l LEFT JOIN i_orders o ON o.order_id = l.order_id""",
    "i_sellers": f"""
        SELECT s.seller_id, s.seller_city, s.seller_state,
               count(DISTINCT l.order_id) AS total_orders, count(*) AS total_items_sold,
               count(DISTINCT l.product_id) AS unique_products_sold,
               CAST(sum(l.price) AS DECIMAL(20,2)) AS total_revenue,
               {mean_cents("l.price", 6)} AS avg_item_price,
               CAST(sum(l.freight_value) AS DOUBLE) AS total_freight_collected,
               {ratio("sum(l.review_score)", "count(l.review_score)", 2)} AS avg_review_score,
               {mean_days("l.micros")} AS avg_delivery_days,
               min(l.order_purchase_timestamp) AS first_order_date,
               max(l.order_purchase_timestamp) AS last_order_date,
               {days("min(l.order_purchase_timestamp)", "max(l.order_purchase_timestamp)")}
                    AS active_days
        FROM s_sellers s LEFT JOIN i_lines l ON l.seller_id = s.seller_id
        GROUP BY s.seller_id, s.seller_city, s.seller_state""",
    "i_people_rows": """
        SELECT o.*, p.payment_type AS paid_with
        FROM s_customers c JOIN i_orders o ON o.customer_id = c.customer_id
        LEFT JOIN s_order_payments p ON p.order_id = o.order_id""",
    "i_people_method": """
        SELECT customer_unique_id, paid_with FROM i_people_rows WHERE paid_with IS NOT NULL
        GROUP BY customer_unique_id, paid_with QUALIFY row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY count(*) DESC, paid_with) = 1""",
    "i_people_state": """
        SELECT customer_unique_id, customer_state FROM i_people_rows
        WHERE customer_state IS NOT NULL
        GROUP BY customer_unique_id, customer_state QUALIFY row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY count(*) DESC, customer_state) = 1""",
    "i_people": f"""
        SELECT g.*, m.paid_with AS preferred_payment_method, s.customer_state AS primary_state
        FROM (SELECT customer_unique_id, count(DISTINCT order_id) AS lifetime_orders,
                     CAST(sum(total_order_value) AS DECIMAL(24,2)) AS lifetime_value,
                     {mean_cents("total_order_value", 6)} AS avg_order_value,
                     {mean_cents("total_order_value", 2)} AS avg_order_value_2,
                     {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score,
                     min(order_purchase_timestamp) AS first_order_date,
                     max(order_purchase_timestamp) AS last_order_date,
                     count(DISTINCT order_id) > 1 AS is_repeat_customer
              FROM i_people_rows GROUP BY customer_unique_id) g
        LEFT JOIN i_people_method m USING (customer_unique_id)
        LEFT JOIN i_people_state s USING (customer_unique_id)""",
    "h_months": """
        SELECT month_start, row_number() OVER (ORDER BY month_start NULLS LAST) AS month_number
        FROM (SELECT DISTINCT CAST(date_trunc('month', order_purchase_timestamp) AS DATE)
                     AS month_start FROM s_orders)""",
    "h_sold": """
        SELECT seller_id, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS sold_month,
               count(*) AS sold
        FROM i_lines WHERE known_order IS NOT NULL GROUP BY ALL""",
    "h_activity": """
        SELECT s.seller_id, m.month_number, m.month_start, coalesce(h.sold, 0) AS sold,
               CASE WHEN h.sold > 0 THEN 'active' ELSE 'inactive' END AS status
        FROM s_sellers s CROSS JOIN h_months m
        LEFT JOIN h_sold h ON h.seller_id = s.seller_id AND h.sold_month = m.month_start""",
    "h_changes": """
        SELECT * FROM h_activity
        QUALIFY coalesce(status <> lag(status) OVER (PARTITION BY seller_id ORDER BY month_number),
                         true)""",
    # Marts.
    "m_months": f"""
        SELECT order_year, order_month,
               CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month_start,
               count(*) AS total_orders, count(DISTINCT customer_unique_id) AS unique_customers,
               CAST(sum({cents("total_order_value")}) AS BIGINT) AS gmv_cents,
               {mean_cents("total_order_value")} AS avg_order_value,
               CAST(sum(total_freight) AS DOUBLE) AS total_freight_revenue,
               {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score,
               {mean_days("micros")} AS avg_delivery_days,
               {pct("count(*) FILTER (WHERE delivery_status = 'late')", "count(*)")}
                    AS late_delivery_pct
        FROM i_orders WHERE order_status = 'delivered' GROUP BY ALL""",
    "m_states": f"""
        SELECT customer_state, count(*) AS total_orders,
               count(DISTINCT customer_unique_id) AS unique_customers,
               CAST(sum({cents("total_order_value")}) AS BIGINT) AS revenue_cents,
               {mean_cents("total_order_value")} AS avg_order_value,
               {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score,
               {mean_days("micros")} AS avg_delivery_days,
               {pct("count(*) FILTER (WHERE delivery_status = 'late')", "count(*)")}
                    AS late_delivery_pct,
               {pct("count(*) FILTER (WHERE review_score <= 2)", "count(*)")} AS low_review_pct
        FROM i_orders WHERE order_status = 'delivered' GROUP BY customer_state""",
    "m_categories": f"""
        SELECT product_category, count(DISTINCT order_id) AS total_orders,
               CAST(sum(price) AS DOUBLE) AS total_revenue, {mean_cents("price")} AS avg_price,
               count(DISTINCT seller_id) AS seller_count,
               count(DISTINCT product_id) AS product_count,
               {ratio("sum(review_score)", "count(review_score)", 2)} AS avg_review_score,
               {mean_days("micros")} AS avg_delivery_days
        FROM i_lines JOIN s_products USING (product_id)
        WHERE order_status = 'delivered'
        GROUP BY product_category HAVING count(DISTINCT order_id) >= 10""",
    "m_sellers": f"""
        SELECT seller_id, seller_city, seller_state, total_orders, total_revenue,
               avg_review_score, avg_delivery_days,
               {ratio("by_revenue - 1", "greatest(others, 1)", 3)} AS revenue_percentile,
               {ratio("by_review - 1", "greatest(others, 1)", 3)} AS review_percentile,
               {ratio("by_days - 1", "greatest(others, 1)", 3)} AS delivery_speed_percentile,
               CASE WHEN total_orders >= 50 AND avg_review_score >= 4 THEN 'gold'
                    WHEN total_orders >= 20 AND avg_review_score >= 3.5 THEN 'silver'
                    WHEN total_orders >= 5 THEN 'bronze' ELSE 'new' END AS seller_tier
        FROM (SELECT *, count(*) OVER () - 1 AS others,
                     rank() OVER (ORDER BY total_revenue NULLS LAST) AS by_revenue,
                     rank() OVER (ORDER BY avg_review_score NULLS LAST) AS by_review,
                     rank() OVER (ORDER BY avg_delivery_days DESC NULLS FIRST) AS by_days
              FROM i_sellers WHERE total_orders > 0)""",
    "m_ranked_people": f"""
        SELECT *, {ratio("idle", str(DAY), 0)} AS recency_days,
               ntile(5) OVER (ORDER BY idle DESC NULLS FIRST, customer_unique_id)
                    AS recency_quintile,
               ntile(5) OVER (ORDER BY lifetime_orders NULLS LAST, customer_unique_id)
                    AS frequency_quintile,
               ntile(5) OVER (ORDER BY lifetime_value NULLS LAST, customer_unique_id)
                    AS monetary_quintile
        FROM (SELECT *, (SELECT epoch_us(max(order_purchase_timestamp)) FROM s_orders)
                     - epoch_us(last_order_date) AS idle
              FROM i_people WHERE lifetime_orders > 0)""",
    # Shared parts of reports.
    "a_visits": """
        SELECT customer_unique_id, month,
               min(month) OVER (PARTITION BY customer_unique_id) AS first_month
        FROM (SELECT DISTINCT customer_unique_id,
                     CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month
              FROM i_orders WHERE customer_unique_id IS NOT NULL)""",
    "a_daily": f"""
        SELECT order_date, count(*) AS orders,
               CAST(sum({cents("total_order_value")}) AS BIGINT) AS revenue_cents
        FROM i_orders WHERE order_status = 'delivered' GROUP BY order_date""",
    "a_sales": """
        SELECT l.order_id, l.price, o.customer_state, p.product_category
        FROM s_order_items l JOIN s_products p ON p.product_id = l.product_id
        JOIN i_orders o ON o.order_id = l.order_id""",
    "a_links": """
        SELECT DISTINCT l.seller_id, o.customer_unique_id
        FROM s_order_items l JOIN i_orders o ON o.order_id = l.order_id""",
    "a_ratios": """
        SELECT *, CASE WHEN price <> 0 THEN
               (2 * CAST(freight_value * 100 AS HUGEINT) * 10000000000000
                    + CAST(price * 100 AS HUGEINT)) // (2 * CAST(price * 100 AS HUGEINT)) END AS share
        FROM s_order_items""",
}

_MONEY = {
    "s_order_items": ("price", "freight_value"),
    "s_order_payments": ("payment_value",),
    "s_products": (
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "i_items": ("total_price", "total_freight"),
    "i_payments": ("total_payment_value",),
    "i_orders": ("total_price", "total_freight", "total_order_value", "total_payment_value"),
    "i_sellers": ("total_revenue",),
    "i_people": ("lifetime_value",),
    "m_sellers": ("total_revenue",),
}


def _all_of(block: str, *left_out: str) -> str:
    exclude = f" EXCLUDE ({', '.join(left_out)})" if left_out else ""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY.get(block, ()))
    return f"SELECT *{exclude}{f' REPLACE ({casts})' if casts else ''} FROM {block}"


def _key_check(table: str, block: str, *key: str) -> str:
    columns = ", ".join(key)
    missing = " OR ".join(f"{c} IS NULL" for c in key)
    return f"""
        SELECT '{table}' AS table_name, '{columns}' AS key_columns,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows,
               CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS null_key_rows,
               CAST(coalesce(sum(n - 1) FILTER (WHERE NOT ({missing})), 0) AS BIGINT)
                    AS duplicate_rows
        FROM (SELECT {columns}, count(*) AS n FROM {block} GROUP BY {columns})"""


_HISTORY = """
    SELECT seller_id, status AS seller_status, month_start AS valid_from,
           CAST(coalesce(lead(month_start) OVER w - INTERVAL 1 DAY, DATE '9999-12-31') AS DATE)
                AS valid_to,
           lead(month_start) OVER w IS NULL AS is_current, sold AS orders_at_change,
           row_number() OVER (ORDER BY seller_id, month_start NULLS LAST) AS scd_id
    FROM h_changes WINDOW w AS (PARTITION BY seller_id ORDER BY month_number)"""

_MONTHS = """
    SELECT * EXCLUDE (gmv_cents), CAST(gmv_cents AS DOUBLE) / 100 AS gmv FROM m_months"""

_STATES = """
    SELECT * EXCLUDE (revenue_cents), CAST(revenue_cents AS DOUBLE) / 100 AS total_revenue
    FROM m_states"""


# The rows of the product profile: one per product it is derived for.
_PRODUCT_ROWS = """(SELECT p.product_id FROM s_products p
    LEFT JOIN i_lines l ON l.product_id = p.product_id
    GROUP BY p.product_id, p.product_category, p.product_weight_g)"""


def _column_digests() -> str:
    """Rows, values and a digest of the values of every raw column."""
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count,
                   count({column}) AS filled,
                   CAST(coalesce(sum(CAST('0x' || substr(md5({column}), 1, 8) AS BIGINT)), 0)
                        AS BIGINT) AS digest FROM r_{table}"""
        for table, columns in RAW_COLUMNS.items()
        for column in columns
    )


def _queries(
    range_dates: tuple[str, str], since: str, half_year: tuple[str, str]
) -> dict[str, str]:
    raw = [name for name in BLOCKS if name.startswith("r_") and name not in ("r_bought", "r_priced")]
    return {
        "raw_csv_scan": _column_digests(),
        "raw_row_counts": " UNION ALL ".join(
            f"SELECT '{name[2:]}' AS table_name, count(*) AS row_count FROM {name}" for name in raw
        ),
        "stg_customers": _all_of("s_customers"),
        "stg_orders": _all_of("s_orders"),
        "stg_order_items": _all_of("s_order_items"),
        "stg_order_payments": _all_of("s_order_payments"),
        "stg_order_reviews": _all_of("s_order_reviews"),
        "stg_products": _all_of("s_products"),
        "stg_sellers": _all_of("s_sellers"),
        "stg_geolocation": _all_of("s_geolocation"),
        "int_orders_enriched": _all_of("i_orders", "micros"),
        "int_seller_performance": _all_of("i_sellers"),
        "int_product_performance": f"""
            SELECT p.product_id, p.product_category,
                   CAST(p.product_weight_g AS DOUBLE) AS product_weight_g,
                   count(DISTINCT l.order_id) AS times_ordered,
                   CAST(sum(l.price) AS DOUBLE) AS total_revenue,
                   {mean_cents("l.price", 6)} AS avg_selling_price,
                   CAST(sum(l.freight_value) AS DOUBLE) AS total_freight,
                   {ratio("sum(l.review_score)", "count(l.review_score)", 2)} AS avg_review_score,
                   min(l.order_purchase_timestamp) AS first_sold_date,
                   max(l.order_purchase_timestamp) AS last_sold_date
            FROM s_products p LEFT JOIN i_lines l ON l.product_id = p.product_id
            GROUP BY p.product_id, p.product_category, p.product_weight_g""",
        "int_customer_history": _all_of("i_people", "avg_order_value_2"),
        "int_seller_status_history": _HISTORY,
        "mart_monthly_revenue": _MONTHS,
        "mart_state_performance": _STATES,
        "mart_product_category_analysis": _all_of("m_categories"),
        "mart_seller_scorecard": _all_of("m_sellers"),
        "mart_customer_segments": """
            SELECT customer_unique_id, lifetime_orders,
                   CAST(lifetime_value AS DOUBLE) AS lifetime_value,
                   avg_order_value_2 AS avg_order_value, avg_review_score, first_order_date,
                   last_order_date, recency_days, is_repeat_customer, preferred_payment_method,
                   primary_state, CAST(recency_quintile AS INTEGER) AS recency_quintile,
                   CAST(frequency_quintile AS INTEGER) AS frequency_quintile,
                   CAST(monetary_quintile AS INTEGER) AS monetary_quintile,
                   -- Fixed values: the segment rule, first matching case.
                   CASE WHEN recency_quintile >= 4 AND frequency_quintile >= 4
                             AND monetary_quintile >= 4 THEN 'champions'
                        WHEN recency_quintile >= 4 AND frequency_quintile >= 3 THEN 'loyal'
                        WHEN recency_quintile >= 4 AND monetary_quintile >= 4 THEN 'big_spenders'
                        WHEN recency_quintile >= 4 THEN 'recent'
                        WHEN frequency_quintile >= 4 THEN 'frequent'
                        WHEN recency_quintile <= 2 AND frequency_quintile <= 2 THEN 'at_risk'
                        ELSE 'regular' END AS customer_segment
            FROM m_ranked_people""",
        "int_order_item_rollup": _all_of("i_items"),
        "int_order_payment_rollup": _all_of("i_payments"),
        "int_order_months": """
            SELECT month_start, CAST(month_number AS INTEGER) AS month_number,
                   CAST(count(*) OVER () - month_number + 1 AS INTEGER) AS months_left
            FROM h_months""",
        "int_seller_change_points": """
            SELECT seller_id, CAST(month_number AS INTEGER) AS month_number,
                   month_start AS valid_from, status AS seller_status, sold AS orders_in_month
            FROM h_changes""",
        "q01_mom_growth": f"""
            SELECT month_start, CAST(gmv_cents AS DOUBLE) / 100 AS gmv, total_orders,
                   CAST(before AS DOUBLE) / 100 AS prev_month_gmv,
                   {ratio("100 * (gmv_cents - before)", "before", 1)} AS mom_growth_pct
            FROM (SELECT *, lag(gmv_cents) OVER (ORDER BY month_start NULLS LAST) AS before
                  FROM m_months)""",
        "q02_cumulative_gmv": """
            SELECT month_start, CAST(gmv_cents AS DOUBLE) / 100 AS gmv,
                   CAST(CAST(sum(gmv_cents) OVER w AS BIGINT) AS DOUBLE) / 100 AS cumulative_gmv,
                   CAST(sum(total_orders) OVER w AS BIGINT) AS cumulative_orders
            FROM m_months WINDOW w AS (ORDER BY month_start NULLS LAST)""",
        "q03_top_categories": """
            SELECT CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS INTEGER)
                        AS revenue_rank, product_category, total_revenue, total_orders, avg_price,
                   avg_review_score
            FROM m_categories ORDER BY revenue_rank, product_category LIMIT 10""",
        "q04_state_pareto": f"""
            SELECT customer_state, CAST(revenue_cents AS DOUBLE) / 100 AS total_revenue,
                   {pct("revenue_cents", "whole")} AS pct_of_total,
                   {pct("so_far", "whole")} AS cumulative_pct
            FROM (SELECT *, sum(revenue_cents) OVER () AS whole,
                         sum(revenue_cents) OVER (ORDER BY revenue_cents DESC NULLS FIRST) AS so_far
                  FROM m_states)""",
        "q05_top_sellers_per_state": """
            SELECT seller_state, seller_id, seller_city,
                   CAST(total_revenue AS DOUBLE) AS total_revenue, total_orders, avg_review_score,
                   CAST(row_number() OVER (PARTITION BY seller_state
                        ORDER BY total_revenue DESC NULLS FIRST, seller_id) AS INTEGER)
                        AS rank_in_state
            FROM m_sellers QUALIFY rank_in_state <= 3""",
        "q06_repeat_order_gap": f"""
            SELECT *, {days("previous_order_date", "order_purchase_timestamp")}
                        AS days_since_last_order
            FROM (SELECT customer_unique_id, order_id, order_purchase_timestamp,
                         lag(order_purchase_timestamp) OVER w AS previous_order_date,
                         lead(order_purchase_timestamp) OVER w AS next_order_date
                  FROM i_orders WHERE customer_unique_id IN
                       (SELECT customer_unique_id FROM i_people WHERE is_repeat_customer)
                  WINDOW w AS (PARTITION BY customer_unique_id
                               ORDER BY order_purchase_timestamp NULLS LAST, order_id))
            ORDER BY customer_unique_id, order_purchase_timestamp NULLS LAST, order_id LIMIT 30""",
        "q07_payment_trends": "SELECT quarter, count(*) AS total_payments, "
        + ", ".join(
            pct(f"count(*) FILTER (WHERE payment_type = '{kind}')", "count(*)") + f" AS {kind}_pct"
            for kind in ("credit_card", "boleto", "voucher", "debit_card")
        )
        + """
            FROM (SELECT payment_type,
                         CAST(date_trunc('quarter', order_purchase_timestamp) AS DATE) AS quarter
                  FROM s_order_payments JOIN s_orders USING (order_id))
            GROUP BY quarter""",
        "q08_delivery_by_dow": f"""
            SELECT dayname(order_purchase_timestamp) AS day_of_week,
                   CAST(dayofweek(order_purchase_timestamp) AS INTEGER) AS dow_num,
                   count(*) AS total_orders, {mean_days("micros")} AS avg_delivery_days,
                   {pct("count(*) FILTER (WHERE delivery_status = 'late')", "count(*)")} AS late_pct
            FROM i_orders WHERE order_status = 'delivered' GROUP BY 1, 2""",
        "q09_cohort_retention": "SELECT first_month AS cohort_month, "
        + ", ".join(
            "count(DISTINCT customer_unique_id) FILTER (WHERE "
            f"datediff('month', first_month, month) = {n}) AS month_{n}"
            for n in (0, 1, 2, 3, 6, 12)
        )
        + " FROM a_visits GROUP BY first_month",
        "q10_rollup_state_category": """
            SELECT coalesce(customer_state, '** ALL STATES **') AS state,
                   coalesce(product_category, '** ALL CATEGORIES **') AS category,
                   count(DISTINCT order_id) AS orders, CAST(sum(price) AS DOUBLE) AS revenue,
                   CAST(grouping(customer_state) AS INTEGER) AS is_state_total,
                   CAST(grouping(product_category) AS INTEGER) AS is_category_total
            FROM a_sales WHERE customer_state IN ('SP', 'RJ', 'MG')
              AND product_category IN ('bed_bath_table', 'health_beauty', 'sports_leisure')
            GROUP BY ROLLUP (customer_state, product_category)""",
        "q11_cube_state_category": """
            SELECT coalesce(customer_state, '** ALL **') AS state,
                   coalesce(product_category, '** ALL **') AS category,
                   count(DISTINCT order_id) AS orders, CAST(sum(price) AS DOUBLE) AS revenue
            FROM a_sales WHERE customer_state IN ('SP', 'RJ')
              AND product_category IN ('bed_bath_table', 'health_beauty')
            GROUP BY CUBE (customer_state, product_category)""",
        "q12_sellers_above_state_avg": f"""
            SELECT seller_id, seller_state, seller_city, total_orders,
                   CAST(own AS DOUBLE) / 100 AS seller_revenue,
                   {ratio("whole", "100 * sellers", 2)} AS state_avg_revenue,
                   {ratio("own * sellers", "whole", 1)} AS times_above_avg
            FROM (SELECT *, {cents("total_revenue")} AS own,
                         sum({cents("total_revenue")}) OVER (PARTITION BY seller_state) AS whole,
                         count(total_revenue) OVER (PARTITION BY seller_state) AS sellers
                  FROM m_sellers WHERE seller_state IS NOT NULL)
            WHERE own * sellers > 2 * whole
            ORDER BY times_above_avg DESC NULLS FIRST, seller_id LIMIT 15""",
        "q13_moving_avg_7": f"""
            SELECT order_date, orders, CAST(revenue_cents AS DOUBLE) / 100 AS daily_revenue,
                   {ratio("sum(orders) OVER w", "count(orders) OVER w", 1)} AS orders_7day_avg,
                   {ratio("sum(revenue_cents) OVER w", "100 * count(revenue_cents) OVER w", 2)}
                        AS revenue_7day_avg
            FROM a_daily WINDOW w AS (ORDER BY order_date NULLS LAST
                                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        "q14_calendar_fill": """
            SELECT cal_date, coalesce(orders, 0) AS orders,
                   CAST(coalesce(revenue_cents, 0) AS DOUBLE) / 100 AS revenue,
                   CAST(dayofweek(cal_date) AS INTEGER) AS day_of_week
            FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date),
                                                     INTERVAL 1 DAY)) AS DATE) AS cal_date
                  FROM i_orders)
            LEFT JOIN a_daily ON order_date = cal_date""",
        "q15_reviews_by_delivery": f"""
            SELECT delivery_status, count(*) AS total_orders,
                   {ratio("sum(review_score)", "count(*)", 2)} AS avg_review,
                   count(*) FILTER (WHERE review_score = 5) AS five_star,
                   count(*) FILTER (WHERE review_score = 1) AS one_star,
                   {pct("count(*) FILTER (WHERE review_score <= 2)", "count(*)")} AS low_review_pct,
                   {pct("count(*) FILTER (WHERE review_score >= 4)", "count(*)")} AS high_review_pct
            FROM i_orders WHERE order_status = 'delivered' AND review_score IS NOT NULL
            GROUP BY delivery_status HAVING count(*) > 100""",
        "q16_shared_customer_pairs": """
            SELECT x.seller_id AS seller_a, y.seller_id AS seller_b, count(*) AS shared_customers
            FROM a_links x JOIN a_links y
              ON x.customer_unique_id = y.customer_unique_id AND x.seller_id < y.seller_id
            GROUP BY ALL HAVING count(*) >= 5
            ORDER BY shared_customers DESC, seller_a, seller_b LIMIT 15""",
        "q17_new_vs_returning": f"""
            SELECT month, total_customers, new_customers, returning_customers,
                   {pct("new_customers", "total_customers")} AS new_pct,
                   {pct("returning_customers", "total_customers")} AS returning_pct
            FROM (SELECT month, count(*) AS total_customers,
                         count(*) FILTER (WHERE first_month = month) AS new_customers,
                         count(*) FILTER (WHERE first_month < month) AS returning_customers
                  FROM a_visits GROUP BY month)""",
        "q18_freight_ratio": f"""
            SELECT product_category, count(*) AS items_sold, {mean_cents("price")} AS avg_price,
                   {mean_cents("freight_value")} AS avg_freight,
                   {ratio("sum(share)", "10000000000 * count(share)", 0)} / 10
                        AS freight_pct_of_price,
                   {ratio("sum(CAST(product_weight_g * 10000 AS BIGINT))",
                          "10000 * count(product_weight_g)", 0)} AS avg_weight_g
            FROM a_ratios JOIN s_products USING (product_id) GROUP BY product_category
            HAVING count(*) >= 20 AND 2 * sum(share) > 10000000000000 * count(share)""",
        "ex_count_by_status": "SELECT count(*) AS orders FROM s_orders WHERE order_status = 'shipped'",
        "ex_orders_in_range": f"""
            SELECT order_id, customer_id, order_purchase_timestamp FROM s_orders
            WHERE order_purchase_timestamp BETWEEN TIMESTAMP '{range_dates[0]}'
                                               AND TIMESTAMP '{range_dates[1]}'""",
        "ex_delivered_items_since": f"""
            SELECT order_id, order_status, CAST(price AS DOUBLE) AS price, product_category
            FROM i_lines JOIN s_products USING (product_id)
            WHERE order_status = 'delivered' AND order_purchase_timestamp >= TIMESTAMP '{since}'
            ORDER BY order_id, order_item_id LIMIT 100""",
        "ex_state_on_time_value": f"""
            SELECT customer_state, count(*) AS orders, {mean_cents("total_order_value")} AS avg_value
            FROM i_orders WHERE delivery_status = 'on_time'
              AND order_date BETWEEN DATE '{half_year[0]}' AND DATE '{half_year[1]}'
            GROUP BY customer_state""",
        "dq_primary_keys": " UNION ALL ".join(
            [
                _key_check("stg_customers", "s_customers", "customer_id"),
                _key_check("stg_orders", "s_orders", "order_id"),
                _key_check("stg_order_items", "s_order_items", "order_id", "order_item_id"),
                _key_check(
                    "stg_order_payments", "s_order_payments", "order_id", "payment_sequential"
                ),
                _key_check("stg_order_reviews", "s_order_reviews", "order_id"),
                _key_check("stg_products", "s_products", "product_id"),
                _key_check("stg_sellers", "s_sellers", "seller_id"),
                _key_check("stg_geolocation", "s_geolocation", "zip_code_prefix"),
                _key_check("int_orders_enriched", "i_orders", "order_id"),
                _key_check("int_seller_performance", "i_sellers", "seller_id"),
                _key_check("int_product_performance", _PRODUCT_ROWS, "product_id"),
                _key_check("int_customer_history", "i_people", "customer_unique_id"),
                _key_check("int_seller_status_history", f"({_HISTORY})", "scd_id"),
            ]
        ),
        "dq_mart_keys": " UNION ALL ".join(
            [
                _key_check("mart_monthly_revenue", "m_months", "month_start"),
                _key_check("mart_state_performance", "m_states", "customer_state"),
                _key_check(
                    "mart_product_category_analysis", "m_categories", "product_category"
                ),
                _key_check("mart_customer_segments", "m_ranked_people", "customer_unique_id"),
            ]
        ),
        "refresh_mart": _MONTHS,
        "layout_hints": """
            SELECT order_year, order_month, customer_state, count(*) AS orders,
                   min(order_date) AS first_date, max(order_date) AS last_date
            FROM i_orders GROUP BY ALL""",
    }


def _needed(sql: str) -> list[str]:
    """The blocks a statement mentions, directly or through others, inputs first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit(BLOCKS[name])
                found.append(name)

    visit(sql)
    return found


def oracle_queries(
    *, range_dates: tuple[str, str], since: str, half_year: tuple[str, str]
) -> dict[str, str]:
    """Complete statements by query name."""
    statements = {}
    for name, sql in _queries(range_dates, since, half_year).items():
        blocks = ",\n".join(f"{block} AS ({BLOCKS[block]})" for block in _needed(sql))
        statements[name] = f"WITH {blocks}\n{sql.strip()}"
    return statements
