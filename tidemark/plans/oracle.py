"""Equivalent SQL for the registered queries, over the star tables."""

from __future__ import annotations

import re

from tidemark.plans.portable import portable_sql

#: Named building blocks; a query pulls in the ones it mentions.
BLOCKS: dict[str, str] = {
    "t_orders": """
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_id, o_orderkey,
               lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer_id, o_custkey, o_totalprice,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status,
               purchase AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL
                    WHEN o_orderkey % 89 = 0 THEN purchase - INTERVAL 2 DAY
                    ELSE purchase + to_days(CAST(1 + o_orderkey % 2 AS INTEGER)) END AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 97 <> 0
                    THEN purchase + to_days(CAST(delivery AS INTEGER)) + to_hours(o_orderkey % 7) END AS order_delivered_customer_date,
               o_orderdate + to_days(CAST(16 + (o_orderkey * 13 + 7) % 15 AS INTEGER)) AS order_estimated_delivery_date,
               delivery, o_orderdate
        FROM (SELECT *, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_custkey % 60) AS purchase,
                     3 + (o_orderkey * 31 + o_custkey * 17) % 15 + CASE WHEN o_custkey % 9 = 0 THEN 14 ELSE 0 END AS delivery
              FROM orders) AS o""",
    "t_items": """
        SELECT o.order_id, l_linenumber AS order_item_id,
               lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS product_id,
               lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS seller_id,
               o.order_purchase_timestamp + to_days(CAST(2 + l_linenumber % 6 AS INTEGER)) AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
        FROM lineitem JOIN t_orders o ON o.o_orderkey = l_orderkey""",
    "t_products": """
        SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN p_brand || '/' || p_type END AS category,
               CASE WHEN p_partkey % 50 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS weight,
               CASE WHEN p_partkey % 50 <> 0 THEN CAST((10 + p_size) * (5 + p_partkey % 30) * (8 + p_partkey % 17) AS DOUBLE) END AS volume
        FROM part""",
    "t_customers": """
        SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS customer_id,
               'u' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS customer_unique_id,
               lpad(CAST(c_custkey % 997 * 97 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "t_sellers": """
        SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS seller_id,
               lpad(CAST(s_suppkey % 997 * 97 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "t_payments": """
        SELECT order_id, seq AS payment_sequential,
               CASE (o_orderkey + seq) % 4 WHEN 0 THEN 'boleto' WHEN 1 THEN 'credit_card'
                    WHEN 2 THEN 'debit_card' ELSE 'voucher' END AS payment_type,
               (o_orderkey + seq) % 25 AS payment_installments,
               CASE WHEN seq = 1 THEN CAST(o_totalprice AS DECIMAL(10,2)) ELSE CAST(seq * 10 AS DECIMAL(10,2)) END AS payment_value
        FROM (SELECT *, unnest(generate_series(1, 1 + o_orderkey % 3)) AS seq FROM t_orders) AS p""",
    "t_reviews": """
        SELECT order_id, order_id || '-' || CAST(seq AS VARCHAR) AS review_id,
               1 + (o_orderkey + delivery + seq) % 5 AS review_score
        FROM (SELECT *, unnest(generate_series(0, CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END)) AS seq
              FROM t_orders WHERE o_orderkey % 40 <> 1) AS r""",
    "t_geo": """
        SELECT lpad(CAST(z * 97 AS VARCHAR), 5, '0') AS zip_code_prefix, n_name AS state,
               CASE WHEN z % 61 = 0 AND j >= 1 THEN 41.0::DOUBLE ELSE CAST(-30 + z % 35 AS DOUBLE) + 0.25::DOUBLE * j END AS lat,
               CAST(-70 + z % 40 AS DOUBLE) + 0.25::DOUBLE * j AS lng
        FROM (SELECT c_custkey % 997 AS z, c_nationkey, unnest([0, 1, 2]) AS j FROM customer) AS c
        JOIN nation ON c_nationkey = n_nationkey WHERE z % 50 <> 0""",
    "t_points": "SELECT * FROM t_geo WHERE lat BETWEEN -34 AND 6 AND lng BETWEEN -74 AND -28",
    "t_zips": """
        SELECT zip_code_prefix, lat, lng, state, n_points FROM
          (SELECT zip_code_prefix, quantile_cont(lat, 0.5) AS lat, quantile_cont(lng, 0.5) AS lng, count(*) AS n_points
           FROM t_points GROUP BY 1) AS c
        JOIN (SELECT zip_code_prefix, state FROM
                (SELECT zip_code_prefix, state, row_number() OVER (PARTITION BY zip_code_prefix ORDER BY count(*) DESC, state) AS rn
                 FROM t_points GROUP BY 1, 2) AS m WHERE rn = 1) AS s USING (zip_code_prefix)""",
    "t_states": """
        SELECT state, quantile_cont(lat, 0.5) AS lat, quantile_cont(lng, 0.5) AS lng, count(*) AS n_points
        FROM t_points GROUP BY 1""",
    "t_delivered": """
        SELECT *, CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE) AS is_late
        FROM t_orders
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
          AND order_purchase_timestamp >= TIMESTAMP '1995-01-01' AND order_purchase_timestamp < TIMESTAMP '2001-07-01'""",
    "t_outcomes": """
        SELECT order_id, order_delivered_customer_date, order_delivered_carrier_date, is_late,
               datediff('microsecond', order_purchase_timestamp, order_delivered_customer_date) / 86400e6 AS delivery_days,
               datediff('microsecond', order_purchase_timestamp, order_delivered_customer_date) AS delivery_us,
               CASE WHEN order_delivered_carrier_date >= order_purchase_timestamp
                     AND order_delivered_carrier_date <= order_delivered_customer_date
                    THEN datediff('microsecond', order_purchase_timestamp, order_delivered_carrier_date) / 86400e6 END AS handling_days
        FROM t_delivered""",
    "t_lines": "SELECT i.*, category, weight, volume, seller_state FROM t_items i JOIN t_products USING (product_id) JOIN t_sellers USING (seller_id)",
    "t_top_seller": """
        SELECT order_id, seller_id FROM
          (SELECT order_id, seller_id, row_number() OVER (PARTITION BY order_id ORDER BY sum(price) DESC, seller_id) AS rn
           FROM t_items GROUP BY 1, 2) AS r WHERE rn = 1""",
    "t_top_category": """
        SELECT order_id, category AS dominant_category FROM
          (SELECT order_id, category, row_number() OVER (PARTITION BY order_id ORDER BY sum(price) DESC, category) AS rn
           FROM t_lines WHERE category IS NOT NULL GROUP BY 1, 2) AS r WHERE rn = 1""",
    "t_top_payment": """
        SELECT order_id, payment_type AS dominant_payment_type FROM
          (SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY sum(payment_value) DESC, payment_type) AS rn
           FROM t_payments GROUP BY 1, 2) AS r WHERE rn = 1""",
    "t_rollup": """
        SELECT order_id, count(*) AS n_items, count(DISTINCT product_id) AS n_distinct_products,
               count(DISTINCT seller_id) AS n_distinct_sellers, count(DISTINCT seller_state) AS n_seller_states,
               sum(price) AS total_price, max(price) AS max_price, sum(freight_value) AS total_freight,
               sum(weight) AS total_weight_g, sum(volume) AS total_volume_cm3,
               max(weight) AS max_item_weight_g, max(volume) AS max_item_volume_cm3,
               max(shipping_limit_date) AS max_shipping_limit_date
        FROM t_lines GROUP BY 1""",
    "t_payment_rollup": """
        SELECT order_id, max(payment_installments) AS max_installments, sum(payment_value) AS total_payment_value,
               count(DISTINCT payment_type) AS n_payment_methods
        FROM t_payments GROUP BY 1""",
    "t_customer_geo": """
        SELECT c.*, coalesce(z.lat, s.lat) AS customer_lat, coalesce(z.lng, s.lng) AS customer_lng,
               CASE WHEN z.lat IS NOT NULL THEN 'zip' WHEN s.lat IS NOT NULL THEN 'state' ELSE 'none' END AS customer_geo_source
        FROM t_customers c LEFT JOIN t_zips z ON z.zip_code_prefix = customer_zip_code_prefix
        LEFT JOIN t_states s ON s.state = customer_state""",
    "t_seller_geo": """
        SELECT c.*, coalesce(z.lat, s.lat) AS seller_lat, coalesce(z.lng, s.lng) AS seller_lng,
               CASE WHEN z.lat IS NOT NULL THEN 'zip' WHEN s.lat IS NOT NULL THEN 'state' ELSE 'none' END AS seller_geo_source
        FROM t_sellers c LEFT JOIN t_zips z ON z.zip_code_prefix = seller_zip_code_prefix
        LEFT JOIN t_states s ON s.state = seller_state""",
    "t_translation": """
        SELECT DISTINCT p_brand || '/' || p_type AS category, lower(translate(p_brand || '/' || p_type, '#/', '__')) AS english
        FROM part WHERE p_brand NOT LIKE '%5'""",
    "t_analytical": """
        SELECT *, 2 * 6371.0088 * asin(sqrt(least(1.0, sin((radians(customer_lat) - radians(seller_lat)) / 2) ** 2
                 + cos(radians(seller_lat)) * cos(radians(customer_lat)) * sin((radians(customer_lng) - radians(seller_lng)) / 2) ** 2)))
                 AS customer_seller_distance_km
        FROM (SELECT d.order_id, d.customer_id, customer_unique_id, d.order_purchase_timestamp,
               CAST(date_trunc('month', d.order_purchase_timestamp) AS TIMESTAMP) AS purchase_month, order_estimated_delivery_date,
               datediff('day', CAST(d.order_purchase_timestamp AS DATE), CAST(order_estimated_delivery_date AS DATE)) AS promised_days,
               is_late, r.* EXCLUDE (order_id), dominant_category, coalesce(english, dominant_category) AS dominant_category_english,
               datediff('microsecond', d.order_purchase_timestamp, max_shipping_limit_date) / 86400e6 AS days_to_shipping_limit,
               dominant_payment_type, max_installments, total_payment_value, n_payment_methods,
               customer_state, customer_zip_code_prefix, customer_lat, customer_lng, customer_geo_source,
               sg.seller_id, seller_state, seller_zip_code_prefix, seller_lat, seller_lng, seller_geo_source,
               seller_state || '->' || customer_state AS route, d.o_orderkey
        FROM t_delivered d JOIN t_rollup r USING (order_id) JOIN t_payment_rollup USING (order_id)
        JOIN t_top_seller ts USING (order_id) JOIN t_top_payment USING (order_id)
        JOIN t_customer_geo cg USING (customer_id) JOIN t_seller_geo sg ON sg.seller_id = ts.seller_id
        LEFT JOIN t_top_category USING (order_id) LEFT JOIN t_translation tr ON tr.category = dominant_category) AS joined""",
    "t_resolved": """
        SELECT a.order_id, a.seller_id, a.seller_state, a.route, a.customer_state, a.dominant_category,
               a.order_purchase_timestamp, o.order_delivered_customer_date, o.is_late, o.delivery_days, o.handling_days, o.delivery_us,
               CAST(round(o.handling_days * 86400e6) AS BIGINT) AS handling_us
        FROM t_analytical a JOIN t_outcomes o USING (order_id)""",
    "t_months": "SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH)) AS snapshot_month",
    "t_scored": """
        SELECT order_id, order_purchase_timestamp, CAST(is_late AS INTEGER) AS label,
               ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE AS s_hash,
               (31 - datediff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_estimated_delivery_date AS DATE))) / 32.0::DOUBLE AS s_promise,
               ((o_custkey % 9 = 0)::INTEGER * 3 + o_orderkey % 2) / 4.0::DOUBLE AS s_buyer
        FROM t_delivered""",
    "t_curve": """
        SELECT score, n, pos, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(pos) OVER () AS p, sum(n) OVER () AS total
        FROM (SELECT score, count(*) AS n, sum(label) AS pos FROM t_blend GROUP BY 1) AS g
        WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
    "t_blend": "SELECT *, s_hash * 0.25::DOUBLE + s_promise * 0.25::DOUBLE + s_buyer * 0.5::DOUBLE AS score FROM t_scored",
}

for _level, _key in (
    ("seller", "seller_id"),
    ("seller_state", "seller_state"),
    ("route", "route"),
    ("customer_state", "customer_state"),
    ("category", "dominant_category"),
):
    BLOCKS[f"t_snap_{_level}"] = f"""
        SELECT {_key}, snapshot_month, count(*) AS order_count, avg(CAST(is_late AS INTEGER)) AS late_rate,
               CAST(sum(delivery_us) AS DOUBLE) / 1e6 / 86400.0::DOUBLE / count(*) AS avg_delivery_days,
               CAST(sum(handling_us) AS DOUBLE) / 1e6 / 86400.0::DOUBLE / nullif(count(handling_us), 0) AS avg_handling_days
        FROM t_resolved JOIN t_months ON order_delivered_customer_date < snapshot_month
        WHERE {_key} IS NOT NULL GROUP BY 1, 2"""
BLOCKS["t_snap_global"] = """
    SELECT snapshot_month, count(*) AS order_count, avg(CAST(is_late AS INTEGER)) AS late_rate,
           CAST(sum(delivery_us) AS DOUBLE) / 1e6 / 86400.0::DOUBLE / count(*) AS avg_delivery_days,
               CAST(sum(handling_us) AS DOUBLE) / 1e6 / 86400.0::DOUBLE / nullif(count(handling_us), 0) AS avg_handling_days
    FROM t_resolved JOIN t_months ON order_delivered_customer_date < snapshot_month GROUP BY 1"""


def _attached(source: str, month: str) -> str:
    parts = []
    for name, level, fallback in (
        ("seller", "seller", "seller_state"),
        ("route", "route", "customer_state"),
        ("category", "category", None),
    ):
        parts.append(f"coalesce(x_{level}.order_count, 0) AS {name}_order_count_hist")
        for metric in ("late_rate", "avg_delivery_days", "avg_handling_days"):
            chain = [f"x_{level}.{metric}"] + ([f"x_{fallback}.{metric}"] if fallback else []) + [f"x_global.{metric}"]
            parts.append(f"coalesce({', '.join(chain)}) AS {name}_{metric}_hist")
        parts.append(f"x_{level}.order_count IS NULL AS {name}_is_new")
    joins = []
    for level, key in (
        ("seller", "seller_id"),
        ("seller_state", "seller_state"),
        ("route", "route"),
        ("customer_state", "customer_state"),
        ("category", "dominant_category"),
        ("global", None),
    ):
        match = f"x_{level}.snapshot_month = {month}" + (f" AND x_{level}.{key} = a.{key}" if key else "")
        joins.append(f"LEFT JOIN t_snap_{level} x_{level} ON {match}")
    return f"SELECT a.*, {', '.join(parts)} FROM {source} a {' '.join(joins)}"


BLOCKS["t_attached"] = _attached("t_analytical", "a.purchase_month")
BLOCKS["t_attached_1999"] = _attached("t_analytical", "TIMESTAMP '1999-01-01'")
BLOCKS["t_attached_2000"] = _attached("t_analytical", "TIMESTAMP '2000-01-01'")
BLOCKS["t_fit"] = """
    SELECT * FROM t_attached
    WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1999-07-01'"""
BLOCKS["t_top30"] = """
    SELECT dominant_category AS value, count(*) AS n FROM t_fit WHERE dominant_category IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, value LIMIT 30"""
BLOCKS["t_regions"] = "SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey"
BLOCKS["t_winsor"] = "SELECT quantile_cont(days_to_shipping_limit, 0.995) AS bound FROM t_fit"


def _capped(value: str, levels: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '__missing__' WHEN {value} IN ({levels}) THEN {value} ELSE '__unknown__' END"


def _features(source: str) -> str:
    return f"""
    SELECT order_id, CAST(promised_days AS DOUBLE) AS promised_days, hour(order_purchase_timestamp) AS purchase_hour,
      isodow(order_purchase_timestamp) - 1 AS purchase_dayofweek, isodow(order_purchase_timestamp) >= 6 AS is_weekend,
      CASE WHEN days_to_shipping_limit IS NOT NULL THEN least(days_to_shipping_limit, (SELECT bound FROM t_winsor)) END AS days_to_shipping_limit,
      {_capped('customer_state', 'SELECT customer_state FROM t_fit')} AS customer_state,
      {_capped('seller_state', 'SELECT seller_state FROM t_fit')} AS seller_state,
      seller_state = customer_state AS same_state,
      coalesce((SELECT region FROM t_regions g WHERE g.state = a.customer_state), '__missing__') AS customer_region,
      customer_seller_distance_km AS haversine_km, n_seller_states AS n_distinct_seller_states,
      {_capped('substr(customer_zip_code_prefix, 1, 2)', 'SELECT substr(customer_zip_code_prefix, 1, 2) FROM t_fit')} AS customer_zip_prefix_2,
      n_items, n_distinct_products, n_distinct_sellers, CAST(total_price AS DOUBLE) AS total_price, CAST(total_freight AS DOUBLE) AS total_freight,
      CAST(total_freight AS DOUBLE) / nullif(CAST(total_price AS DOUBLE), 0) AS freight_ratio,
      total_weight_g, max_item_weight_g, total_volume_cm3, max_item_volume_cm3,
      total_weight_g / nullif(total_volume_cm3, 0) AS avg_density,
      {_capped('dominant_category', 'SELECT value FROM t_top30')} AS product_category,
      {_capped('dominant_payment_type', 'SELECT dominant_payment_type FROM t_fit')} AS payment_type,
      max_installments, CAST(total_payment_value AS DOUBLE) AS payment_value, n_payment_methods,
      CAST(seller_order_count_hist AS DOUBLE) AS seller_order_count_hist, seller_late_rate_hist, seller_avg_delivery_days_hist,
      seller_avg_handling_days_hist, seller_is_new, CAST(route_order_count_hist AS DOUBLE) AS route_order_count_hist,
      route_late_rate_hist, route_avg_delivery_days_hist, category_late_rate_hist, category_avg_delivery_days_hist
    FROM {source} a"""


NUMERIC = (
    "promised_days purchase_hour purchase_dayofweek days_to_shipping_limit haversine_km n_distinct_seller_states "
    "n_items n_distinct_products n_distinct_sellers total_price total_freight freight_ratio total_weight_g "
    "max_item_weight_g total_volume_cm3 max_item_volume_cm3 avg_density max_installments payment_value "
    "n_payment_methods seller_order_count_hist seller_late_rate_hist seller_avg_delivery_days_hist "
    "seller_avg_handling_days_hist route_order_count_hist route_late_rate_hist route_avg_delivery_days_hist "
    "category_late_rate_hist category_avg_delivery_days_hist"
).split()
BLOCKS["t_raw_matrix"] = _features("t_attached")
BLOCKS["t_raw_serving"] = _features("t_attached_2000")
BLOCKS["t_fit_matrix"] = "SELECT m.* FROM t_raw_matrix m JOIN (SELECT order_id FROM t_fit) f USING (order_id)"
BLOCKS["t_medians"] = (
    "SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUMERIC) + " FROM t_fit_matrix"
)


def _imputed(source: str) -> str:
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT {c} FROM t_medians)) AS {c}" for c in NUMERIC)
    return f"SELECT * REPLACE ({filled}) FROM {source}"


BLOCKS["t_matrix"] = _imputed("t_raw_matrix")
BLOCKS["t_serving"] = _imputed("t_raw_serving")


def _with_blocks(body: str) -> str:
    """Prefix the blocks a query mentions, directly or through other blocks."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bt_[a-z_0-9]+\b", text):
            if name in BLOCKS and name not in needed:
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in needed) + "\n" + body


def sql_for(body: str, spec: str) -> str:
    return _with_blocks(portable_sql(body, spec))
