"""The DuckDB SQL of every query, written from the tables and not from the operators.

DuckDB rounds a double cast to an integer, so truncation is spelled ``trunc``.
"""

from __future__ import annotations

# The wide order-line table, with every dimension joined.
SUPERSTORE = """
superstore AS (
  SELECT l_orderkey AS order_id,
         l_linenumber AS line_number,
         l_partkey AS product_id,
         l_suppkey AS supplier_id,
         l_extendedprice::DECIMAL(12,2) AS sales,
         l_quantity::SMALLINT AS quantity,
         l_discount::DECIMAL(4,2) AS discount,
         o_orderdate::DATE AS order_date,
         o_custkey AS customer_id,
         c_name AS customer_name,
         n_name AS state,
         p_type AS category,
         l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2))
           - p_retailprice::DECIMAL(12,2) * l_quantity::SMALLINT AS profit
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN part ON p_partkey = l_partkey
)
"""

EVENTS = """
event_numbers AS (
  SELECT event_id, ts, user_id, value, json_extract(props, '$.k')::INTEGER AS k FROM events
),
departures AS (
  SELECT user_id AS stop_id, k % 8 + 1 AS route, event_id % 2 AS direction,
         strftime(ts, '%H') AS hour
  FROM event_numbers
),
vehicles AS (
  SELECT stop_id,
         count(*) FILTER (WHERE route > 4) AS buses,
         count(*) FILTER (WHERE route <= 4) AS trams
  FROM departures
  GROUP BY stop_id
)
"""

LINE_ORDER = "order_id, line_number, product_id, supplier_id, sales"

TOP_PROFITS = f"""
best AS (
  SELECT *, CAST(row_number() OVER (ORDER BY profit DESC, {LINE_ORDER}) AS INTEGER) AS rank
  FROM superstore
)
"""

SORTED_LINES = """
SELECT order_id, line_number, product_id, supplier_id, sales::DOUBLE AS sales,
       quantity::DOUBLE AS quantity, discount::DOUBLE AS discount, customer_id, order_date,
       strftime(order_date, '%Y/%m/%d') AS sortable_date
FROM superstore
"""


def top_stops(services: str) -> str:
    return f"""
WITH {EVENTS},
ranked AS (
  SELECT stop_id, {services} AS services,
         CAST(row_number() OVER (ORDER BY {services} DESC, stop_id) AS INTEGER) AS rank
  FROM vehicles
)
SELECT stop_id, services, rank FROM ranked WHERE rank <= 10
"""


def frequent_words(table: str, column: str) -> str:
    return f"""
WITH words AS (
  SELECT unnest(regexp_split_to_array({column}, '\\s+')) AS word FROM {table}
)
SELECT word, count(*) AS count
FROM words
WHERE length(word) > 3
GROUP BY word
HAVING count(*) >= 3
"""


SALES_BY_DATE_STATE = f"""
WITH {SUPERSTORE}
SELECT order_date, state, sum(sales * quantity)::DOUBLE AS sales_amount
FROM superstore
GROUP BY order_date, state
"""

SALES_BY_DATE_CATEGORY = f"""
WITH {SUPERSTORE}
SELECT order_date, category, sum(sales * quantity)::DOUBLE AS sales_amount
FROM superstore
GROUP BY order_date, category
"""

ORACLES: dict[str, str] = {
    "word_count": frequent_words("documents", "text"),
    "web_page_word_count": frequent_words("pages", "html"),
    "html_word_count": r"""
WITH cleaned AS (
  SELECT regexp_replace(replace(html, '&nbsp;', ' '), '[.!?,:;"()0-9]', '', 'g') AS html
  FROM pages
),
words AS (
  SELECT unnest(regexp_split_to_array(html, '\s?<[^>]*>\s?|\s')) AS word FROM cleaned
)
SELECT word, count(*) AS count FROM words WHERE word <> '' GROUP BY word
""",
    "listing_word_count": r"""
WITH words AS (
  SELECT unnest(regexp_split_to_array(
           regexp_replace(lower(text), '[^a-zA-Z]', ' ', 'g'), '\s+')) AS word
  FROM documents
)
SELECT word, count(*) AS count
FROM words
WHERE word <> ''
GROUP BY word
HAVING count(*) > 100
""",
    "profit_by_customer": f"""
WITH {SUPERSTORE}
SELECT customer_id, sum(profit)::DOUBLE AS profit FROM superstore GROUP BY customer_id
""",
    "customer_profit_rows": f"""
WITH {SUPERSTORE}
SELECT customer_id, profit::DOUBLE AS profit FROM superstore
""",
    "customer_profit_distinct": f"""
WITH {SUPERSTORE}
SELECT DISTINCT customer_id, profit::DOUBLE AS profit FROM superstore
""",
    "sales_by_date_category": SALES_BY_DATE_CATEGORY,
    "sales_by_date_state": SALES_BY_DATE_STATE,
    "order_distinct_products": f"""
WITH {SUPERSTORE}
SELECT order_id,
       count(DISTINCT product_id) AS distinct_products,
       sum(quantity)::BIGINT AS total_quantity,
       sum(sales * quantity)::DOUBLE AS sales_amount
FROM superstore
GROUP BY order_id
""",
    "distinct_customers": f"""
WITH {SUPERSTORE}
SELECT customer_id, min(customer_name) AS customer_name FROM superstore GROUP BY customer_id
""",
    "topk_profit": f"""
WITH {SUPERSTORE}, {TOP_PROFITS}
SELECT rank, order_id, line_number, product_id, supplier_id, sales::DOUBLE AS sales,
       customer_id, customer_name, state, category, order_date,
       quantity::DOUBLE AS quantity,
       profit::DOUBLE AS profit
FROM best
WHERE rank <= 10
""",
    "topk_clients": f"""
WITH {SUPERSTORE}, {TOP_PROFITS}
SELECT rank, customer_id, trunc(profit)::BIGINT AS profit FROM best WHERE rank <= 10
""",
    "sort_by_date_asc": f"WITH {SUPERSTORE} {SORTED_LINES} ORDER BY order_date, {LINE_ORDER}",
    "sort_by_date_desc": f"WITH {SUPERSTORE} {SORTED_LINES} ORDER BY order_date DESC, {LINE_ORDER}",
    "join_customer_orders": """
SELECT c_name AS customer_name, o_orderkey AS order_id, o_orderpriority AS priority
FROM customer JOIN orders ON c_custkey = o_custkey
""",
    "customer_order_total": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS total
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name
""",
    "customer_order_total_nonzero": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       sum(floor(o_totalprice / 400000))::DOUBLE AS total
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name
HAVING sum(floor(o_totalprice / 400000)) <> 0
""",
    "stop_hourly_services": f"""
WITH {EVENTS}
SELECT hour, route, count(*) AS services, hour || 'h' || chr(9) || 'Ligne ' || route AS line
FROM departures
WHERE stop_id = 1
GROUP BY hour, route
""",
    "stop_mode_counts": f"WITH {EVENTS} SELECT stop_id, buses, trams FROM vehicles",
    "top_tram_stops": top_stops("trams"),
    "top_bus_stops": top_stops("buses"),
    "top_all_stops": top_stops("trams + buses"),
    "stop_hour_traffic": f"""
WITH {EVENTS},
counts AS (
  SELECT stop_id // 8 AS stop_id, hour,
         count(*) FILTER (WHERE route <= 4 AND direction = 1) AS trams_out,
         count(*) FILTER (WHERE route <= 4 AND direction <> 1) AS trams_back,
         count(*) FILTER (WHERE route > 4 AND direction = 1) AS buses_out,
         count(*) FILTER (WHERE route > 4 AND direction <> 1) AS buses_back
  FROM departures
  GROUP BY 1, 2
),
peaks AS (
  SELECT *, greatest(trams_out, trams_back) AS trams_peak,
         greatest(buses_out, buses_back) AS buses_peak
  FROM counts
)
SELECT *,
       stop_id || '(' || hour || 'h)' AS stop_hour,
       concat_ws(chr(9),
         CASE WHEN trams_peak = 0 THEN NULL
              WHEN trams_peak <= 4 THEN 'trams=faible'
              WHEN trams_peak <= 9 THEN 'trams=moyen'
              ELSE 'trams=fort' END,
         CASE WHEN buses_peak = 0 THEN NULL
              WHEN buses_peak <= 4 THEN 'bus=faible'
              WHEN buses_peak <= 9 THEN 'bus=moyen'
              ELSE 'bus=fort' END) AS traffic
FROM peaks
""",
    "peak_hours": f"""
WITH {EVENTS}
SELECT hour(ts)::INTEGER AS hour, sum(k % 7)::BIGINT AS passengers
FROM event_numbers
GROUP BY 1
""",
    "top_days_of_month": f"""
WITH {EVENTS},
days AS (SELECT day(ts)::INTEGER AS day, sum(k % 7)::BIGINT AS passengers
         FROM event_numbers GROUP BY 1),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY passengers DESC, day) AS INTEGER) AS rank
           FROM days)
SELECT day, passengers, rank FROM ranked WHERE rank <= 3
""",
    "daily_top_payment": """
WITH counts AS (
  SELECT day(o_orderdate)::INTEGER AS day, left(o_orderpriority, 1)::INTEGER AS payment_type,
         count(*) AS n
  FROM orders GROUP BY 1, 2
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, payment_type) AS position
  FROM counts
)
SELECT day, payment_type,
       CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
            WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip' END AS payment
FROM ranked
WHERE position = 1
""",
    "zone_demand": f"""
WITH {EVENTS},
demand AS (SELECT k AS zone_id, count(*) AS trips FROM event_numbers GROUP BY 1),
zones AS (SELECT n_nationkey * 5 AS zone_id, n_name AS zone FROM nation)
SELECT coalesce(demand.zone_id, zones.zone_id) AS zone_id, zone, coalesce(trips, 0) AS trips
FROM demand FULL OUTER JOIN zones ON demand.zone_id = zones.zone_id
""",
    "passenger_frequency": f"""
WITH {EVENTS}
SELECT k % 7 AS passengers, count(*) AS trips FROM event_numbers GROUP BY 1
""",
    "tip_ratio_pct": """
WITH fares AS (
  SELECT trunc(l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,2))::BIGINT AS tip,
         trunc(l_extendedprice::DECIMAL(12,2) * (1 + l_tax::DECIMAL(4,2)))::BIGINT AS total
  FROM lineitem
)
SELECT (sum(tip) * 100 // sum(total))::BIGINT AS tip_pct FROM fares
""",
    "avg_trip_length": """
SELECT sum(trunc(value)::BIGINT)::DOUBLE / count(*) AS mean_distance FROM events
""",
    "avg_trip_price": """
SELECT sum(trunc(o_totalprice::DECIMAL(12,2))::BIGINT)::DOUBLE / count(*) AS mean_price
FROM orders
""",
    "top_hosts": """
SELECT s_suppkey AS host_id, s_name AS host_name, count(*) AS listings
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
GROUP BY 1, 2
""",
    "cheapest_listings": """
WITH ranked AS (
  SELECT p_partkey AS id, trunc(p_retailprice)::BIGINT AS price,
         CAST(row_number() OVER (ORDER BY trunc(p_retailprice), p_partkey) AS INTEGER) AS rank
  FROM part WHERE p_type = 'ECONOMY'
)
SELECT id, price, rank FROM ranked WHERE rank <= 10
""",
    "room_type_share": """
SELECT p_type AS room_type, count(*) AS listings,
       count(*) * 100::DOUBLE / (SELECT count(*) FROM part) AS share_pct
FROM part
GROUP BY p_type
""",
    "neighbourhood_centroid": """
SELECT label AS neighbourhood,
       round(avg(embedding[1]::DOUBLE), 6) AS lat,
       round(avg(embedding[2]::DOUBLE), 6) AS lon
FROM embeddings
GROUP BY label
""",
    "sql_sales_by_date_state": SALES_BY_DATE_STATE,
    "sql_sales_by_date_category": SALES_BY_DATE_CATEGORY,
    "sql_order_products": f"""
WITH {SUPERSTORE}
SELECT order_id, count(DISTINCT product_id) AS distinct_products,
       sum(sales * quantity)::DOUBLE AS sales_amount
FROM superstore
GROUP BY order_id
""",
    "sql_join_customer_orders": """
SELECT c_name AS name, o_orderpriority AS comment
FROM customer JOIN orders ON c_custkey = o_custkey
""",
    "sql_customer_order_total": """
SELECT c_custkey AS customer_id, c_name AS name,
       sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS total
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name
""",
}
