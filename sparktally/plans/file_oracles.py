"""The DuckDB SQL of the queries over files, on the tables that the files were made of."""

from __future__ import annotations

from sparktally.plans.oracles import EVENTS, LINE_ORDER, ORACLES, SALES_BY_DATE_STATE, SUPERSTORE

FILE_ORACLES: dict[str, str] = {
    "text_file_word_count": ORACLES["word_count"],
    "split_listings": """
SELECT p_partkey AS id, p_name || chr(10) || 'size "' || p_size || '", ' || p_type AS description,
       p_size::BIGINT AS host_id, p_brand AS host_name, p_type AS room_type, p_retailprice AS price
FROM part
""",
    "peak_hours_by_header": ORACLES["peak_hours"],
    "zone_demand_one_folder": ORACLES["zone_demand"],
    "stop_mode_counts_by_header": (
        f"WITH {EVENTS} SELECT stop_id::VARCHAR AS stop_id, buses, trams FROM vehicles"
    ),
    "order_line_rejects": """
WITH spoilt AS (
  SELECT l_extendedprice::DECIMAL(12,2) AS sales,
         CASE WHEN (l_orderkey + l_linenumber) % 10 <> 0 THEN 'none'
              WHEN l_partkey % 4 = 0 THEN 'fields'
              WHEN l_partkey % 4 = 1 THEN 'sales'
              WHEN l_partkey % 4 = 2 THEN 'quantity'
              ELSE 'order_date' END AS reason
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)
SELECT reason, count(*) AS rows, (sum(sales) FILTER (WHERE reason = 'none'))::DOUBLE AS sales
FROM spoilt
GROUP BY reason
""",
    "mixed_join_customer_orders": """
SELECT c_name AS customer_name, o_orderkey AS order_id,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS comment
FROM customer JOIN orders ON o_custkey = c_custkey
""",
    "mixed_customer_order_total": """
SELECT c_custkey AS customer_id, c_name AS customer_name,
       sum(o_totalprice::DECIMAL(15,2))::DOUBLE AS total
FROM customer JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_name
""",
    "mixed_line_shapes": """
SELECT 'customer' AS shape, count(*) AS rows FROM customer
UNION ALL SELECT 'order', count(*) FROM orders
UNION ALL SELECT 'other', count(*) FROM nation
""",
    "top_third_of_profits": f"""
WITH {SUPERSTORE},
best AS (SELECT *, row_number() OVER (ORDER BY profit DESC, {LINE_ORDER}) AS rank FROM superstore)
SELECT rank, order_id, line_number, product_id, supplier_id, sales::DOUBLE AS sales, profit::DOUBLE AS profit
FROM best WHERE rank <= (SELECT count(*) // 3 FROM lineitem)
""",
    "published_sales": f"""
SELECT row_number() OVER (ORDER BY order_date, state) - 1 AS place, order_date, state, sales_amount
FROM ({SALES_BY_DATE_STATE})
""",
}
