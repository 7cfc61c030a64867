"""Column types of the input files, by position.

Amounts are decimals, so that their sums are exact, with ten decimals, so that none are lost
before values are truncated. Text that does not fit its type becomes NULL; the rest of the
row is kept.
"""

ORDER_LINES = """
    row_id STRING, order_id STRING, order_date STRING, ship_date STRING, ship_mode STRING,
    customer_id STRING, customer_name STRING, segment STRING, country STRING, city STRING,
    state STRING, postal_code STRING, region STRING, product_id STRING, category STRING,
    sub_category STRING, product_name STRING, sales DECIMAL(24,10), quantity INT,
    discount DECIMAL(24,10), profit DECIMAL(24,10)
"""

# A line of these two ends in a delimiter; the last column takes what follows it.
CUSTOMERS = """
    custkey BIGINT, name STRING, address STRING, nationkey INT, phone STRING,
    acctbal DECIMAL(15,2), mktsegment STRING, comment STRING, line_end STRING
"""

ORDERS = """
    orderkey BIGINT, custkey BIGINT, status STRING, totalprice DECIMAL(15,2), orderdate DATE,
    priority STRING, clerk STRING, shippriority INT, comment STRING, line_end STRING
"""

DEPARTURES = """
    course STRING, stop_code STRING, stop_id STRING, stop_name STRING, route STRING,
    headsign STRING, direction STRING, departure_time STRING
"""

TRIPS = """
    vendor_id STRING, pickup TIMESTAMP_NTZ, dropoff TIMESTAMP_NTZ, passengers INT,
    distance DOUBLE, rate_code STRING, stored STRING, zone_id INT, dropoff_zone_id INT,
    payment_type INT, fare DECIMAL(24,10), extra DECIMAL(24,10), tax DECIMAL(24,10),
    tip DECIMAL(24,10), tolls DECIMAL(24,10), surcharge DECIMAL(24,10), total DECIMAL(24,10)
"""

ZONES = "zone_id INT, borough STRING, zone STRING, service_zone STRING"

# Read as text, so that only a wrong number of fields makes a row malformed.
LISTINGS = """
    id STRING, description STRING, host_id STRING, host_name STRING,
    neighbourhood_group STRING, neighbourhood STRING, lat STRING, lon STRING,
    room_type STRING, price STRING, minimum_nights STRING, reviews STRING,
    last_review STRING, reviews_per_month STRING, host_listings STRING, availability STRING,
    malformed STRING
"""

LISTING_TYPES = {
    "id": "bigint",
    "host_id": "bigint",
    "lat": "double",
    "lon": "double",
    "price": "decimal(24,10)",
}
