"""Every query against its SQL in DuckDB, and the shape of its plan."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from sparktally.plans.oracles import ORACLES
from sparktally.plans.programs import PROGRAMS
from sparktally.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


def folder(scale: str) -> str:
    return f"{TESTDATA}/sf{scale}"


@pytest.fixture(scope="module", params=["0.001", "0.01"])
def tables(request):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{folder(request.param)}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    yield folder(request.param), connection
    connection.close()


def comparable(columns, rows):
    """Rows as sorted text tuples, with columns in name order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[index]) for index in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    path, connection = tables
    rows = QUERIES[name](spark, path)
    expected = connection.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(rows.columns) == sorted(names)
    types = {column[0]: SPARK_TYPES[str(column[1])] for column in expected.description}
    assert dict(rows.dtypes) == types
    found = rows.collect()
    assert found
    assert comparable(rows.columns, found) == comparable(names, expected.fetchall())


def test_every_report_runs_over_files_as_well():
    assert set(PROGRAMS) == {name for name in QUERIES if not name.startswith("sql_")}


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["order_date", "state", "sales_amount"]
    assert rows.limit(1).count() == 1


ORDERED = {
    "listing_word_count": (["count"], "word"),
    "peak_hours": (["passengers"], "hour"),
    "passenger_frequency": (["trips"], "passengers"),
    "zone_demand": (["trips"], "zone_id"),
    "top_hosts": (["listings"], "host_id"),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_ranked_reports_come_out_in_order(spark, name):
    (count,), key = ORDERED[name]
    rows = QUERIES[name](spark, folder("0.01")).collect()
    order = [(-row[count], row[key]) for row in rows]
    assert order == sorted(order)


@pytest.mark.parametrize("name, sign", [("sort_by_date_asc", 1), ("sort_by_date_desc", -1)])
def test_sorted_lines_come_out_in_date_order(spark, name, sign):
    rows = QUERIES[name](spark, folder("0.001")).collect()
    keys = [
        (sign * row.order_date.toordinal(), row.order_id, row.line_number, row.product_id)
        for row in rows
    ]
    assert keys == sorted(keys)


def test_profit_rows_come_out_by_customer(spark):
    customers = [row.customer_id for row in QUERIES["customer_profit_rows"](spark, folder("0.001")).collect()]
    assert customers == sorted(customers)


TOP_QUERIES = {
    "topk_profit", "topk_clients", "top_tram_stops", "top_bus_stops", "top_all_stops",
    "top_days_of_month", "cheapest_listings",
}


@pytest.fixture(scope="module")
def large_plans(spark):
    """The plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {
            name: QUERIES[name](spark, folder("0.001"))
            ._jdf.queryExecution().executedPlan().toString()
            for name in QUERIES
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_scales(large_plans, name):
    plan = large_plans[name]
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    # Only the rows of a top-k are gathered or broadcast; a global total is one row per task.
    if name not in TOP_QUERIES:
        assert "BroadcastExchange" not in plan
        assert "Window" not in plan
    if name in TOP_QUERIES:
        assert "TakeOrderedAndProject" in plan
    for single in re.finditer(r"Exchange SinglePartition.*\n.*", plan):
        assert "partial_" in single.group()


AGGREGATED = set(QUERIES) - TOP_QUERIES - {
    "join_customer_orders", "sql_join_customer_orders", "customer_profit_rows",
    "customer_profit_distinct", "sort_by_date_asc", "sort_by_date_desc",
}


@pytest.mark.parametrize("name", sorted(AGGREGATED))
def test_groups_are_combined_before_the_shuffle(large_plans, name):
    assert "partial_" in large_plans[name]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("word_count", {"text"}),
        ("html_word_count", {"html"}),
        ("avg_trip_length", {"value"}),
        ("tip_ratio_pct", {"l_extendedprice", "l_tax"}),
        ("order_distinct_products", {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"}),
        ("stop_mode_counts", {"user_id", "props"}),
    ],
)
def test_scan_reads_only_the_columns_it_needs(large_plans, name, columns):
    (scan,) = re.findall(r"FileScan parquet \[(.*?)\]", large_plans[name])
    assert {column.split("#")[0] for column in scan.split(",")} == columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("stop_hourly_services", "EqualTo(user_id,1)"),
        ("cheapest_listings", "EqualTo(p_type,ECONOMY)"),
    ],
)
def test_filters_reach_the_scan(large_plans, name, pushed):
    assert pushed in large_plans[name]


def test_share_reuses_the_counts_for_the_total(spark):
    rows = QUERIES["room_type_share"](spark, folder("0.001"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0] or plan.count("ReusedExchange") > 0


def test_total_by_customer_shuffles_no_single_order(large_plans):
    plan = large_plans["customer_order_total"]
    # Orders meet the join only after they are totalled per customer.
    assert plan.index("SortMergeJoin") < plan.index("partial_sum(shiftright")
