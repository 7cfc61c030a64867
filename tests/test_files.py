"""The reports over raw input files, from the reader to the written result."""

from __future__ import annotations

import datetime
import os
from decimal import Decimal

import pytest
from conftest import values

from sparktally import __main__ as runner
from sparktally.plans.programs import PROGRAMS
from sparktally.sources import readers, writers

ORDER_HEADER = (
    "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,"
    "City,State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,"
    "Discount,Profit\n"
)


def order_line(row, order, date, customer, name, state, product, category, sales, quantity, profit):
    return (
        f"{row},{order},{date},{date},Second Class,{customer},{name},Consumer,Country,City,{state},"
        f'1,South,{product},{category},Chairs,"A chair, with ""arms""",{sales},{quantity},0,{profit}\n'
    )


@pytest.fixture
def superstore(write_file):
    lines = [
        order_line(1, "O1", "1/30/16", "C1", '"Gute, Claire"', "Ohio", "P1", "Desk", "10.5", 2, "4.9"),
        order_line(2, "O1", "1/30/16", "C1", '"Gute, Claire"', "Ohio", "P1", "Desk", "1.1", 3, "9.2"),
        order_line(3, "O1", "1/5/2016", "C1", "Claire Gute", "Ohio", "P2", "Lamp", "2", "2.5", "x"),
        order_line(4, "O2", "12/31/99", "C2", "Bo", "Iowa", "P1", "Desk", "y", 4, "-7.5"),
        order_line(5, "O3", "bad", "C2", "Bo", "Iowa", "P3", "Desk", "3.25", 1, "9.2"),
    ]
    return write_file(ORDER_HEADER + "".join(lines))


def test_order_lines_are_typed_and_keep_quoted_commas(spark, superstore):
    rows = readers.read_order_lines(spark, superstore).orderBy("row_id").collect()
    assert [row.customer_name for row in rows][:1] == ["Gute, Claire"]
    assert rows[0].product_name == 'A chair, with "arms"'
    assert [row.sales for row in rows] == [
        Decimal("10.5"), Decimal("1.1"), Decimal("2"), None, Decimal("3.25")
    ]
    assert [row.quantity for row in rows] == [2, 3, None, 4, 1]
    assert [row.profit for row in rows][2] is None


def test_profit_counts_a_bad_number_as_zero(spark, superstore):
    totals = dict(values(PROGRAMS["profit_by_customer"](spark, superstore)))
    assert totals == {"C1": Decimal("14.1"), "C2": Decimal("1.7")}


def test_profit_rows_and_distinct_profit_rows(spark, superstore):
    rows = values(PROGRAMS["customer_profit_rows"](spark, superstore))
    assert rows == [
        ("C1", Decimal("4.9")), ("C1", Decimal("9.2")), ("C1", Decimal("0")),
        ("C2", Decimal("-7.5")), ("C2", Decimal("9.2")),
    ]
    distinct = values(PROGRAMS["customer_profit_distinct"](spark, superstore))
    assert sorted(distinct) == sorted(rows)


def test_sales_by_date(spark, superstore):
    by_state = PROGRAMS["sales_by_date_state"](spark, superstore)
    assert sorted(values(by_state)) == [
        ("1/30/16", "Ohio", Decimal("24.3")),
        ("1/5/2016", "Ohio", Decimal("0")),
        ("12/31/99", "Iowa", Decimal("0")),
        ("bad", "Iowa", Decimal("3.25")),
    ]
    by_category = PROGRAMS["sales_by_date_category"](spark, superstore)
    assert ("1/30/16", "Desk", Decimal("24.3")) in values(by_category)


def test_distinct_products_of_an_order(spark, superstore):
    assert sorted(values(PROGRAMS["order_distinct_products"](spark, superstore))) == [
        ("O1", 2, 5, Decimal("24.3")),
        ("O2", 1, 4, Decimal("0")),
        ("O3", 1, 1, Decimal("3.25")),
    ]


def test_one_name_per_customer(spark, superstore):
    rows = sorted(values(PROGRAMS["distinct_customers"](spark, superstore)))
    assert rows == [("C1", "Claire Gute"), ("C2", "Bo")]


def test_top_lines(spark, superstore):
    assert values(PROGRAMS["topk_profit"](spark, superstore, k=3), "row_id", "profit") == [
        ("2", Decimal("9.2")), ("5", Decimal("9.2")), ("1", Decimal("4.9")),
    ]
    assert values(PROGRAMS["topk_clients"](spark, superstore)) == [
        ("C1", 9), ("C2", 9), ("C1", 4), ("C2", -7),
    ]


def test_lines_in_date_order_without_bad_dates(spark, superstore):
    rows = values(PROGRAMS["sort_by_date_asc"](spark, superstore), "row_id", "sortable_date")
    assert rows == [("4", "1999/12/31"), ("3", "2016/01/05"), ("1", "2016/01/30"), ("2", "2016/01/30")]
    descending = values(PROGRAMS["sort_by_date_desc"](spark, superstore), "row_id", "order_date")
    assert descending[0] == ("1", datetime.date(2016, 1, 30))
    assert [row for row, _ in descending] == ["1", "2", "3", "4"]


@pytest.fixture
def piped(write_file):
    write_file("1|Ann|street|5|25-989|711.56|BUILDING|a \"quoted| note|\n2|Bo|street|1|25|0.00|AUTO|b|\n", "customer.tbl.1")
    write_file("10|1|O|100.10|1996-01-02|5-LOW|Clerk|0|first|\n", "orders.tbl.1")
    return write_file("11|1|O|0.20|1996-01-02|5-LOW|Clerk|0||\n12|3|O|5.00|1996-01-02|5-LOW|Clerk|0|z|\n", "orders.tbl.u1")


def test_piped_tables_are_told_apart_by_file(spark, piped):
    customers = readers.read_customers(spark, piped)
    assert sorted(values(customers, "custkey", "name", "nationkey")) == [(1, "Ann", 5), (2, "Bo", 1)]
    placed = readers.read_orders(spark, piped)
    assert sorted(values(placed, "orderkey", "totalprice", "comment")) == [
        (10, Decimal("100.10"), "first"), (11, Decimal("0.20"), None), (12, Decimal("5.00"), "z"),
    ]


def test_customer_orders(spark, piped):
    joined = values(PROGRAMS["join_customer_orders"](spark, piped))
    assert sorted(joined, key=str) == [("Ann", "first"), ("Ann", None)]
    assert values(PROGRAMS["customer_order_total"](spark, piped)) == [(1, "Ann", Decimal("100.30"))]


def test_customer_whose_orders_cancel_out(spark, piped, write_file):
    folder = write_file("13|2|O|4.50|1996-01-02|L|C|0|x|\n14|2|O|-4.50|1996-01-02|L|C|0|y|\n", "orders.tbl.u2")
    run = PROGRAMS["customer_order_total"]
    assert sorted(values(run(spark, folder), "custkey", "total"))[1] == (2, Decimal("0"))
    assert values(run(spark, folder, keep_zero=False), "custkey") == [(1,)]


@pytest.fixture
def departures(write_file):
    header = "course;stop_code;stop_id;stop_name;route;headsign;direction;departure_time;delay\n"
    rows = ["1;2;3;OCCITANIE;1;Nord;1;07:10:00;0", "1;2;3;OCCITANIE;6;Sud;0;24:05:00;0"]
    rows += ["1;2;3;GARE;1;Nord;1;07:10:00;0"]
    return write_file(header + "\n".join(rows) + "\n")


def test_transit_reports(spark, departures):
    assert sorted(values(PROGRAMS["stop_hourly_services"](spark, departures), "line", "services")) == [
        ("07h\tLigne 1", 1), ("24h\tLigne 6", 1),
    ]
    assert values(PROGRAMS["stop_hourly_services"](spark, departures, stop="GARE"), "services") == [(1,)]
    assert sorted(values(PROGRAMS["stop_mode_counts"](spark, departures))) == [
        ("GARE", 0, 1), ("OCCITANIE", 1, 1),
    ]
    assert values(PROGRAMS["top_tram_stops"](spark, departures)) == [("GARE", 1), ("OCCITANIE", 1)]
    assert values(PROGRAMS["top_bus_stops"](spark, departures, k=1)) == [("OCCITANIE", 1)]
    assert values(PROGRAMS["top_all_stops"](spark, departures)) == [("OCCITANIE", 2), ("GARE", 1)]
    assert len(values(PROGRAMS["stop_hour_traffic"](spark, departures))) == 3


@pytest.fixture
def taxi(write_file):
    header = "v,pickup,dropoff,passengers,distance,r,s,pu,do,pay,fare,extra,tax,tip,tolls,sur,total\n"
    rows = [
        "1,2018-01-01 00:21:05,2018-01-01 00:30:00,5,2.9,1,N,1,2,1,9,0,0,1.99,0,0,20.99",
        "",
        "1,2018-01-02 10:21:05,2018-01-02 00:30:00,1,1.2,1,N,1,2,2,9,0,0,2.00,0,0,10.01",
        "1,2018-01-02 10:59:59,2018-01-02 00:30:00,2,0.2,1,N,265,2,7,9,0,0,-0.50,0,0,5.00",
    ]
    return write_file(header + "\n".join(rows) + "\n", "trips.csv", "taxi")


@pytest.fixture
def zones(write_file):
    lines = ['"LocationID","Borough","Zone","service_zone"', '1,"EWR","Newark Airport","EWR"']
    lines += ['2,"Queens","Jamaica Bay","Boro Zone"']
    return write_file("\n".join(lines) + "\n", "zone_lookup.csv", "zones")


def test_trip_reports(spark, taxi, zones):
    def run(name, **options):
        return values(PROGRAMS[name](spark, taxi, **options))

    assert run("peak_hours") == [(0, 5), (10, 3)]
    assert run("top_days_of_month") == [(1, 5), (2, 3)]
    assert sorted(run("daily_top_payment")) == [(1, 1, "Credit Card"), (2, 2, "Cash")]
    assert run("passenger_frequency") == [(1, 1), (2, 1), (5, 1)]
    assert run("tip_ratio_pct") == [(8,)]
    assert run("avg_trip_length") == [(1.0,)]
    assert run("avg_trip_price") == [(35 / 3,)]
    assert run("zone_demand", zones=zones) == [
        (1, "Newark Airport", 2), (265, None, 1), (2, "Jamaica Bay", 0),
    ]


def test_lookup_in_the_folder_of_the_trips(spark, taxi, write_file):
    folder = write_file("h,h,h,h\n1,EWR,Newark Airport,EWR\n", "zone_lookup.csv", "taxi")
    demand = PROGRAMS["zone_demand"](spark, folder, f"{folder}/zone_lookup.csv", "trips*")
    assert values(demand) == [(1, "Newark Airport", 2), (265, None, 1)]


@pytest.fixture
def offers(write_file):
    header = "id,name,host_id,host_name,g,neighbourhood,lat,lon,room_type,price,n,r,l,m,c,a\n"
    rows = [
        '1,"Cosy, near the ""sea""",7,Ann,,Port,1.0,3.0,Entire home/apt,80.9,1,1,x,1,1,9',
        '2,"Two\nlines",7,Ann,,Port,2.0,5.0,Entire home/apt,80.1,1,1,x,1,1,',
        "3,Sea view,8,Bo,,Old Town,4.0,4.0,Shared room,10,1,1,x,1,1,9",
        "4,No price,8,Bo,,Old Town,4.0,4.0,Entire home/apt,n/a,1,1,x,1,1,9",
        "5,Too short,9,Cy,,Port",
    ]
    return write_file(header + "\n".join(rows) + "\n")


def test_listing_reports(spark, offers):
    def run(name, **options):
        return values(PROGRAMS[name](spark, offers, **options))

    assert run("top_hosts") == [(7, "Ann", 2), (8, "Bo", 2)]
    assert run("cheapest_listings") == [(1, 80), (2, 80)]
    assert run("cheapest_listings", room_type="Shared room", k=1) == [(3, 10)]
    assert sorted(run("room_type_share")) == [("Entire home/apt", 3, 75.0), ("Shared room", 1, 25.0)]
    assert sorted(run("neighbourhood_centroid")) == [("Old Town", 4.0, 4.0), ("Port", 1.5, 4.0)]
    assert run("listing_word_count", min_count=2) == [("sea", 2)]
    assert readers.read_listings(spark, offers).count() == 4


def test_listings_without_newlines_in_fields_can_be_split(spark, write_file):
    folder = write_file(
        "id,name,host_id,host_name,g,neighbourhood,lat,lon,room_type,price,n,r,l,m,c,a\n"
        "1,x,7,Ann,,Port,1.0,3.0,Entire home/apt,80.9,1,1,x,1,1,9\n\n"
        "2,x,7,Ann,,Port,1.0,3.0,Entire home/apt,80.9,1,1,x,1,1,9,17\n"
    )
    assert values(readers.read_listings(spark, folder, multi_line=False), "id") == [(1,)]


def test_text_reports(spark, write_file):
    folder = write_file("data  data\tfour\n\ndata of <b>data</b>\n", "poem.txt")
    assert values(PROGRAMS["word_count"](spark, folder)) == [("data", 3)]
    assert values(PROGRAMS["web_page_word_count"](spark, folder)) == [("data", 3)]
    assert dict(values(PROGRAMS["html_word_count"](spark, folder))) == {"data": 4, "four": 1, "of": 1}
    assert values(PROGRAMS["word_count"](spark, folder, min_length=2, min_count=9)) == []


def test_reports_of_empty_inputs_are_empty(spark, write_file):
    folder = write_file(ORDER_HEADER)
    for name in ("profit_by_customer", "order_distinct_products", "topk_profit", "sort_by_date_asc"):
        assert values(PROGRAMS[name](spark, folder)) == []


def test_tab_separated_result(spark, tmp_path):
    path = writers.run_folder(str(tmp_path), "totals")
    rows = spark.createDataFrame([("Ann", 3, None), ('B "o"', 4, "")], "name string, n int, note string")
    writers.write_tab_separated(rows.coalesce(1), path)
    text = "".join(
        open(os.path.join(path, name), encoding="utf-8").read()
        for name in sorted(os.listdir(path))
        if name.endswith(".txt")
    )
    assert text == 'Ann\t3\t\nB "o"\t4\t\n'
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_tab_separated(rows, path)


def test_parquet_result(spark, tmp_path):
    path = writers.run_folder(str(tmp_path), "totals")
    writers.write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_runner_writes_a_fresh_folder(spark, superstore, tmp_path):
    arguments = ["topk_profit", superstore, str(tmp_path / "out"), "--k", "2", "--format", "parquet"]
    folder = runner.main(arguments)
    assert os.path.basename(folder).startswith("topk_profit-")
    assert spark.read.parquet(folder).count() == 2


def test_runner_rejects_a_parameter_of_another_report(superstore, tmp_path):
    with pytest.raises(SystemExit):
        runner.main(["peak_hours", superstore, str(tmp_path), "--k", "2"])


def test_spread_is_the_plain_scan_unless_told_otherwise(spark, write_file):
    scan = readers.read_text(spark, write_file("one\ntwo\n", "poem.txt"))
    assert readers.spread(scan) is scan
    assert readers.spread(scan, 3).rdd.getNumPartitions() == 3
