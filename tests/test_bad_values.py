"""What bad, precise and missing values give in the reports over files, and the bytes of texts."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from conftest import TESTDATA, values
from pyspark.sql import functions as F

from sparktally import __main__ as runner
from sparktally.functions import numbers
from sparktally.operators import aggregates
from sparktally.plans.programs import PROGRAMS
from sparktally.plans.queries import QUERIES
from sparktally.sources import writers

TRIPS = "v,pickup,dropoff,passengers,distance,r,s,pu,do,pay,fare,extra,tax,tip,tolls,sur,total\n"
LISTINGS = "id,name,host_id,host_name,g,neighbourhood,lat,lon,room_type,price,n,r,l,m,c,a\n"
DEPARTURES = "course;stop_code;stop_id;stop_name;route;headsign;direction;departure_time\n"


def trip(pickup="2018-01-01 08:00:00", passengers="1", distance="1", zone="1", tip="0", total="1"):
    return f"1,{pickup},{pickup},{passengers},{distance},1,N,{zone},2,1,9,0,0,{tip},0,0,{total}\n"


def listing(key="1", host="7", name="Ann", lat="1.0", lon="2.0", price="80"):
    return f"{key},Sea,{host},{name},,Port,{lat},{lon},Entire home/apt,{price},1,1,x,1,1,9\n"


def test_values_are_truncated_with_all_their_decimals(spark, write_file):
    taxi = write_file(TRIPS + trip(tip="0.999", total="9.999"))
    assert values(PROGRAMS["avg_trip_price"](spark, taxi)) == [(9.0,)]
    assert values(PROGRAMS["tip_ratio_pct"](spark, taxi)) == [(0,)]
    offers = write_file(LISTINGS + listing(price="79.999"), folder="offers")
    assert values(PROGRAMS["cheapest_listings"](spark, offers), "price") == [(79,)]
    line = ",".join(str(n) for n in range(17)) + ",1,1,0,9.99999\n"
    header = ",".join(f"h{n}" for n in range(21)) + "\n"
    lines = write_file(header + line, folder="lines")
    assert values(PROGRAMS["topk_clients"](spark, lines), "profit") == [(9,)]


def test_an_amount_with_too_many_decimals_is_rejected_not_rounded(spark):
    rows = spark.createDataFrame([(v,) for v in (0.12, 0.125, float("nan"), 1e300, None)], "v double")
    assert values(rows.select(numbers.scaled("v"))) == [(12,), (None,), (None,), (None,), (None,)]


def test_no_number_disqualifies_its_row_only(spark, write_file):
    taxi = write_file(TRIPS + trip(distance="NaN") + trip(distance="Infinity") + trip(distance="2.9"))
    assert values(PROGRAMS["avg_trip_length"](spark, taxi)) == [(2.0,)]


def test_trips_without_a_valid_key_are_rejected(spark, write_file):
    taxi = write_file(TRIPS + trip(pickup="soon") + trip(passengers="x", zone="y") + trip())
    zones = write_file("h,h,h,h\n1,EWR,Newark,EWR\n", folder="zones")
    assert values(PROGRAMS["peak_hours"](spark, taxi)) == [(8, 1)]
    assert values(PROGRAMS["top_days_of_month"](spark, taxi)) == [(1, 1)]
    assert values(PROGRAMS["daily_top_payment"](spark, taxi)) == [(1, 1, "Credit Card")]
    assert values(PROGRAMS["passenger_frequency"](spark, taxi)) == [(1, 2)]
    assert values(PROGRAMS["zone_demand"](spark, taxi, zones=zones)) == [(1, "Newark", 2), (None, None, 1)]


def test_listings_without_id_host_or_place(spark, write_file):
    offers = write_file(
        LISTINGS + listing(key="") + listing(key="2", host="x") + listing(key="3", lat="north", lon="9.0")
    )
    assert values(PROGRAMS["room_type_share"](spark, offers)) == [("Entire home/apt", 3, 100.0)]
    assert values(PROGRAMS["top_hosts"](spark, offers)) == [(7, "Ann", 2)]
    assert values(PROGRAMS["neighbourhood_centroid"](spark, offers)) == [("Port", 1.0, 2.0)]
    assert values(PROGRAMS["cheapest_listings"](spark, offers), "id") == [(2,), (3,)]
    assert PROGRAMS["listing_word_count"](spark, offers, min_count=3).count() == 1


def written(folder):
    names = sorted(n for n in os.listdir(folder) if n.endswith(".txt"))
    return b"".join(open(os.path.join(folder, n), "rb").read() for n in names)


def test_bytes_of_values_with_tabs(spark, write_file, tmp_path):
    stops = write_file(DEPARTURES + "1;2;3;OCCITANIE;1;N;1;07:10:00\n1;2;3;OCCITANIE;6;S;1;07:20:00\n")
    for name, expected in (
        ("stop_hourly_services", {b"07\t1\t1\t07h\tLigne 1", b"07\t6\t1\t07h\tLigne 6"}),
        ("stop_hour_traffic", None),
    ):
        folder = writers.run_folder(str(tmp_path), name)
        writers.write_tab_separated(PROGRAMS[name](spark, stops), folder)
        text = written(folder)
        assert b"\x00" not in text and b'"' not in text
        if expected:
            assert set(text.splitlines()) == expected
        else:
            assert text.rstrip(b"\n").endswith(b"trams=faible\tbus=faible")


def test_runner_needs_the_zones(tmp_path):
    with pytest.raises(SystemExit):
        runner.main(["zone_demand", str(tmp_path), str(tmp_path)])


def test_runner_passes_switches(spark, write_file, tmp_path):
    offers = write_file(LISTINGS + listing())
    folder = runner.main(["room_type_share", offers, str(tmp_path / "out"), "--multi_line", "no"])
    assert written(folder) == b"Entire home/apt\t1\t100.0\n"
    with pytest.raises(SystemExit):
        runner.main(["room_type_share", offers, str(tmp_path), "--multi_line", "perhaps"])


def test_run_folders_differ():
    assert writers.run_folder("x", "y") != writers.run_folder("x", "y")


def test_one_value_by_sorts_distinct_pairs_only(spark, write_file):
    header = ",".join(f"h{n}" for n in range(21)) + "\n"
    lines = write_file(header + ",".join(str(n) for n in range(21)) + "\n")
    plan = PROGRAMS["distinct_customers"](spark, lines)._jdf.queryExecution().executedPlan().toString()
    first = plan.rstrip().splitlines()
    assert "HashAggregate" in [line for line in first if "Aggregate" in line][-1]


def test_a_table_written_anew_is_read_with_its_new_types(spark, tmp_path):
    for kind, expected in (("bigint", [(1,)]), ("double", [(1,)])):
        rows = spark.sql(f"SELECT CAST(7 AS {kind}) AS n_nationkey, 'x' AS n_name, 1 AS n_regionkey")
        rows.write.mode("overwrite").parquet(str(tmp_path / "nation.parquet"))
        from sparktally.plans.tables import Tables

        nations = Tables(spark, str(tmp_path)).nations()
        assert dict(nations.dtypes)["nation_id"] == kind
        assert values(nations.select(F.count("*"))) == expected


def test_means_are_of_whole_rows(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 8.0), ("a", float("nan"), 9.0)], "k string, x double, y double")
    assert values(aggregates.means_by(rows, "k", ["x", "y"])) == [("a", 1.0, 2.0)]


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
class TestTables:
    def test_every_traffic_class_occurs(self, spark):
        for scale in ("0.001", "0.01"):
            rows = QUERIES["stop_hour_traffic"](spark, f"{TESTDATA}/sf{scale}")
            classes = rows.select(F.explode(F.split("traffic", "\t"))).distinct() if "traffic" in rows.columns else None
            text = " ".join(" ".join(map(str, row)) for row in rows.collect())
            assert classes is None or classes.count() >= 3
            assert all(name in text for name in ("faible", "moyen", "fort"))

    @pytest.mark.parametrize("name", ["sort_by_date_asc", "customer_profit_rows"])
    def test_order_holds_across_partitions(self, spark, name):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            rows = QUERIES[name](spark, f"{TESTDATA}/sf0.01")
            assert rows.rdd.getNumPartitions() > 1
            key = "order_date" if name.startswith("sort") else "customer_id"
            keys = [row[key] for row in rows.select(key).collect()]
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert keys == sorted(keys)

    def test_customers_without_bulk_orders_are_left_out(self, spark):
        everyone = QUERIES["customer_order_total"](spark, f"{TESTDATA}/sf0.01").count()
        bulk = QUERIES["customer_order_total_nonzero"](spark, f"{TESTDATA}/sf0.01")
        assert 0 < bulk.count() < everyone
        assert bulk.filter("total = 0").isEmpty()


def test_zero_totals_can_be_left_out(spark, write_file):
    write_file("1|Ann|x|1|p|1|A|b|\n", "customer.tbl")
    folder = write_file("1|1|O|2.00|2020-01-02|1|c|0|x|\n2|1|O|-2.00|2020-01-02|1|c|0|x|\n", "orders.tbl")
    run = PROGRAMS["customer_order_total"]
    assert values(run(spark, folder)) == [(1, "Ann", Decimal("0.00"))]
    assert values(run(spark, folder, keep_zero=False)) == []
