from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import values
from pyspark.sql import functions as F

from sparktally.operators import aggregates, joins, listings, orders, ordering, transit, trips, words


@pytest.fixture(scope="module")
def sales(spark):
    """Rows of which one key holds a third."""
    generator = random.Random(7)
    rows = [
        (index, 0 if index % 3 == 0 else generator.randrange(50), generator.randrange(-500, 500))
        for index in range(3000)
    ]
    return spark.createDataFrame(rows, "id int, key int, amount bigint").cache()


def test_totals_with_a_hot_key(sales):
    expected = defaultdict(int)
    for _, key, amount in values(sales):
        expected[key] += amount
    assert dict(values(aggregates.total_by(sales, ["key"], {"total": "amount"}))) == dict(expected)


@pytest.mark.parametrize("partitions", [1, 8])
def test_results_do_not_depend_on_partitions(spark, sales, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spread = sales.repartition(partitions)
    try:
        counts = Counter(key for _, key, _ in values(sales))
        assert dict(values(aggregates.count_by(spread, ["key"]))) == counts
        top = ordering.top_k(spread, "amount", ["id"], 5, "rank")
        expected = sorted(values(sales), key=lambda row: (-row[2], row[0]))[:5]
        assert values(top, "id", "key", "amount") == expected
        assert [rank for (rank,) in values(top, "rank")] == [1, 2, 3, 4, 5]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_distinct_items_and_totals(spark):
    lines = spark.createDataFrame(
        [("a", "x", 2, 1.5), ("a", "x", 3, 2.0), ("a", "y", None, 4.0), ("b", None, 1, None)],
        "order_id string, product_id string, quantity int, sales double",
    )
    rows = {row[0]: row[1:] for row in values(orders.order_products(lines))}
    assert rows == {"a": (2, 5, 9.0), "b": (0, 1, 0.0)}


def test_one_value_per_key_is_the_smallest(spark):
    rows = spark.createDataFrame([(1, "Ann B"), (1, "Ann A"), (2, "Bo")], "id int, name string")
    assert sorted(values(aggregates.one_value_by(rows, "id", "name"))) == [(1, "Ann A"), (2, "Bo")]


def test_key_values_keep_duplicates_in_key_order(spark):
    rows = spark.createDataFrame(
        [(3, "b", 1), (1, "a", 5), (2, "b", 1), (4, "a", 2)], "row int, key string, value int"
    )
    pairs = values(aggregates.key_values(rows, "key", "value", ["row"]))
    assert pairs == [("a", 5), ("a", 2), ("b", 1), ("b", 1)]
    distinct = values(aggregates.distinct_key_values(rows, "key", "value"))
    assert sorted(distinct) == [("a", 2), ("a", 5), ("b", 1)]


def test_most_frequent_value_takes_the_lowest_on_a_tie(spark):
    rows = spark.createDataFrame(
        [(1, 2), (1, 1), (1, 2), (1, 1), (1, None), (2, 3), (2, 3), (2, 1), (3, None)],
        "day int, code int",
    )
    assert sorted(values(aggregates.most_frequent_by(rows, "day", "code"))) == [
        (1, 1),
        (2, 3),
        (3, None),
    ]


def test_mean_of_whole_parts(spark):
    rows = spark.createDataFrame([(1.9,), (2.9,), (-1.9,), (None,)], "v double")
    assert values(aggregates.mean_of(rows, "v")) == [(2 / 3,)]
    assert values(aggregates.mean_of(rows, "v", truncate=False))[0][0] == pytest.approx(2.9 / 3)
    assert values(aggregates.mean_of(rows.limit(0), "v")) == [(None,)]


def test_ratio_in_whole_percent(spark):
    rows = spark.createDataFrame([(1.9, 10.9), (2.9, 30.9)], "tip double, total double")
    assert values(trips.tip_ratio(rows)) == [(7,)]
    assert values(trips.tip_ratio(rows.limit(0))) == [(None,)]
    cancelled = spark.createDataFrame([(1.0, 5.0), (1.0, -5.0)], "tip double, total double")
    assert values(trips.tip_ratio(cancelled)) == [(None,)]


def test_share_of_all_rows(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "room_type string")
    shares = sorted(values(listings.room_type_share(rows)))
    assert shares == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert values(listings.room_type_share(rows.limit(0))) == []


def test_centroid(spark):
    rows = spark.createDataFrame(
        [("n", 1.0, 2.0), ("n", 2.0, 4.0), ("m", 5.0, 5.0)],
        "neighbourhood string, lat double, lon double",
    )
    assert sorted(values(listings.neighbourhood_centroid(rows))) == [
        ("m", 5.0, 5.0),
        ("n", 1.5, 3.0),
    ]


def test_total_by_lookup_is_join_then_total(spark, sales):
    lookup = spark.createDataFrame([(key, f"group {key % 4}") for key in range(40)], "key int, name string")
    early = joins.total_by_lookup(sales, lookup, "key", ["name"], {"total": "amount"})
    late = aggregates.total_by(sales.join(lookup, "key"), ["name"], {"total": "amount"})
    assert sorted(values(early)) == sorted(values(late))
    counted = joins.count_by_lookup(sales, lookup, "key", ["name"])
    assert sorted(values(counted)) == sorted(
        values(aggregates.count_by(sales.join(lookup, "key"), ["name"]))
    )


def test_inner_join_drops_customers_without_orders(spark):
    customers = spark.createDataFrame([(1, "A"), (2, "B")], "custkey int, name string")
    placed = spark.createDataFrame([(1, "x"), (1, ""), (3, "z")], "custkey int, comment string")
    rows = joins.join_records(customers, placed, "custkey", ["name", "comment"])
    assert sorted(values(rows)) == [("A", ""), ("A", "x")]


def test_hot_join_key_is_split_and_the_result_whole(spark):
    # Hashes do not compress, so the shuffle sizes follow the row counts.
    columns = ["IF(id % 3 = 0, 0, id) AS key", "id", "md5(CAST(id AS STRING)) AS hash"]
    facts = spark.range(60000).selectExpr(*columns)
    lookup = spark.range(60000).selectExpr("id AS key", "id % 10 AS kind")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = joins.join_records(facts, lookup, "key", ["id", "kind", "hash"])
        found = values(rows)
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    pairs = sorted((index, kind) for index, kind, _ in found)
    assert pairs == [(i, 0 if i % 3 == 0 else i % 10) for i in range(60000)]


def test_zone_demand_keeps_both_sides(spark):
    taken = spark.createDataFrame([(1,), (1,), (9,), (2,), (None,)], "zone_id int")
    zones = spark.createDataFrame(
        [(1, "Corona"), (2, "Corona"), (3, "Quiet")], "zone_id int, zone string"
    )
    assert values(trips.zone_demand(taken, zones)) == [
        (1, "Corona", 2),
        (None, None, 1),
        (2, "Corona", 1),
        (9, None, 1),
        (3, "Quiet", 0),
    ]


def test_labels_of_codes(spark):
    rows = spark.createDataFrame([(1,), (6,), (7,), (None,)], "code int")
    labels = values(rows.select(joins.label_of("code", trips.PAYMENT_LABELS)))
    assert labels == [("Credit Card",), ("Voided Trip",), (None,), (None,)]
    table = spark.createDataFrame([(1, "one")], "code int, label string")
    assert sorted(values(joins.with_label(rows.na.drop(), table, "code"))) == [
        (1, "one"),
        (6, None),
        (7, None),
    ]


def test_few_rows_are_completed_by_broadcasting_them(spark):
    few = spark.createDataFrame([(1, "first")], "key int, place string")
    lookup = spark.range(1000).selectExpr("CAST(id AS INT) AS key", "id * 2 AS twice")
    rows = joins.complete_few(few, lookup, "key")
    assert values(rows) == [(1, "first", 2)]
    assert "BuildLeft" in rows._jdf.queryExecution().executedPlan().toString()


def test_sort_is_total_and_breaks_ties_by_row_key(spark):
    rows = spark.createDataFrame([(1, 5), (3, 7), (2, 7), (4, 1)], "id int, v int")
    assert values(ordering.sort_rows(rows, "v", ["id"])) == [(4, 1), (1, 5), (2, 7), (3, 7)]
    descending = ordering.sort_rows(rows, "v", ["id"], descending=True)
    assert values(descending) == [(2, 7), (3, 7), (1, 5), (4, 1)]


@pytest.mark.parametrize(
    "kind, keys",
    [("int", [3, 1, 2]), ("bigint", [2**40, -1, 7]), ("string", ["b", "a", "é"])],
)
def test_descending_order_of_every_key_type(spark, kind, keys):
    rows = spark.createDataFrame([(key,) for key in keys], f"v {kind}")
    found = values(ordering.sort_rows(rows, "v", [], descending=True))
    assert found == [(key,) for key in sorted(keys, reverse=True)]


def test_rows_of_one_key_are_sorted_by_several_tasks(spark):
    rows = spark.range(20000).selectExpr("CAST(id AS INT) AS id", "'hot' AS key", "id % 7 AS value")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_key = aggregates.key_values(rows.repartition(4), "key", "value", ["id"])
        tasks = values(by_key.groupBy(F.spark_partition_id()).count())
        in_order = values(ordering.sort_rows(rows.repartition(4), "key", ["id"]), "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(count for _, count in tasks) < 10000
    assert in_order == [(index,) for index in range(20000)]


@pytest.mark.parametrize("k", [0, -1])
def test_a_k_below_one_is_one(sales, k):
    with pytest.warns(UserWarning, match="taken as 1"):
        rows = ordering.top_k(sales, "amount", ["id"], k)
    assert values(rows) == values(ordering.top_k(sales, "amount", ["id"], 1))


def test_top_k_with_fewer_rows_than_k(spark):
    rows = spark.createDataFrame([(1, 5), (2, 7)], "id int, v int")
    assert values(ordering.top_k(rows, "v", ["id"], 10)) == [(2, 7), (1, 5)]
    assert values(ordering.bottom_k(rows, "v", ["id"], 10, "rank")) == [(1, 5, 1), (2, 7, 2)]


def test_cheapest_listings_among_equal_prices(spark):
    rows = [(index, "Entire home/apt", 50.9) for index in range(30, 0, -1)]
    rows += [(31, "Entire home/apt", 49.0), (32, "Shared room", 1.0), (33, "Entire home/apt", None)]
    offers = spark.createDataFrame(rows, "id int, room_type string, price double")
    expected = [(31, 49)] + [(index, 50) for index in range(1, 10)]
    assert values(listings.cheapest_listings(offers)) == expected


def test_top_hosts(spark):
    rows = spark.createDataFrame([(2, "B"), (1, "A"), (2, "B"), (3, "C")], "host_id int, host_name string")
    assert values(listings.top_hosts(rows)) == [(2, "B", 2), (1, "A", 1), (3, "C", 1)]


def test_whole_profits_keep_the_rank_by_profit(spark):
    rows = spark.createDataFrame(
        [(1, "a", 9.2), (2, "b", 9.8), (3, "c", None), (4, "b", 9.8)],
        "row_id int, customer_id string, profit double",
    )
    best = orders.top_profits(rows, ["row_id"], 3)
    assert values(orders.whole_profits(best)) == [("b", 9), ("b", 9), ("a", 9)]


@pytest.fixture(scope="module")
def departures(spark):
    rows = [("OCCITANIE", "1", "1", "07:10:00"), ("OCCITANIE", "1", "1", "07:20:00")]
    rows += [("OCCITANIE", "12", "0", "25:05:00"), ("GARE", "2", "0", "07:00:00")]
    rows += [("GARE", "x", "1", "07:00:00")]
    rows += [("PORT", "10", "1", "08:00:00")] * 5 + [("PORT", "10", "0", "08:00:00")] * 10
    return spark.createDataFrame(
        rows, "stop_name string, route string, direction string, departure_time string"
    ).cache()


def test_services_of_one_stop(departures):
    assert sorted(values(transit.services_of_stop(departures))) == [
        ("07", "1", 2, "07h\tLigne 1"),
        ("25", "12", 1, "25h\tLigne 12"),
    ]


def test_vehicle_counts_ignore_a_route_that_is_no_number(departures):
    assert sorted(values(transit.vehicle_counts(departures))) == [
        ("GARE", 0, 1),
        ("OCCITANIE", 1, 2),
        ("PORT", 15, 0),
    ]


def test_top_stops_rank_ties_by_name_and_keep_zero_counts(departures):
    assert values(transit.top_stops(departures, "trams")) == [
        ("OCCITANIE", 2),
        ("GARE", 1),
        ("PORT", 0),
    ]
    assert values(transit.top_stops(departures, "buses", k=1)) == [("PORT", 15)]
    assert values(transit.top_stops(departures, "trams + buses"))[1:] == [
        ("OCCITANIE", 3),
        ("GARE", 1),
    ]


def test_stop_hour_traffic(departures):
    rows = transit.stop_hour_traffic(departures)
    texts = dict(values(rows, "stop_hour", "traffic"))
    assert texts == {
        "OCCITANIE(07h)": "trams=faible",
        "OCCITANIE(25h)": "bus=faible",
        "GARE(07h)": "trams=faible",
        "PORT(08h)": "bus=fort",
    }
    port = rows.filter("stop_name = 'PORT'").head()
    assert (port.buses_out, port.buses_back, port.buses_peak, port.trams_peak) == (5, 10, 10, 0)


def test_word_count_thresholds(spark):
    text = "data data data data\nmap map map map reduce  reduce\treduce four"
    rows = spark.createDataFrame([(text,)], "value string")
    assert sorted(values(words.word_count(rows))) == [("data", 4), ("reduce", 3)]
    everything = dict(values(words.word_count(rows, min_length=1, min_count=1)))
    assert everything == {"data": 4, "map": 4, "reduce": 3, "four": 1}


def test_word_length_counts_characters_not_bytes(spark):
    rows = spark.createDataFrame([("été été été déjà déjà déjà 日本語文 日本語文 日本語文",)], "value string")
    assert dict(values(words.word_count(rows))) == {"déjà": 3, "日本語文": 3}


def test_word_count_of_long_texts_is_whole(spark):
    generator = random.Random(3)
    texts = [
        " ".join(generator.choice(["alpha", "beta", "gamma", "no"]) for _ in range(20000))
        for _ in range(3)
    ]
    rows = spark.createDataFrame([(text,) for text in texts], "value string")
    expected = Counter(word for text in texts for word in text.split() if len(word) > 3)
    assert dict(values(words.word_count(rows))) == expected


def test_description_words_by_frequency(spark):
    rows = spark.createDataFrame([("Sea sea view",), ("SEA, view; bed",)], "description string")
    counted = words.description_word_count(rows, min_count=1)
    assert values(counted) == [("sea", 3), ("view", 2), ("bed", 1)]
    assert values(words.description_word_count(rows)) == []
    many = spark.createDataFrame([("sea " * 100 + "bed " * 101,)], "description string")
    assert values(words.description_word_count(many)) == [("bed", 101)]


def test_trip_reports(spark):
    rows = spark.createDataFrame(
        [
            ("2018-01-01 00:21:05", 5, 2.9, 1, 20.0),
            ("2018-02-01 00:59:59", 1, 1.1, 2, 10.9),
            ("2018-01-02 09:00:00", 6, 0.5, 2, 30.0),
            ("2018-01-03 13:00:00", 2, 0.5, 7, 30.0),
            ("2018-01-04 13:00:00", 2, 0.5, 1, 30.0),
        ],
        "pickup string, passengers int, distance double, payment_type int, total double",
    ).withColumn("pickup", F.col("pickup").cast("timestamp_ntz"))
    assert values(trips.passengers_by_hour(rows)) == [(0, 6), (9, 6), (13, 4)]
    assert values(trips.top_days_of_month(rows)) == [(1, 6), (2, 6), (3, 2)]
    assert values(trips.passenger_frequency(rows)) == [(2, 2), (1, 1), (5, 1), (6, 1)]
    assert sorted(values(trips.top_payment_by_day(rows))) == [
        (1, 1, "Credit Card"),
        (2, 2, "Cash"),
        (3, 7, None),
        (4, 1, "Credit Card"),
    ]
    assert values(trips.mean_distance(rows)) == [(0.6,)]
    assert values(trips.mean_price(rows)) == [(24.0,)]
