from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktally.functions import dates, numbers, text, transit


def evaluate(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("out")).head().out


@pytest.mark.parametrize(
    "value, expected", [("12.5", 12.5), ("-3", -3.0), ("abc", 0.0), ("", 0.0), (None, 0.0)]
)
def test_number_or_zero(spark, value, expected):
    assert evaluate(spark, value, numbers.number_or_zero("v")) == expected


def test_number_or_zero_of_an_integer_rejects_a_fraction(spark):
    assert evaluate(spark, "2.5", numbers.number_or_zero("v", "decimal(4,2)")) == Decimal("2.50")
    assert evaluate(spark, "x", numbers.number_or_zero("v", "int")) == 0


@pytest.mark.parametrize("value, expected", [(2.9, 2), (-2.9, -2), (0.0, 0), (None, None)])
def test_truncation_goes_toward_zero(spark, value, expected):
    assert evaluate(spark, value, numbers.truncated("v"), "double") == expected


@pytest.mark.parametrize(
    "part, whole, expected",
    [(7, 200, 3), (-7, 200, -3), (1, 0, None), (9 * 10**18, 9 * 10**18, 100)],
)
def test_whole_percent(spark, part, whole, expected):
    rows = spark.createDataFrame([(part, whole)], "part bigint, whole bigint")
    out = rows.select(numbers.whole_percent(F.col("part"), F.col("whole")).alias("out"))
    assert out.head().out == expected


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=30))
def test_sums_in_parts_are_exact_beyond_a_bigint(spark, amounts):
    rows = spark.createDataFrame([(amount,) for amount in amounts], "v bigint")
    parts = numbers.bit_parts("v")
    sums = rows.agg(*(F.sum(value).alias(name) for name, value in parts.items()))
    assert sums.select(numbers.from_bit_parts().alias("out")).head().out == sum(amounts)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=30))
def test_scaled_amounts_are_exact(spark, cents):
    rows = spark.createDataFrame([(amount / 100,) for amount in cents], "v double")
    assert [row.out for row in rows.select(numbers.scaled("v").alias("out")).collect()] == cents


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1/30/16", datetime.date(2016, 1, 30)),
        ("1/5/16", datetime.date(2016, 1, 5)),
        ("12/31/99", datetime.date(1999, 12, 31)),
        ("2/29/96", datetime.date(1996, 2, 29)),
        ("1/30/2016", datetime.date(2016, 1, 30)),
        ("11/8/45", datetime.date(2045, 11, 8)),
        ("11/8/46", datetime.date(1946, 11, 8)),
        ("13/1/16", None),
        ("2/30/16", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_short_dates(spark, value, expected):
    as_of = datetime.date(2026, 6, 1)
    assert evaluate(spark, value, dates.parse_short_date("v", as_of)) == expected


def test_sortable_date(spark):
    column = dates.sortable_date(dates.parse_short_date("v"))
    assert evaluate(spark, "1/3/16", column) == "2016/01/03"


@pytest.mark.parametrize("value, expected", [("07:15:00", "07"), ("25:01:00", "25"), ("", "")])
def test_hour_prefix(spark, value, expected):
    assert evaluate(spark, value, dates.hour_prefix("v")) == expected


def test_field_out_of_range_is_empty(spark):
    assert evaluate(spark, "a-b", dates.field("v", "-", 2)) == "b"
    assert evaluate(spark, "a-b", dates.field("v", "-", 3)) == ""


def test_words_between_whitespace(spark):
    words = evaluate(spark, " one  two\tthree\nfour ", text.words_of_text("v"))
    assert words == ["", "one", "two", "three", "four", ""]


def test_markup_words_lose_punctuation_before_tags(spark):
    record = '<p class="a1">Hello,&nbsp;World! 42</p> <b>No. 7</b>'
    words = [word for word in evaluate(spark, record, text.words_of_markup("v")) if word]
    assert words == ["Hello", "World", "No"]


def test_markup_keeps_case_and_a_tag_left_open(spark):
    words = [word for word in evaluate(spark, "Été été <a href", text.words_of_markup("v")) if word]
    assert words == ["Été", "été", "<a", "href"]


def test_description_words(spark):
    record = "L'été: 3 Rooms, \"cosy\"—near the Sea!"
    words = [word for word in evaluate(spark, record, text.words_of_description("v")) if word]
    assert words == ["l", "t", "rooms", "cosy", "near", "the", "sea"]


@pytest.mark.parametrize(
    "count, expected",
    [(0, "faible"), (4, "faible"), (5, "moyen"), (9, "moyen"), (10, "fort"), (99, "fort")],
)
def test_traffic_class_edges(spark, count, expected):
    assert evaluate(spark, count, transit.traffic_class("v"), "int") == expected


@pytest.mark.parametrize("route, expected", [("4", "tram"), ("5", "bus"), ("x", None)])
def test_vehicle_of_route(spark, route, expected):
    assert evaluate(spark, route, transit.vehicle("v")) == expected


@pytest.mark.parametrize("code, expected", [("1", "aller"), ("0", "retour"), ("x", "retour")])
def test_direction_name(spark, code, expected):
    assert evaluate(spark, code, transit.direction_name("v")) == expected


@pytest.mark.parametrize(
    "trams, buses, expected",
    [(3, 12, "trams=faible\tbus=fort"), (0, 5, "bus=moyen"), (5, 0, "trams=moyen"), (0, 0, "")],
)
def test_traffic_text_leaves_out_a_kind_without_services(spark, trams, buses, expected):
    rows = spark.createDataFrame([(trams, buses)], "trams int, buses int")
    assert rows.select(transit.traffic_text("trams", "buses").alias("out")).head().out == expected
