"""Known results over small files of the shipped shapes, and over shipped inputs if given.

The tests over shipped inputs exist only if their environment variable names the folder:
GOLDEN_ORDERS the one with 500 customers and 5,000 orders, GOLDEN_FEW_ORDERS the one with 100
customers and 9 orders, GOLDEN_ZONES the one of the zone lookup, GOLDEN_TEXT the second of the
two word-count folders (one text of 16 frequent words), GOLDEN_HTML the one with a web page.
Their expected values are those of ``FIXTURES.md``.
"""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from sparktally.plans.programs import PROGRAMS
from sparktally.sources import readers


def folder(variable: str) -> str:
    return os.environ[variable]


def given(variable: str):
    """Keeps a test only if its variable is set."""
    return lambda test: test if os.environ.get(variable) else None


@pytest.fixture
def small_orders(write_file):
    write_file("1|Ann|x|1|p|10.50|AUTO|a \"quote\"|\n2|Bo|y|2|p|0.00|AUTO|b|\n3|Cy|z|3|p|1.00|AUTO||\n", "customer.tbl")
    return write_file(
        "10|1|O|100.10|2020-01-02|1-URGENT|c|0|first|\n11|1|O|0.20|2020-01-03|2-HIGH|c|0|second|\n"
        "12|2|F|-5.00|2020-01-04|2-HIGH|c|0|z|\n13|2|F|5.00|2020-01-05|2-HIGH|c|0|z|\n14|9|F|7.00|2020-01-05|2-HIGH|c|0|none|\n",
        "orders.tbl",
    )


def test_small_orders(spark, small_orders):
    joined = PROGRAMS["join_customer_orders"](spark, small_orders)
    assert sorted(values(joined)) == [("Ann", "first"), ("Ann", "second"), ("Bo", "z"), ("Bo", "z")]
    totals = sorted(values(PROGRAMS["customer_order_total"](spark, small_orders)))
    assert totals == [(1, "Ann", Decimal("100.30")), (2, "Bo", Decimal("0.00"))]
    nonzero = values(PROGRAMS["customer_order_total_nonzero"](spark, small_orders))
    assert nonzero == [(1, "Ann", Decimal("100.30"))]


def test_small_zones(spark, write_file):
    path = write_file(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
        '2,"Queens","Corona","Boro Zone"\n3,"Queens","Corona","Boro Zone"\n'
    )
    zones = readers.read_zones(spark, path)
    assert dict(values(zones.groupBy("borough").count())) == {"EWR": 1, "Queens": 2}


def test_small_texts(spark, write_file):
    path = write_file("data of clusters\ndata, data nodes\tdata\nclusters clusters the the the\n", "t.txt")
    assert sorted(values(PROGRAMS["word_count"](spark, path))) == [("clusters", 3), ("data", 3)]
    page = write_file("<p>les villes</p>\n<b class=x>les</b> des\n", "page.html", "html")
    assert sorted(values(PROGRAMS["html_word_count"](spark, page))) == [("des", 1), ("les", 2), ("villes", 1)]


@given("GOLDEN_ORDERS")
def test_orders(spark):
    path = folder("GOLDEN_ORDERS")
    assert readers.read_customers(spark, path).count() == 500
    assert readers.read_orders(spark, path).count() == 5000
    assert PROGRAMS["join_customer_orders"](spark, path).count() == 20
    totals = {key: total for key, _, total in values(PROGRAMS["customer_order_total"](spark, path))}
    assert len(totals) == 20
    assert sum(totals.values()) == Decimal("2684160.31")
    expected = {
        25: "32275.72", 58: "95297.48", 67: "269000.36", 88: "35524.49",
        49810: "66276.68", 49814: "111044.97", 149984: "203097.32",
    }
    assert {key: str(totals[key]) for key in expected} == expected


@given("GOLDEN_FEW_ORDERS")
def test_few_orders(spark):
    path = folder("GOLDEN_FEW_ORDERS")
    assert PROGRAMS["join_customer_orders"](spark, path).count() == 9
    totals = {key: str(total) for key, _, total in values(PROGRAMS["customer_order_total"](spark, path))}
    assert totals == {1: "336909.45", 24: "193846.25", 38: "696225.50", 50: "46929.18"}


@given("GOLDEN_ZONES")
def test_zones(spark):
    zones = readers.read_zones(spark, folder("GOLDEN_ZONES"))
    assert dict(values(zones.groupBy("borough").count())) == {
        "Bronx": 43, "Brooklyn": 61, "EWR": 1, "Manhattan": 69, "Queens": 69,
        "Staten Island": 20, "Unknown": 2,
    }
    assert values(zones.filter("zone_id = 1"), "zone") == [("Newark Airport",)]


@given("GOLDEN_TEXT")
def test_words(spark):
    counts = dict(values(PROGRAMS["word_count"](spark, folder("GOLDEN_TEXT"))))
    assert len(counts) == 16
    assert (counts["Apache"], counts["data"], counts["that"], counts["with"]) == (14, 8, 5, 3)


@given("GOLDEN_HTML")
def test_markup_words(spark):
    counts = PROGRAMS["html_word_count"](spark, folder("GOLDEN_HTML"))
    assert values(counts.agg(F.count("*"), F.sum("count"))) == [(497, 1079)]
    assert dict(values(counts))["des"] == 26
