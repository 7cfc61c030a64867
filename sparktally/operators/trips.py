"""Reports over taxi trips.

A trip without a valid time or number of passengers is rejected by reports grouped by it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.constants import PAYMENT_LABELS, TOP_DAYS
from sparktally.operators.aggregates import (
    count_by,
    mean_of,
    most_frequent_by,
    ratio_percent,
    total_by,
)
from sparktally.operators.joins import count_with_names, label_of
from sparktally.operators.ordering import sort_rows, top_k


def passengers_by_hour(trips: DataFrame) -> DataFrame:
    """Passengers by hour of day, busiest hour first, then by hour."""
    trips = trips.filter("pickup IS NOT NULL")
    totals = total_by(trips, [F.hour("pickup").alias("hour")], {"passengers": "passengers"})
    return sort_rows(totals, "passengers", ["hour"], descending=True)


def top_days_of_month(trips: DataFrame, k: int = TOP_DAYS, rank: str | None = None) -> DataFrame:
    """The days of the month, over all months, with the most passengers."""
    trips = trips.filter("pickup IS NOT NULL")
    totals = total_by(trips, [F.dayofmonth("pickup").alias("day")], {"passengers": "passengers"})
    return top_k(totals, "passengers", ["day"], k, rank)


def top_payment_by_day(
    trips: DataFrame, labels: Mapping[int, str] = PAYMENT_LABELS
) -> DataFrame:
    """The most used payment of each day of the month; a tie goes to the lowest code."""
    trips = trips.filter("pickup IS NOT NULL")
    by_day = trips.select(F.dayofmonth("pickup").alias("day"), "payment_type")
    best = most_frequent_by(by_day, "day", "payment_type")
    return best.withColumn("payment", label_of("payment_type", labels))


def zone_demand(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips by pickup zone with the zone's name, in descending order of demand.

    Zones are matched by id: several share a name.
    """
    return count_with_names(trips, zones, "zone_id", "zone", "trips")


def passenger_frequency(trips: DataFrame) -> DataFrame:
    """Trips by number of passengers, most frequent first, then by number."""
    known = trips.filter("passengers IS NOT NULL")
    return sort_rows(count_by(known, ["passengers"], "trips"), "trips", ["passengers"], True)


def tip_ratio(trips: DataFrame, truncate: bool = True) -> DataFrame:
    """Tips in whole percent of the totals."""
    return ratio_percent(trips, "tip", "total", "tip_pct", truncate)


def mean_distance(trips: DataFrame, truncate: bool = True) -> DataFrame:
    return mean_of(trips, "distance", "mean_distance", truncate)


def mean_price(trips: DataFrame, truncate: bool = True) -> DataFrame:
    return mean_of(trips, "total", "mean_price", truncate)
