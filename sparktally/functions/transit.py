"""Labels of the transit reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.constants import (
    BUS_PREFIX,
    HIGH_TRAFFIC,
    INBOUND,
    LAST_TRAM_ROUTE,
    LOW_TRAFFIC,
    LOW_TRAFFIC_MAX,
    MEDIUM_TRAFFIC,
    MEDIUM_TRAFFIC_MAX,
    OUTBOUND,
    OUTBOUND_CODE,
    TRAM_PREFIX,
)
from sparktally.functions.numbers import as_column, number_or_null


def is_tram(route: Column | str) -> Column:
    """True for a tram route, false for a bus route, NULL if the route is no number."""
    return number_or_null(route, "int") <= LAST_TRAM_ROUTE


def vehicle(route: Column | str) -> Column:
    tram = is_tram(route)
    return F.when(tram, "tram").when(~tram, "bus")


def direction_name(code: Column | str) -> Column:
    outbound = as_column(code).cast("string") == OUTBOUND_CODE
    return F.when(outbound, OUTBOUND).otherwise(INBOUND)


def traffic_class(services: Column | str) -> Column:
    count = as_column(services)
    return (
        F.when(count <= LOW_TRAFFIC_MAX, LOW_TRAFFIC)
        .when(count <= MEDIUM_TRAFFIC_MAX, MEDIUM_TRAFFIC)
        .otherwise(HIGH_TRAFFIC)
    )


def traffic_text(trams: Column | str, buses: Column | str) -> Column:
    """``trams=<class>`` and ``bus=<class>``, tab-separated; a kind without services is left out."""
    trams, buses = as_column(trams), as_column(buses)
    return F.concat_ws(
        "\t",
        F.when(trams > 0, F.concat(F.lit(TRAM_PREFIX), traffic_class(trams))),
        F.when(buses > 0, F.concat(F.lit(BUS_PREFIX), traffic_class(buses))),
    )


def stop_hour_text(stop: Column | str, hour: Column | str) -> Column:
    return F.concat(as_column(stop).cast("string"), F.lit("("), as_column(hour), F.lit("h)"))


def line_text(hour: Column | str, route: Column | str) -> Column:
    return F.concat(as_column(hour), F.lit("h\tLigne "), as_column(route).cast("string"))
