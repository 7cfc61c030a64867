"""Reports over transit departures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.constants import DEFAULT_STOP, OUTBOUND, TOP_ROWS
from sparktally.functions.dates import hour_prefix
from sparktally.functions.transit import (
    direction_name,
    is_tram,
    line_text,
    stop_hour_text,
    traffic_text,
)
from sparktally.operators.aggregates import count_by
from sparktally.operators.ordering import top_k


def services_of_stop(
    departures: DataFrame, name: str | int = DEFAULT_STOP, stop: str = "stop_name"
) -> DataFrame:
    """Services of one stop by hour and route."""
    at_stop = departures.filter(F.col(stop) == name)
    keys = [hour_prefix("departure_time").alias("hour"), F.col("route")]
    services = count_by(at_stop, keys, "services")
    return services.withColumn("line", line_text("hour", "route"))


def vehicle_counts(departures: DataFrame, stop: str = "stop_name") -> DataFrame:
    """Buses and trams of each stop. A route that is no number counts as neither."""
    tram = is_tram("route")
    return departures.groupBy(stop).agg(
        F.count_if(~tram).alias("buses"), F.count_if(tram).alias("trams")
    )


def top_stops(
    departures: DataFrame,
    by: Column | str,
    stop: str = "stop_name",
    k: int = TOP_ROWS,
    rank: str | None = None,
) -> DataFrame:
    """The stops with the most services, by an expression over ``buses`` and ``trams``.

    Stops with 0 services of the kind are ranked too.
    """
    services = F.expr(by) if isinstance(by, str) else by
    counts = vehicle_counts(departures, stop).select(stop, services.alias("services"))
    return top_k(counts, "services", [stop], k, rank)


def stop_hour_traffic(departures: DataFrame, stop: str = "stop_name") -> DataFrame:
    """Traffic class of trams and buses of each stop and hour, by the busier direction."""
    tram = is_tram("route")
    outbound = direction_name("direction") == OUTBOUND
    counts = departures.groupBy(stop, hour_prefix("departure_time").alias("hour")).agg(
        F.count_if(tram & outbound).alias("trams_out"),
        F.count_if(tram & ~outbound).alias("trams_back"),
        F.count_if(~tram & outbound).alias("buses_out"),
        F.count_if(~tram & ~outbound).alias("buses_back"),
    )
    peaks = counts.withColumns(
        {
            "trams_peak": F.greatest("trams_out", "trams_back"),
            "buses_peak": F.greatest("buses_out", "buses_back"),
        }
    )
    return peaks.withColumns(
        {
            "stop_hour": stop_hour_text(stop, "hour"),
            "traffic": traffic_text("trams_peak", "buses_peak"),
        }
    )
