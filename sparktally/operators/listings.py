"""Reports over accommodation listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.constants import DEFAULT_ROOM_TYPE, TOP_ROWS
from sparktally.functions.numbers import truncated
from sparktally.operators.aggregates import count_by, means_by, share_by
from sparktally.operators.ordering import bottom_k, sort_rows


def top_hosts(listings: DataFrame) -> DataFrame:
    """Listings by host, most listings first, then by host. A listing without a host is rejected."""
    listings = listings.filter("host_id IS NOT NULL")
    return most_listings_first(count_by(listings, ["host_id", "host_name"], "listings"))


def most_listings_first(counts: DataFrame) -> DataFrame:
    return sort_rows(counts, "listings", ["host_id", "host_name"], descending=True)


def cheapest_listings(
    listings: DataFrame,
    room_type: str = DEFAULT_ROOM_TYPE,
    k: int = TOP_ROWS,
    rank: str | None = None,
) -> DataFrame:
    """The ``k`` cheapest listings of a room type by whole price, then by id.

    A listing without a numeric id or price is no candidate.
    """
    wanted = listings.filter(F.col("room_type") == room_type)
    priced = wanted.select("id", truncated("price").alias("price")).na.drop()
    return bottom_k(priced, "price", ["id"], k, rank)


def room_type_share(listings: DataFrame) -> DataFrame:
    """Listings by room type and their share of all listings in percent."""
    return share_by(listings, "room_type", "listings", "share_pct")


def neighbourhood_centroid(listings: DataFrame, digits: int | None = None) -> DataFrame:
    """The mean position of the listings of each neighbourhood."""
    return means_by(listings, "neighbourhood", ["lat", "lon"], digits)
