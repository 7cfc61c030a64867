"""Delimited files whose columns are told by their header, not by their place.

A layout names the columns of a table, their types and the names that a header may give them. The
header of each file is read on the driver; files with the same header are one scan, in which each
column has its type. So columns may come in any order, and a folder may hold files of several tables.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparktally.sources import schemas
from sparktally.sources.folders import files_in, first_lines


class UnknownHeader(ValueError):
    """Files whose header lacks columns of the layout."""


def plain_name(name: str) -> str:
    """A header's name in lower case, with one underscore for whatever is no letter or digit."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


@dataclass(frozen=True)
class Layout:
    """Columns in the order of ``schema``; ``names`` has what a header may call them besides."""

    schema: str
    separator: str = ","
    names: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)

    def types(self) -> dict[str, str]:
        fields = StructType.fromDDL(self.schema).fields
        return {f.name: f.dataType.simpleString() for f in fields}

    def columns_of(self, header: str) -> list[str]:
        """Our names of the header's columns, NULL-free; those that we do not know as they are."""
        (fields,) = csv.reader([header], delimiter=self.separator)
        plain = [plain_name(name) for name in fields]
        return [self.names.get(name, name) for name in plain]

    def lacks(self, header: str) -> list[str]:
        found = self.columns_of(header)
        return [name for name in self.types() if name not in found]


# The headers that the public files of these tables have, beside our own names.
ORDER_LINES = Layout(schemas.ORDER_LINES)
DEPARTURES = Layout(
    schemas.DEPARTURES,
    ";",
    {
        "route_short_name": "route",
        "trip_headsign": "headsign",
        "direction_id": "direction",
    },
)
TRIPS = Layout(
    schemas.TRIPS,
    names={
        "vendorid": "vendor_id",
        "tpep_pickup_datetime": "pickup",
        "tpep_dropoff_datetime": "dropoff",
        "passenger_count": "passengers",
        "trip_distance": "distance",
        "ratecodeid": "rate_code",
        "store_and_fwd_flag": "stored",
        "pulocationid": "zone_id",
        "dolocationid": "dropoff_zone_id",
        "fare_amount": "fare",
        "mta_tax": "tax",
        "tip_amount": "tip",
        "tolls_amount": "tolls",
        "improvement_surcharge": "surcharge",
        "total_amount": "total",
    },
    options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"},
)
ZONES = Layout(schemas.ZONES, names={"locationid": "zone_id"})
LISTINGS = Layout(
    schemas.LISTINGS.replace("malformed STRING", "").rstrip().rstrip(","),
    names={
        "name": "description",
        "latitude": "lat",
        "longitude": "lon",
        "number_of_reviews": "reviews",
        "calculated_host_listings_count": "host_listings",
        "availability_365": "availability",
    },
)


def files_by_header(spark: SparkSession, path: str, files: str = "*") -> dict[str, list[str]]:
    """The files of a folder by their first line."""
    names = files_in(spark, path, files)
    found: dict[str, list[str]] = defaultdict(list)
    for name, header in zip(names, first_lines(spark, names), strict=True):
        found[header].append(name)
    return dict(found)


def read_by_header(
    spark: SparkSession, path: str, layout: Layout, files: str = "*", others: list[Layout] | None = None
) -> DataFrame:
    """The rows of the files that have the layout, in the layout's columns and types.

    A file with none of the layout's columns missing may have more, in any order. Others must
    have one of the layouts ``others``, and are left to it; else they are an ``UnknownHeader``,
    with the names of the file, of what it lacks and of what it has.
    """
    groups = files_by_header(spark, path, files)
    mine: list[tuple[str, list[str]]] = []
    for header, names in groups.items():
        if not layout.lacks(header):
            mine.append((header, names))
        elif not any(not other.lacks(header) for other in others or []):
            raise UnknownHeader(
                f"{names[0]} lacks {', '.join(layout.lacks(header))}; it has {', '.join(layout.columns_of(header))}"
            )
    if not mine:
        return spark.createDataFrame([], layout.schema)
    return reduce(DataFrame.unionByName, [_scan(spark, layout, *group) for group in mine])


def _scan(spark: SparkSession, layout: Layout, header: str, files: list[str]) -> DataFrame:
    types, schema = layout.types(), []
    for place, name in enumerate(layout.columns_of(header)):
        # The first column of a name counts; further ones and unknown ones are not read.
        is_new = name in types and all(f"`{name}` " not in part for part in schema)
        schema.append(f"`{name}` {types[name]}" if is_new else f"_{place} STRING")
    options = {"sep": layout.separator, "header": True, "quote": '"', "escape": '"', **layout.options}
    return spark.read.options(**options).schema(", ".join(schema)).csv(files).select(*types)


def fields_by_header(layout: Layout, fields: str, header: str) -> dict[str, F.Column]:
    """Each column of the layout from the arrays of a record's fields and of its file's header."""
    plain = F.transform(header, lambda n: F.trim(F.regexp_replace(F.lower(n), "[^a-z0-9]+", "_"), F.lit("_")))

    def column(name: str) -> F.Column:
        known = [name, *(other for other, ours in layout.names.items() if ours == name)]
        places = [F.nullif(F.array_position(plain, other), F.lit(0)) for other in known]
        return F.get(F.col(fields), F.coalesce(*places).cast("int") - 1)

    return {name: column(name) for name in layout.types()}
