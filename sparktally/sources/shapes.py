"""Customers and orders in one folder, told apart by the shape of their lines.

A line of a customer has eight fields, one of an order nine; both end in a delimiter. An empty last
field counts like any other. Fields are not quoted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparktally.sources import schemas


class MixedLines:
    """The lines of a folder, each a customer, an order or neither."""

    def __init__(self, spark: SparkSession, path: str, files: str = "*") -> None:
        scanned = spark.read.option("pathGlobFilter", files).text(path)
        lines = scanned.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("value").alias("line"),
            F.split("value", r"\|", -1).alias("fields"),
        )
        self.lines = lines.filter("line <> ''")

    def customers(self) -> DataFrame:
        return self._of(schemas.CUSTOMERS)

    def orders(self) -> DataFrame:
        return self._of(schemas.ORDERS)

    def others(self) -> DataFrame:
        """``file`` and ``line`` of lines of neither shape."""
        shapes = [len(StructType.fromDDL(s)) for s in (schemas.CUSTOMERS, schemas.ORDERS)]
        ended = F.element_at("fields", -1) == ""
        return self.lines.filter(~(F.size("fields").isin(shapes) & ended)).select("file", "line")

    def _of(self, schema: str) -> DataFrame:
        """Typed by position; a value that does not fit its type is NULL, as is an empty one."""
        fields = StructType.fromDDL(schema).fields
        shaped = self.lines.filter((F.size("fields") == len(fields)) & (F.element_at("fields", -1) == ""))
        return shaped.select(
            *[
                F.nullif(F.get("fields", place), F.lit("")).try_cast(f.dataType.simpleString()).alias(f.name)
                for place, f in enumerate(fields[:-1])
            ]
        )
