"""Result writers. Each task writes its own file; nothing is gathered."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_folder(base: str, name: str) -> str:
    """A fresh folder for one run: the name with the seconds since 1970 and a random part."""
    return f"{base.rstrip('/')}/{name}-{int(time.time())}-{uuid.uuid4().hex[:8]}"


def write_tab_separated(rows: DataFrame, path: str) -> None:
    """Tab-separated text, NULL as nothing. An existing folder is an error, not overwritten.

    Values are written as they are, tabs and quotes included.
    """
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in rows.columns]
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.mode("errorifexists").text(path)


def write_parquet(rows: DataFrame, path: str) -> None:
    """Parquet, the choice for results that are read again."""
    rows.write.mode("errorifexists").parquet(path)
