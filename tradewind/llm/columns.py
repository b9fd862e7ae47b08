"""Column names of tables that may have any columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare_name(df: DataFrame, made: str) -> str:
    """``made``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while made.lower() in taken:
        made += "_"
    return made


def all_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
