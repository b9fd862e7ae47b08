"""Economic indicator records into one long table."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import parse_day_first, safe_cast

# Series name and its number at the central bank.
SERIES = {
    "exchange_rate_usd": 1,
    "ipca": 433,
    "selic": 4189,
    "igpm": 189,
    "exchange_commercial": 12,
}


class EmptySeriesError(ValueError):
    """A series without a single record."""


def read_indicator_series(
    spark: SparkSession,
    path: str,
    series: str,
    start: str | None = None,
    end: str | None = None,
    extracted_at: Column | None = None,
) -> DataFrame:
    """JSON records {data: 'DD/MM/YYYY', valor: '3.14'} as typed rows of one series.

    A value that is no number becomes NULL, a date that is no date raises. ``start`` and
    ``end`` ('DD/MM/YYYY') bound the dates, both inclusive.
    """
    if series not in SERIES:
        raise ValueError(f"unknown series {series!r}: one of {', '.join(SERIES)}")
    rows = spark.read.schema("data STRING, valor STRING").json(path).select(
        parse_day_first(F.col("data")).alias("data"),
        safe_cast(F.col("valor"), "double").alias("valor"),
        F.lit(series).alias("series_name"),
        F.lit(SERIES[series]).cast("bigint").alias("series_id"),
        (F.current_timestamp() if extracted_at is None else extracted_at).alias("extracted_at"),
    )
    if start is not None:
        rows = rows.where(F.col("data") >= parse_day_first(F.lit(start)))
    if end is not None:
        rows = rows.where(F.col("data") <= parse_day_first(F.lit(end)))
    return rows


def union_series(dfs: Sequence[DataFrame | None]) -> DataFrame | None:
    """All series below each other; None if there are none."""
    found = [df for df in dfs if df is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def read_all_series(
    spark: SparkSession,
    paths: Mapping[str, str],
    start: str | None = None,
    end: str | None = None,
    skip_failed: bool = False,
) -> DataFrame | None:
    """Every series, below each other; None if there is none.

    A series without a file, without records between ``start`` and ``end`` or with an
    unreadable date raises. With ``skip_failed`` it is left out and logged instead, and the
    others are not affected.
    """
    found = []
    for name, path in paths.items():
        try:
            rows = read_indicator_series(spark, path, name, start, end)
            # Parsing every date now decides whether the series can be used at all.
            if not rows.agg(F.count("data")).first()[0]:
                raise EmptySeriesError(f"series {name} has no records")
            found.append(rows)
        except (PySparkException, EmptySeriesError) as error:
            if not skip_failed:
                raise
            logging.getLogger(__name__).warning("series %s left out: %s", name, error)
    return union_series(found)
