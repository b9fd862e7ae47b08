"""Joining sales to economic indicator series.

Indicator tables hold one row per series and day or month, a few thousand rows per decade
whatever the sales volume, so Spark broadcasts them by its own size check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.scalars import month_of, unit_mean, units
from tradewind.operators.asof import asof_join

FX_SERIES = "exchange_rate_usd"


def series(ind: DataFrame, name: str, value: str) -> DataFrame:
    """One series as (indicator_date, ``value``)."""
    return ind.where(F.col("series_name") == name).select(
        "indicator_date", F.col("indicator_value").alias(value)
    )


def ffill_daily(ind: DataFrame, name: str, start=None, end=None) -> DataFrame:
    """One row per day with the last published value of the series.

    Runs from the first observation (or ``start``) to ``end``, by default today, so that
    days after the last observation keep its value. Days before the first have none.
    """
    rows = series(ind, name, "indicator_value")
    first = F.min("indicator_date") if start is None else F.lit(start).cast("date")
    last = F.greatest(F.max("indicator_date"), F.current_date()) if end is None else F.lit(end).cast("date")
    days = rows.agg(first.alias("a"), last.alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("indicator_date")
    )
    # Observations before ``start`` still feed the fill, hence the full join.
    line = days.withColumn("asked", F.lit(True)).join(rows, "indicator_date", "full")
    so_far = (
        Window.partitionBy(F.lit(name))
        .orderBy("indicator_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        line.withColumn("indicator_value", F.last("indicator_value", ignorenulls=True).over(so_far))
        .where("asked")
        .select("indicator_date", "indicator_value")
    )


def with_fx(
    df: DataFrame,
    date_col: str,
    ind: DataFrame,
    policy: str = "exact",
    name: str = "usd_brl_rate",
    end=None,
) -> DataFrame:
    """Add the exchange rate of the day.

    ``exact`` leaves days without a published rate NULL; ``ffill`` carries the last one, up to
    ``end``, by default today or the last observation.
    """
    rates = series(ind, FX_SERIES, name)
    if policy == "exact":
        return df.join(rates.withColumnRenamed("indicator_date", date_col), date_col, "left")
    if policy != "ffill":
        raise ValueError(f"unknown policy {policy!r}: use 'exact' or 'ffill'")
    known = asof_join(df, rates.where(F.col(name).isNotNull()), date_col, "indicator_date")
    if end is None:
        last = F.greatest(rates.agg(F.max("indicator_date")).scalar(), F.current_date())
    else:
        last = F.lit(end).cast("date")
    return known.withColumn(name, F.when(F.col(date_col) <= last, F.col(name)))


def with_monthly(
    df: DataFrame,
    date_col: str,
    ind: DataFrame,
    names: Mapping[str, str],
    dedupe: str | None = None,
) -> DataFrame:
    """Add monthly series, matched on the month; ``names`` maps series to new column.

    A series with several rows in a month repeats the left row for each of them. To keep
    one row, pass ``dedupe='first'`` (earliest) or ``'avg'``.
    """
    out = df.withColumn("_month", month_of(F.col(date_col)))
    for source, column in names.items():
        rows = series(ind, source, column).withColumn("_month", month_of(F.col("indicator_date")))
        if dedupe == "first":
            rows = rows.groupBy("_month").agg(F.min_by(column, "indicator_date").alias(column))
        elif dedupe == "avg":
            rows = rows.groupBy("_month").agg(unit_mean(units(F.col(column))).cast("double").alias(column))
        elif dedupe is not None:
            raise ValueError(f"unknown dedupe {dedupe!r}: use None, 'first' or 'avg'")
        out = out.join(rows.select("_month", column), "_month", "left")
    return out.drop("_month")


def widen(ind: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row per date, one column per series, from a single scan."""
    columns = [
        F.max(F.when(F.col("series_name") == source, F.col("indicator_value"))).alias(column)
        for source, column in names.items()
    ]
    return (
        ind.where(F.col("series_name").isin(list(names)))
        .groupBy("indicator_date")
        .agg(*columns)
    )
