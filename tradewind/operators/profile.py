"""Counts, null counts, repeats, distributions: what a table looks like."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.medians import medians


def _rows(one_row: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """Turn the columns of a single aggregated row into rows."""
    return one_row.select(F.inline(F.array(*cells)))


def table_stats(df: DataFrame, series_col: str, date_col: str, ts_col: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct(series_col).alias("series_count"),
        F.min(date_col).alias("earliest_date"),
        F.max(date_col).alias("latest_date"),
        F.max(ts_col).alias("extraction_time"),
    )


def row_counts(tables: Mapping[str, DataFrame], total: bool = True) -> DataFrame:
    """(table_name, row_count) per table, and a 'total' row."""
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ],
    )
    if not total:
        return counts
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.coalesce("table_name", F.lit("total")).alias("table_name"), "row_count")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls), from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _rows(
        counted, [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    )


def completeness(df: DataFrame) -> DataFrame:
    """Share of non-null cells."""
    filled = reduce(Column.__add__, [F.count(c) for c in df.columns])
    cells = F.count(F.lit(1)) * F.lit(len(df.columns))
    return df.agg((filled / F.nullif(cells, F.lit(0))).alias("completeness"))


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """(duplicated, row_count): how many rows repeat an earlier one, and how many do not."""
    groups = df.groupBy(*(subset or df.columns)).count()
    counted = groups.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("again"), F.count(F.lit(1)).alias("once")
    )
    return _rows(
        counted,
        [
            F.struct(F.lit(flag).alias("duplicated"), F.col(c).alias("row_count"))
            for flag, c in ((True, "again"), (False, "once"))
        ],
    )


def profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, row_count, column_count) for every column."""
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("row_count"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for f in df.schema.fields
    ]
    return _rows(df.agg(F.count(F.lit(1)).alias("n")), cells)


def month_bounds(df: DataFrame, col: str = "order_month") -> DataFrame:
    return df.agg(F.min(col).alias("min_month"), F.max(col).alias("max_month"))


def series_summary(df: DataFrame, series_col: str = "series_name", date_col: str = "data") -> DataFrame:
    """Records and date range per series."""
    return df.where(F.col(series_col).isNotNull()).groupBy(series_col).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Non-null values with their count, most frequent first."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), col)
    )


def mean_rating(df: DataFrame, group: str = "product_category_english", score: str = "review_score") -> DataFrame:
    """Mean score per category to three digits, half-way cases to even."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.bround(F.avg(score), 3).alias("avg_rating")
    )


def median_payment(
    df: DataFrame,
    group: str = "product_category_english",
    value: str = "payment_value",
    exact_median: bool = True,
) -> DataFrame:
    """Median payment per category as a whole number, half-way cases to even."""
    middle = medians(df, [group], [value], exact=exact_median)
    return middle.select(group, F.bround(value, 0).cast("bigint").alias("median_payment"))


def top_bottom(df: DataFrame, col: str, k: int = 10, largest: bool = True) -> DataFrame:
    """The ``k`` rows with the largest or smallest ``col``; ties by the other columns."""
    order = F.col(col).desc_nulls_last() if largest else F.col(col).asc_nulls_last()
    ties = [c for c in df.columns if c != col]
    return df.where(F.col(col).isNotNull()).orderBy(order, *ties).limit(k)


def peek(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The first ``n`` rows by ``key``, or any ``n`` rows."""
    return df.orderBy(*key).limit(n) if key else df.limit(n)


def sample_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` rows drawn at random without replacement."""
    return df.orderBy(F.rand(seed)).limit(n)
