"""Data tests: rows that break a rule, a fused run over many rules, and a verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import elapsed


class Check(NamedTuple):
    """One declared test. ``arg`` holds the values, expression or parent it needs."""

    table: str
    column: str
    kind: str
    severity: str = "warn"
    arg: object = None

    @property
    def name(self) -> str:
        if self.kind == "expression":
            return f"{self.table}.{self.column}: {self.arg}"
        return f"{self.table}.{self.column}: {self.kind}"


def _breaks(check: Check) -> Column | None:
    """True for a row that breaks the rule; None for rules about more than one row."""
    col = F.col(check.column)
    if check.kind == "not_null":
        return col.isNull()
    if check.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(list(check.arg))
    if check.kind == "expression":
        return ~F.expr(str(check.arg))
    if check.kind == "range":
        return ~col.between(*check.arg)
    return None


def _rows(copies: str | None) -> Column:
    """How many rows a group stands for; ``copies`` names the column of a table that counts equal rows."""
    return F.count(F.lit(1)) if copies is None else F.sum(copies)


def _failing(rule: Column, copies: str | None) -> Column:
    return F.count_if(rule) if copies is None else F.coalesce(F.sum(F.when(rule, F.col(copies))), F.lit(0))


def unique(df: DataFrame, cols: str | Sequence[str], copies: str | None = None) -> DataFrame:
    """Values (or combinations) that occur more than once, with their count."""
    keys = [cols] if isinstance(cols, str) else list(cols)
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(_rows(copies).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(_breaks(Check("", col, "not_null")))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows with another value; NULL is accepted."""
    return df.where(_breaks(Check("", col, "accepted_values", arg=values)))


def expression_is_true(df: DataFrame, expr: str) -> DataFrame:
    """Rows for which the expression is false; an unknown outcome is no failure."""
    return df.where(~F.expr(expr))


def in_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(_breaks(Check("", col, "range", arg=(lo, hi))))


def relationships(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent lacks; NULL keys are left out."""
    known = parent.select(F.col(key).alias(col)).distinct()
    return child.where(F.col(col).isNotNull()).join(known, col, "left_anti")


def valid_numeric(df: DataFrame, col: str) -> DataFrame:
    """One row of counts if any value of the column is missing, else none."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count(F.lit(1)) - F.count(col)).alias("invalid_rows"),
    )
    return counts.where(F.col("invalid_rows") > 0).select(
        F.lit("Data type violation detected").alias("error_message"), "invalid_rows", "total_rows"
    )


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def _orphans(tables: Mapping[str, DataFrame], check: Check, copies: str | None) -> DataFrame:
    """Count of child rows without a parent, from keys that are counted before the join."""
    parent, key = check.arg
    keys = (
        tables[check.table]
        .where(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("k"))
        .agg(_rows(copies).alias("n"))
    )
    known = tables[parent].select(F.col(key).alias("k")).distinct()
    lone = keys.join(known, "k", "left_anti")
    return lone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], copies: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per check: (check_name, table_name, column_name, severity, failures, outcome).

    All rules about single rows of a table are counted in one pass over it. Keys are
    counted before they are compared, so a key that fills a third of the table is one row.

    A table in which equal rows stand once, with their number in a column, is named in ``copies``
    with that column; its outcome is that of the table with all of its rows.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        df, times = tables[table], (copies or {}).get(table)
        mine = [c for c in checks if c.table == table]
        row_rules = [(c, _breaks(c)) for c in mine if _breaks(c) is not None]
        if row_rules:
            counted = df.agg(*[_failing(rule, times).alias(f"c{i}") for i, (_, rule) in enumerate(row_rules)])
            cells = [_result(c, F.col(f"c{i}")) for i, (c, _) in enumerate(row_rules)]
            parts.append(counted.select(F.inline(F.array(*cells))))
        for check in mine:
            if check.kind == "unique":
                keys = check.arg or [check.column]
                counted = unique(df, keys, times).agg(F.count(F.lit(1)).alias("n"))
            elif check.kind == "relationships":
                counted = _orphans(tables, check, times)
            else:
                continue
            parts.append(counted.select(F.inline(F.array(_result(check, F.col("n"))))))
    broken = F.when(F.col("severity") == "error", "ERROR").otherwise("WARN")
    return reduce(DataFrame.unionByName, parts).withColumn(
        "outcome", F.when(F.col("failures") == 0, "PASS").otherwise(broken)
    )


def gate(results: DataFrame) -> DataFrame:
    """One row: passed, warned, errors, total and the status they add up to."""
    counts = {name: F.count_if(F.col("outcome") == out) for name, out in
              (("passed", "PASS"), ("warned", "WARN"), ("errors", "ERROR"))}
    totals = results.agg(*[c.alias(n) for n, c in counts.items()], F.count(F.lit(1)).alias("total"))
    return totals.withColumn(
        "status",
        F.when(F.col("errors") > 0, "FAILED").when(F.col("warned") > 0, "WARNING").otherwise("SUCCESS"),
    )


def freshness(df: DataFrame, ts_col: str, now: Column, max_hours: int = 24) -> DataFrame:
    """Newest load time, its age in whole hours, and whether that is too old."""
    newest = df.agg(F.max(ts_col).alias("last_update"))
    aged = newest.withColumn("hours_old", elapsed("HOUR", F.col("last_update"), now))
    return aged.withColumn("is_stale", F.col("hours_old") > max_hours)


def recency(spark: SparkSession, paths: Mapping[str, str], now: Column, minutes: int = 10) -> DataFrame:
    """The table written last, minutes since then, and whether that is recent.

    Only the file listing is read: file contents are pruned from the scan.
    """
    newest = reduce(
        DataFrame.unionByName,
        [
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(path)
            .agg(F.max("modificationTime").alias("last_modified"))
            .select(F.lit(name).alias("table_name"), "last_modified")
            for name, path in paths.items()
        ],
    )
    since = elapsed("MINUTE", F.col("last_modified"), now)
    return (
        newest.where(F.col("last_modified").isNotNull())
        .orderBy(F.desc("last_modified"), "table_name")
        .limit(1)
        .select("table_name", since.alias("minutes_since_update"))
        .withColumn("recently_updated", F.col("minutes_since_update") < minutes)
    )


def run_report(counts: DataFrame, results: DataFrame) -> DataFrame:
    """One row: tables built, rows in them, and the status the checks give."""
    built = counts.where(F.col("table_name") != "total").agg(
        F.count(F.lit(1)).alias("tables_built"), F.sum("row_count").alias("total_rows")
    )
    status = gate(results).select("status").scalar()
    return built.withColumn("status", status)
