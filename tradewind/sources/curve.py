"""Order of rows along a space-filling curve, so that files say something about every column.

Files that are sorted by one column can be skipped by a filter on that column only. Along a
curve that winds through all of several columns, each file holds a small range of every one of them,
and the statistics that Parquet keeps of each row group let a reader skip files by any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6


def _number(df: DataFrame, name: str) -> Column:
    """A value's place in the order of its column, as a number: of a text the seven bytes that follow
    what all texts of the column begin with."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        ends = df.agg(F.min(col).alias("a"), F.max(col).alias("b"))
        upto = F.sequence(F.lit(0), F.least(F.length("a"), F.length("b")))
        common = F.size(F.filter(upto, lambda n: F.left("a", n) == F.left("b", n))) - 1
        shared = ends.select(common).first()[0] or 0
        first = F.substring(F.substr(col, F.lit(shared + 1)).cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(first), 14, "0"), 16, 10).cast("bigint").cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def _steps_up_to(steps: Column, value: Column) -> Column:
    return F.size(F.filter(steps, lambda step: step <= value))


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Where a row lies on the curve: the bits of its ranks in all columns, in turn.

    A rank is the number of quantiles of the column that are not greater, so that each column has
    about equally filled ranges whatever its values are. NULL ranks first. The quantiles are found
    here, by a pass over the columns: 2 ** bits numbers of each.
    """
    edges = [i / 2**bits for i in range(1, 2**bits)]
    values = [_number(df, c) for c in columns]
    cuts = [F.percentile_approx(value, edges, 2000).alias(f"e{i}") for i, value in enumerate(values)]
    found = df.agg(*cuts).first()
    place = F.lit(0).cast("bigint")
    for i, value in enumerate(values):
        steps = F.array(*map(F.lit, found[i] or [])).cast("array<double>")
        rank = F.when(value.isNull(), 0).otherwise(_steps_up_to(steps, value))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i)
    return place


def along_curve(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` dealt into ranges of the curve, one a file when it is written, each in order.

    Ranges have about equal numbers of rows unless very many rows agree in all ``columns``; such rows
    are dealt out by the rest of their columns. Without ``files`` Spark chooses the number by size.
    """
    if not columns or len(columns) * bits > 62:
        raise ValueError("one to ten columns")
    placed = df.withColumn("__place", curve_place(df, columns, bits)).withColumn("__rest", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    keys = [F.col("__place"), F.col("__rest")]
    dealt = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys).drop("__place", "__rest")
