"""Last known value at a time, without a calendar and without a hot group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import keep

# Ranges of time are found among so many by so many edges.
EDGES = 32
# Different times up to so many are one range.
FEW = 200_000


def _range_of(at: Column, edges: Column) -> Column:
    """The number of the range that ``at`` falls into, by two short searches."""
    coarse = F.transform(F.sequence(F.lit(1), F.lit(EDGES - 1)), lambda i: F.get(edges, i * EDGES - 1))
    first = F.size(F.filter(coarse, lambda e: e <= at))
    fine = F.slice(edges, first * EDGES + 1, F.lit(EDGES - 1))
    return first * EDGES + F.size(F.filter(fine, lambda e: e <= at))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    by: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Each row of ``left`` with the columns of the last row of ``right`` at or before its time.

    ``by`` columns must be equal. ``strict`` takes rows before the time only. Left rows without
    such a row, or with a null time or ``by``, get NULLs; right rows with one are never met. Of right rows of one
    time the greatest, by its columns in order, is taken.

    Different times of both sides are brought together, stored, and, if they are many, split into a
    thousand ranges of about equal numbers of times, whatever their spread; each is sorted once, and the last value of a range is carried
    over to those that follow. Rows of ``left`` meet the result by an equal time, so that a
    time, or a key, that very many rows share is split like any skewed join.
    """
    by = list(by)
    values = [c for c in right.columns if c not in by and c != right_at]
    clash = [c for c in values if c in left.columns]
    if clash:
        raise ValueError(f"both sides have the columns {clash}")
    keys = {f"__by{i}": c for i, c in enumerate(by)}
    key_columns = [F.col(c).alias(k) for k, c in keys.items()]
    whole = [F.col(c).isNotNull() for c in by]
    value = F.struct(F.lit(True).alias("__there"), *values)
    kind = left.schema[left_at].dataType
    if right.schema[right_at].dataType != kind:
        raise ValueError(f"{left_at} and {right_at} are of different types")

    def complete(df: DataFrame, at: str) -> DataFrame:
        cond = F.col(at).isNotNull()
        for c in whole:
            cond &= c
        return df.where(cond)

    points = complete(right, right_at).select(*key_columns, F.col(right_at).alias("__at"), value.alias("__v"))
    asked = complete(left, left_at).select(*key_columns, F.col(left_at).alias("__at"))
    missing = F.lit(None).cast(points.schema["__v"].dataType)
    times = points.withColumn("__asked", F.lit(False)).unionByName(asked.select("*", missing.alias("__v"), F.lit(True).alias("__asked")))
    times = times.groupBy(*keys, "__at").agg(F.max("__v").alias("__v"), F.max("__asked").alias("__asked"))

    times = keep(times, "times")
    one_range = times.count() <= FEW
    if not one_range:
        n = EDGES * EDGES
        (edges,) = times.agg(F.percentile_approx("__at", [i / n for i in range(1, n)], 10 * n)).first()
        times = times.withColumn("__range", _range_of(F.col("__at"), F.array(*[F.lit(e).cast(kind) for e in edges])))

    own = Window.partitionBy(*([*keys, *["__range"] * (not one_range)] or [F.lit(0)])).orderBy("__at")
    so_far = own.rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    within = times.withColumn("__last", F.last("__v", ignorenulls=True).over(so_far)).where("__asked")
    if one_range:
        found = within.select(*keys, "__at", F.col("__last").alias("__found"))
    else:
        # The last value of each range, and from it the one that each range begins with.
        there = F.col("__v").isNotNull()
        ends = times.groupBy(*keys, "__range").agg(F.max_by("__v", F.when(there, F.col("__at"))).alias("__end"))
        before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        begins = ends.select(*keys, "__range", F.last("__end", ignorenulls=True).over(before).alias("__begin"))
        found = within.join(begins, [*keys, "__range"]).select(*keys, "__at", F.coalesce("__last", "__begin").alias("__found"))

    meets = F.col(f"`{left_at}`") == F.col("__at")
    for k, c in keys.items():
        meets &= F.col(f"`{c}`") == F.col(k)
    joined = left.join(found, meets, "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__found.`{c}`").alias(c) for c in values])
