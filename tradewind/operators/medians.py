"""Exact medians without bringing a group together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import keep

ACCURACY = 10_000
# Rows of one group that may be ordered in one task.
WINDOW_ROWS = 1_000_000
SPLITS = 100

def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys)) if keys else df


def _long(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keys, column, value) for every cell of ``cols``."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(*keys, F.inline(F.array(*cells)))


def _sketch(df: DataFrame, keys: Sequence[str], cols: Sequence[str], at, accuracy: int) -> DataFrame:
    """(keys, column, n, b): the number of values of each column, and quantiles of them."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.percentile_approx(F.col(c).cast("double"), at, accuracy).alias("b"),
        )
        for c in cols
    ]
    return df.groupBy(*keys).agg(F.array(*cells).alias("cells")).select(*keys, F.inline("cells"))


def _ranked(tally: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Rows before and up to each row of a tally, and the two middle ranks."""
    upto = F.sum("c").over(Window.partitionBy(*group).orderBy(order))
    return tally.withColumn("upto", upto).withColumns(
        {
            "before": F.col("upto") - F.col("c"),
            "first": F.floor((F.col("n") + 1) / 2),
            "second": F.floor(F.col("n") / 2) + 1,
        }
    )


def _narrowed(tally: DataFrame, group: Sequence[str], window_rows: int) -> DataFrame:
    """Cut a tally down until no group has more than ``window_rows`` rows.

    The values of a group are split into ranges of equal size, the ranges are counted, and
    only those that hold a middle rank are kept; what lies below them stays as a count.
    """
    tally = keep(tally, "tally")
    while True:
        most = tally.groupBy(*group).count().agg(F.max("count")).first()[0]
        if most is None or most <= window_rows:
            return tally
        points = [i / SPLITS for i in range(1, SPLITS)]
        edges = tally.groupBy(*group).agg(F.percentile_approx("value", points, 10 * SPLITS).alias("edges"))
        place = F.size(F.filter("edges", lambda edge: edge < F.col("value")))
        placed = tally.join(keep(edges, "edges"), group).withColumn(
            "part", F.when(F.col("value").isNull(), -1).otherwise(place)
        )
        parts = placed.groupBy(*group, "part").agg(F.sum("c").alias("c"), F.max("n").alias("n"))
        middle = keep(
            _ranked(parts, group, "part")
            .where((F.col("upto") >= F.col("first")) & (F.col("before") < F.col("second")))
            .select(*group, "part", "before", "n"),
            "middle",
        )
        inside = placed.join(middle.select(*group, "part"), [*group, "part"])
        below = middle.groupBy(*group).agg(F.min("before").alias("c"), F.max("n").alias("n"))
        tally = keep(
            inside.select(*group, "value", "c", "n").unionByName(
                below.select(*group, F.lit(None).cast("double").alias("value"), "c", "n")
            ),
            "tally",
        )


def _picked(tally: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, median) from a tally that holds the middle ranks."""
    value = F.col("value")

    def at(rank: str) -> Column:
        hit = (F.col("before") < F.col(rank)) & (F.col(rank) <= F.col("upto"))
        return F.max(F.when(hit, value))

    return _ranked(tally, group, "value").groupBy(*group).agg(
        ((at("first") + at("second")) / 2).alias("median")
    )


def weighted_medians(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], weight: str, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """One row per group with values, each of ``cols`` holding the median of its counted values.

    For tallies: a row stands for ``weight`` rows. NULL values are skipped, and rows with a
    NULL key belong to no group. Distinct values are ranked per group; of a group with more
    than ``window_rows`` of them only those near the middle are.
    """
    group = [*keys, "column"]
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), F.col(weight).alias("c")) for c in cols
    ]
    long = _complete(df, keys).select(*keys, F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    tally = keep(long.groupBy(*group, "value").agg(F.sum("c").alias("c")), "tally")
    sizes = keep(tally.groupBy(*group).agg(F.sum("c").alias("n"), F.count("*").alias("_values")), "sizes")
    most = sizes.agg(F.max("_values")).first()[0] or 0
    tally = tally.join(sizes.drop("_values"), group)
    if most > window_rows:
        tally = _narrowed(tally, group, window_rows)
    wide = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in cols]
    return _picked(tally, group).groupBy(*keys).agg(*wide)


def medians_long(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    exact: bool = True,
    accuracy: int = ACCURACY,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Median of each of ``cols`` per group, as rows (keys, column, median).

    NULL values are skipped, a group without values has a NULL median, and rows with a
    NULL key belong to no group. Two passes, none of which brings the values of a group to
    one place:

    1. a mergeable quantile sketch brackets the middle of each group between two of its
       values, with a rank error the sketch guarantees;
    2. the values below the bracket are only counted, those inside it are counted per
       distinct value, and the middle ranks are read off. What is ordered per group is
       about a thousandth of its rows, and is cut down further if that is still a lot.

    ``df`` is read twice; the bracket is stored in between, so a repeated task meets the
    same one. A rank outside its bracket would raise, never give a wrong value.
    """
    group = [*keys, "column"]
    df = _complete(df, keys)
    if not exact:
        return _sketch(df, keys, cols, 0.5, accuracy).select(*group, F.col("b").alias("median"))
    margin = 4 / accuracy
    sketched = _sketch(df, keys, cols, [0.5 - margin, 0.5 + margin], accuracy)
    # Stored, so that its size is known: Spark then broadcasts it if, and only if, small.
    bracket = keep(sketched.select(*group, "n", F.col("b")[0].alias("lo"), F.col("b")[1].alias("hi")), "bracket")
    value = F.col("value")
    tally = (
        _long(df, keys, cols).join(bracket, group)
        .where(value <= F.col("hi"))
        .groupBy(*group, F.when(value >= F.col("lo"), value).alias("value"))
        .agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    )
    # The NULL row sums up what lies below the bracket; NULLs sort first. A bracket holds
    # at most 2 * (margin + 1 / accuracy) of the rows of its group.
    most = bracket.agg(F.max("n")).first()[0] or 0
    if most * 10 / accuracy > window_rows:
        tally = _narrowed(tally, group, window_rows)
    picked = _picked(tally, group)
    missed = F.raise_error(F.lit("median outside its bracket")).cast("double")
    checked = F.when(F.col("n") > 0, F.coalesce("median", missed))
    return bracket.join(picked, group, "left").select(*group, checked.alias("median"))


def medians(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], exact: bool = True, accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group, each of ``cols`` holding its median."""
    rows = medians_long(df, keys, cols, exact, accuracy)
    wide = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in cols]
    return rows.groupBy(*keys).agg(*wide)


def column_medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """One row with the median of each column over the whole frame."""
    return medians(df, [], cols, exact)


def fill_with_group_median(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of ``cols`` with the median of the row's group.

    Rows with a NULL key, or of a group without values, keep their NULL.
    """
    middle = medians(df, [key], cols).withColumnsRenamed({c: f"_{c}" for c in cols})
    # The medians are unique per key, and written out so that their size is known.
    joined = df.join(keep(middle, "group-medians"), key, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def fill_with_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of ``cols`` with the median of the whole column (a scalar subquery)."""
    middle = column_medians(df, cols).select(F.struct(*cols).alias("m")).scalar()
    return df.select(
        *[F.coalesce(F.col(c), middle[c]).alias(c) if c in cols else F.col(c) for c in df.columns]
    )
