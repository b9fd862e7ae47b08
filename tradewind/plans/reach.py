"""How many orders and customers stand behind the groups of a mart, at any level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scalars import rounded
from tradewind.operators.distinct import distinct_count, merged
from tradewind.plans.marts import REACH


def reach(cube: DataFrame, levels: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """Items, revenue, and different orders and customers on every level of a roll-up.

    ``cube`` is a `sales_cube` with reach, as built or as stored, for any months. ``levels`` go from the
    coarsest down; each row is one value of some of them, and ``level`` counts the bits of those
    left out, as grouping_id does. ``per`` columns stay apart on all levels. An order or customer in
    several groups counts once, because sketches are merged and never added.
    """
    sums = {"items": F.sum("order_count"), "total_sum": F.sum("total_sum")}
    sums |= {f"{n}_sketch": merged(F.col(f"{n}_sketch")) for n in REACH}
    # Down to the finest level first, so that the roll-up repeats few rows.
    finest = cube.groupBy(*per, *levels).agg(*[v.alias(k) for k, v in sums.items()])
    sets = [[*per, *levels[:n]] for n in range(len(levels), -1, -1)]
    total = F.sum("items").alias("items"), F.sum("total_sum").alias("total_sum")
    level = F.grouping_id().alias("level")
    rolled = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in (*per, *levels)])
    found = rolled.agg(level, *total, *[merged(F.col(f"{n}_sketch")).alias(f"{n}_sketch") for n in REACH])
    return found.select(
        *per, *levels, "level", "items", rounded(F.col("total_sum")).alias("total_revenue_brl"),
        *[distinct_count(F.col(f"{n}_sketch")).alias(n) for n in REACH],
    )
