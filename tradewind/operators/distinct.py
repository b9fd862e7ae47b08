"""Distinct counts that add up over months and levels.

A group keeps a theta sketch of the keys it has seen. Sketches of groups are merged into that of
their union, so a roll-up never goes back to the rows. Up to 2 ** log_entries different keys
the count is exact (keys are told apart by 64-bit hashes); beyond, its relative error has a
standard deviation of 1 / sqrt(2 ** log_entries). A sketch takes 8 bytes a key up to that number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_ENTRIES = 14


def distinct_sketch(col: Column, log_entries: int = LOG_ENTRIES) -> Column:
    """An aggregate: the sketch of a column's values. NULLs are not counted."""
    return F.theta_sketch_agg(col, log_entries)


def merged(col: Column, log_entries: int = LOG_ENTRIES) -> Column:
    """An aggregate: the sketch of what any of the sketches has seen."""
    return F.theta_union_agg(col, log_entries)


def distinct_count(sketch: Column) -> Column:
    """The number of different keys of a sketch; 0 for one that has seen none."""
    return F.coalesce(F.theta_sketch_estimate(sketch).cast("bigint"), F.lit(0).cast("bigint"))
