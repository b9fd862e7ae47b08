"""Connected components by alternating large and small stars, on packed edges.

The edges lie in both directions with the part of their first end: (part, a, b). What is done is
that of ``components``; an edge costs some bytes here and no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import packed
from tradewind.llm.scratch import removed, stored
from tradewind.llm.text import mixed

EDGES = "part int, a binary, b binary"
# The part of a row with the number and a print of the edges of a task.
COUNTS = -1


def both_ways(a: np.ndarray, b: np.ndarray, parts: int) -> pa.RecordBatch:
    """Edges in both directions, by the part of their first end."""
    x, y = np.concatenate([a, b]), np.concatenate([b, a])
    return packed.dealt(0, packed.parts_of(x, parts), {"a": x, "b": y}).drop_columns("chunk")


def from_rows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Packed edges of rows (a, b)."""
    for batch in batches:
        yield both_ways(batch.column("a").to_numpy(), batch.column("b").to_numpy(), parts)


def _different(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges of a part, each once and in order, and where those of a vertex begin."""
    a, b = packed.column(part, "a", np.int64), packed.column(part, "b", np.int64)
    order = np.lexsort((b, a))
    order = order[packed.first_of(a[order], b[order])]
    a, b = a[order], b[order]
    return a, b, packed.runs(a)


def _large(part: pa.Table, parts: int) -> pa.Table:
    """Hang the neighbours above each vertex below the least of them and itself."""
    a, b, edges = _different(part)
    least = np.repeat(np.minimum(a[edges[:-1]], b[edges[:-1]]), np.diff(edges))
    once = a > b
    marks = mixed(mixed(a[once].view(np.uint64)) + b[once].view(np.uint64)) >> np.uint64(33)
    counts = [np.array([once.sum()]), np.array([marks.sum()])]
    first = pa.RecordBatch.from_arrays([pa.array([COUNTS], pa.int32()), *(pa.array([c.astype(np.int64).tobytes()], pa.binary()) for c in counts)], names=["part", "a", "b"])
    a, b = b[~once], least[~once]
    rows = packed.dealt(0, packed.parts_of(a, parts), {"a": a, "b": b}).drop_columns("chunk")
    return pa.Table.from_batches([first, rows])


def _small(part: pa.Table, parts: int) -> pa.Table:
    """Hang each vertex and its neighbours, all below it, below the least of them."""
    a, b, edges = _different(part)
    at = edges[:-1]
    least = np.repeat(b[at], np.diff(edges))
    other = b != least
    return pa.Table.from_batches([both_ways(np.concatenate([b[other], a[at]]), np.concatenate([least[other], b[at]]), parts)])


def labels_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of a part of the result of ``stars`` in order, and their components."""
    a, b, edges = _different(part)
    return a[edges[:-1]], np.minimum(a, b)[edges[:-1]]


def stars(links: DataFrame, parts: int) -> tuple[DataFrame, str]:
    """The packed edges between each vertex and the least one that it reaches, and where they lie."""
    spark = links.sparkSession

    def large(part: pa.Table) -> pa.Table:
        return _large(part, parts)

    def small(part: pa.Table) -> pa.Table:
        return _small(part, parts)

    now, now_at = stored(links, "links")
    seen = None
    while True:
        hung, hung_at = stored(now.groupBy("part").applyInArrow(large, EDGES), "stars")
        counts = [packed.column(hung.where(F.col("part") == COUNTS).select("a", "b").toArrow(), c, np.int64) for c in "ab"]
        counts = [int(c.sum()) for c in counts]
        if counts == seen or not counts[0]:
            removed(spark, hung_at)
            return now, now_at
        seen, before = counts, now_at
        now, now_at = stored(hung.where(F.col("part") != COUNTS).groupBy("part").applyInArrow(small, EDGES), "links")
        for path in (before, hung_at):
            removed(spark, path)
