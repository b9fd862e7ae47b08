"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import keep


# Small tables are written as few files: so many rows for each.
FILE_ROWS = 200_000


def stored(df: DataFrame, label: str, rows: int) -> DataFrame:
    """Write a table of at most about ``rows`` rows; the number of files follows from that."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = rows // FILE_ROWS + 1
    return keep(df.coalesce(files) if files < parts else df, label)


def _star(pairs: DataFrame, keep_above: bool, rows: int) -> DataFrame:
    """Hang the neighbours ``b`` of each ``a`` below the least of them and ``a``.

    The least neighbours are written before they are joined, so that both sides of the join
    are plain shuffles and a vertex with very many neighbours is split.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    least = stored(least.select("a", F.least("a", "least").alias("least")), "least", rows)
    hung = pairs.join(least, "a")
    if keep_above:
        return hung.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own).where("a <> b")


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the least vertex reachable from each vertex of ``edges`` (a, b).

    Vertices are whole numbers. Loops and repeated edges are allowed; an edge with a null end
    is ignored. Every step is written to the shared folder. The result has no row for a
    vertex that has no edge to another one.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = keep(ordered.where("a > b").distinct(), "edges")
    seen = _print_of(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_star(both, True, 2 * seen[0]).distinct(), "edges", seen[0])
        now = stored(_star(large, False, seen[0]).distinct(), "edges", 2 * seen[0])
        before, seen = seen, _print_of(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct()
    )
