"""Reproducible shuffle of rows into shards by a Feistel permutation with cycle walking.

Rows are numbered 0 .. n - 1 in the order of their keys. A keyed Feistel network permutes a
domain of a * b >= n numbers; a number that leaves 0 .. n - 1 is permuted again until it is
back inside. Shard and slot follow from the permuted number p: p % shards and p div shards.
They can be computed for any row number, without the rows, and backwards.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import keep

# A prime: multiplication by a round's key is one-to-one below it, and no product overflows.
PRIME = 2**31 - 1
ROUNDS = 6


def domain(n: int) -> tuple[int, int]:
    """Two factors near the root of ``n`` whose product exceeds it by as little as possible.

    A number walks through points outside 0 .. n - 1 only, so it is inside again after at most
    a * b - n + 1 steps.
    """
    if n <= 1:
        return 1, 1
    best = None
    root = math.isqrt(n - 1) + 1
    for a in range(root, min(2 * root, root + 100_000) + 1):
        over = -n % a
        if best is None or over < best[0]:
            best = (over, a)
        if over <= 2:
            break
    a = best[1]
    return a, -(-n // a)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    """Four numbers for each round, from a multiplicative generator."""
    x = (seed * 48271 + 11) % PRIME or 1
    out = []
    for _ in range(rounds):
        row = []
        for _ in range(4):
            x = x * 48271 % PRIME
            row.append(x)
        out.append(tuple(row))
    return out


def _mixed(x, key, bits):
    """A round's function of one half; ``bits`` gives (x ^ x >> 15) for numbers or columns."""
    k0, k1, k2, k3 = key
    x = (x % PRIME * k0 + k1) % PRIME
    return (bits(x) % PRIME * k2 + k3) % PRIME


def permuted(number: int, n: int, seed: int) -> int:
    """The place of a row number, in plain Python: for looking up single rows."""
    a, b = domain(n)
    keys = round_keys(seed)
    p = number
    while True:
        left, right = p // b, p % b
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + _mixed(right, key, lambda x: x ^ (x >> 15))) % a
            else:
                right = (right + _mixed(left, key, lambda x: x ^ (x >> 15))) % b
        p = left * b + right
        if p < n:
            return p


def _whole(x: Column, by: int) -> Column:
    """x div by: the difference is a multiple, so the quotient is exact below 2**53."""
    return ((x - F.pmod(x, F.lit(by))) / by).cast("long")


def permuted_column(number: Column, n: int, seed: int) -> Column:
    """The place of a row number, as a Spark expression."""
    a, b = domain(n)
    keys = round_keys(seed)

    def bits(x: Column) -> Column:
        return x.bitwiseXOR(F.shiftright(x, 15))

    def half_round(i: int, key: tuple):
        def step(h: Column) -> Column:
            if i % 2 == 0:
                return F.struct(((h["l"] + _mixed(h["r"], key, bits)) % a).alias("l"), h["r"].alias("r"))
            return F.struct(h["l"].alias("l"), ((h["r"] + _mixed(h["l"], key, bits)) % b).alias("r"))

        return step

    def once(p: Column) -> Column:
        halves = F.struct(_whole(p, b).alias("l"), F.pmod(p, F.lit(b)).alias("r"))
        for i, key in enumerate(keys):
            halves = F.get(F.transform(F.array(halves), half_round(i, key)), F.lit(0))
        return F.get(F.transform(F.array(halves), lambda h: h["l"] * b + h["r"]), F.lit(0))

    steps = a * b - n + 1
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(number.cast("long").alias("p"), F.lit(False).alias("done")),
        lambda s, _: F.when(s["done"], s).otherwise(
            F.get(F.transform(F.array(once(s["p"])), lambda p: F.struct(p.alias("p"), (p < n).alias("done"))), F.lit(0))
        ),
        lambda s: s["p"],
    )


def numbered(rows: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """``rows`` with gapless numbers from 0 in the order of the columns ``order`` (nulls first).

    The numbers depend on the rows alone, not on files, partitions or the cluster; rows equal
    in all of ``order`` take neighbouring numbers in any way, and are spread over partitions
    like others. Rows are sorted by ranges; only one count per partition is added up in one
    place.
    """
    tied = keep(rows.withColumn("__tie", F.monotonically_increasing_id()), "unnumbered")
    parts = int(tied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "__tie"]
    ranged = tied.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__tie")
    ranged = keep(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = keep(sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before")), "offsets")
    inside = F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    out = ranged.withColumn("__part", part).join(sizes, "__part")
    return out.withColumn(name, F.col("__before") + inside).drop("__part", "__before", "__at")


def sharded(rows: DataFrame, order: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with row_number, shard and slot, where counts of shards differ by one at most.

    ``order`` names the columns that number the rows; they should tell rows apart. Slots of a
    shard have no gaps. An empty table gives an empty result.
    """
    found = keep(numbered(rows, order), "numbered")
    n = found.count()
    found = found.withColumn("__place", permuted_column(F.col("row_number"), max(n, 1), seed))
    slot = _whole(F.col("__place"), shards)
    return found.withColumns({"shard": F.pmod("__place", F.lit(shards)).cast("int"), "slot": slot}).drop("__place")


def write_shards(rows: DataFrame, path: str) -> None:
    """Write sharded rows, one folder per shard, its files sorted by slot."""
    spread = rows.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
