"""Pairs among the members of large buckets, by the rarest members of their sets.

Of two sets that share ``percent`` of their union each has a member of the other among its rarest
ones, if it looks at 100 - percent of them and one more (prefix filter). Many sets that are alike
but under the threshold, because a common line stands in all, hold the words of that line last:
they do not meet, and work does not grow with the square of their number. Where more than
BUCKET_ROWS sets share a rare shingle, their sizes and the shingle's place in them tell which can
still have enough in common (positional filter). Only sets of the same few sizes and places that
are too many for pairs are compared by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import packed
from tradewind.llm.minhash import near_duplicates
from tradewind.llm.scratch import stored
from tradewind.llm.sets import BUCKET_ROWS, CROWD, MET_ROWS, PAIRS, SET_ROWS, _sorted, dealt, marks_of, may_be_linked, met_rows, pairs_and_crowd
from tradewind.llm.stars import EDGES, from_rows
from tradewind.session import keep

PAIRS_AT_ONCE = 1 << 20
# A set at one of its rarest shingles: ``rest`` counts its members from that shingle on.
MEMBERS = {"bucket": np.uint64, "v": np.int64, "marks": np.uint64, "size": np.int32, "rest": np.int32}
MEMBER_ROWS = "chunk long, part int, " + ", ".join(f"{c} binary" for c in MEMBERS)


def _own(crowd: pa.Table, known: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets of the members of a part."""
    v, sizes, members = _sorted(known)
    at = np.flatnonzero(packed.looked_up(np.unique(packed.column(crowd, "v", np.int64)), v)[1])
    return v[at], sizes[at], packed.reordered(members, sizes, at)


def _asked(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """How many sets of a part hold each shingle, by the part of the shingle."""
    for batch in batches:
        for row in range(batch.num_rows):
            key, n = np.unique(packed.column(batch.slice(row, 1), "members", np.uint64), return_counts=True)
            yield packed.dealt(batch.column("part")[row].as_py(), packed.parts_of(key, parts), {"key": key, "n": n})


def _counted(part: pa.Table) -> pa.Table:
    """In how many sets each shingle of a part is, for those that asked, if it is in several."""
    sizes = packed.sizes_of(part, "key", np.uint64)
    key, n = packed.column(part, "key", np.uint64), packed.column(part, "n", np.int64)
    order = np.argsort(key)
    edges = packed.runs(key[order])
    total = np.empty(len(key), np.int64)
    total[order] = np.repeat(np.add.reduceat(n[order], edges[:-1]), np.diff(edges))
    several = total > 1
    edges = np.concatenate([[0], np.cumsum(np.add.reduceat(several.astype(np.int64), np.cumsum(sizes) - sizes))])
    return pa.Table.from_arrays([part.column("chunk"), *packed.cells([key[several], total[several]], edges)], names=["chunk", "key", "n"])


def _rarest(known: pa.Table, counts: pa.Table, percent: int, parts: int) -> pa.Table:
    """The sets of a part by each of their rarest shingles that another set has too."""
    v, sizes, members = _sorted(known)
    key, n = packed.column(counts, "key", np.uint64), packed.column(counts, "n", np.int64)
    order = np.argsort(key)
    key, n = key[order], n[order]
    at, several = packed.looked_up(key, members)
    total = np.where(several, n[at] if len(n) else 1, 1)
    owner = np.repeat(np.arange(len(v)), sizes)
    order = np.lexsort((members, total, owner))
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    looked = sizes - -(-percent * sizes // 100) + 1
    chosen = (place < looked[owner]) & (total[order] > 1)
    order, rest = order[chosen], (sizes[owner] - place)[chosen]
    rare, of = members[order], owner[order]
    marks = marks_of(members, sizes) if len(v) else np.zeros(0, np.uint64)
    found = (rare, v[of], marks[of], sizes[of], rest)
    found = {c: a.astype(k, copy=False) for (c, k), a in zip(MEMBERS.items(), found, strict=True)}
    return pa.Table.from_batches([packed.dealt(0, packed.parts_of(rare, parts), found)])


def _meet(part: pa.Table, percent: int, parts: int) -> pa.Table:
    bucket, v, marks, size, rest = (packed.column(part, c, k) for c, k in MEMBERS.items())
    order = np.lexsort((v, bucket))
    bucket, v, marks, size, rest = (x[order] for x in (bucket, v, marks, size, rest))
    edges = packed.runs(bucket)
    large = np.repeat(np.diff(edges) > BUCKET_ROWS, np.diff(edges))
    a, b, crowd = pairs_and_crowd(bucket[~large], v[~large], marks[~large], percent)
    pairs, crowd = [(a, b)], [crowd]
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if high - low > BUCKET_ROWS:
            some = slice(low, high)
            for x, y in _classes(size[some], rest[some], percent):
                x, y = x + low, y + low
                if len(x) * len(y) > BUCKET_ROWS * (len(x) + len(y)):
                    crowd.append(v[np.union1d(x, y)])
                    continue
                step = max(1, PAIRS_AT_ONCE // len(y))
                for i in range(0, len(x), step):
                    one = np.repeat(x[i : i + step], len(y))
                    other = np.tile(y, len(one) // len(y))
                    near = (v[one] != v[other]) & may_be_linked(marks[one], marks[other], percent)
                    one, other = v[one[near]], v[other[near]]
                    pairs.append((np.minimum(one, other), np.maximum(one, other)))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    return pa.concat_tables(met_rows(a, b, np.unique(np.concatenate(crowd)), parts))


def _classes(size: np.ndarray, rest: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The members of each two kinds, of one size and place of the shingle, that may be linked there.

    At the first shingle that two sets share, all they share is among what follows.
    """
    order = np.lexsort((rest, size))
    edges = np.append(np.flatnonzero(packed.first_of(size[order], rest[order])), len(order))
    kinds = [order[i:j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    size, rest = (x[order[edges[:-1]]].astype(np.int64) for x in (size, rest))
    for k in range(len(kinds)):
        common = -(-percent * (size[k] + size[k:]) // (100 + percent))
        for other in (k + np.flatnonzero(np.minimum(rest[k], rest[k:]) >= common)).tolist():
            yield kinds[k], kinds[other]


def _spelled(v: np.ndarray, sizes: np.ndarray, members: np.ndarray) -> pa.Table:
    """Sets as texts of words that are their members."""
    words = [f"{x:x}" for x in members.tolist()]
    edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    texts = [" ".join(words[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    return pa.Table.from_arrays([pa.array(v, pa.int64()), pa.array(texts, pa.string())], names=["name", "text"])


def met(crowd: DataFrame, known: DataFrame, percent: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Packed pairs (part, a, b) that may be linked, and links (EDGES), among the members ``crowd``
    (part, v) of large buckets; ``known`` are all sets (SET_ROWS)."""
    spark = crowd.sparkSession

    def own(some: pa.Table, sets: pa.Table) -> pa.Table:
        v, sizes, members = _own(some, sets)
        return pa.Table.from_batches([dealt(packed.parts_of(v, parts), v, sizes, members)])

    def rarest(sets: pa.Table, counts: pa.Table) -> pa.Table:
        return _rarest(sets, counts, percent, parts)

    def meet(part: pa.Table) -> pa.Table:
        return _meet(part, percent, parts)

    def spelled(some: pa.Table, sets: pa.Table) -> pa.Table:
        return _spelled(*_own(some, sets))

    ours, _ = stored(crowd.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(own, SET_ROWS), "crowd")
    asked = ours.select("part", "members").mapInArrow(partial(_asked, parts=parts), "chunk long, part int, key binary, n binary")
    counts = asked.groupBy("part").applyInArrow(_counted, "chunk long, key binary, n binary")
    rare = ours.groupBy("part").cogroup(counts.withColumn("chunk", F.col("chunk").cast("int")).groupBy("chunk"))
    rare = rare.applyInArrow(rarest, MEMBER_ROWS)
    found, _ = stored(rare.groupBy("part").applyInArrow(meet, MET_ROWS), "crowd")
    pairs, rest = (found.where(F.col("kind") == k).select(F.col("to").cast("int").alias("part"), F.col("a"), F.col("b")) for k in (PAIRS, CROWD))
    links = pairs.where("false")
    if not rest.isEmpty():
        rest = rest.select("part", F.col("a").alias("v")).groupBy("part").cogroup(ours.groupBy("part"))
        texts, _ = stored(rest.applyInArrow(spelled, "name long, text string"), "crowd")
        grouped = keep(near_duplicates(texts, ["name"], percent, 1, bands=10, band_rows=3), "crowd")
        heads = grouped.groupBy("group").agg(F.min("name").alias("b"))
        rows = grouped.join(heads, "group").select(F.col("name").alias("a"), "b").where("a <> b")
        links = rows.mapInArrow(partial(from_rows, parts=parts), EDGES)
    return pairs, links
