"""Sets of shingles as packed arrays: pairs that may be linked, and those that are.

A set is known by a 64-bit number ``v`` and lies with the others of its part; pairs travel to the
part of their first set, and with it to that of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm import packed
from tradewind.llm.minhash import _scattered
from tradewind.llm.stars import EDGES, both_ways

# Sets meet in pairs in buckets of up to so many different ones; members of larger buckets
# are left to ``crowds``.
BUCKET_ROWS = 128
# Bits for the members of a set, and the greatest size told apart beside them.
MARKS = 48
MOST = 65_535
# Pairs are compared so many at once, by as many bits of the members as are then left of 64.
BLOCK_BITS = 16

# What comes out of buckets, packed for a part of the sets or for a chunk of texts.
PAIRS, CROWD, WANTED = 0, 1, 2
MET_ROWS = "kind int, to long, a binary, b binary"

SETS = {"v": np.int64, "size": np.int32, "members": np.uint64}
SET_ROWS = "part int, " + ", ".join(f"{c} binary" for c in SETS)


def set_bits(once: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The marks of sets without their sizes, from the 32-bit numbers of their members."""
    bits = np.uint64(1) << (once % np.uint32(MARKS)).astype(np.uint64)
    return np.bitwise_or.reduceat(bits, edges[:-1]) << np.uint64(16)


def marks_of(members: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return set_bits(_scattered((members >> np.uint64(32)).astype(np.uint32)), edges) | np.minimum(sizes, MOST).astype(np.uint64)


def may_be_linked(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """False for two ``set_marks`` whose sets can't share ``percent`` of their union.

    Linked sets of x and y members have at least percent * (x + y) / (100 + percent) in common,
    and of the bits in which the marks differ each is due to another member that is not.
    """
    x, y = ((z & np.uint64(MOST)).astype(np.int64) for z in (a, b))
    common = -(-percent * (x + y) // (100 + percent))
    differ = np.bitwise_count((a ^ b) >> np.uint64(16)).astype(np.int64)
    return (np.maximum(x, y) == MOST) | (differ <= x + y - 2 * common)


def _meeting(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a bucket that may be linked, from rows sorted by bucket; of a bucket of more than
    BUCKET_ROWS, each member alone."""

    def made(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        other = pa.array(b) if b is not None else pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), other], names=["a", "b"])

    held = [np.zeros(0, np.int64)] * 3
    large = None  # the bucket whose first rows have gone out as those of a large one
    for batch in _and_none(batches):
        if batch is not None:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("bucket", "v", "marks"), strict=True)]
        bucket, v, marks = held
        if not len(bucket):
            continue
        edges = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        sizes = np.diff(edges)
        big = (sizes > BUCKET_ROWS) | (bucket[edges[:-1]] == large if large is not None else False)
        # The last bucket may go on in the next batch.
        if batch is not None and not big[-1]:
            held = [h[edges[-2] :] for h in held]
            bucket, v, marks, sizes, big = bucket[: edges[-2]], v[: edges[-2]], marks[: edges[-2]], sizes[:-1], big[:-1]
            large = None
        else:
            large = bucket[-1] if big[-1] else None
            held = [h[:0] for h in held]
        alone = np.repeat(big, sizes)
        if alone.any():
            yield made(v[alone], None)
        bucket, v, marks = bucket[~alone], v[~alone], marks[~alone].view(np.uint64)
        at = np.arange(len(bucket))
        for d in range(1, BUCKET_ROWS):
            at = at[: np.searchsorted(at, len(bucket) - d)]
            at = at[bucket[at] == bucket[at + d]]
            if not len(at):
                break
            near = at[may_be_linked(marks[at], marks[at + d], percent)]
            if len(near):
                yield made(v[near], v[near + d])


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def pairs_and_crowd(bucket: np.ndarray, v: np.ndarray, marks: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (two arrays) of rows in order of bucket and v, and the members of large buckets."""
    columns = [pa.array(x.view(np.int64)) for x in (bucket, v, marks)]
    met = list(_meeting(iter([pa.RecordBatch.from_arrays(columns, names=["bucket", "v", "marks"])]), percent))
    none = np.zeros(0, np.int64)
    pairs = [m for m in met if not m.column("b").null_count]
    a, b = (np.concatenate([none, *(m.column(c).to_numpy() for m in pairs)]) for c in "ab")
    return a, b, np.unique(np.concatenate([none, *(m.column("a").to_numpy() for m in met if m.column("b").null_count)]))


def packed_rows(kind: int, to: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.Table:
    order = np.argsort(to, kind="stable")
    edges = packed.runs(to[order])
    ids = [pa.array(np.full(len(edges) - 1, kind, np.int32)), pa.array(to[order][edges[:-1]].astype(np.int64))]
    return pa.Table.from_arrays([*ids, *packed.cells([one[order], other[order]], edges)], names=["kind", "to", "a", "b"])


def met_rows(a: np.ndarray, b: np.ndarray, crowd: np.ndarray, parts: int) -> list[pa.Table]:
    """Pairs by the part of the first one, and members of large buckets by their part."""
    return [packed_rows(PAIRS, packed.parts_of(a, parts), a, b), packed_rows(CROWD, packed.parts_of(crowd, parts), crowd, crowd)]


def shingle_sets(windows: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of the sets of these members, and the sets, each in order."""
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((windows, owner))
    windows, owner = windows[order], owner[order]
    new = packed.first_of(owner, windows)
    return np.bincount(owner[new], minlength=len(edges) - 1).astype(np.int32), windows[new]


def dealt(part: np.ndarray, v: np.ndarray, sizes: np.ndarray, members: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """A row for each part: its sets, and what else belongs to each."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = packed.runs(part)
    members = packed.reordered(members, sizes, order)
    sizes = sizes[order].astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes)])[edges]
    columns = [*packed.cells([v[order], sizes], edges), *packed.cells([members], ends), *packed.cells([a[order] for a in more.values()], edges)]
    return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]].astype(np.int32)), *columns], names=["part", *SETS, *more])


def _sorted(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets of a part, each once, in order of v, with where their members begin."""
    v, sizes, members = (packed.column(table, c, k) for c, k in SETS.items())
    order = np.unique(v, return_index=True)[1]
    members = packed.reordered(members, sizes.astype(np.int64), order)
    return v[order], sizes[order].astype(np.int64), members


def _with_first(pairs: pa.Table, known: pa.Table, parts: int) -> pa.Table:
    """The pairs of a part, each once, with the set of the first one, by the part of the other."""
    a, b = packed.column(pairs, "a", np.int64), packed.column(pairs, "b", np.int64)
    order = np.lexsort((b, a))
    order = order[packed.first_of(a[order], b[order])]
    a, b = a[order], b[order]
    v, sizes, members = _sorted(known)
    at, there = packed.looked_up(v, a)
    a, b, at = a[there], b[there], at[there]
    members = packed.reordered(members, sizes, at)
    return pa.Table.from_batches([dealt(packed.parts_of(b, parts), a, sizes[at] if len(at) else at, members, other=b)])


def _both(pairs: pa.Table, known: pa.Table, percent: int, parts: int) -> pa.Table:
    """The pairs of a part that share ``percent`` of their union, as edges."""
    a, sizes_a, of_a = (packed.column(pairs, c, k) for c, k in SETS.items())
    b, sizes_a = packed.column(pairs, "other", np.int64), sizes_a.astype(np.int64)
    v, sizes, members = _sorted(known)
    at, there = packed.looked_up(v, b)
    sizes_b = np.where(there, sizes[at] if len(v) else 0, 0)
    chosen = np.flatnonzero(there & (100 * np.minimum(sizes_a, sizes_b) >= percent * np.maximum(sizes_a, sizes_b)))
    bits = np.uint64(64 - BLOCK_BITS)
    out = []
    for low in range(0, len(chosen), 1 << BLOCK_BITS):
        some = chosen[low : low + (1 << BLOCK_BITS)]
        one, other = packed.reordered(of_a, sizes_a, some), packed.reordered(members, sizes, at[some])
        n_a, n_b = sizes_a[some], sizes[at[some]]
        pair_a, pair_b = (np.repeat(np.arange(len(some), dtype=np.uint64), n) for n in (n_a, n_b))
        # Both are in order, since the sets are.
        one, other = (pair << bits | x >> np.uint64(BLOCK_BITS) for pair, x in ((pair_a, one), (pair_b, other)))
        both = np.bincount(pair_b[packed.looked_up(one, other)[1]].astype(np.int64), minlength=len(some))
        out.append(some[100 * both >= percent * (n_a + n_b - both)])
    out = np.concatenate([chosen[:0], *out])
    return pa.Table.from_batches([both_ways(a[out], b[out], parts)])


def linked(pairs: DataFrame, known: DataFrame, percent: int, parts: int) -> DataFrame:
    """The links (EDGES) among packed pairs (part, a, b) of sets (SET_ROWS)."""

    def with_first(some: pa.Table, sets: pa.Table) -> pa.Table:
        return _with_first(some, sets, parts)

    def both(some: pa.Table, sets: pa.Table) -> pa.Table:
        return _both(some, sets, percent, parts)

    sent = pairs.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(with_first, f"{SET_ROWS}, other binary")
    return sent.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(both, EDGES)
