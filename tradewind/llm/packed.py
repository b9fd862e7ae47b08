"""Tables of packed arrays: a row holds whole arrays, so Spark moves few rows and numpy does the work.

Texts are dealt into chunks, a row each. Chunks ask parts of the keys, a row for a chunk and a
part, and are answered by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A chunk takes further texts until it has so many bytes of them.
CHUNK_BYTES = 4 << 20
# Texts are hashed in blocks that a core's cache holds.
BLOCK_BYTES = 1 << 18
CHUNKS = "chunk long, nos binary, offsets binary, data binary"


def column(table: pa.Table | pa.RecordBatch, name: str, kind) -> np.ndarray:
    """The numbers of a column of packed arrays, all rows one after the other."""
    return np.frombuffer(b"".join(table.column(name).drop_null().to_pylist()), kind)


def sizes_of(table: pa.Table | pa.RecordBatch, name: str, kind) -> np.ndarray:
    """How many numbers each row of a column of packed arrays has."""
    width = np.dtype(kind).itemsize
    return np.array([len(x) // width for x in table.column(name).to_pylist()], np.int64)


def cells(arrays: list[np.ndarray], edges: np.ndarray) -> list[pa.Array]:
    """Columns of packed arrays, cut at these edges."""
    spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
    return [pa.array([a[i:j].tobytes() for i, j in spans], pa.binary()) for a in arrays]


def runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin, and the end."""
    return np.concatenate([np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])[: len(x)]), [len(x)]])


def first_of(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    found = (keys.view(np.uint64) >> np.uint64(32)) % np.uint64(parts)
    return found.astype(np.uint16 if parts <= 65_536 else np.int32)


def dealt(chunk: int, part: np.ndarray, arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each part: chunk, part and its share of the arrays."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = runs(part)
    ids = [pa.array(np.full(len(edges) - 1, chunk, np.int64)), pa.array(part[edges[:-1]].astype(np.int32))]
    return pa.RecordBatch.from_arrays([*ids, *cells([a[order] for a in arrays.values()], edges)], names=["chunk", "part", *arrays])


def reordered(values: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The values of rows of these sizes, the rows put in this order."""
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    return values[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def looked_up(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands among sorted known ones, and whether it does."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of numbered texts (no, text), in order of the numbers; a chunk has that of its first text."""

    def made() -> pa.RecordBatch:
        nos = np.concatenate([b.column("no").to_numpy() for b in held])
        order = pa.array(np.argsort(nos))
        nos = np.sort(nos)
        texts = pa.concat_arrays([b.column("text").cast(pa.large_binary()) for b in held]).take(order)
        _, where, data = texts.buffers()
        offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data is not None else b""
        row = [nos[:1], [nos.astype(np.int64).tobytes()], [(offsets - offsets[0]).tobytes()], [data]]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["chunk", "nos", "offsets", "data"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        row = 0
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        while row < batch.num_rows:
            before = int(ends[row - 1]) if row else 0
            last = min(batch.num_rows, int(np.searchsorted(ends, before + CHUNK_BYTES - size)) + 1)
            held.append(batch.slice(row, last - row))
            size += int(ends[last - 1]) - before
            row = last
            if size >= CHUNK_BYTES:
                yield made()
                held, size = [], 0
    if held:
        yield made()


def texts_of(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(number, numbers of its texts, its texts) of each chunk."""
    for row in range(table.num_rows):
        chunk, nos, offsets, data = (table.column(c)[row] for c in ("chunk", "nos", "offsets", "data"))
        offsets = offsets.as_buffer()
        texts = pa.Array.from_buffers(pa.large_binary(), offsets.size // 8 - 1, [None, offsets, data.as_buffer()])
        yield chunk.as_py(), np.frombuffer(nos.as_buffer(), np.int64), texts
