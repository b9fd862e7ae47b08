"""Interpolated modified Kneser-Ney n-gram models, counted in Spark and read through memory maps.

Counting: each task turns its texts into n-grams of 48-bit word hashes, counts them, and deals
them out over a grid of buckets, by the hash of an n-gram's first words one way and of its last
words the other way. No bucket gets more than a grid line's share of a frequent word, and all
copies of an n-gram meet in one. Each bucket is merged into a sorted array of n-gram hashes next
to an array of counts, a file each. What a model needs besides, the statistics of each context
and the number of different words before each shorter n-gram, is summed per bucket first and
then merged the same way, one order after the other.

Scoring: workers map the files into memory and look up sorted keys, so that a model of any size
takes no memory of its own. The files are written to the shared folder (spark.checkpoint.dir),
which must be a mounted file system; every write is a rename of a finished file, so a repeated
or lost task does no harm.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import blocks_of_words, mixed
from tradewind.session import keep, scratch_path

WORD_BITS = np.uint64((1 << 48) - 1)
BEGIN, END = np.uint64(0), np.uint64(1)
# n-grams that a task counts at once.
CHUNK = 1 << 21

_PARTS = "kind string, bucket int, blob binary, distinct long, total long, n1 long, n2 long, n3 long, n4 long"
_FIGURES = ("distinct", "total", "n1", "n2", "n3", "n4")


def word_of(text: str) -> np.uint64:
    """The hash that stands for one word."""
    ((_, _, words, _),) = blocks_of_words(pa.array([text]))
    return words[0] & WORD_BITS


def gram_keys(words: np.ndarray) -> np.ndarray:
    """A hash for each row of word hashes."""
    out = np.full(len(words), words.shape[1], np.uint64)
    for k in range(words.shape[1]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return out


def token_stream(words: np.ndarray, rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each after order - 1 begins and before an end; and the places
    of all words and ends in it."""
    n, before = len(rows) - 1, max(order - 1, 0)
    lengths = np.diff(rows)
    out = np.full(len(words) + n * (before + 1), BEGIN, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n) * (before + 1) + before, lengths)] = words & WORD_BITS
    ends = rows[1:] + np.arange(1, n + 1) * (before + 1) - 1
    out[ends] = END
    token = np.ones(len(out), bool)
    if before:
        starts = ends - lengths - before
        for k in range(before):
            token[starts + k] = False
    return out, np.flatnonzero(token)


def counted(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in word order, and how often each occurs."""
    if len(grams) == 0:
        return grams, np.zeros(0, np.int64)
    order = np.lexsort(grams.T[::-1])
    grams = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    if counts is None:
        return grams[at], np.diff(np.append(at, len(grams)))
    return grams[at], np.add.reduceat(counts[order], at)


def _planes(column: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of whole numbers, first bytes first: these compress well."""
    wide = np.ascontiguousarray(column, "<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(wide[:, :width].T).tobytes()


def pack(columns: list[np.ndarray], widths: list[int]) -> bytes:
    return b"".join(_planes(c, w) for c, w in zip(columns, widths, strict=True))


def unpack(blobs: list[bytes], widths: list[int]) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in widths]
    for blob in blobs:
        raw = np.frombuffer(blob, np.uint8)
        n, at = len(raw) // sum(widths), 0
        for column, w in zip(out, widths, strict=True):
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :w] = raw[at : at + n * w].reshape(w, n).T
            column.append(wide.view("<u8").reshape(-1))
            at += n * w
    return [np.concatenate(c) if c else np.zeros(0, np.uint64) for c in out]


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its rows, in their order."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for first, last in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(bucket[order[first]]), order[first:last]


def grid_bucket(grams: np.ndarray, grid: int) -> np.ndarray:
    side = np.uint64(grid)
    if grams.shape[1] == 1:
        return (mixed(grams[:, 0]) % np.uint64(grid * grid)).astype(np.int64)
    first, last = gram_keys(grams[:, :-1]) % side, gram_keys(grams[:, 1:]) % side
    return (first * side + last).astype(np.int64)


def key_bucket(keys: np.ndarray, grid: int) -> np.ndarray:
    return (mixed(keys) % np.uint64(grid * grid)).astype(np.int64)


def _part(kind: str, bucket: int, blob: bytes, figures: tuple[int, ...] = (0,) * 6) -> pa.RecordBatch:
    values = [kind, bucket, blob, *figures]
    types = [pa.string(), pa.int32(), pa.binary(), *[pa.int64()] * 6]
    names = ["kind", "bucket", "blob", *_FIGURES]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def _gram_parts(kind: str, grams: np.ndarray, counts: np.ndarray, grid: int) -> Iterator[pa.RecordBatch]:
    widths = [6] * grams.shape[1] + [5]
    for bucket, at in _split(grid_bucket(grams, grid)):
        yield _part(kind, bucket, pack([*grams[at].T, counts[at]], widths))


def _count(batches: Iterator[pa.RecordBatch], order: int, grid: int, chunk: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        grams, counts = counted(np.concatenate(held))
        held, size = [], 0
        yield from _gram_parts(f"grams{order}", grams, counts, grid)

    for batch in batches:
        for _, _, words, rows in blocks_of_words(batch.column("text")):
            stream, at = token_stream(words, rows, order)
            held.append(np.stack([stream[at - order + 1 + k] for k in range(order)], axis=1))
            size += len(at)
            if size >= chunk:
                yield from settle()
    if held:
        yield from settle()


def _write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Files that appear whole or not at all; the same content may be written twice."""
    os.makedirs(folder, exist_ok=True)
    for part, values in arrays.items():
        draft = f"{folder}/.{name}.{part}.{uuid.uuid4().hex}"
        values.tofile(draft)
        os.replace(draft, f"{folder}/{name}.{part}")


def _figures(counts: np.ndarray) -> tuple[int, ...]:
    return (len(counts), int(counts.sum()), *[int((counts == k).sum()) for k in (1, 2, 3, 4)])


def _sum_by(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys, and the sums of each column over them."""
    found, at = np.unique(keys, return_inverse=True)
    return [found, *[np.bincount(at, c, len(found)).astype(np.uint64) for c in columns]]


def _merge(key: tuple, table: pa.Table, level: int, top: bool, grid: int, folder: str) -> pa.Table:
    """All n-grams of one bucket: write them, and pass on what the other files need."""
    bucket = key[0].as_py()
    *words, counts = unpack(table.column("blob").to_pylist(), [6] * level + [5])
    grams, counts = counted(np.stack(words, axis=1), counts)
    keys = gram_keys(grams)
    order = np.argsort(keys)
    _write(folder, f"grams{level}-{bucket}", {"key": keys[order], "count": counts[order].astype(np.uint64)})
    parts = [_part("figures", bucket, b"", _figures(counts))]
    if level > 1:
        stats = [counts, counts == 1, counts == 2, counts >= 3]
        context, *sums = _sum_by(gram_keys(grams[:, :-1]), *stats)
        for to, at in _split(key_bucket(context, grid)):
            blob = pack([context[at], *[s[at] for s in sums]], [8, 5, 4, 4, 4])
            parts.append(_part(f"contexts{level}", to, blob))
        parts += _gram_parts(f"grams{level - 1}", *counted(grams[:, 1:]), grid)
    if top:
        word, total = _sum_by(grams[:, -1], counts)
        parts += _gram_parts("words", word[:, None], total, grid)
    return pa.Table.from_batches(parts)


def _merge_contexts(key: tuple, table: pa.Table, level: int, folder: str) -> pa.Table:
    bucket = key[0].as_py()
    context, *sums = _sum_by(*unpack(table.column("blob").to_pylist(), [8, 5, 4, 4, 4]))
    names = ("total", "one", "two", "more")
    _write(folder, f"contexts{level}-{bucket}", {"key": context} | dict(zip(names, sums, strict=True)))
    return pa.Table.from_batches([_part("figures", bucket, b"", (len(context), 0, 0, 0, 0, 0))])


def _merge_words(key: tuple, table: pa.Table, folder: str) -> pa.Table:
    bucket = key[0].as_py()
    word, total = _sum_by(*unpack(table.column("blob").to_pylist(), [6, 5]))
    _write(folder, f"words-{bucket}", {"key": word, "count": total})
    return pa.Table.from_batches([_part("figures", bucket, b"", _figures(total))])


@dataclass(frozen=True)
class Model:
    """Where the files of a model are, and its few global figures."""

    folder: str
    order: int
    grid: int
    tokens: int
    distinct: int
    discounts: tuple[tuple[float, float, float], ...]  # for counts of 1, 2 and more, by order
    words_total: int  # different words before each word, summed
    words_backoff: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more; a half of each where too few n-grams tell."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def local_path(uri: str) -> str:
    """The path of a folder on a mounted file system."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory maps need a mounted shared folder, not {parts.scheme}:")
    return unquote(parts.path)


def train(docs: DataFrame, order: int = 3, chunk: int = CHUNK) -> Model:
    """A model of the column ``text`` of ``docs``; null texts count as empty.

    An empty text is one end. No texts at all give a model under which every token has the
    probability of the one unknown word. Case of A-Z is ignored.
    """
    spark = docs.sparkSession
    folder = local_path(scratch_path(spark, "ngrams"))
    grid = max(2, round(int(spark.conf.get("spark.sql.shuffle.partitions")) ** 0.5))

    def summed(parts: DataFrame, kind: str, merge) -> tuple[DataFrame, dict[str, int]]:
        chosen = parts.where(F.col("kind") == kind).select("bucket", "blob")
        whole = lambda key, table: merge(key, table)  # noqa: E731  it must be a plain function
        merged = keep(chosen.groupBy("bucket").applyInArrow(whole, _PARTS), kind)
        row = merged.where("kind = 'figures'").agg(*[F.sum(c).alias(c) for c in _FIGURES]).first()
        return merged, {c: row[c] or 0 for c in _FIGURES}

    parts = docs.select("text").mapInArrow(partial(_count, order=order, grid=grid, chunk=chunk), _PARTS)
    found, levels, words = parts, {}, None
    for level in range(order, 0, -1):
        merge = partial(_merge, level=level, top=level == order, grid=grid, folder=folder)
        found, levels[level] = summed(found, f"grams{level}", merge)
        if level == order:
            _, words = summed(found, "words", partial(_merge_words, folder=folder))
        if level > 1:
            summed(found, f"contexts{level}", partial(_merge_contexts, level=level, folder=folder))
    cut = [discounts(*[levels[m][f"n{k}"] for k in (1, 2, 3, 4)]) for m in range(1, order + 1)]
    one = levels[1]
    left = one["n1"] * cut[0][0] + one["n2"] * cut[0][1] + (one["distinct"] - one["n1"] - one["n2"]) * cut[0][2]
    backoff = left / one["total"] if one["total"] else 1.0
    return Model(folder, order, grid, words["total"], words["distinct"], tuple(cut), one["total"], backoff)


class _Files:
    """Sorted arrays of a model, mapped when first asked for."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def get(self, name: str, part: str, kind) -> np.ndarray:
        if (name, part) not in self.open:
            path = f"{self.folder}/{name}.{part}"
            # No file: no text fell into the bucket. Empty files cannot be mapped.
            there = os.path.exists(path) and os.path.getsize(path)
            self.open[name, part] = np.memmap(path, kind, "r") if there else np.zeros(0, kind)
        return self.open[name, part]

    def find(self, kind: str, bucket: np.ndarray, keys: np.ndarray, parts: tuple[str, ...]) -> list[np.ndarray]:
        """The values stored for each key, 0 where it is not stored."""
        out = [np.zeros(len(keys), np.float64) for _ in parts]
        order = np.lexsort((keys, bucket))
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for first, last in zip(edges, [*edges[1:], len(order)], strict=True):
            at = order[first:last]
            name = f"{kind}-{bucket[at[0]]}"
            stored = self.get(name, "key", np.uint64)
            if not len(stored):
                continue
            place = np.minimum(np.searchsorted(stored, keys[at]), len(stored) - 1)
            hit = stored[place] == keys[at]
            for values, part in zip(out, parts, strict=True):
                values[at[hit]] = self.get(name, part, np.uint64)[place[hit]]
        return out


def _after_discount(count: np.ndarray, cut: tuple[float, float, float]) -> np.ndarray:
    less = np.select([count == 0, count == 1, count == 2], [0, cut[0], cut[1]], cut[2])
    return np.maximum(count - less, 0)


def probabilities(stream: np.ndarray, at: np.ndarray, model: Model, files: _Files) -> np.ndarray:
    """The probability of each token at the places ``at`` of a stream."""
    found = np.full(len(at), 1 / (model.distinct + 1))
    for level in range(1, model.order + 1):
        grams = np.stack([stream[at - level + 1 + k] for k in range(level)], axis=1)
        (count,) = files.find(f"grams{level}", grid_bucket(grams, model.grid), gram_keys(grams), ("count",))
        cut = model.discounts[level - 1]
        if level == 1:
            if model.words_total:
                found = _after_discount(count, cut) / model.words_total + model.words_backoff * found
            continue
        context = gram_keys(grams[:, :-1])
        parts = ("total", "one", "two", "more")
        total, one, two, more = files.find(f"contexts{level}", key_bucket(context, model.grid), context, parts)
        seen = total > 0
        total = np.where(seen, total, 1)
        backoff = np.where(seen, (one * cut[0] + two * cut[1] + more * cut[2]) / total, 1)
        found = _after_discount(count, cut) / total + backoff * found
    return found


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    files = _Files(model.folder)
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for _, _, words, rows in blocks_of_words(batch.column("text")):
            stream, at = token_stream(words, rows, model.order)
            tokens = stream[at]
            (count,) = files.find("words", key_bucket(tokens, model.grid), tokens, ("count",))
            base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
            score = np.log10(probabilities(stream, at, model, files))
            first = rows[:-1] + np.arange(len(rows) - 1)
            for column, values in zip(out, (np.ones(len(at)), count > 0, base, score), strict=True):
                column.append(np.add.reduceat(values.astype(np.float64), first))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        n, known, base, score = [np.concatenate(c) if c else np.zeros(0) for c in out]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
            names=[*batch.schema.names[:-1], "n_tokens", "n_known", "base_score", "score"],
        )


def scored(docs: DataFrame, model: Model, ids: list[str]) -> DataFrame:
    """``ids``, n_tokens, n_known, base_score and score (both log10) of each text of ``docs``.

    A text is its words and one end; null counts as empty. base_score takes each token's share
    of the training tokens, one added. Perplexity is 10 ** (-score / n_tokens).
    """
    rows = docs.select(*ids, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(
        partial(_score, model=model), f"{fields}, n_tokens long, n_known long, base_score double, score double"
    )
