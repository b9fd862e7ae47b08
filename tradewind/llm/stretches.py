"""Stretches of words that stand more than once, word by word.

Of each PASSAGE - SEED + 1 neighbouring windows of SEED words the one with the least hash is a
seed, so two copies of any PASSAGE words share a seed. From shared seeds the match is extended
word by word to its ends; line ends and spaces do not matter.

Texts are numbered in the order of their ids, and a place is a text's number with the number of
a word. Stretches travel as arrays (``packed``): the texts of a chunk ask each part of the keys
for the first place of their keys there, one row for a chunk and a part, with each key once.
However often a key stands in the texts, the task of its part gets it once from each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import packed
from tradewind.llm.scratch import removed, stored
from tradewind.llm.text import mixed, power_tables, text_blocks, word_numbers, word_spans

# Any repeat of PASSAGE words is found by a seed of SEED words, at most PASSAGE - SEED words from
# either end of the repeat.
SEED = 20
PASSAGE = 51
# Ends are looked up at every STEP-th word first.
STEP = 4
LEAST_PARTS = 24

# What is known of a stretch: its key, its place, its words, their places in code points, and
# on which side of a seed it stands (0: it holds a seed).
KINDS = {"key": np.uint64, "place": np.int64, "width": np.int32, "start": np.int32, "end": np.int32, "side": np.int8}
ASKED = "chunk long, part int, " + ", ".join(f"{c} binary" for c in KINDS)
FOUND = "chunk long, " + ", ".join(f"{c} binary" for c in [*KINDS, "copy"][1:])
# What repeats an earlier copy: its text, its words, their places in code points, and of the longest
# repeat in it the words, where it begins, what it is, and the text whose copy stays.
PIECES = {"no": np.int64, "first": np.int64, "last": np.int64, "start": np.int64, "end": np.int64, "size": np.int64, "from": np.int64, "kind": np.int32, "kept": np.int64}
SEGMENTS = "chunk long, " + ", ".join(f"`{c}` binary" for c in PIECES)


def sums_of(words: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """What ``stretch_hashes`` needs to hash any stretch of these words."""
    up, down = tables if len(words) <= len(tables[0]) else power_tables(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return sums, down


def stretch_hashes(sums: tuple[np.ndarray, np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed((sums[0][last] - sums[0][first]) * sums[1][first] + (last - first).astype(np.uint64))


def code_points(data: np.ndarray):
    """A function that counts the code points before places of a block."""
    inside = np.flatnonzero((data & 0xC0) == 0x80)
    return lambda at: at - np.searchsorted(inside, at)


def seeds(words: np.ndarray, rows: np.ndarray, sums) -> np.ndarray:
    """Where the seeds of a block of texts begin; ``rows`` are the first words of the texts."""
    n = PASSAGE - SEED + 1
    count = len(words) - PASSAGE + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    where = np.arange(len(words) - SEED + 1)
    least = stretch_hashes(sums, where, where + SEED)
    # The first of the least of 1, 2, 4 ... neighbouring windows, and at last of n.
    width = 1
    while width < n:
        step = min(width, n - width)
        later = least[step:] < least[:-step]
        where = np.where(later, where[step:], where[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    end = rows[np.searchsorted(rows, np.arange(count), "right")]
    where = where[np.arange(count) + PASSAGE <= end]
    return where[packed.first_of(where)]


def numbered(keyed: DataFrame) -> tuple[DataFrame, str, DataFrame, str]:
    """The different texts in chunks and where they lie; their ids (no, doc_id, text_key), likewise.

    Numbers are gapless and in the order of the ids, those that are null first.
    """
    spark = keyed.sparkSession
    keyed = keyed.where("text is not null")
    ids = keyed.select("doc_id", "text_key").dropDuplicates(["text_key"]).orderBy("doc_id", "text_key")
    ids = ids.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    ids, ids_at = stored(ids, "ids")
    # A count for each part of the sorted ids.
    parts = sorted(ids.groupBy("part").agg(F.min("at"), F.count("*")).collect())
    before = np.cumsum([0, *(n for _, _, n in parts)]).tolist()
    shifts = pa.table({"part": pa.array([p for p, _, _ in parts], pa.int32()), "shift": pa.array([b - low for (_, low, _), b in zip(parts, before, strict=False)], pa.int64())})
    numbers = ids.join(spark.createDataFrame(shifts), "part").select("doc_id", "text_key", (F.col("at") + F.col("shift")).alias("no"))
    numbers, numbers_at = stored(numbers, "numbers")
    removed(spark, ids_at)
    texts = keyed.select("text_key", "text").join(numbers.select("text_key", "no").hint("merge"), "text_key")
    texts = texts.dropDuplicates(["text_key"]).select("no", "text").mapInArrow(packed.chunked, packed.CHUNKS)
    texts, texts_at = stored(texts, "texts")
    return texts, texts_at, numbers, numbers_at


def _array(table: pa.RecordBatch | pa.Table, name: str, kind=None) -> np.ndarray:
    return packed.column(table, name, kind or KINDS.get(name, np.int64))


def _asking(chunk: int, held: list[dict[str, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """A row for each part that the stretches of a chunk ask, the keys of each in order."""
    all_of = {c: np.concatenate([h[c] for h in held]) for c in KINDS} if held else {"key": ()}
    if len(all_of["key"]):
        order = np.argsort(all_of["key"])
        all_of = {c: a[order] for c, a in all_of.items()}
        yield packed.dealt(chunk, packed.parts_of(all_of["key"], parts), all_of)


def _placed(keys, first, last, side, text, nos, rows, starts, ends, data, offsets) -> dict[str, np.ndarray]:
    """Stretches of words of a block with their places in their texts."""
    points = code_points(data)
    out = {
        "key": keys,
        "place": (nos[text] << 32) + first - rows[text],
        "width": last - first,
        "start": points(starts[first]) - points(offsets)[text],
        "end": points(ends[last - 1]) - points(offsets)[text],
        "side": side,
    }
    return {c: a.astype(KINDS[c], copy=False) for c, a in out.items()}


def _seeded(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The seeds of each text, and the stretches from each seed to the end of the next one."""
    tables = power_tables(packed.BLOCK_BYTES // 2)

    def made(nos: np.ndarray, texts: pa.Array) -> Iterator[dict[str, np.ndarray]]:
        for row, end, data, offsets in text_blocks(texts, packed.BLOCK_BYTES):
            starts, ends, rows = word_spans(data, offsets)
            words = word_numbers(data, starts, ends)
            sums = sums_of(words, tables)
            at = seeds(words, rows, sums)
            text = np.searchsorted(rows, at, "right") - 1
            next_too = np.flatnonzero(text[1:] == text[:-1])
            first = np.concatenate([at, at[next_too]])
            last = np.concatenate([at, at[next_too + 1]]) + SEED
            text = np.concatenate([text, text[next_too]])
            keys = stretch_hashes(sums, first, last)
            side = np.zeros(len(first), np.int8)
            yield _placed(keys, first, last, side, text, nos[row:end], rows, starts, ends, data, offsets)

    for batch in batches:
        for chunk, nos, texts in packed.texts_of(batch):
            yield from _asking(chunk, list(made(nos, texts)), parts)


def _before(found: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """The seed of each end: its text's number, first word and side, each once; how far a first copy
    that it does not overlap is known to go, how far any other one, and how far it was followed."""
    place, width, side, copy = (found[c] for c in ("place", "width", "side", "copy"))
    at = np.where(side > 0, place - SEED, place + width) << 1 | (side > 0)
    order = np.argsort(at)
    at, width, place, copy = (x[order] for x in (at, width, place, copy))
    edges = packed.runs(at)[:-1]
    apart = np.maximum.reduceat(np.where(_apart(place, width, copy, SEED), width, 0), edges)
    shared = np.maximum.reduceat(np.where(copy >= 0, width, 0), edges)
    at, side = at[edges] >> 1, np.where(at[edges] & 1, 1, -1).astype(np.int8)
    return at >> 32, at & 0xFFFFFFFF, side, apart, shared, np.maximum.reduceat(width, edges)


def _listed(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from ``low`` to ``high`` of each row, and their rows."""
    count = np.maximum(0, high - low + 1)
    row = np.repeat(np.arange(len(low)), count)
    return low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count), row


def _followed(chunks: pa.Table, before: pa.Table, parts: int, step: str) -> pa.Table:
    """Stretches before and behind the shared seeds of the texts of a chunk.

    ``furthest``: the longest ones. ``coarse``: of ends whose longest one has no first copy apart
    from it, those of every STEP-th length. ``fine``: the lengths between that are still open. As
    the first copy of a longer stretch is no earlier one, whether there is one is settled between
    two lengths; an end that is a first copy itself speaks for the others at all lengths it shares.
    """
    tables = power_tables(packed.BLOCK_BYTES // 2)
    most = PASSAGE - SEED
    kinds = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), *((c, pa.binary()) for c in KINDS)])
    found = {c: _array(before, c) for c in before.column_names if c != "chunk"}
    if not before.num_rows or not len(found["place"]):
        return kinds.empty_table()
    if step == "furthest":
        own = found["place"][found["width"] == SEED]
        ends_of = [np.tile(own >> 32, 2), np.tile(own & 0xFFFFFFFF, 2), np.repeat(np.array([1, -1], np.int8), len(own))]
        order = np.argsort(ends_of[0], kind="stable")
        ends_of = [x[order] for x in ends_of]
    else:
        *ends_of, known = _before(found)
        if step == "coarse":
            # Those that are left agree with a first copy as far as they may be followed.
            wanted = (ends_of[3] == 0) | (known < most)
            ends_of = [x[wanted] for x in ends_of]

    def made(nos: np.ndarray, texts: pa.Array) -> Iterator[dict[str, np.ndarray]]:
        # Only texts with such ends are hashed.
        chosen = np.flatnonzero(np.isin(nos, ends_of[0]))
        nos, texts = nos[chosen], texts.take(pa.array(chosen))
        for row, end, data, offsets in text_blocks(texts, packed.BLOCK_BYTES):
            low, high = np.searchsorted(ends_of[0], [nos[row], nos[end - 1] + 1])
            text, at, side, *reach = (x[low:high] for x in ends_of)
            text = np.searchsorted(nos[row:end], text)
            starts, ends, rows = word_spans(data, offsets)
            words = word_numbers(data, starts, ends)
            sums = sums_of(words, tables)
            limit = np.minimum(most, np.where(side > 0, rows[text + 1] - rows[text] - at - SEED, at))
            if step == "furthest":
                m, of = limit, np.arange(len(limit))
            else:
                apart, shared = reach
                if step == "coarse":
                    # An end that stands elsewhere is only looked up if a copy may go on where it can't.
                    m, of = _listed(np.ones_like(limit), np.where(apart > 0, 0, limit // STEP))
                    m, chosen = m * STEP, m * STEP < limit[of]
                else:
                    m, of = _listed(apart + 1, np.minimum(shared + STEP - 1, limit - 1))
                    chosen = m % STEP > 0
                cut = np.flatnonzero((limit < most) & ((limit % STEP > 0) | (step == "coarse")))
                m, of = np.concatenate([m[chosen], limit[cut]]), np.concatenate([of[chosen], cut])
            at, text, side = (x[of] for x in (at, text, side))
            fits = m > 0
            at, text, side, m = (x[fits] for x in (at, text, side, m))
            at = at + rows[text]
            low = np.where(side > 0, at + SEED, at - m)
            high = low + m
            key = stretch_hashes(sums, at, at + SEED)
            keys = mixed(stretch_hashes(sums, low, high) + mixed(key + side.astype(np.int64).view(np.uint64)))
            yield _placed(keys, low, high, side, text, nos[row:end], rows, starts, ends, data, offsets)

    out = [b for chunk, nos, texts in packed.texts_of(chunks) for b in _asking(chunk, list(made(nos, texts)), parts)]
    return pa.Table.from_batches(out, kinds)


def _following(parts: int, step: str):
    return lambda chunks, before: _followed(chunks, before, parts, step)


def _apart(place: np.ndarray, width: np.ndarray, copy: np.ndarray, reach: np.ndarray | int) -> np.ndarray:
    """Whether a place has a first copy that it does not overlap, with so many words behind the latter."""
    return (copy >= 0) & ((place >> 32 != copy >> 32) | (place >= copy + width + reach))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each key of a chunk and part once, with its first place there and whether it has another one."""
    for batch in batches:
        key, place = _array(batch, "key"), _array(batch, "place")
        sizes = packed.sizes_of(batch, "key", np.uint64)
        edges = np.append(np.flatnonzero(packed.first_of(np.repeat(np.arange(len(sizes)), sizes), key)), len(key))
        at = edges[:-1]
        rows = np.searchsorted(at, np.concatenate([[0], np.cumsum(sizes)]))
        columns = packed.cells([key[at], np.minimum.reduceat(place, at) if len(at) else place, np.diff(edges) > 1], rows)
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("part"), *columns], names=["chunk", "part", "key", "place", "many"])


def _answered(part: pa.Table) -> pa.Table:
    """The keys of a part that stand at several places, with the first of them, for each chunk that asked."""
    sizes = packed.sizes_of(part, "key", np.uint64).tolist()
    key, place, many = _array(part, "key"), _array(part, "place"), _array(part, "many", bool)
    order = np.argsort(key, kind="stable")
    edges = packed.runs(key[order])
    at = edges[:-1]
    run = np.empty(len(key), np.int64)
    run[order] = np.repeat(np.arange(len(at)), np.diff(edges))
    shared = ((np.diff(edges) > 1) | np.logical_or.reduceat(many[order], at))[run]
    first = np.minimum.reduceat(place[order], at)[run]
    edges = np.concatenate([[0], np.cumsum(np.add.reduceat(shared.astype(np.int64), np.cumsum([0, *sizes[:-1]])))])
    columns = packed.cells([key[shared], first[shared]], edges)
    found = pa.Table.from_arrays([part.column("chunk"), *columns], names=["chunk", "known", "copy"])
    return found.filter(pa.array(np.diff(edges) > 0))


def _regrouped(asked: pa.Table, answers: pa.Table, alone: bool) -> pa.Table:
    """The stretches of a chunk that stand elsewhere too, in order of their places; with ``alone``
    all, with a copy of -1 those that do not."""
    every = {c: _array(asked, c) for c in KINDS}
    known, copy = _array(answers, "known", np.uint64), _array(answers, "copy")
    order = np.argsort(known)
    known, copy = known[order], copy[order]
    at, shared = packed.looked_up(known, every["key"])
    every["copy"] = np.where(shared, copy[at] if len(known) else -1, -1)
    if not alone:
        every = {c: a[shared] for c, a in every.items()}
    order = np.argsort(every["place"], kind="stable")
    del every["key"]
    columns = packed.cells([a[order] for a in every.values()], np.array([0, len(order)]))
    found = pa.Table.from_arrays([asked.column("chunk")[:1] if asked.num_rows else pa.array([0]), *columns], names=["chunk", *every])
    return found.slice(0, int(len(order) > 0))


def _met(asked: DataFrame, label: str, alone: bool = False) -> tuple[DataFrame, str]:
    """The stretches that stand at several places with the first one, a row for each chunk."""
    spark = asked.sparkSession
    asked, asked_at = stored(asked, f"{label}-asked")
    once = asked.select("chunk", "part", "key", "place").mapInArrow(_once, "chunk long, part int, key binary, place binary, many binary")
    answers = once.groupBy("part").applyInArrow(_answered, "chunk long, known binary, copy binary")
    answers, answers_at = stored(answers, f"{label}-answers")

    def regrouped(one: pa.Table, other: pa.Table) -> pa.Table:
        return _regrouped(one, other, alone)

    found, found_at = stored(asked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(regrouped, FOUND), label)
    for path in (asked_at, answers_at):
        removed(spark, path)
    return found, found_at


def _segments(batches: Iterator[pa.RecordBatch], reach: int, kind: int) -> Iterator[pa.RecordBatch]:
    """What is a later copy, a piece for the stretches of a text that overlap or touch; with the
    longest of them: its words, where it begins, and the text of its first copy."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            place, width, start, end, copy = (_array(one, c) for c in ("place", "width", "start", "end", "copy"))
            chosen = _apart(place, width, copy, reach)
            place, width, start, end, copy = (x[chosen] for x in (place, width, start, end, copy))
            if not len(place):
                continue
            # A text's last word is far from the next text's first.
            stop = np.maximum.accumulate(place + width)
            edges = np.concatenate([[0], np.flatnonzero(place[1:] > stop[:-1]) + 1, [len(place)]])
            at = edges[:-1]
            best = np.lexsort((copy, place, -width, np.repeat(np.arange(len(at)), np.diff(edges))))[at]
            low = place & 0xFFFFFFFF
            found = [
                *(place[at] >> 32, low[at], stop[edges[1:] - 1] & 0xFFFFFFFF, np.minimum.reduceat(start, at), np.maximum.reduceat(end, at)),
                *(width[best], low[best], np.full(len(at), kind), copy[best] >> 32),
            ]
            yield pieces(one.column("chunk")[0].as_py(), found)


def pieces(chunk: int, found: list[np.ndarray]) -> pa.RecordBatch:
    """A chunk's row of PIECES."""
    found = [a.astype(k, copy=False) for a, k in zip(found, PIECES.values(), strict=True)]
    columns = packed.cells(found, np.array([0, len(found[0])]))
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *columns], names=["chunk", *PIECES])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(packed.column(batch, c, k)) for c, k in PIECES.items()], names=list(PIECES))


def stretches_of(texts: DataFrame) -> DataFrame:
    """What repeats an earlier copy word by word, as PIECES of each chunk: one for the stretches of a
    text that overlap or touch."""
    spark = texts.sparkSession
    # Fewer and larger parts than tasks: a chunk has a row for each.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(parts, LEAST_PARTS), parts // 3)
    found, found_at = _met(texts.mapInArrow(partial(_seeded, parts=parts), ASKED), "seeds")
    segments = [found.mapInArrow(partial(_segments, reach=0, kind=1), SEGMENTS)]
    # Most ends agree with another one as far as they are followed at all. Of all that agree only
    # the first one is followed at the shorter distances, and those that overlap their first copy:
    # where there is a first copy at some distance, there is one at all shorter ones.
    columns, paths, before = ["chunk", "place", "width", "side"], [found_at], found
    for step in ("furthest", "coarse", "fine"):
        open_ends = texts.groupBy("chunk").cogroup(before.select(*columns).groupBy("chunk"))
        before, path = _met(open_ends.applyInArrow(_following(parts, step), ASKED), step, alone=step != "fine")
        paths.append(path)
        segments.append(before.mapInArrow(partial(_segments, reach=SEED, kind=2), SEGMENTS))
        columns = [*columns[:4], "copy"]
    out, _ = stored(reduce(DataFrame.unionByName, segments), "stretches")
    for path in paths:
        removed(spark, path)
    return out


def repeated_stretches(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What repeats an earlier copy word by word: a row for the stretches of a text that overlap or
    touch, and the texts' numbers (doc_id, text_key, no).

    The rows have no, first, last (in words), start, end (in code points), and of the longest
    stretch its size, where it begins (``from``), its kind and the number of the text whose copy
    stays (``kept``). Any PASSAGE words that stand at two places are covered at the later one.
    """
    texts, texts_at, numbers, _ = numbered(keyed)
    out = stretches_of(texts)
    removed(keyed.sparkSession, texts_at)
    names = ", ".join(f"`{c}` {'int' if k is np.int32 else 'long'}" for c, k in PIECES.items())
    return out.mapInArrow(_unpacked, names), numbers
