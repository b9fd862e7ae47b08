"""Texts that hold passages of a benchmark, found by spaced seeds.

A spaced seed is a window of words of which a fixed mask ignores some, so that a hash of the
others survives a substituted word. All windows of the benchmark are hashed under each mask;
windows of the texts with the same hash are hits. Around each hit, on its diagonal (the
difference of the two positions), the overlap of text and benchmark item is decided word by
word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import blocks_of_words, mixed
from tradewind.session import keep

# Masks of 10 words that leave out words 5 and 6, 7 and 8, or 9 (from 0). Before a segment that
# counts most reaches its first changed word it has 5 equal words, and 9 before the second (see
# MISS), so of its first 10 words at most one is changed, none before word 5: one of the masks
# hits there, whatever the pattern of changes.
MASKS = ("1111100111", "1111111001", "1111111110")
# Hashes of the benchmark are marked in so many bits, at two places each, so that texts need
# not be shuffled to find that they have no hit. The size is fixed; with a benchmark so large
# that most bits are set more windows are shuffled, and the result is the same.
FILTER_BITS = 24
# A segment of the diagonal counts one for an equal word and MISS for another one, which it
# outweighs at 80 % equal words. It is an overlap from LEAST equal words, or all but two words
# of an item of LEAST words or one more. Items of fewer than LEAST words must stand there whole.
MISS = -4
LEAST = 12


def _wanted(n: int) -> int:
    """How many equal words make an overlap with an item of n words."""
    return n if n < LEAST else min(LEAST, n - 2)


def _seeds(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hashes of all windows under a mask; empty if there are fewer words than the mask has."""
    width = len(mask)
    if len(words) < width:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - width + 1, salt, np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            out = out * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - width + 1 + k]
    return mixed(out)


def _bits(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.uint64(64 - FILTER_BITS)
    return (seeds >> top).astype(np.int64), ((seeds << np.uint64(FILTER_BITS)) >> top).astype(np.int64)


def _item_seeds(batches: Iterator[pa.RecordBatch], masks: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The words of each item, and its seeds and their positions."""
    for batch in batches:
        words_of, seeds_of, at_of = [], [], []
        for _, _, words, rows in blocks_of_words(batch.column("text")):
            for first, last in zip(rows[:-1], rows[1:], strict=True):
                own = words[first:last]
                if 0 < len(own) < LEAST:
                    found = [_seeds(own, "1" * len(own), len(masks) + len(own))]
                else:
                    found = [_seeds(own, m, i) for i, m in enumerate(masks)]
                words_of.append(own.tobytes())
                seeds_of.append(np.concatenate(found).view(np.int64))
                at_of.append(np.concatenate([np.arange(len(f)) for f in found]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(words_of, pa.binary()), pa.array(seeds_of, pa.list_(pa.int64())), pa.array(at_of, pa.list_(pa.int64()))],
            names=["item_id", "words", "seeds", "at"],
        )


def _regions(batches: Iterator[pa.RecordBatch], masks: Sequence[tuple[str, int]], marks, margin: int) -> Iterator[pa.RecordBatch]:
    """The stretches of each text around windows whose hash may be in the benchmark; ``masks`` come
    with their salts."""
    marked = np.unpackbits(np.frombuffer(marks.value, np.uint8)).view(bool)
    widest = max(len(m) for m, _ in masks)
    for batch in batches:
        row_of, starts, words_of, seeds_of, at_of = [], [], [], [], []
        for row, _, words, rows in blocks_of_words(batch.column("text")):
            found, at = [], []
            for m, salt in masks:
                seeds = _seeds(words, m, salt)
                one, two = _bits(seeds)
                hit = np.flatnonzero(marked[one] & marked[two])
                owner = np.searchsorted(rows, hit, "right")
                hit = hit[hit + len(m) <= rows[np.minimum(owner, len(rows) - 1)]]
                found.append(seeds[hit])
                at.append(hit)
            found, at = np.concatenate(found), np.concatenate(at)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            found, at = found[order], at[order]
            owner = np.searchsorted(rows, at, "right") - 1
            apart = np.flatnonzero((np.diff(at) > 2 * margin) | (np.diff(owner) > 0)) + 1
            for first, last in zip([0, *apart], [*apart, len(at)], strict=True):
                text = owner[first]
                start = max(rows[text], at[first] - margin)
                end = min(rows[text + 1], at[last - 1] + widest + margin)
                row_of.append(row + int(text))
                starts.append(int(start - rows[text]))
                words_of.append(words[start:end].tobytes())
                seeds_of.append(found[first:last].view(np.int64))
                at_of.append(at[first:last] - start)
        kept = [batch.column(i).take(pa.array(row_of, pa.int64())) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(starts, pa.int64()), pa.array(words_of, pa.binary()), pa.array(seeds_of, pa.list_(pa.int64())), pa.array(at_of, pa.list_(pa.int64()))],
            names=[*batch.schema.names[:-1], "start", "words", "seeds", "at"],
        )


def best_segment(equal: np.ndarray) -> tuple[int, int, int]:
    """(first, length, equal words) of the segment that counts most; the first of equals."""
    score = np.where(equal, 1, MISS)
    total = np.concatenate([[0], np.cumsum(score)])
    lowest = np.minimum.accumulate(total)
    last = int(np.argmax(total - lowest))
    if total[last] <= lowest[last]:
        return 0, 0, 0
    first = int(np.flatnonzero(total[: last + 1] == lowest[last])[-1])
    return first, last - first, int(equal[first:last].sum())


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chosen, starts, item_starts, lengths, equals = [], [], [], [], []
        columns = [batch.column(n).to_pylist() for n in ("words", "item_words", "diagonal", "start")]
        for i, (text, item, diagonal, start) in enumerate(zip(*columns, strict=True)):
            text, item = np.frombuffer(text, np.uint64), np.frombuffer(item, np.uint64)
            low, high = max(0, -diagonal), min(len(item), len(text) - diagonal)
            first, length, equal = best_segment(item[low:high] == text[low + diagonal : high + diagonal])
            if equal >= _wanted(len(item)):
                chosen.append(i)
                starts.append(start + low + first + diagonal)
                item_starts.append(low + first)
                lengths.append(length)
                equals.append(equal)
        names = [n for n in batch.schema.names if n not in ("words", "item_words", "diagonal", "start")]
        kept = [batch.column(n).take(pa.array(chosen, pa.int64())) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*kept, *[pa.array(x, pa.int64()) for x in (starts, item_starts, lengths, equals)]],
            names=[*names, "text_start", "item_start", "n_words", "n_equal"],
        )


def overlaps(docs: DataFrame, benchmark: DataFrame, ids: Sequence[str], masks: Sequence[str] = MASKS) -> DataFrame:
    """A row for each overlap of a text with a benchmark item.

    ``docs`` has a column ``text``; ``benchmark`` has item_id and text. Returns ``ids``,
    item_id, text_start, item_start, n_words (length of the overlap in words) and n_equal.
    Words are compared in lower case.
    Items of equal words are one, under the least item_id, which is null only if all of theirs
    are; an item of fewer than LEAST words is found where all its words stand, and a null or empty
    one nowhere.
    Rows of ``docs`` stay apart even if their ids are equal or null; a text that holds an item
    in two places gives two rows.
    """
    spark = docs.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", F.lower("text").alias("text")).mapInArrow(
        partial(_item_seeds, masks=tuple(masks)),
        f"item_id {kind}, words binary, seeds array<long>, at array<long>",
    )
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id"), F.min("seeds").alias("seeds"), F.min("at").alias("at"))
    items = keep(items.where("size(seeds) > 0").withColumn("item", F.xxhash64("words")), "items")
    seeds = items.select("item", F.explode(F.arrays_zip("seeds", "at")).alias("s"))
    seeds = keep(seeds.select("item", F.col("s.seeds").alias("seed"), F.col("s.at").alias("item_at")), "seeds")
    longest = items.agg(F.max(F.octet_length("words"))).first()[0]
    margin = (longest or 0) // 8
    n_words = F.octet_length("words") / 8
    short = sorted(int(x.n) for x in items.where(n_words < LEAST).select(n_words.alias("n")).distinct().collect())
    salted = (*((m, i) for i, m in enumerate(masks)), *(("1" * n, len(masks) + n) for n in short))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array(batch.column("seed")).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_bits(own))).astype(np.int32))], names=["bit"])

    found = seeds.select("seed").mapInArrow(places, "bit int").distinct().toArrow()
    marked = np.zeros(1 << FILTER_BITS, bool)
    marked[found.column("bit").to_numpy()] = True
    marks = spark.sparkContext.broadcast(np.packbits(marked).tobytes())

    rows = docs.select(*ids, F.lower("text").alias("text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    regions = rows.mapInArrow(
        partial(_regions, masks=salted, marks=marks, margin=margin),
        f"{fields}start long, words binary, seeds array<long>, at array<long>",
    )
    regions = keep(regions.withColumn("region", F.monotonically_increasing_id()), "regions")
    hits = regions.select("region", F.explode(F.arrays_zip("seeds", "at")).alias("s"))
    hits = hits.select("region", F.col("s.seeds").alias("seed"), F.col("s.at").alias("at"))
    met = hits.join(seeds, "seed").select("region", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    met = keep(met, "diagonals")
    sides = met.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item").drop("item")
    sides = sides.join(regions.drop("seeds", "at"), "region")
    sides = sides.select(*ids, "region", "item_id", "words", "item_words", "diagonal", "start")
    result = f"{fields}region long, item_id {kind}, text_start long, item_start long, n_words long, n_equal long"
    return sides.mapInArrow(_overlaps, result)


def contaminated(docs: DataFrame, benchmark: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Distinct ``ids`` of the texts that overlap a benchmark item."""
    return overlaps(docs, benchmark, ids).select(*ids).distinct()
