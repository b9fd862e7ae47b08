"""Repeated passages inside texts, by MinHash bands of paragraphs.

A paragraph here is a line or a part of one: long lines are cut after each word whose hash is
the least among the REACH words before and after it. The cuts depend on the words around them
alone, so a passage that stands in two texts is cut alike in both, wherever in a line it begins.
Where lines are short or broken at other places the same rule is applied to the words as if they
stood in one line, and these parts are paragraphs too.

Paragraphs that share a band of their signature with another one are compared in full and
grouped by their links; the first paragraph of each group stays.

Passages that are repeated word by word need not hold a whole paragraph; ``stretches`` finds them.
The first copy of each stretch of words stays here too.

Neighbouring paragraphs and stretches to be removed make a span, and spans of enough words are
the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import crowds, packed, sets
from tradewind.llm.columns import all_columns, spare_name
from tradewind.llm.minhash import SHINGLE_WORDS, _permuted, _scattered
from tradewind.llm.scratch import removed, shuffles_dropped, stored
from tradewind.llm.sets import BUCKET_ROWS, CROWD, MET_ROWS, MOST, PAIRS, WANTED, _meeting, may_be_linked, met_rows, packed_rows, pairs_and_crowd, set_bits  # noqa: F401
from tradewind.llm.stars import labels_of, stars
from tradewind.llm.stretches import PASSAGE, PIECES, SEED, SEGMENTS, code_points, numbered, pieces, stretch_hashes, stretches_of, sums_of  # noqa: F401
from tradewind.llm.text import mixed, power_tables, text_blocks, word_hashes, word_numbers, word_spans  # noqa: F401

PERCENT = 80
RECALL = 0.98
BAND_ROWS = 2
REACH = 6
# Paragraphs of fewer words are not looked at, and spans of fewer words are not reported.
LEAST_WORDS = 8
LEAST_SPAN = 20


def tuned_bands(percent: int = PERCENT, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` rows that find a pair at ``percent`` with this chance."""
    bands, miss = 1, 1 - (percent / 100) ** rows
    while 1 - miss**bands < recall:
        bands += 1
    return bands


def cut(data: np.ndarray, offsets: np.ndarray, tables, lines: bool = True) -> tuple[np.ndarray, ...]:
    """The paragraphs of a block of texts, as arrays: text, first word, word after the last;
    and the words' hashes, byte starts and byte ends. Without ``lines`` a text is one line."""
    starts, ends, rows = word_spans(data, offsets)
    words = word_numbers(data, starts, ends)
    return *_cut_words(_least(words), _line_ends(data, starts, rows, lines), rows), words, starts, ends


def _least(words: np.ndarray) -> np.ndarray:
    """Whether a word's hash is less than those of the REACH words before it and at most that of
    those behind; false for words that have fewer."""
    out = np.zeros(len(words), bool)
    if len(words) > 2 * REACH:
        least, width = words, 1
        while width < REACH:
            step = min(width, REACH - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        inside = words[REACH:-REACH]
        out[REACH:-REACH] = (inside < least[: len(inside)]) & (inside <= least[REACH + 1 :])
    return out


def _line_ends(data: np.ndarray, starts: np.ndarray, rows: np.ndarray, lines: bool) -> np.ndarray:
    """Whether a line, or at least the text, ends with a word."""
    out = np.zeros(len(starts), bool)
    if lines and len(starts):
        behind = np.searchsorted(starts, np.flatnonzero(data == 10))
        out[behind[behind > 0] - 1] = True
    out[rows[1:][np.diff(rows) > 0] - 1] = True
    return out


def _cut_words(least: np.ndarray, ends_line: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    if len(least) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    # Near the ends of a line a cut would not see enough words on one side.
    at = np.flatnonzero(least)
    lines = np.concatenate([[0], np.cumsum(ends_line)])
    at = at[lines[at + REACH] == lines[at - REACH]]
    last = ends_line.copy()
    last[at] = True
    stop = np.flatnonzero(last) + 1
    start = np.concatenate([[0], stop[:-1]])
    text = np.searchsorted(rows, start, "right") - 1
    return text, start, stop


def cut_twice(data: np.ndarray, offsets: np.ndarray, tables, across: bool) -> tuple[np.ndarray, ...]:
    """``cut``; with ``across``, each text's further paragraphs over line ends come after its others."""
    starts, ends, rows = word_spans(data, offsets)
    words = word_numbers(data, starts, ends)
    least = _least(words)
    text, start, stop = _cut_words(least, _line_ends(data, starts, rows, True), rows)
    if across and len(words):
        other, low, high = _cut_words(least, _line_ends(data, starts, rows, False), rows)
        # Both are in order of their last words.
        at = np.minimum(np.searchsorted(stop, high), len(stop) - 1)
        new = (stop[at] != high) | (start[at] != low)
        text, start, stop = (np.concatenate([a, b[new]]) for a, b in ((text, other), (start, low), (stop, high)))
        order = np.argsort(text, kind="stable")
        text, start, stop = text[order], start[order], stop[order]
    return text, start, stop, words, starts, ends


def _window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for the n words from each place on, whatever paragraph they are in."""
    out = words[: max(0, len(words) - n + 1)].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - n + 1 + k]
    return mixed(out)


def _windows_of(words: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each paragraph of at least n words, and where they begin."""
    windows = _window_hashes(words, n)
    sizes = stop - start - n + 1
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return windows[np.arange(edges[-1]) - np.repeat(edges[:-1] - start, sizes)], edges


def _shingles_of(words: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of the shingles of each paragraph of at least n words, and where they begin."""
    found, edges = _windows_of(words, start, stop, n)
    return _scattered((found >> np.uint64(32)).astype(np.uint32)), edges


def band_hashes(words: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int, bands: int, rows: int) -> np.ndarray:
    """A row of band hashes for each paragraph of at least n words."""
    return _bands_of(*_shingles_of(words, start, stop, n), bands, rows)


def _bands_of(once: np.ndarray, edges: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(edges) - 1, bands), np.uint64)
    for b in range(bands):
        for r in range(rows):
            shifted = _permuted(once + np.uint32(1 + b * rows + r))
            least = np.minimum.reduceat(shifted, edges[:-1]).astype(np.uint64)
            out[:, b] = out[:, b] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(1)
    return mixed(out + np.arange(bands, dtype=np.uint64))


def set_marks(words: np.ndarray, start: np.ndarray, stop: np.ndarray, n: int) -> np.ndarray:
    """The size of each paragraph's shingle set, up to MOST, and above it a bit for each of its members."""
    return _marks_of(*_shingles_of(words, start, stop, n))


def _marks_of(once: np.ndarray, edges: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(edges) - 1, dtype=np.uint64), np.diff(edges))
    found = np.sort(owner << np.uint64(32) | once)
    owner = (found >> np.uint64(32))[np.concatenate([[True], found[1:] != found[:-1]])]
    sizes = np.bincount(owner.astype(np.int64), minlength=len(edges) - 1).astype(np.uint64)
    return set_bits(once, edges) | np.minimum(sizes, MOST)


# A paragraph in a bucket: what tells apart its words, its marks, and 1 if it stands at several
# places of the chunk, 2 in the first band.
MEMBERS = {"bucket": np.uint32, "v": np.int64, "marks": np.uint64, "flags": np.uint8}
MEMBER_ROWS = "chunk long, part int, " + ", ".join(f"{c} binary" for c in MEMBERS)
# Where a paragraph stands: its text and first word, words, code points, number in its text.
PLACES = {"v": np.int64, "place": np.int64, "width": np.int32, "start": np.int32, "end": np.int32, "paragraph": np.int32}
PLACE_ROWS = ", ".join(f"{c} binary" for c in PLACES)


def _bucketed(batches: Iterator[pa.RecordBatch], parts: int, n: int, bands: int, rows: int, least: int, across: bool) -> Iterator[pa.RecordBatch]:
    """The different paragraphs of a chunk, in each of their buckets."""
    tables = power_tables(packed.BLOCK_BYTES // 2)

    def made(texts: pa.Array) -> Iterator[list[np.ndarray]]:
        for _, _, data, offsets in text_blocks(texts, packed.BLOCK_BYTES):
            _, start, stop, words, _, _ = cut_twice(data, offsets, tables, across)
            long = stop - start >= max(least, n)
            if long.any():
                start, stop = start[long], stop[long]
                once, edges = _shingles_of(words, start, stop, n)
                v = stretch_hashes(sums_of(words, tables), start, stop).view(np.int64)
                yield [v, _marks_of(once, edges), _bands_of(once, edges, bands, rows)]

    for batch in batches:
        for chunk, _, texts in packed.texts_of(batch):
            held = list(made(texts))
            if not held:
                continue
            v, marks, found = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(v)
            edges = packed.runs(v[order])
            at = order[edges[:-1]]
            flags = np.repeat((np.diff(edges) > 1).astype(np.uint8)[:, None], bands, axis=1)
            flags[:, 0] |= 2
            found = found[at].ravel()
            low = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            members = (low, np.repeat(v[at], bands), np.repeat(marks[at], bands), flags.ravel())
            yield packed.dealt(chunk, packed.parts_of(found, parts), dict(zip(MEMBERS, members, strict=True)))


def _met(part: pa.Table, percent: int, parts: int) -> pa.Table:
    """Of the buckets of a part: pairs that may be linked, members of large buckets, and for each chunk
    its paragraphs that are looked at, or stand elsewhere too."""
    part = part.take(pa.array(np.argsort(part.column("chunk").to_numpy())))
    bucket, v, marks, flags = (packed.column(part, c, k) for c, k in MEMBERS.items())
    chunk = np.repeat(part.column("chunk").to_numpy(), packed.sizes_of(part, "v", np.int64))
    key = np.sort(bucket.astype(np.uint64) << np.uint64(32) | np.arange(len(bucket), dtype=np.uint64))
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    bucket = (key >> np.uint64(32)).astype(np.int64)
    sizes = np.diff(packed.runs(bucket))
    shared = np.repeat(sizes > 1, sizes)
    alone = at[~shared]
    alone = alone[flags[alone] == 3]
    at, bucket = at[shared], bucket[shared]
    # In order of the bucket, v and the chunk, which a bucket's rows come in.
    order = np.argsort(v[at], kind="stable")
    order = order[np.argsort(bucket[order], kind="stable")]
    at, bucket = at[order], bucket[order]
    new = packed.first_of(bucket, v[at])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    many = (count > 1) | (np.maximum.reduceat(flags[at] & 1, first) > 0 if len(first) else False)
    copies = many & (flags[at[first]] & 2 > 0)
    sizes = np.diff(packed.runs(bucket[first]))
    several = np.repeat(sizes > 1, sizes)
    columns = [bucket[first][several], v[at[first]][several], marks[at[first]][several]]
    a, b, crowd = pairs_and_crowd(*columns, percent)
    looked = packed.looked_up(np.unique(np.concatenate([a, b, crowd])), v[at[first]])[1]
    group = np.cumsum(new) - 1
    wanted = (looked | copies)[group] if len(group) else np.zeros(0, bool)
    # The first chunk of a paragraph gives its words.
    gives = ((looked[group] & new)[wanted] if len(group) else wanted).astype(np.uint8)
    asked, whose, gives = (np.concatenate(x) for x in ((v[at[wanted]], v[alone]), (chunk[at[wanted]], chunk[alone]), (gives, np.zeros(len(alone), np.uint8))))
    order = np.lexsort((gives, asked, whose))[::-1]
    order = order[packed.first_of(whose[order], asked[order])]
    asked, whose, gives = asked[order], whose[order], gives[order]
    return pa.concat_tables([*met_rows(a, b, crowd, parts), packed_rows(WANTED, whose, asked, gives)])


def _written_out(chunks: pa.Table, asked: pa.Table, parts: int, n: int, least: int, across: bool) -> pa.Table:
    """Where the paragraphs that a chunk is asked for stand, and the sets of shingles of some, by their part."""
    tables = power_tables(packed.BLOCK_BYTES // 2)
    kinds = pa.schema([("chunk", pa.int64()), *((c, pa.binary()) for c in PLACES), ("part", pa.int32()), *((c, pa.binary()) for c in sets.SETS if c != "v")])
    if not asked.num_rows:
        return kinds.empty_table()
    wanted, gives = packed.column(asked, "a", np.int64), packed.column(asked, "b", np.uint8)
    order = np.lexsort((gives, wanted))[::-1]
    order = order[packed.first_of(wanted[order])][::-1]
    wanted, gives = wanted[order], gives[order] > 0
    places, written = [], []
    for chunk, nos, texts in packed.texts_of(chunks):
        for row, _, data, offsets in text_blocks(texts, packed.BLOCK_BYTES):
            text, start, stop, words, starts, ends = cut_twice(data, offsets, tables, across)
            number = np.arange(len(text)) - np.searchsorted(text, text)
            long = stop - start >= max(least, n)
            text, start, stop, number = text[long], start[long], stop[long], number[long]
            v = stretch_hashes(sums_of(words, tables), start, stop).view(np.int64)
            of, known = packed.looked_up(wanted, v)
            text, start, stop, number, v, of = text[known], start[known], stop[known], number[known], v[known], of[known]
            if not len(v):
                continue
            points = code_points(data)
            rows = np.searchsorted(starts, offsets)
            place = (nos[row:][text] << 32) + start - rows[text]
            low, high = points(starts[start]) - points(offsets)[text], points(ends[stop - 1]) - points(offsets)[text]
            places.append([v, place, stop - start, low, high, number])
            new = np.unique(of, return_index=True)[1]
            new = new[gives[of[new]]]
            gives[of[new]] = False
            if len(new):
                written.append([v[new], *sets.shingle_sets(*_windows_of(words, start[new], stop[new], n))])
        out = []
        if places:
            found = [np.concatenate(x) for x in zip(*places, strict=True)]
            order = np.argsort(found[1])
            columns = packed.cells([a[order].astype(k, copy=False) for a, k in zip(found, PLACES.values(), strict=True)], np.array([0, len(order)]))
            out.append(pa.Table.from_arrays([pa.array([chunk]), *columns], names=["chunk", *PLACES]))
        if written:
            v, sizes, members = (np.concatenate(x) for x in zip(*written, strict=True))
            out.append(pa.Table.from_batches([sets.dealt(packed.parts_of(v, parts), v, sizes, members)]))
    # Rows of places have no part, and rows of sets no chunk.
    return pa.concat_tables([kinds.empty_table(), *out], promote_options="default").select(kinds.names)


def _keyed(docs: DataFrame, name: str = "text_key") -> DataFrame:
    return docs.withColumn(name, F.xxhash64("doc_id", F.lit(3), "text"))


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT, recall: float = RECALL, least: int = LEAST_WORDS, across: bool = False) -> DataFrame:
    """Paragraphs that have a near copy: doc_id, text_key, paragraph, start, end, n_words, first, group.

    ``docs`` has doc_id and text. Positions count code points, the end is exclusive; first is
    the number of the paragraph's first word. Copies are
    linked by 100 * shared five-word shingles >= percent * all of them. Rows equal in doc_id
    and text are one text; rows with equal or null ids and other texts are texts of their own.
    With ``across`` the paragraphs that a text has if line ends are spaces are added; a copy may
    then overlap another one of its text.
    """
    texts, texts_at, numbers, _ = numbered(_keyed(docs.select("doc_id", "text")))
    found, _ = _grouped(texts, percent, recall, least, across)
    removed(docs.sparkSession, texts_at)

    rows = found.mapInArrow(_paragraph_rows, "no long, paragraph int, start long, end long, n_words long, first long, `group` long")
    return rows.join(numbers, "no").select("doc_id", "text_key", "paragraph", "start", "end", "n_words", "first", "group")


def _paragraph_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place, width, start, end, number = (packed.column(batch, c, k) for c, k in PLACES.items() if c != "v")
        columns = [place >> 32, number, start.astype(np.int64), end.astype(np.int64), width.astype(np.int64), place & 0xFFFFFFFF, packed.column(batch, "group", np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["no", "paragraph", "start", "end", "n_words", "first", "group"])


def _different(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The different paragraphs of a chunk, by their part."""
    for batch in batches:
        for row in range(batch.num_rows):
            v = np.unique(packed.column(batch.slice(row, 1), "v", np.int64))
            yield packed.dealt(batch.column("chunk")[row].as_py(), packed.parts_of(v, parts), {"v": v})


def _labelled(asked: pa.Table, labels: pa.Table) -> pa.Table:
    """Those paragraphs of a part that have a link, with their component, for each chunk that asked."""
    known, component = labels_of(labels)
    out = []
    for chunk, v in zip(asked.column("chunk").to_pylist(), asked.column("v").to_pylist(), strict=True):
        v = np.frombuffer(v, np.int64)
        at, linked = packed.looked_up(known, v)
        if linked.any():
            out.append((chunk, v[linked].tobytes(), component[at[linked]].tobytes()))
    kinds = [("chunk", pa.int64()), ("known", pa.binary()), ("component", pa.binary())]
    return pa.Table.from_arrays([pa.array([x[i] for x in out], k) for i, (_, k) in enumerate(kinds)], names=[c for c, _ in kinds])


def _with_group(places: pa.Table, answers: pa.Table) -> pa.Table:
    """The paragraphs of a chunk with their groups: the component, or else the words alone."""
    v = packed.column(places, "v", np.int64)
    known, component = packed.column(answers, "known", np.int64), packed.column(answers, "component", np.int64)
    order = np.argsort(known)
    at, linked = packed.looked_up(known[order], v)
    group = np.where(linked, component[order][at] if len(known) else 0, v)
    return places.drop_columns("v").append_column("group", packed.cells([group], np.array([0, len(group)]))[0]) if places.num_rows else places.drop_columns("v").append_column("group", pa.array([], pa.binary()))


def _of_groups(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The first paragraph of each group in a chunk, and how many there are, by the group's part."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            group, place, width = (packed.column(one, c, k) for c, k in (("group", np.int64), ("place", np.int64), ("width", np.int32)))
            order = np.lexsort((width, place, group))
            edges = packed.runs(group[order])
            at = order[edges[:-1]]
            found = {"group": group[at], "place": place[at], "width": width[at], "n": np.diff(edges)}
            yield packed.dealt(one.column("chunk")[0].as_py(), packed.parts_of(found["group"], parts), found)


def _firsts(part: pa.Table) -> pa.Table:
    """The groups of a part that have several paragraphs, with the first one, for each chunk that has some."""
    sizes = packed.sizes_of(part, "group", np.int64)
    group, place, width, n = (packed.column(part, c, k) for c, k in (("group", np.int64), ("place", np.int64), ("width", np.int32), ("n", np.int64)))
    order = np.lexsort((width, place, group))
    edges = packed.runs(group[order])
    at = np.repeat(order[edges[:-1]], np.diff(edges))
    several = np.repeat(np.add.reduceat(n[order], edges[:-1]) > 1, np.diff(edges))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    at, several = at[back], several[back]
    edges = np.concatenate([[0], np.cumsum(np.add.reduceat(several.astype(np.int64), np.cumsum(sizes) - sizes))])
    columns = packed.cells([group[several], place[at[several]], (place + width)[at[several]]], edges)
    return pa.Table.from_arrays([part.column("chunk"), *columns], names=["chunk", "known", "copy", "stop"])


def _copies(places: pa.Table, firsts: pa.Table) -> pa.Table:
    """The paragraphs of a chunk that repeat the first one of their group, as PIECES."""
    known, copy, stop = (packed.column(firsts, c, np.int64) for c in ("known", "copy", "stop"))
    order = np.argsort(known)
    known, copy, stop = known[order], copy[order], stop[order]
    group = packed.column(places, "group", np.int64)
    place, width, start, end, _ = (packed.column(places, c, k) for c, k in PLACES.items() if c != "v")
    at, several = packed.looked_up(known, group)
    at, place, width, start, end = (x[several] for x in (at, place, width, start, end))
    # In the text of the first copy, what overlaps it is no other copy.
    other = (place >> 32 != copy[at] >> 32) | (place >= stop[at])
    at, place, width, start, end = (x[other] for x in (at, place, width, start, end))
    first = place & 0xFFFFFFFF
    found = [place >> 32, first, first + width, start, end, width, first, np.zeros(len(at), np.int32), copy[at] >> 32]
    out = pa.Table.from_batches([pieces(places.column("chunk")[0].as_py() if places.num_rows else 0, found)])
    return out.slice(0, int(len(at) > 0))


def _spans(found: pa.Table, least_span: int) -> pa.Table:
    """The spans of the texts of a chunk, from all its PIECES."""
    no, first, last, start, end, size, at, kind, kept = (packed.column(found, c, k) for c, k in PIECES.items())
    order = np.lexsort((kind, last, first, no))
    no, first, last, start, end, size, at, kind, kept = (x[order] for x in (no, first, last, start, end, size, at, kind, kept))
    low, high = (no << 32) + first, (no << 32) + last
    # A text's first word is far from the last one of the text before.
    done = np.concatenate([[-LEAST_WORDS], np.maximum.accumulate(high)[:-1]])
    # A few words between two repeats do not end a span.
    edges = np.flatnonzero(low - done >= LEAST_WORDS)
    span = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(no))))
    words = np.add.reduceat(np.maximum(0, high - np.maximum(low, done)), edges)
    best = np.lexsort((kept, -kind, at, -size, span))[edges]
    columns = [no[edges], np.minimum.reduceat(start, edges), np.maximum.reduceat(end, edges), words, kept[best]]
    out = pa.Table.from_arrays([pa.array(c) for c in columns], names=["no", "start", "end", "n_words", "kept"])
    return out.filter(pa.array(words >= least_span))


def _grouped(texts: DataFrame, percent: int, recall: float, least: int, across: bool) -> tuple[DataFrame, str]:
    """The paragraphs of each chunk that are looked at, with their groups, and where they lie."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One band more than the recall needs: a pair that misses all of them is not looked for again.
    bands = tuned_bands(percent, BAND_ROWS, recall) + 1
    options = {"n": SHINGLE_WORDS, "least": least, "across": across}
    members = texts.mapInArrow(partial(_bucketed, parts=parts, bands=bands, rows=BAND_ROWS, **options), MEMBER_ROWS)

    def meeting(part: pa.Table) -> pa.Table:
        return _met(part, percent, parts)

    def written_out(chunks: pa.Table, asked: pa.Table) -> pa.Table:
        return _written_out(chunks, asked, parts, **options)

    met, met_at = stored(members.groupBy("part").applyInArrow(meeting, MET_ROWS), "pairs")
    asked = met.where(F.col("kind") == WANTED).select(F.col("to").alias("chunk"), "a", "b")
    schema = f"chunk long, {PLACE_ROWS}, part int, {', '.join(f'{c} binary' for c in sets.SETS if c != 'v')}"
    written = texts.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(written_out, schema)
    written, written_at = stored(written, "paragraphs")
    places = written.where("part is null").select("chunk", *PLACES)
    known = written.where("part is not null").select("part", *sets.SETS)

    pairs, crowd = (met.where(F.col("kind") == k).select(F.col("to").cast("int").alias("part"), "a", "b") for k in (PAIRS, CROWD))
    if not crowd.isEmpty():
        more, links = crowds.met(crowd.select("part", F.col("a").alias("v")), known, percent, parts)
        links = links.unionByName(sets.linked(pairs.unionByName(more), known, percent, parts))
    else:
        links = sets.linked(pairs, known, percent, parts)
    labels, labels_at = stars(links, parts)
    removed(spark, met_at)

    asked = places.select("chunk", "v").mapInArrow(partial(_different, parts=parts), "chunk long, part int, v binary")
    answers = asked.groupBy("part").cogroup(labels.groupBy("part")).applyInArrow(_labelled, "chunk long, known binary, component binary")
    found = places.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    kinds = ", ".join(f"{c} binary" for c in PLACES if c != "v")
    found, found_at = stored(found.applyInArrow(_with_group, f"chunk long, {kinds}, `group` binary"), "grouped")
    for path in (written_at, labels_at):
        removed(spark, path)
    return found, found_at


def repeated_spans(docs: DataFrame, percent: int = PERCENT, least_span: int = LEAST_SPAN) -> DataFrame:
    """Spans of texts that repeat what stands elsewhere, to be removed.

    Returns doc_id, text_key, start, end, n_words and kept_doc_id, the text in which the first
    copy of the span's longest paragraph or stretch stays. n_words counts the repeated words;
    fewer than LEAST_WORDS others between two repeats go with them. The first copy is that with
    the least doc_id (nulls first), then place; it may be in the same text. A null or empty text
    has no spans.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def spans(chunk: pa.Table) -> pa.Table:
        return _spans(chunk, least_span)

    with shuffles_dropped(spark):
        texts, texts_at, numbers, _ = numbered(_keyed(docs.select("doc_id", "text")))
        found, found_at = _grouped(texts, percent, RECALL, LEAST_WORDS, across=True)
        stretches = stretches_of(texts)
        removed(spark, texts_at)
        firsts = found.select("chunk", "group", "place", "width").mapInArrow(
            partial(_of_groups, parts=parts), "chunk long, part int, `group` binary, place binary, width binary, n binary"
        )
        firsts = firsts.groupBy("part").applyInArrow(_firsts, "chunk long, known binary, copy binary, stop binary")
        copies = found.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInArrow(_copies, SEGMENTS)
        out = copies.unionByName(stretches).groupBy("chunk").applyInArrow(spans, "no long, start long, end long, n_words long, kept long")
        out, _ = stored(out, "spans")
        removed(spark, found_at)
    kept = numbers.select(F.col("no").alias("kept"), F.col("doc_id").alias("kept_doc_id"))
    return out.join(numbers, "no").join(kept, "kept").select("doc_id", "text_key", "start", "end", "n_words", "kept_doc_id")


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``repeated_spans`` taken out of their texts."""
    key, cuts = spare_name(docs, "text_key"), spare_name(docs, "cuts")
    listed = F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts)
    joined = _keyed(docs, key).join(found.groupBy(F.col("text_key").alias(key)).agg(listed), key, "left")
    rest = F.aggregate(
        cuts,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.concat(s["done"], F.substring("text", (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))).alias("done"),
            x["end"].alias("at"),
        ),
        lambda s: F.concat(s["done"], F.substring("text", (s["at"] + 1).cast("int"), F.length("text"))),
    )
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(rest)
    return joined.withColumn("text", text).select(*all_columns(docs))
