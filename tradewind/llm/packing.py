"""Packing of token streams into training sequences by order-preserving dynamic programming.

The documents of a partition are one stream of tokens in their order. It is cut into windows of
at most ``length`` tokens; every document and sentence end is a place where a cut may go. The
cost of a window is its padding plus a penalty for the kind of its cut, and the cheapest cuts
of the whole stream are found by dynamic programming: with f the cost up to a place and p its
position, f(j) = length - p(j) + penalty(j) + least f(i) + p(i) over places i within ``length``
before j, and a monotone queue gives that least value in constant time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame

from tradewind.llm.text import BLOCK_BYTES, power_tables, text_blocks, word_hashes, word_spans

LENGTH = 4096
# Cost, in tokens of padding, of a cut inside a document at a sentence end, and elsewhere.
SENTENCE_CUT = 8
WORD_CUT = 256
# Where a sentence is longer, cuts between words are offered so many tokens apart.
STRIDE = 64
# Windows are settled in portions of about so many tokens; the open end is carried on.
PORTION = 1 << 20
END = 2
_END = np.uint32(END)


class Words:
    """Ids of words, by a tokenizer that takes A-Z as a-z and never joins characters over white space.

    Words are found by their 64-bit hashes among those of earlier texts: in sorted arrays, or,
    if they are new, in a dictionary that is merged into the arrays from time to time. Unknown
    words are encoded many at a time. When there are too many known words they are forgotten.
    """

    def __init__(self, tokenizer, most: int = 3_000_000, recent: int = 200_000):
        self.tokenizer, self.most, self.most_recent = tokenizer, most, recent
        self.forget()

    def forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.recent: dict[int, int] = {}
        self.pool = np.zeros(0, np.uint32)  # ids of all known words, one after the other
        self.edges = np.zeros(1, np.int64)  # where each known word begins in it

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it is not known."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            out[hit] = self.places[at[hit]]
        if self.recent:
            rest = np.flatnonzero(out < 0)
            out[rest] = [self.recent.get(h, -1) for h in hashes[rest].tolist()]
        return out

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words that are not known yet."""
        if len(self.recent) >= self.most_recent:
            keys = np.concatenate([self.keys, np.array(list(self.recent), np.uint64)])
            places = np.concatenate([self.places, np.array(list(self.recent.values()), np.int64)])
            order = np.argsort(keys)
            self.keys, self.places, self.recent = keys[order], places[order], {}
        first = len(self.edges) - 1
        self.recent.update(zip(hashes.tolist(), range(first, first + len(words)), strict=True))
        pools, edges = [self.pool], [self.edges]
        for at in range(0, len(words), 1000):
            part = [w.decode() for w in words[at : at + 1000]]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in part])
            starts = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            edges.append(edges[-1][-1] + np.searchsorted(starts, ends))
            pools.append(np.array(found.ids, np.uint32))
        self.pool, self.edges = np.concatenate(pools), np.concatenate(edges)

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of whole texts, each with the end mark."""
        tables = power_tables(max(1, min(BLOCK_BYTES, texts.nbytes)))
        for _, _, data, offsets in text_blocks(texts):
            starts, ends, rows = word_spans(data, offsets)
            hashes, _ = word_hashes(data, offsets, tables)
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.edges) + len(distinct) > self.most:
                self.forget()
            new = np.flatnonzero(self.find(distinct) < 0)
            if len(new):
                raw, at = data.tobytes().lower(), first[new]
                words = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                self.learn(distinct[new], words)
            known = self.find(distinct)[which]
            begin, size = self.edges[known], self.edges[known + 1] - self.edges[known]
            after = np.concatenate([[0], np.cumsum(size)])
            found = self.pool[np.repeat(begin - after[:-1], size) + np.arange(after[-1])]
            for low, high in zip(after[rows[:-1]], after[rows[1:]], strict=True):
                yield np.append(found[low:high], _END)


def worker_words(path: str) -> Words:
    """The words known to this worker process, which outlive its tasks."""
    import tokenizers

    kept = vars(tokenizers).setdefault("words_of_tradewind", {})
    if path not in kept:
        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        kept[path] = Words(tokenizer)
    return kept[path]


def sentence_ends(tokenizer) -> np.ndarray:
    """For each id, whether it closes a sentence."""
    out = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    for token, i in tokenizer.get_vocab().items():
        out[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
    return out


def places(ids: np.ndarray, ends: np.ndarray, doc_ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, rising, and the penalty of each."""
    closing = np.flatnonzero(ends[ids]) + 1
    at = np.unique(np.concatenate([closing, doc_ends]))
    gaps = np.diff(at, prepend=0)
    extra = [np.arange(a - g + stride, a, stride) for a, g in zip(at[gaps > stride], gaps[gaps > stride], strict=True)]
    all_at = np.unique(np.concatenate([at, *extra])) if extra else at
    penalty = np.full(len(all_at), WORD_CUT, np.int64)
    penalty[np.searchsorted(all_at, closing)] = SENTENCE_CUT
    penalty[np.searchsorted(all_at, doc_ends)] = 0
    return all_at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The window ends, among the positions ``at``, that cost least; the last is at[-1].

    The positions must not lie further apart than ``length``. Of equal costs the earliest
    start of a window wins.
    """
    position = [0, *at.tolist()]
    cost = [0] * len(position)
    back = [0] * len(position)
    queue = deque([0])  # places whose cost + position rises
    value = [0] * len(position)
    penalties = [0, *penalty.tolist()]
    penalties[-1] = 0  # nothing follows the end
    for j in range(1, len(position)):
        while position[queue[0]] < position[j] - length:
            queue.popleft()
        i = queue[0]
        back[j] = i
        cost[j] = value[i] + length - position[j] + penalties[j]
        value[j] = cost[j] + position[j]
        while queue and value[queue[-1]] > value[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(position) - 1
    while j:
        cuts.append(position[j])
        j = back[j]
    return np.array(cuts[::-1], np.int64)


def _windows(docs: Iterator[np.ndarray], ends: np.ndarray, length: int, portion: int) -> Iterator[tuple]:
    """(document, start, ids, window, offset) for each piece of a stream of documents."""
    held: list[tuple[int, int, np.ndarray]] = []  # document, start in it, ids that are still open
    size = window = 0

    def settle(final: bool) -> Iterator[tuple]:
        nonlocal held, size, window
        ids = np.concatenate([h[2] for h in held])
        edges = np.cumsum([len(h[2]) for h in held])
        cuts = best_cuts(*places(ids, ends, edges), length)
        if not final and len(cuts) > 1:
            cuts = cuts[:-1]  # the last window may still grow
        done = int(cuts[-1])
        piece, begin = 0, 0
        rest = []
        for doc, start, own in held:
            stop = begin + len(own)
            at = begin
            while at < min(stop, done):
                while cuts[piece] <= at:
                    piece += 1
                first = int(cuts[piece - 1]) if piece else 0
                to = min(stop, int(cuts[piece]))
                yield doc, start + at - begin, own[at - begin : to - begin], window + piece, at - first
                at = to
            if stop > done:
                rest.append((doc, start + max(at, begin) - begin, own[max(at, begin) - begin :]))
            begin = stop
        window += len(cuts)
        held, size = rest, sum(len(r[2]) for r in rest)

    for doc, ids in enumerate(docs):
        held.append((doc, 0, ids))
        size += len(ids)
        if size >= portion:
            yield from settle(False)
    if held:
        yield from settle(True)


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, portion: int) -> Iterator[pa.RecordBatch]:
    words = worker_words(path)
    ends = sentence_ends(words.tokenizer)
    # Rows in two partitions must not share a sequence.
    base = pyspark.TaskContext.get().partitionId() << 40
    ids_of: dict[int, tuple] = {}
    schema = None

    def docs() -> Iterator[np.ndarray]:
        nonlocal schema
        n = 0
        for batch in batches:
            schema = batch.schema
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns - 1)]
            for row, ids in enumerate(words.ids(batch.column("text"))):
                ids_of[n] = (*(c[row] for c in columns), len(ids))
                yield ids
                n += 1

    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        fields = [*list(schema)[:-1], pa.field("doc_tokens", pa.int64()), pa.field("start", pa.int64())]
        fields += [pa.field("length", pa.int64()), pa.field("ids", pa.binary())]
        fields += [pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())]
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    last = -1
    for doc, start, ids, window, offset in _windows(docs(), ends, length, portion):
        for gone in range(last, doc):
            ids_of.pop(gone, None)
        last = doc
        out.append((*ids_of[doc], start, len(ids), ids.tobytes(), base + window, offset))
        if len(out) >= 2000:
            yield made()
    if out:
        yield made()


def packed(docs: DataFrame, ids: list[str], vocabulary: str, length: int = LENGTH, portion: int = PORTION) -> DataFrame:
    """Pieces of documents laid into sequences of at most ``length`` tokens.

    ``docs`` has a column ``text``; ``ids`` are carried along and may be null or repeated, each
    row is a document of its own. A null or empty text is its end mark alone. Returns ids,
    doc_tokens, start (tokens of the document before the piece), length, ids (unsigned 32-bit
    little-endian), sequence_id (distinct over all partitions) and offset (gapless from 0).
    ``vocabulary`` is the path of a tokenizer file, the same on all executors.

    Documents keep the order of their partition, and a sequence never spans two of them. A
    task holds ``portion`` tokens and one document.
    """
    rows = docs.select(*ids, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{fields}, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    return rows.mapInArrow(partial(_pack, path=vocabulary, length=length, portion=portion), schema)
