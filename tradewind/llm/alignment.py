"""Alignment of the tokens of two tokenizers, and corpus-wide counts of the tokens that they link.

Both tokenizers cut the bytes of space + text. Byte offsets where tokens of both end cut them into
groups; these are the components of the graph that joins overlapping tokens. They are found by
pointer jumping: every token points to its farthest-right overlapping token, and the successors
of all tokens are doubled at once until they stand still at the last token of each component.

Neither tokenizer joins a space to what stands before it, so a text can be cut before any space
that follows something else, and both treat the pieces apart. Pieces that a worker has met are
looked up; new ones are encoded and aligned many at a time.

Counting is Spark's: pairs of linked ids are stored once for each document, counted by pair, and
the counts are brought back to the documents. The commonest pairs, a bounded number, are looked up
in place, so what is shuffled are rare pairs, and no key is hot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.scratch import removed, stored
from tradewind.llm.text import BLOCK_BYTES
from tradewind.session import keep

# Pairs whose counts every task holds: 2 MB.
HOT_PAIRS = 1 << 17
# Pieces, and tokens of them, that a worker remembers at most before it starts afresh.
MOST_PIECES = 400_000
MOST_TOKENS = 4_000_000
# Before a space that follows something else, unless the text ends with it.
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_CROSSING = re.compile(r"\S ")


def successors(a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """For each token, those of A and then those of B, the farthest-right overlapping token.

    Both cut the same bytes. Of two tokens with one end, that of B counts as farther right; a
    token of B that no token of A outreaches points to itself.
    """
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    to_b = np.searchsorted(b_end - b_sizes, a_end, "left") - 1
    to_a = np.searchsorted(a_end - a_sizes, b_end, "left") - 1
    n = len(a_sizes)
    return np.concatenate([n + to_b, np.where(a_end[to_a] > b_end, to_a, n + np.arange(len(b_sizes)))])


def doubled(pointers: np.ndarray) -> np.ndarray:
    """The last token that each token leads to."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


def groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A and of B, numbered from the left, and the number of groups."""
    if len(a_sizes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    ends, group = np.unique(doubled(successors(a_sizes, b_sizes)), return_inverse=True)
    return group[: len(a_sizes)], group[len(a_sizes) :], len(ends)


def byte_level() -> dict[str, int]:
    """The bytes that stand behind the characters of a byte-level vocabulary: printable Latin-1
    characters are themselves, the other bytes follow from character 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _a_bytes(tokenizer) -> list[bytes]:
    table = byte_level()
    vocabulary = tokenizer.get_vocab()
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return out


def _b_bytes(model) -> list[bytes]:
    def of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return [of(i) for i in range(model.get_piece_size())]


class Aligner:
    """Pieces of text, their tokens under both tokenizers, groups and linked pairs.

    A pair of an id a of A and b of B is the number a * (ids of B) + b. Piece i has tokens, groups
    and links in ``sizes``, its groups as text in ``texts``, and its distinct pairs with the
    number of their links from ``edges[i]`` on in ``pairs`` and ``links``. A piece whose tokens
    do not give back its bytes is not ``sound``.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = _a_bytes(self.a), _b_bytes(self.b)
        self.a_size, self.b_size = (np.array([len(x) for x in known], np.int64) for known in (self.a_bytes, self.b_bytes))
        names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names, self.widths = np.array(names, object), np.array([len(n) for n in names], np.int64)
        self.marks = np.array([",", "|", ";"], object)
        # Should a token hold a space behind something else, texts are left whole.
        self.cut = not any(_CROSSING.search(x.decode(errors="replace")) for x in (*self.a_bytes, *self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.sound = np.zeros(0, bool)
        self.edges = np.zeros(1, np.int64)
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        whole = " " + text
        return _CUT.split(whole) if self.cut else [whole]

    def _ids(self, found: list[list[int]], known: list[bytes], size: np.ndarray, raw: list[bytes]):
        """(ids, sizes in bytes, tokens of each piece, whether they give the piece's bytes)."""
        n = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
        same = np.array([b"".join([known[i] for i in own]) == r for own, r in zip(found, raw, strict=True)], bool)
        return ids, size[ids], n, same

    def learn(self, new: list[str]) -> None:
        """Encode and align pieces that are not known yet."""
        raw = [p.encode() for p in new]
        a_found = [e.ids for e in self.a.encode_batch(new, add_special_tokens=False)]
        b_found = self.b.encode([p[1:] for p in new], num_threads=1)  # B puts the space in front itself
        a, a_size, n_a, a_same = self._ids(a_found, self.a_bytes, self.a_size, raw)
        b, b_size, n_b, b_same = self._ids(b_found, self.b_bytes, self.b_size, raw)
        sound = a_same & b_same
        keep_a, keep_b = np.repeat(sound, n_a), np.repeat(sound, n_b)
        a, a_size, b, b_size = a[keep_a], a_size[keep_a], b[keep_b], b_size[keep_b]
        n_a, n_b = np.where(sound, n_a, 0), np.where(sound, n_b, 0)
        # Pieces end with tokens of both, so all of them are aligned as one text.
        of_a, of_b, n = groups(a_size, b_size)
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        piece = np.zeros(n, np.int64)
        piece[of_a] = np.repeat(np.arange(len(new)), n_a)
        n_groups = np.bincount(piece, minlength=len(new))
        n_links = np.bincount(piece, in_a * in_b, minlength=len(new)).astype(np.int64)
        self._write(a, of_a, b, of_b, piece, len(new))
        pairs, links, many = self._pairs(a, of_a, b, of_b, piece, n, len(new))
        self.pairs, self.links = np.concatenate([self.pairs, pairs]), np.concatenate([self.links, links])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(many)])
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, n_groups, n_links], axis=1)])
        self.sound = np.concatenate([self.sound, sound])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))

    def _write(self, a, of_a, b, of_b, piece, pieces: int) -> None:
        """Note the groups of each piece as text: ids in order, each with the mark that follows it."""
        group = np.concatenate([of_a, of_b])
        order = np.argsort(group, kind="stable")  # of each group the tokens of A, then those of B
        ids, of_b_too = np.concatenate([a, b])[order], order >= len(a)
        group = group[order]
        ends = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
        turns = np.append(of_b_too[1:] != of_b_too[:-1], True) if len(group) else ends
        mark = np.where(ends, 2, np.where(turns, 1, 0))
        text = "".join((self.names[ids] + self.marks[mark]).tolist())
        width = np.bincount(piece[group], self.widths[ids] + 1, pieces).astype(np.int64) if len(group) else np.zeros(pieces, np.int64)
        stops = np.cumsum(width).tolist()
        self.texts += [text[i : max(i, j - 1)] for i, j in zip([0, *stops], stops, strict=False)]

    def _pairs(self, a, of_a, b, of_b, piece, n: int, pieces: int):
        """Distinct pairs of each piece, the links of each, and the number of pairs of each piece.

        Equal ids of a group are taken together before they are paired.
        """
        own_a, times_a = np.unique(of_a * len(self.a_bytes) + a, return_counts=True)
        own_b, times_b = np.unique(of_b * len(self.b_bytes) + b, return_counts=True)
        group_a, group_b = own_a // len(self.a_bytes), own_b // len(self.b_bytes)
        first_b = np.searchsorted(group_b, np.arange(n))
        width = np.bincount(group_b, minlength=n)[group_a]
        left = np.repeat(np.arange(len(own_a)), width)
        right = first_b[group_a[left]] + np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width)
        pair = (own_a[left] % len(self.a_bytes)) * len(self.b_bytes) + own_b[right] % len(self.b_bytes)
        return summed(piece[group_a[left]], pair, times_a[left] * times_b[right], pieces)

    def found(self, texts: list[str | None]) -> dict[str, object]:
        """Sizes, groups as text, and distinct pairs of whole texts."""
        cut = [self.pieces(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        new = [p for p in dict.fromkeys(flat) if p not in self.index]
        if self.index and (len(self.index) + len(new) > MOST_PIECES or len(self.links) > MOST_TOKENS):
            self.forget()
            new = list(dict.fromkeys(flat))
        at = size = 0
        for i, p in enumerate(new):
            size += len(p)
            if size > 1_000_000 or i + 1 == len(new):
                self.learn(new[at : i + 1])
                at, size = i + 1, 0
        which = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        row = np.repeat(np.arange(len(texts)), n)
        sound = np.bincount(row, ~self.sound[which], minlength=len(texts)) == 0
        good = sound[row]
        which_good, row_good = which[good], row[good]
        sizes = np.stack([np.bincount(row_good, c, len(texts)).astype(np.int64) for c in self.sizes[which_good].T], axis=1)
        ends, listed = np.cumsum(n).tolist(), which.tolist()
        written = [
            ";".join([self.texts[i] for i in listed[end - m : end]]) if fine else ""
            for end, m, fine in zip(ends, n.tolist(), sound.tolist(), strict=True)
        ]
        # Each piece of a text once, with the number of its places; then its pairs.
        once, times = np.unique(row_good * len(self.index) + which_good, return_counts=True)
        own, piece = once // max(1, len(self.index)), once % max(1, len(self.index))
        many = self.edges[piece + 1] - self.edges[piece]
        place = np.repeat(self.edges[piece] - np.cumsum(many) + many, many) + np.arange(many.sum())
        pairs, links, per_text = summed(
            np.repeat(own, many), self.pairs[place], self.links[place] * np.repeat(times, many), len(texts)
        )
        return {"sizes": sizes, "written": written, "pairs": pairs, "links": links, "per_text": per_text}


def summed(owner: np.ndarray, pair: np.ndarray, links: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links added up for each owner and pair: pairs and links by owner, and pairs of each owner."""
    order = np.lexsort((pair, owner))
    owner, pair, links = owner[order], pair[order], links[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(links, first) if len(first) else links
    return pair[first], total, np.bincount(owner[first], minlength=owners)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this worker process, which outlives its tasks."""
    return Aligner(a_path, b_path)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64()))


_SIZES = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, digest: bool) -> Iterator[pa.RecordBatch]:
    known = aligner(a_path, b_path)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        filled = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
        row = 0
        while row < len(texts):
            before = filled[row - 1] if row else 0
            last = max(row + 1, int(np.searchsorted(filled, before + BLOCK_BYTES, "right")))
            part = batch.slice(row, last - row)
            row = last
            got = known.found(part.column(part.num_columns - 1).to_pylist())
            written = got["written"]
            if digest:
                written = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            columns += [pa.array(got["sizes"][:, i]) for i in range(4)]
            columns += [pa.array(written, pa.string()), _lists(got["pairs"], got["per_text"]), _lists(got["links"], got["per_text"])]
            names = [*part.schema.names[:-1], *_SIZES, "groups", "pairs", "links"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def aligned(docs: DataFrame, ids: list[str], a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """``ids`` and the alignment of each text of ``docs`` under two tokenizers.

    A is a byte-level tokenizer file, which gets space + text; B is a piece model, which adds the
    space itself. Names of special tokens in a text are ordinary text. (n_a, n_b, n_groups,
    n_links, groups, pairs, links): numbers of tokens, groups, and linked token occurrences;
    the ids of each group as `a1,a2|b1;a3|b2,b3`, or with ``digest`` the SHA-256 of that; the
    distinct linked pairs as numbers a * (ids of B) + b, rising, and the links of each.

    A text that is null or empty, or that either tokenizer does not give back byte for byte,
    has no tokens: zeros, an empty string and empty lists.
    """
    rows = docs.select(*ids, "text")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    fields += "".join(f"{n} long, " for n in _SIZES) + "groups string, pairs array<long>, links array<long>"
    return rows.mapInArrow(partial(_aligned, a_path=a_path, b_path=b_path, digest=digest), fields)


def _looked_up(batches: Iterator[pa.RecordBatch], keys: np.ndarray, count: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Replace pairs that are known by the sums of their links; leave the others."""
    for batch in batches:
        pairs, links = batch.column("pairs"), batch.column("links")
        n = pairs.value_lengths().to_numpy(zero_copy_only=False)
        pair, link = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, links))
        at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
        hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
        row = np.repeat(np.arange(len(n)), n)
        total, top = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        np.add.at(total, row[hit], link[hit] * count[at[hit]])
        np.add.at(top, row[hit], link[hit] * best[at[hit]])
        rest = np.bincount(row[~hit], minlength=len(n))
        kept = [batch.column(c) for c in batch.schema.names[:-2]]
        columns = [*kept, pa.array(total), pa.array(top), _lists(pair[~hit], rest), _lists(link[~hit], rest)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-2], "count_sum", "n_best", "pairs", "links"])


def linked(docs: DataFrame, ids: list[str], a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """`aligned` texts with corpus-wide counts of their linked pairs of ids.

    The count of a pair is the number of rows of ``docs`` that hold it linked; equal rows count
    each. ``count_sum`` adds the counts of all links of a text, ``n_best`` is the number of its
    links whose count is the highest that their id of A has anywhere, ties included. ``groups``
    is the SHA-256 of the groups. (ids, n_a, n_b, n_groups, n_links, groups, count_sum, n_best)
    """
    spark = docs.sparkSession
    renamed = {c: f"id{i}" for i, c in enumerate(ids)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in renamed.items()], F.monotonically_increasing_id().alias("row"), "text")
    found, path = stored(aligned(rows, [*renamed.values(), "row"], a_path, b_path, digest=True), "aligned")
    size = _ids_of_b(b_path)
    counts = keep(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    of_a = F.expr(f"pair div {size}").alias("a")
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))
    known = counts.withColumn("a", of_a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    known = keep(known, "counts")
    hot = known.orderBy(F.desc("n"), "pair").limit(hot_pairs).toArrow().sort_by("pair")
    tables = {"keys": "pair", "count": "n", "best": "best"}
    tables = {name: hot.column(c).to_numpy() for name, c in tables.items()}
    kept = [c for c in found.columns if c not in ("pairs", "links")]
    fields = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in kept)
    fields += ", count_sum long, n_best long, pairs array<long>, links array<long>"
    part, _ = stored(found.select(*kept, "pairs", "links").mapInArrow(partial(_looked_up, **tables), fields), "hot-pairs")
    removed(spark, path)
    rest = part.select("row", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair").join(known, "pair")
    rest = rest.groupBy("row").agg(F.sum(F.col("links") * F.col("n")).alias("more"), F.sum(F.col("links") * F.col("best")).alias("more_best"))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return part.join(rest, "row", "left").select(
        *[F.col(n).alias(c) for c, n in renamed.items()], *_SIZES, "groups", plus("count_sum", "more"), plus("n_best", "more_best")
    )


def _ids_of_b(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
