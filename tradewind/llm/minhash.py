"""Near duplicates by circulant MinHash.

Two permutations of a universe of 2**32 shingle numbers make every signature coordinate: the
first scatters the shingles, the second is applied to them shifted circularly by 1, 2, 3 ...,
and each shift's least value is a coordinate. Coordinates are grouped into bands; texts that
share a band meet in a bucket. Their links are then decided on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components, stored
from tradewind.llm.text import blocks_of_words, mixed, shingles
from tradewind.session import keep

BANDS = 16
BAND_ROWS = 4
SHINGLE_WORDS = 5
# Members of a bucket are compared in blocks of about so many.
BLOCK_ROWS = 128
# Pairs whose signatures agree on a share of coordinates this far below the threshold are not
# read in full: over four standard deviations of the agreement at the threshold.
SLACK = 0.2


def _scattered(x: np.ndarray) -> np.ndarray:
    """The first permutation, of the universe of 32-bit numbers onto itself."""
    x = x ^ (x >> np.uint32(15))
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    x *= np.uint32(0x297A2D39)
    x ^= x >> np.uint32(15)
    return x


def _permuted(x: np.ndarray) -> np.ndarray:
    """The second permutation; works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingles(words, n))


def shingle_sets(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of many texts, one after the other, and the sizes of all."""
    lengths = np.diff(rows)
    counts = np.maximum(lengths - n + 1, 0)
    before = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) + np.repeat(rows[:-1] - before, counts)
    found = [shingles(words, n)[at] if len(at) else words[:0]]
    owner = [np.repeat(np.arange(len(lengths)), counts)]
    for i in np.flatnonzero((lengths > 0) & (lengths < n)):
        found.append(shingles(words[rows[i] : rows[i + 1]], n))
        owner.append([i])
    found, owner = np.concatenate(found), np.concatenate(owner).astype(np.int64)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.bincount(owner[new], minlength=len(lengths))


def signatures(found: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of each of the sets that ``shingle_sets`` gives, but the empty ones."""
    counts = counts[counts > 0]
    starts = np.cumsum(counts) - counts
    once = _scattered((found >> np.uint64(32)).astype(np.uint32))
    out = np.empty((len(counts), size), np.uint32)
    for k in range(size if len(counts) else 0):
        out[:, k] = np.minimum.reduceat(_permuted(once + np.uint32(k + 1)), starts)
    return out


def set_prints(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number for each set; that of empty sets is 0."""
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = mixed(np.add.reduceat(mixed(found + np.uint64(1)), starts) + counts[full].astype(np.uint64))
    return out


def _sketches(size: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, marks = [], [], []
            for _, _, words, rows in blocks_of_words(batch.column("text")):
                found, counts = shingle_sets(words, rows, n)
                sizes.append(counts)
                prints.append(set_prints(found, counts).view(np.int64))
                rest = iter(signatures(found, counts, size))
                marks += [next(rest).tobytes() if c else None for c in counts.tolist()]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            sizes, prints = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, prints))
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(marks, pa.binary())],
                names=[*batch.schema.names[:-1], "n_shingles", "v", "signature"],
            )

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(percent: int, n: int):
    """Keep the pairs whose full sets share ``percent`` of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pairs come in runs with the same text on one side, whose set is made once.
        recent: dict[str, dict[int, np.ndarray]] = {"a": {}, "b": {}}

        def sets(part: pa.RecordBatch, side: str) -> list[np.ndarray]:
            ids, known = part.column(side).to_pylist(), dict(recent[side])
            todo = list({v: i for i, v in enumerate(ids) if v not in known}.values())
            texts = part.column(f"text_{side}").take(pa.array(todo, pa.int64()))
            for row, last, words, rows in blocks_of_words(texts):
                for i in range(row, last):
                    known[ids[todo[i]]] = shingle_set(words[rows[i - row] : rows[i - row + 1]], n)
            recent[side] = {ids[-1]: known[ids[-1]]}
            return [known[v] for v in ids]

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                chosen = [_linked(x, y, percent) for x, y in zip(sets(part, "a"), sets(part, "b"), strict=True)]
                links = part.select(["a", "b"]).filter(pa.array(chosen, pa.bool_()))
                if links.num_rows:
                    yield links

    return run


def _first_meeting(x: np.ndarray, y: np.ndarray, rows: int) -> np.ndarray:
    """The first band in which each signature of ``y`` equals ``x``."""
    same = (y == x).reshape(len(y), len(x) // rows, rows).all(axis=2)
    return same.argmax(axis=1)


def _joining(percent: int, n: int, band_rows: int, least: float):
    """Links that join different components, of the members of a block pair of a bucket.

    Each pair is looked at in the first bucket it shares, in order of falling agreement of the
    signatures, and read in full unless links found before have joined its components.
    """

    def links(band: int, rows: list[tuple]) -> list[tuple[int, int]]:
        v, component, right, marks, texts = zip(*rows, strict=True)
        marks = np.frombuffer(b"".join(marks), np.uint32).reshape(len(rows), -1)
        component, right = np.array(component), np.array(right)
        same = not right.any()  # a block with itself
        left = np.flatnonzero(~right)
        other = left if same else np.flatnonzero(right)
        pairs = []
        for i in left:
            to = other[other > i] if same else other
            to = to[component[to] != component[i]]
            share = (marks[to] == marks[i]).mean(axis=1)
            to, share = to[share >= least], share[share >= least]
            first = _first_meeting(marks[i], marks[to], band_rows) == band
            pairs += [(-s, i, j) for s, j in zip(share[first].tolist(), to[first].tolist(), strict=True)]
        above: dict[int, int] = {}

        def top(c: int) -> int:
            while c in above:
                c = above[c]
            return c

        sets: dict[int, np.ndarray] = {}
        wanted = sorted({k for _, i, j in pairs for k in (int(i), j)})
        for row, last, words, at in blocks_of_words(pa.array([texts[k] for k in wanted], pa.large_string())):
            for k in range(row, last):
                sets[wanted[k]] = shingle_set(words[at[k - row] : at[k - row + 1]], n)
        out = []
        for _, i, j in sorted(pairs):
            one, two = top(int(component[i])), top(int(component[j]))
            if one != two and _linked(sets[int(i)], sets[j], percent):
                above[max(one, two)] = min(one, two)
                out.append((v[i], v[j], int(component[i]), int(component[j])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key: tuple, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found := links(key[-1], rows):
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "one", "two"])

        key, held = None, []
        names = ("v", "component", "right", "signature", "text")
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("bucket", "low", "high", "band")], strict=True)
            for k, *row in zip(keys, *[batch.column(c).to_pylist() for c in names], strict=True):
                if k != key and held:
                    yield from made(key, held)
                    held = []
                key = k
                held.append(tuple(row))
        if held:
            yield from made(key, held)

    return run


def _with_text(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Put both texts next to the pairs (a, b)."""
    for side in ("a", "b"):
        named = texts.select(F.col("v").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(named, side)
    return pairs.select("a", "b", "text_a", "text_b")


def near_duplicates(
    rows: DataFrame,
    ids: list[str],
    percent: int = 85,
    shingle_words: int = SHINGLE_WORDS,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """The columns ``ids`` of ``rows`` (with a column ``text``), n_shingles and ``group``.

    Two texts are linked if 100 * shared shingles >= percent * all their shingles; texts
    reachable over links have the same ``group``, a whole number. A text with fewer words than
    a shingle has one shingle, all its words; a text that is null or without words has none
    and its group is null. Repeated rows stay.

    A pair at 85 % meets in one of 16 bands of 4 rows with a probability of 0.999993; all pairs
    that meet are decided, by these steps, none of which makes all pairs of a bucket:

    - texts with equal sets are one vertex from here on;
    - each member of a bucket is checked against the bucket's first and last member;
    - members that are not yet connected are compared block by block: by signature, and those
      that agree well enough in full. Only links that join two components leave a task.
    """
    spark = rows.sparkSession
    size = bands * band_rows
    with_print = rows.withColumn("text_print", F.xxhash64("text"))
    narrow = with_print.select(*ids, "text_print", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    sketched = keep(
        narrow.mapInArrow(_sketches(size, shingle_words), f"{schema}, n_shingles long, v long, signature binary"),
        "sketches",
    )
    vertices = keep(
        sketched.where("n_shingles > 0")
        .groupBy("v")
        .agg(F.min("text_print").alias("text_print"), F.min("signature").alias("signature")),
        "vertices",
    )
    n_bands = bands * vertices.count()
    width = 4 * band_rows
    band = [F.xxhash64(F.lit(i), F.substring("signature", 1 + i * width, width)) for i in range(bands)]
    members = vertices.select("v", F.posexplode(F.array(*band)).alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.min("v").alias("first"), F.max("v").alias("last"))
    buckets = stored(buckets.where("first < last"), "buckets", n_bands)
    members = stored(members.join(buckets, "bucket"), "members", n_bands)
    stars = members.select(F.col("v").alias("a"), F.explode(F.array("first", "last")).alias("b")).where("a <> b")
    stars = stars.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).distinct()

    # A text for each vertex that meets another one. The vertices of copies are many at any
    # size, so the texts are always shuffled, whatever a small table would allow.
    met = stored(members.select("v").distinct().join(vertices, "v"), "met", n_bands)
    texts = with_print.select("text_print", "text").join(met.hint("merge"), "text_print")
    texts = keep(texts.groupBy("v").agg(F.min("signature").alias("signature"), F.min("text").alias("text")), "texts")

    verified = _with_text(stars, texts).mapInArrow(_verified(percent, shingle_words), "a long, b long")
    links = keep(verified, "links")
    labels = keep(components(links), "labels")

    # Buckets whose members are still in several components; one of two members is decided.
    placed = members.join(labels, "v", "left").select(
        "band", "bucket", "v", F.coalesce("component", "v").alias("component")
    )
    placed = stored(placed, "placed", n_bands)
    open_buckets = placed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("first"), F.max("component").alias("last")
    )
    open_buckets = open_buckets.where("first < last and n > 2")
    open_buckets = stored(open_buckets.select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")), "open", n_bands)
    block = F.pmod(F.xxhash64("v", F.lit(7)), F.col("blocks"))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    blocks = placed.join(open_buckets, "bucket").withColumn("block", block).withColumn("other", F.explode(numbers))
    blocks = blocks.select(
        "band",
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("right"),
        "v",
        "component",
    )
    keys = ["bucket", "low", "high", "band"]
    blocks = blocks.join(texts, "v").repartition(*keys).sortWithinPartitions(*keys, "right", "v")
    joining = _joining(percent, shingle_words, band_rows, percent / 100 - SLACK)
    more = keep(blocks.mapInArrow(joining, "a long, b long, one long, two long"), "more")
    # These links join components as a whole.
    joined = components(more.select(F.col("one").alias("a"), F.col("two").alias("b")))
    joined = keep(joined.select(F.col("v").alias("was"), F.col("component").alias("now")), "joined")
    # A vertex without a link so far was its own component.
    alone = joined.select(F.col("was").alias("v"), F.col("was").alias("component"))
    labels = labels.unionByName(alone).distinct()
    labels = labels.join(joined, F.col("component") == F.col("was"), "left")
    labels = keep(labels.select("v", F.coalesce("now", "component").alias("component")), "labels")

    out = sketched.drop("signature", "text_print").join(labels, "v", "left")
    group = F.when(F.col("n_shingles") > 0, F.coalesce("component", "v")).alias("group")
    return out.select(*ids, "n_shingles", group)


def one_per_group(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add component_id, the least id of the group, and kept, true for the row with that id.

    A row without a group is its own. Rows with equal ids are kept or dropped together; where
    all ids of a group are null, all its rows are kept.
    """
    found = keep(found, "found")
    least = keep(found.where("group is not null").groupBy("group").agg(F.min(doc_id).alias("least")), "least")
    joined = found.join(least, "group", "left")
    component = F.when(F.col("group").isNull(), F.col(doc_id)).otherwise(F.col("least"))
    return joined.withColumn("component_id", component).withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id"))).drop("least")
