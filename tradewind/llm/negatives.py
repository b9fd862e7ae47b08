"""Hard negatives for contrastive training, filtered by rotated one-bit codes.

A vector o of whole numbers is turned by a fixed random frame P and kept as the signs of P o, one
bit a coordinate. x, the signs turned back into the space of o, is the code vector, and its
alignment <o, x> is stored with it. Then o = a x + r with a = <o, x> / |x|^2 and r at a right
angle to x, so for a query q

    <o, q> = a <x, q> + <r, q>,   |<r, q>| <= |r| * sqrt(|q|^2 - <x, q>^2 / |x|^2)

by Cauchy and Schwarz. <x, q> comes from popcounts of the code against bit planes of the turned
query, whose rounding error is added to the interval. A row whose interval cannot reach the wanted
scores is left out; all others get their exact whole-number score, so results are exact.

Rows are compared with anchors in blocks: a group of at most about ROWS rows meets a group of at
most about ANCHORS anchors in one task, however rows are spread over labels and vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import keep

# Bits of a code for each component of a vector; more bits make narrower intervals.
BITS = 4
# Bit planes of a turned query.
PLANES = 8
ROWS = 4096
ANCHORS = 4096
# Anchors of a group that are compared at once.
_AT_ONCE = 16
# Products are exact in doubles below this.
_EXACT = 2.0**53
_LEAST, _MOST = -(2**63 - 1), 2**63 - 1
_NO_ID = _MOST

CODED = "row long, vec_id long, label long, embedding array<double>, code binary, alignment double, code_norm double, norm double"


@lru_cache(maxsize=2)
def frame(dimension: int, seed: int) -> np.ndarray:
    """A random matrix of orthonormal columns, (bits x dimension)."""
    bits = -(-max(1, BITS * dimension) // 64) * 64
    drawn = np.random.default_rng(seed).normal(size=(bits, dimension))
    return np.linalg.qr(drawn)[0]


def whole(values: np.ndarray) -> np.ndarray:
    """Components as whole numbers, held in doubles."""
    return np.floor(256 * values.astype(np.float64))


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """Lists as rows of equal length, shorter ones filled up with zeros."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    out = np.zeros((len(column), dimension))
    if len(column):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(np.arange(len(sizes)), sizes), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def codes(v: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, alignment <o, x>, |x|^2, |o|^2) of each row o of ``v``."""
    bits = len(turn)
    turned = v @ turn.T
    above = turned >= 0
    back = np.where(above, 1.0, -1.0) @ turn / np.sqrt(bits)
    return np.packbits(above, axis=1), (v * back).sum(axis=1), (back**2).sum(axis=1), (v**2).sum(axis=1)


class Query:
    """Turned queries as bit planes."""

    def __init__(self, v: np.ndarray, turn: np.ndarray):
        turned = v @ turn.T
        bits = len(turn)
        self.low = turned.min(axis=1, initial=0)
        self.step = (turned.max(axis=1, initial=0) - self.low) / (2**PLANES - 1)
        self.step[self.step == 0] = 1
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        rounded = self.low[:, None] + self.step[:, None] * levels
        self.total = rounded.sum(axis=1)
        self.error = np.abs(turned - rounded).sum(axis=1) / np.sqrt(bits)
        self.norm = (v**2).sum(axis=1)
        planes = [np.packbits((levels >> p) & 1, axis=1).view(np.uint64) for p in range(PLANES)]
        self.planes = np.stack(planes, axis=1)  # query, plane, word

    def intervals(self, which: slice, code: np.ndarray, alignment: np.ndarray, code_norm: np.ndarray, norm: np.ndarray):
        """Lowest and highest possible product of each query of ``which`` with each coded row."""
        words = code.view(np.uint64)
        planes, bits = self.planes[which], code.shape[1] * 8
        counted = np.zeros((len(planes), len(code)))
        for p in range(PLANES):
            common = np.zeros(counted.shape, np.uint32)
            for w in range(words.shape[1]):
                common += np.bitwise_count(planes[:, p, w, None] & words[None, :, w])
            counted += common * float(1 << p)
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        above = self.low[which, None] * ones + self.step[which, None] * counted
        found = (2 * above - self.total[which, None]) / np.sqrt(bits)  # about <x, q>
        error = self.error[which, None]
        share = np.divide(alignment, code_norm, out=np.zeros_like(alignment), where=code_norm > 0)
        rest = np.sqrt(np.maximum(0, norm - share * alignment))
        at_least = np.maximum(0, np.abs(found) - error)
        seen = np.divide(at_least**2, code_norm, out=np.zeros_like(found), where=code_norm > 0)
        open_part = np.sqrt(np.maximum(0, self.norm[which, None] - seen))
        # Beside the method's own error, that of doubles.
        width = np.abs(share) * error + rest * open_part + 1e-9 * np.sqrt(norm * self.norm[which, None]) + 1e-6
        return share * found - width, share * found + width


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices, within the range of a long."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 1 << 14):
        x, y = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
        if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1]) < _EXACT:
            out[at : at + len(x)] = np.einsum("ij,ij->i", x, y).astype(np.int64)
        else:
            sums = [sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for r, s in zip(x, y, strict=True)]
            out[at : at + len(x)] = [min(max(s, _LEAST), _MOST) for s in sums]
    return out


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first rows of each group, by falling score and then rising id."""
    order = np.lexsort((ids, -score, group))
    own = group[order]
    start = np.searchsorted(own, own, "left")
    return order[np.arange(len(own)) - start < k]


def _kth(values: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest allowed value of each row, -inf if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(np.where(allowed, values, -np.inf), values.shape[1] - k, axis=1)[:, -k]


class Block:
    """Rows of a group, decoded."""

    def __init__(self, table: pa.Table, dimension: int):
        self.row = table.column("row").to_numpy()
        self.ids = table.column("vec_id").fill_null(_NO_ID).to_numpy()
        self.label = table.column("label").to_numpy()
        self.v = _matrix(table.column("embedding"), dimension)
        code = b"".join(table.column("code").to_pylist())
        self.code = np.frombuffer(code, np.uint8).reshape(len(self.ids), -1) if len(self.ids) else np.zeros((0, 8), np.uint8)
        self.numbers = [table.column(c).to_numpy() for c in ("alignment", "code_norm", "norm")]


def _similar(left: pa.Table, right: pa.Table, dimension: int, seed: int, k: int) -> pa.Table:
    """For each anchor (right) the k best rows (left) of its label."""
    rows, anchors = Block(left, dimension), Block(right, dimension)
    query = Query(anchors.v, frame(dimension, seed))
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(anchors.ids) if len(rows.ids) else 0, _AT_ONCE):
        part = slice(at, min(at + _AT_ONCE, len(anchors.ids)))
        low, high = query.intervals(part, rows.code, *rows.numbers)
        other = (rows.ids[None, :] != anchors.ids[part, None]) & (rows.label[None, :] == anchors.label[part, None])
        q, i = np.nonzero(other & (high >= _kth(low, other, k)[:, None]))
        score = products(rows.v[i], anchors.v[q + at])
        best = first_of(q, score, rows.ids[i], k)
        found.append((anchors.row[q[best] + at], rows.ids[i[best]], score[best]))
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found, strict=True) if found else [[], [], []])]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "vec_id", "score"), columns, strict=True)})


def _dissimilar(left: pa.Table, right: pa.Table, dimension: int, seed: int, k: int, shares: tuple[int, int]) -> pa.Table:
    """For each anchor (right) and each of its positives, the k best rows (left) of other labels
    whose score lies between two shares, in percent, of the positive's score."""
    rows, anchors = Block(left, dimension), Block(right, dimension)
    query = Query(anchors.v, frame(dimension, seed))
    wanted = [
        [(max(_LEAST, -(-shares[0] * p // 100)), min(_MOST, shares[1] * p // 100)) for p in scores]
        for scores in right.column("scores").to_pylist()
    ]
    most = max(map(len, wanted), default=0)
    bounds = np.array([w + [(1, 0)] * (most - len(w)) for w in wanted], np.int64).reshape(len(wanted), most, 2)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(anchors.ids) if len(rows.ids) else 0, _AT_ONCE):
        part = slice(at, min(at + _AT_ONCE, len(anchors.ids)))
        low, high = query.intervals(part, rows.code, *rows.numbers)
        other = rows.label[None, :] != anchors.label[part, None]
        open_rows = np.zeros(other.shape, bool)
        for w in range(most):
            least, top = (bounds[part, w, side, None].astype(float) for side in (0, 1))
            may = other & (high >= least) & (low <= top) & (least <= top)
            sure = may & (low >= least) & (high <= top)
            open_rows |= may & (high >= _kth(low, sure, k)[:, None])
        q, i = np.nonzero(open_rows)
        score = products(rows.v[i], anchors.v[q + at])
        for w in range(most):
            fits = np.flatnonzero((bounds[q + at, w, 0] <= score) & (score <= bounds[q + at, w, 1]))
            best = fits[first_of(q[fits], score[fits], rows.ids[i[fits]], k)]
            found.append((anchors.row[q[best] + at], np.full(len(best), w), rows.ids[i[best]], score[best]))
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found, strict=True) if found else [[]] * 4)]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "place", "vec_id", "score"), columns, strict=True)})


def _coded(batches: Iterator[pa.RecordBatch], dimension: int, seed: int) -> Iterator[pa.RecordBatch]:
    turn = frame(dimension, seed)
    for batch in batches:
        v = whole(_matrix(batch.column("embedding"), dimension))
        signs, *numbers = codes(v, turn)
        made = [pa.array([r.tobytes() for r in signs], pa.binary()), *map(pa.array, numbers)]
        lists = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * dimension, pa.array(v.reshape(-1)))
        columns = [batch.column("row"), batch.column("vec_id"), batch.column("label"), lists, *made]
        names = ["row", "vec_id", "label", "embedding", "code", "alignment", "code_norm", "norm"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def coded(vectors: DataFrame, seed: int = 11) -> tuple[DataFrame, int]:
    """The rows of ``vectors`` (vec_id, label, embedding) that take part, with their codes, and the
    dimension. ``row`` numbers them; ``embedding`` holds whole numbers.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A
    vector shorter than the longest one is filled up with zeros.
    """
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    return keep(rows.mapInArrow(partial(_coded, dimension=longest, seed=seed), CODED), "codes"), longest


def _met(rows: DataFrame, anchors: DataFrame, by: Sequence[str]):
    """Rows and anchors, each repeated for the groups of the other that it meets, to be cogrouped.

    Only rows and anchors of equal ``by`` meet. Both are dealt out by their row numbers, so a
    group stays small however often a label or a vector occurs.
    """
    many, some = F.ceil(F.count("*") / ROWS).cast("int"), F.ceil(F.count("*") / ANCHORS).cast("int")
    if by:
        sizes = rows.groupBy(*by).agg(many.alias("row_groups"))
        sizes = keep(sizes.join(anchors.groupBy(*by).agg(some.alias("anchor_groups")), list(by)), "sizes")
        rows, anchors = (df.join(sizes, list(by)) for df in (rows, anchors))
    else:
        whole_size = {"row_groups": F.lit(rows.agg(many).first()[0]), "anchor_groups": F.lit(anchors.agg(some).first()[0])}
        rows, anchors = (df.withColumns(whole_size).where("row_groups * anchor_groups > 0") for df in (rows, anchors))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        group = F.pmod(F.xxhash64("row"), F.col(f"{own}s")).cast("int").alias(own)
        met = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        return df.select("*", group, met).drop("row_groups", "anchor_groups")

    left, right = dealt(rows, "row_group", "anchor_group"), dealt(anchors, "anchor_group", "row_group")
    right = right.select([F.col(c).alias(c) for c in right.columns])  # told apart from the columns of the left
    keys = [*by, "row_group", "anchor_group"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def _ranked(found: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
    seed: int = 11,
) -> DataFrame:
    """For each anchor and each of its positives, the hardest rows of other labels.

    ``vectors`` has vec_id, label and embedding. A component x counts as floor(256 x), and a
    row's score for an anchor is the inner product in whole numbers. Anchors are the rows for
    which ``is_anchor`` (over vec_id, label, row) is true. An anchor's positives are its
    ``positives`` best rows of the same label with another vec_id; negatives are the best
    ``negatives`` rows of other labels with a score from ``shares[0]`` to ``shares[1]`` percent
    of the positive's. Ties go to the smaller vec_id, a null one last. All anchors meet all
    rows, in blocks; the result is exact.

    A repeated row counts as often as it occurs. Rows that `coded` leaves out take no part. A
    score beyond the range of a long is held at its end. (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score)
    """
    rows, dimension = coded(vectors, seed)
    anchors = rows.where(is_anchor)
    settings = {"dimension": dimension, "seed": seed}
    near = _met(rows, anchors, ["label"]).applyInArrow(
        lambda left, right: _similar(left, right, k=positives, **settings), "anchor long, vec_id long, score long"
    )
    best = keep(_ranked(near, ["anchor"], positives), "positives")
    lists = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("l"))
    asked = anchors.join(lists.select(F.col("anchor").alias("row"), F.col("l.score").alias("scores")), "row")
    far = _met(rows, asked, []).applyInArrow(
        lambda left, right: _dissimilar(left, right, k=negatives, shares=shares, **settings),
        "anchor long, place long, vec_id long, score long",
    )
    ranked = _ranked(far, ["anchor", "place"], negatives)
    known = best.join(rows.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor", "anchor_id", (F.col("rank") - 1).cast("long").alias("place"), F.col("vec_id").alias("p"), F.col("score").alias("ps")
    )
    named = lambda c: F.when(F.col(c) < _NO_ID, F.col(c))
    return ranked.join(known, ["anchor", "place"]).select(
        "anchor_id",
        named("p").alias("positive_id"),
        "rank",
        named("vec_id").alias("negative_id"),
        F.col("ps").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
