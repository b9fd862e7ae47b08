"""Left joins whose right side may repeat a key very often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import keep

HOT_ROWS = 1_000_000
SKETCH_ITEMS = 10_000
MAX_HOT = 100


def hot_values(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> list:
    """Key values that appear in at least ``min_rows`` rows, at most MAX_HOT of them.

    A mergeable frequent-items sketch over one column: a scan without a shuffle of rows,
    and an answer of bounded size. It only decides which rows take which route, so an
    estimate that is off changes the speed and never the result.
    """
    top = F.expr(f"approx_top_k(`{key}`, {MAX_HOT}, {SKETCH_ITEMS})")
    found = df.where(F.col(key).isNotNull()).agg(top.alias("top")).first()["top"]
    return [row["item"] for row in found or [] if row["count"] >= min_rows]


def left_join_many(left: DataFrame, right: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` LEFT JOIN ``right`` where one key may own a large part of ``right``.

    Spark can split a skewed partition of the preserved side of an outer join, not of the
    other side. Keys that are hot on the right exist there for certain, so for them the
    outer join equals an inner join, whose sides can both be split at run time. All other
    keys take the plain left join.
    """
    hot = hot_values(right, key, min_rows)
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.col(key).isin(hot)
    cold = left.where(F.col(key).isNull() | ~is_hot).join(right.where(~is_hot), key, "left")
    return cold.unionByName(left.where(is_hot).join(right.where(is_hot), key, "inner"))


# Rows of a sample, about, that a key needs to count as hot.
_SEEN = 2_000


def _parts(df: DataFrame, key: str, min_rows: int, name: str) -> DataFrame:
    """Keys with at least about ``min_rows`` rows, and how many parts of that size they make.

    Counted in a sample just large enough to tell: it only decides which rows take which route.
    """
    share = min(1.0, _SEEN / min_rows)
    keys = df.where(F.col(key).isNotNull()).select(key)
    keys = keys.sample(False, share, seed=5) if share < 1 else keys
    counted = keys.groupBy(key).agg((F.count("*") / F.lit(share * min_rows)).alias("n"))
    return counted.where(F.col("n") >= 1).select(key, F.ceil("n").cast("int").alias(name))


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    min_rows: int = HOT_ROWS,
    count_left: bool = True,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` where any number of keys may own many rows on either side.

    Rows of each key are counted on both sides. A key with more than ``min_rows`` of them is cut into
    parts of about that many rows, on both sides, and each part of one side meets each part of the
    other in a group of its own; so a task holds a few parts, however large a key is and however
    many are. Which part a row goes to follows from its columns. The table of hot keys has at
    most a row for every ``min_rows`` rows; it is stored, and Spark broadcasts it if it is small.

    With ``count_left=False`` only the right side is counted and cut: for a left side that is itself a
    chain of joins, which counting would run once more. Spark can split a preserved side itself.
    ``counted`` stands in for a right side that is a chain of joins: the table its rows come from.

    A left row with a null key, or with a key that the right side lacks, comes once, with NULLs.
    """
    sizes = _parts(right if counted is None else counted, key, min_rows, "__b")
    if count_left:
        sizes = _parts(left, key, min_rows, "__a").join(sizes, key, "full")
    else:
        sizes = sizes.withColumn("__a", F.lit(1))
    grid = keep(sizes.select(key, *[F.coalesce(c, F.lit(1)).alias(c) for c in ("__a", "__b")]), "hot-keys")
    if grid.isEmpty():
        return left.join(right, key, "left")
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    cold = left.join(grid, key, "left_anti").join(right.join(grid, key, "left_anti"), key, "left").select(*columns)

    def dealt(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        part = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.join(grid, key).select(*df.columns, "__b", part.alias(f"_{own}"), every.alias(f"_{other}"))

    hot_left = dealt(left, "__a", "__b", 1)
    hot_right = dealt(right, "__b", "__a", 2).drop("__b")
    on = [key, "___a", "___b"]
    # With a single right part each left row stands once, and may find nothing. With more the
    # key is there for certain, and a part that has got no rows must not add any.
    single = hot_left.where("__b = 1").join(hot_right, on, "left").select(*columns)
    many = hot_left.where("__b > 1").join(hot_right, on, "inner").select(*columns)
    return cold.unionByName(single).unionByName(many)


# Copies of a row that are made in one go.
_BLOCK = 4_096


def repeated(rows: DataFrame, copies: str, spread: bool = False) -> DataFrame:
    """Each row as many times as its column ``copies`` says, without that column.

    A row with very many copies is made in blocks. With ``spread`` the blocks are dealt out over all
    tasks first: for few rows with many copies, which may all lie in one partition.
    """
    columns = [c for c in rows.columns if c != copies]
    blocks = F.sequence(F.lit(0), F.expr(f"CAST((`{copies}` - 1) div {_BLOCK} AS INT)"))
    rows = rows.withColumn("__block", F.explode(blocks))
    if spread:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(tasks, *[F.col(f"`{c}`") for c in rows.columns])
    left = F.least(F.lit(_BLOCK), F.col(copies) - F.col("__block") * F.lit(_BLOCK)).cast("int")
    return rows.select(*columns, F.explode(F.sequence(F.lit(1), left)).alias("__copy")).select(*columns)
