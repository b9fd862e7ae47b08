"""Order along a curve: ranks, evenness, and files skipped by any of the columns."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from suite.entities import Entities
from suite.marts_queries import d3
from tradewind.session import keep, scratch_path
from tradewind.sources.curve import along_curve, curve_place
from tradewind.sources.tables import write_table

FILES = 64


def groups(path):
    """(rows, minimum and maximum of each column) of each row group below a folder."""
    import glob

    out = []
    for name in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(i) for i in range(meta.num_columns)]
            out.append((meta.row_group(g).num_rows, {c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics.has_min_max}))
    return out


def share_read(path, column, value):
    found = groups(path)
    hit = [n for n, s in found if column in s and s[column][0] <= value <= s[column][1]]
    return sum(hit) / sum(n for n, _ in found)


def test_a_filter_on_any_column_skips_most_files(spark):
    df = keep(spark.range(400_000, numPartitions=8).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7919 % 48 * 30).cast("int")).alias("m"),
        F.concat(F.lit("category "), F.lpad((F.col("id") * 104_729 % 70).cast("string"), 2, "0")).alias("c"),
        F.concat(F.lit("S"), F.lpad((F.col("id") * 1_299_709 % 27).cast("string"), 2, "0")).alias("s"),
        F.col("id").alias("v"),
    ), "facts")
    path, sorted_path = scratch_path(spark, "curve"), scratch_path(spark, "sorted")
    write_table(df, path, df.schema, curve_by=("m", "c", "s"), files=FILES)
    df.repartitionByRange(FILES, "m", "c", "s").sortWithinPartitions("m", "c", "s").write.parquet(sorted_path)
    assert rows(spark.read.parquet(path).agg(F.sum("v"), F.count("*"))) == rows(df.agg(F.sum("v"), F.count("*")))
    one = df.first()
    read = {c: share_read(path, c, one[c]) for c in "mcs"}
    plain = {c: share_read(sorted_path, c, one[c]) for c in "mcs"}
    # On 64 files each column has two bits: a quarter of the files, and more where a value lies on an edge.
    assert all(r <= 0.6 for r in read.values()) and sum(read.values()) < 1.3, read
    assert plain["s"] > 0.9 and max(read.values()) < max(plain.values()), plain


def test_ranks_follow_the_order_of_values(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("a", 3), ("ab", 4), ("b", 5), ("é", 6)] * 30, "t string, n int")
    found = df.select("t", curve_place(df, ["t"]).alias("p")).distinct().orderBy(F.col("t").asc_nulls_first()).collect()
    assert [r.p for r in found] == sorted(r.p for r in found) and len({r.p for r in found}) >= 5
    mixed = df.select(curve_place(df, ["t", "n"]).alias("p")).agg(F.min("p"), F.max("p")).first()
    assert mixed[0] >= 0 and mixed[1] < 2**12
    with pytest.raises(ValueError, match="columns"):
        along_curve(df, [])
    assert along_curve(df.limit(0), ["t"]).count() == 0


def test_equal_rows_are_dealt_evenly(spark):
    """A third of all rows agree in all columns of the curve."""
    df = keep(spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("a"), F.col("id").alias("v")), "hot")
    path = scratch_path(spark, "curve-hot")
    along_curve(df, ["a"], 10).write.parquet(path)
    assert max(n for n, _ in groups(path)) < 2 * 30_000 / 10


def test_the_mart_keeps_its_values(spark):
    mart = keep(d3(Entities(spark, SMALL)), "mart")
    path = scratch_path(spark, "curve-mart")
    write_table(mart, path, mart.schema, curve_by=("order_month", "category_name", "customer_state"), files=8)
    assert rows(spark.read.parquet(path)) == rows(mart) and len(groups(path)) == 8
