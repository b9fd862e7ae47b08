"""Readers and writers."""

import datetime as dt
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tradewind.operators.quality import Check, run_checks
from tradewind.session import RUNTIME_SETTINGS, drop_scratch, keep, scratch_path, scratch_root, shared_dir
from tradewind.sources import indicators as ind
from tradewind.sources import tables


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def put(folder, name, text):
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_entities_by_file_pattern(spark, folder):
    put(folder, "shop_orders_dataset.csv",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 00:00:00,,,,\n")
    put(folder, "shop_order_reviews_dataset.csv",
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2018-01-01,2018-01-02\n')
    specs = {n: tables.ENTITIES[n] for n in ("raw_orders", "raw_order_reviews")}
    got = tables.read_entities(spark, folder, specs)
    assert got["raw_orders"].first().order_approved_at is None
    assert got["raw_order_reviews"].first().review_comment_message == 'two\nlines, "quoted"'
    assert {t for _, t in got["raw_orders"].dtypes} == {"string"}


def test_there_are_nine_entities_with_known_keys():
    assert len(tables.ENTITIES) == 9
    assert all(set(e.keys) <= set(e.columns) for e in tables.ENTITIES.values())


def test_entity_keys_feed_the_unique_check(spark):
    spec = tables.ENTITIES["raw_order_items"]
    df = spark.createDataFrame([("o", 1), ("o", 1)], "order_id string, order_item_id int")
    check = Check("items", spec.keys[0], "unique", "error", list(spec.keys))
    assert run_checks({"items": df}, [check]).first().outcome == "ERROR"


def test_csv_load_parses_date_columns(spark, folder):
    path = put(folder, "a.csv", "id,Ship_Date,n\n1,2018-01-02,5\n2,soon,6\n")
    table = scratch_path(spark, "a")
    got = tables.load_csv(spark, path, table)
    assert got.dtypes == [("id", "int"), ("Ship_Date", "timestamp"), ("n", "int")]
    assert rows(got) == [(1, dt.datetime(2018, 1, 2), 5), (2, None, 6)]
    tables.load_csv(spark, path, table, mode="append")
    assert spark.read.parquet(table).count() == 4
    stated = tables.load_csv(spark, path, table, schema=got.schema)
    assert rows(stated.select("id", "n")) == [(1, 5), (2, 6)]


def test_csv_columns_are_found_by_name(spark, folder):
    spec = {"raw_sellers": tables.ENTITIES["raw_sellers"]}
    put(folder, "my_sellers_dataset.csv", "seller_state,extra,seller_city,seller_id,seller_zip_code_prefix\nSP,x,Itu,s1,13300\n")
    got = tables.read_entities(spark, folder, spec)["raw_sellers"]
    assert [r.asDict() for r in got.collect()] == [
        {"seller_id": "s1", "seller_zip_code_prefix": "13300", "seller_city": "Itu", "seller_state": "SP"}
    ]
    path = put(folder, "b.csv", "n,id\n5,1\n")
    stated = tables.load_csv(spark, path, scratch_path(spark, "b"), schema=T.StructType.fromDDL("id int, n int"))
    assert rows(stated.select("id", "n")) == [(1, 5)]
    with pytest.raises(ValueError, match="no column m"):
        tables.load_csv(spark, path, scratch_path(spark, "c"), schema=T.StructType.fromDDL("id int, m int"))


def test_indicator_records(spark, folder):
    put(folder, "s.json", '{"data":"17/05/2017","valor":"3.14"}\n{"data":"18/05/2017","valor":"n/d"}\n')
    got = ind.read_indicator_series(spark, f"{folder}/s.json", "selic").drop("extracted_at")
    assert rows(got) == [
        (dt.date(2017, 5, 17), 3.14, "selic", 4189), (dt.date(2017, 5, 18), None, "selic", 4189),
    ]
    late = ind.read_indicator_series(spark, f"{folder}/s.json", "selic", "18/05/2017", "18/05/2017")
    assert late.count() == 1
    with pytest.raises(ValueError):
        ind.read_indicator_series(spark, f"{folder}/s.json", "gdp")


def test_indicator_array_file(spark, folder):
    """The wire format is one JSON array; a date in another format raises."""
    put(folder, "a.json", '[{"data":"17/05/2017","valor":"1"},{"data":"18/05/2017","valor":"2"}]')
    assert ind.read_indicator_series(spark, f"{folder}/a.json", "ipca").count() == 2
    put(folder, "b.json", '{"data":"2017-05-17","valor":"1"}\n')
    with pytest.raises(PySparkException):
        ind.read_indicator_series(spark, f"{folder}/b.json", "ipca").collect()


def test_unreadable_series_are_left_out(spark, folder):
    put(folder, "good.json", '{"data":"17/05/2017","valor":"1"}\n{"data":"31/12/2015","valor":"1"}\n')
    put(folder, "bad.json", '{"data":"17/05/2017","valor":"1"}\n{"data":"2017-05-18","valor":"1"}\n')
    put(folder, "empty.json", "")
    paths = {"ipca": f"{folder}/good.json", "selic": f"{folder}/bad.json", "igpm": f"{folder}/none.json",
             "exchange_rate_usd": f"{folder}/empty.json"}
    got = ind.read_all_series(spark, paths, skip_failed=True)
    # All dates count, however old, unless the caller bounds them.
    assert rows(got.select("data", "series_name")) == [(dt.date(2015, 12, 31), "ipca"), (dt.date(2017, 5, 17), "ipca")]
    assert ind.read_all_series(spark, {"ipca": paths["ipca"]}, "01/01/2016").count() == 1
    assert ind.read_all_series(spark, {"igpm": f"{folder}/none.json"}, skip_failed=True) is None
    for name in ("selic", "igpm", "exchange_rate_usd"):
        with pytest.raises((PySparkException, ind.EmptySeriesError)):
            ind.read_all_series(spark, {"ipca": paths["ipca"], name: paths[name]})


def test_union_of_series(spark):
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    assert rows(ind.union_series([None, one, one.select("s", "n")])) == [(1, "a"), (1, "a")]
    assert ind.union_series([None]) is None


def test_dispositions(spark):
    path = scratch_path(spark, "sink")
    df = spark.createDataFrame([("1", 2.0)], "a string, b double")
    for how, n in (("WRITE_TRUNCATE", 1), ("WRITE_APPEND", 2), ("WRITE_TRUNCATE", 1)):
        tables.write_table(df, path, "b DOUBLE, a BIGINT", how)
        assert spark.read.parquet(path).count() == n
    assert spark.read.parquet(path).dtypes == [("b", "double"), ("a", "bigint")]


def test_partitioned_write_with_stamp(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(1000).selectExpr("id", "id % 3 AS m")
    tables.write_table(df, path, df.schema, partition_by=["m"], cluster_by=["id"], stamp="loaded")
    back = spark.read.parquet(path)
    assert back.count() == 1000 and "loaded" in back.columns
    files = back.where("m = 1").select(F.input_file_name()).distinct().collect()
    assert files and all("/m=1/" in f[0] for f in files)


def test_views_and_tables(spark):
    df = spark.range(3)
    assert tables.materialize(df, "v_three", "view").count() == 3
    assert tables.materialize(df, "p_three", "table", scratch_path(spark, "three")).count() == 3
    assert tables.materialize(df, "t_three", "table").count() == 3
    spark.sql("DROP TABLE t_three")


def test_databases_and_tables(spark, folder):
    tables.ensure_database(spark, "shop_raw", f"{folder}/db")
    tables.ensure_database(spark, "shop_raw", f"{folder}/db")
    spark.range(1).write.saveAsTable("shop_raw.fct_orders")
    spark.range(1).write.saveAsTable("shop_raw.stg_orders")
    assert {r.table_name for r in tables.list_tables(spark, "shop_raw").collect()} >= {"fct_orders", "stg_orders"}
    facts = tables.list_tables(spark, "shop_raw", "fct_%").collect()
    assert [r.table_name for r in facts] == ["fct_orders"]
    spark.sql("DROP DATABASE shop_raw CASCADE")


def test_jdbc_options():
    """No database here: what is handed to Spark, not what comes back."""
    assert tables.jdbc_options("jdbc:x:y", "orders") == {
        "url": "jdbc:x:y", "dbtable": "orders", "fetchsize": "10000",
    }
    split = tables.jdbc_options("jdbc:x:y", "orders", "id", 1, 1000, 8)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")


def test_jdbc_reader_passes_its_options_on():
    calls = []

    class Reader:
        read = property(lambda self: self)

        def format(self, name):
            calls.append(name)
            return self

        def options(self, **options):
            calls.append(options)
            return self

        def load(self):
            return "frame"

    got = tables.read_jdbc_tables(Reader(), "jdbc:x:y", ["a", "b"], {"user": "me"}, {"b": ("id", 0, 9, 3)})
    assert got == {"a": "frame", "b": "frame"} and calls[0] == "jdbc"
    assert calls[1] == tables.jdbc_options("jdbc:x:y", "a") | {"user": "me"}
    assert calls[3] == tables.jdbc_options("jdbc:x:y", "b", "id", 0, 9, 3) | {"user": "me"}


def test_source_catalogue(spark):
    root = scratch_path(spark, "cat")
    spark.range(2).write.parquet(f"{root}/{tables.SOURCES['orders']}")
    assert tables.read_sources(spark, root, ["orders"])["orders"].count() == 2
    tables.ensure_database(spark, "shop_sources")
    spark.range(3).write.saveAsTable(f"shop_sources.`{tables.SOURCES['indicators']}`")
    assert tables.read_sources(spark, "shop_sources", ["indicators"], catalogued=True)["indicators"].count() == 3
    spark.sql("DROP DATABASE shop_sources CASCADE")


def test_load_time(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert tables.with_load_time(spark.range(1), at=at).first().loaded_at == dt.datetime(2024, 1, 1)


def test_shared_folder_and_settings(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())
    df = spark.range(5).withColumn("s", F.lit("x"))
    assert keep(df, "five").schema.simpleString() == df.schema.simpleString() and keep(df, "five").count() == 5


def test_a_run_can_remove_what_it_left(spark, folder):
    """In a session of its own, so that no other test loses its data."""
    code = (
        "from tradewind.session import *\nimport os\n"
        f"s = local_session('own', 1, 1, **{{'spark.checkpoint.dir': '{folder}'}})\n"
        "keep(s.range(3), 'x'), keep(s.range(3), 'y')\n"
        "assert len(os.listdir(scratch_root(s))) == 2 and scratch_root(s).startswith(shared_dir(s))\n"
        "drop_scratch(s)\nassert not os.path.exists(scratch_root(s))\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[1], timeout=120)
    assert scratch_path(spark, "z").startswith(scratch_root(spark)) and drop_scratch
