"""The event stream, in several runs."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tradewind.session import scratch_path
from tradewind.streaming import intake

SCHEMA = "ts timestamp, event_type string, value double"


def batch(spark, *events):
    data = [(dt.datetime(2024, 1, 1, 0, m, s), k, v) for m, s, k, v in events]
    return spark.createDataFrame(data, SCHEMA)


def test_resumes_and_updates_open_windows(spark):
    root = scratch_path(spark, "stream")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"

    late = 0

    def run():
        events = spark.readStream.schema(SCHEMA).parquet(src)
        nonlocal late
        late = intake.run_intake(intake.windowed_totals(events, delay="10 minutes"), out, ckpt)
        return rows(intake.latest_totals(spark.read.parquet(out)).select(
            F.minute("window_start"), "event_type", "events", "total"))

    batch(spark, (0, 1, "buy", 1.5), (0, 59, "buy", 2.0), (1, 0, "view", 1.0)).coalesce(1).write.mode("append").parquet(src)
    assert run() == [(0, "buy", 2, 3.5), (1, "view", 1, 1.0)]
    # Late but within the delay: the window is updated, not written a second time.
    batch(spark, (0, 30, "buy", 0.5), (2, 0, "buy", 4.0)).coalesce(1).write.mode("append").parquet(src)
    expected = [(0, "buy", 3, 4.0), (1, "view", 1, 1.0), (2, "buy", 1, 4.0)]
    assert run() == expected
    # Nothing new: nothing changes.
    assert run() == expected
    # Far ahead, then too late: the second event meets a closed window and is dropped.
    batch(spark, (40, 0, "buy", 1.0)).coalesce(1).write.mode("append").parquet(src)
    run()
    batch(spark, (0, 10, "buy", 100.0)).coalesce(1).write.mode("append").parquet(src)
    assert late == 0
    assert run() == expected + [(40, "buy", 1, 1.0)]
    assert late == 1


def test_without_a_delay_no_event_is_too_late(spark):
    root = scratch_path(spark, "stream")
    for event in ((40, 0, "buy", 1.0), (0, 10, "buy", 100.0)):
        batch(spark, event).coalesce(1).write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        assert intake.run_intake(intake.windowed_totals(events), f"{root}/out", f"{root}/ckpt") == 0
    got = intake.latest_totals(spark.read.parquet(f"{root}/out")).select(F.minute("window_start"), "total")
    assert rows(got) == [(0, 100.0), (40, 1.0)]


def test_table_and_stream_agree(spark):
    df = batch(spark, (0, 1, "buy", 1.5), (0, 59, "buy", 2.0))
    assert intake.windowed_totals(df).count() == 1
