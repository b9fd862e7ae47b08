"""Events taken in once: late, early and repeated ones, batches that are repeated."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.session import scratch_path
from tradewind.streaming import intake

SCHEMA = "event_id long, ts timestamp, event_type string, value double"


def at(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def plain(batches, delay=60):
    """The same with lists: (taken in, late)."""
    taken, late, newest = [], [], None
    for batch in batches:
        fresh = {}
        seen = {r[0] for r in taken if newest is not None and r[1] >= newest - dt.timedelta(minutes=delay)}
        for r in batch:
            if r[1] is None:
                late.append((*r, intake.NO_TIME))
            elif newest is not None and r[1] < newest - dt.timedelta(minutes=delay):
                late.append((*r, intake.LATE))
            elif r[0] is None:
                fresh.setdefault(None, []).append(r)
            elif r[0] not in seen:
                fresh.setdefault(r[0], []).append(r)
        taken += [r for k, own in fresh.items() for r in (own if k is None else [min(own, key=lambda r: r[1:])])]
        newest = max([t for t in [newest, *(r[1] for r in batch)] if t is not None], default=None)
    return sorted(taken, key=repr), sorted(late, key=repr)


@pytest.fixture
def feed(spark):
    root = scratch_path(spark, "intake")

    def put(*batches):
        """A file, and so a micro-batch, each."""
        for batch in batches:
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
            intake.run_event_intake(stream, f"{root}/out", f"{root}/checkpoint")

    put.held = lambda: tuple(rows(df) for df in intake.taken_in(spark, f"{root}/out", SCHEMA))
    put.root = root
    return put


def test_late_early_and_repeated_events(feed):
    first = [(1, at(0), "buy", 1.0), (2, at(50), "buy", 2.0), (2, at(49), "buy", 2.5), (None, at(1), "x", 0.0), (None, at(1), "x", 0.0)]
    second = [(1, at(0), "buy", 1.0), (3, at(300), "view", 3.0), (4, at(-11), "buy", 9.0), (5, None, "buy", 1.0)]
    third = [(2, at(49), "buy", 2.5), (3, at(300), "view", 3.0), (6, at(241), "buy", 1.5), (7, at(239), "buy", 1.5)]
    feed(first, second, third)
    assert feed.held() == plain([first, second, third])
    taken, late = feed.held()
    assert {r[0] for r in taken} == {1, 2, 3, 6, None} and sorted((r[0], r[4]) for r in late) == [
        (2, "late"), (4, "late"), (5, "no time"), (7, "late")
    ]


def test_a_repeated_batch_leaves_no_trace_of_the_first_attempt(spark, feed, monkeypatch):
    first = [(1, at(0), "buy", 1.0), (2, at(100), "buy", 1.0)]
    second = [(2, at(100), "buy", 1.0), (3, at(10), "buy", 1.0), (4, at(200), "buy", 1.0)]
    feed(first)
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(f"{feed.root}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{feed.root}/in")
    done = intake.take_in

    def killed(batch, number, *rest):
        done(batch, number, *rest)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(intake, "take_in", killed)
        with pytest.raises(Exception, match="killed"):
            intake.run_event_intake(stream, f"{feed.root}/out", f"{feed.root}/checkpoint")
    feed()
    intake.run_event_intake(stream, f"{feed.root}/out", f"{feed.root}/checkpoint")
    assert feed.held() == plain([first, second])


def test_random_batches_equal_plain_lists(spark):
    pick = random.Random(4)
    out = scratch_path(spark, "intake")
    batches = []
    for n in range(8):
        batches.append([(pick.choice([None, *range(25)]), at(pick.choice([None, *range(40 * n - 90, 40 * n + 60)])), pick.choice("ab"), 1.0) for _ in range(20)])
        intake.take_in(spark.createDataFrame(batches[-1], SCHEMA), n, out, "event_id", "ts", "60 minutes")
    assert tuple(rows(df) for df in intake.taken_in(spark, out, SCHEMA)) == plain(batches)
    assert [df.count() for df in intake.taken_in(spark, scratch_path(spark, "none"), SCHEMA)] == [0, 0]


def test_late_rows_are_counted_beyond_a_hundred_batches(spark):
    """Each batch after the first has one event that is too late for its window."""
    root, n = scratch_path(spark, "many"), 120
    schema = "ts timestamp, event_type string, value double"
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for i in range(n):
            events = [(at(10_000 + 30 * i), "buy", 1.0)] + [(at(i), "old", 1.0)] * (i > 1)
            spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        late = intake.run_intake(intake.windowed_totals(stream, delay="10 minutes"), f"{root}/out", f"{root}/checkpoint")
        got = intake.latest_totals(spark.read.parquet(f"{root}/out"))
        assert late == n - 2 and got.agg(F.sum("events")).first()[0] == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
