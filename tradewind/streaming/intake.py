"""Near-real-time intake: windowed totals of an event stream, and events taken in once."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from tradewind.functions.scalars import unit_sum, units
from tradewind.session import folder_names, keep


def windowed_totals(
    events: DataFrame,
    ts: str = "ts",
    kind: str = "event_type",
    value: str = "value",
    width: str = "1 minute",
    delay: str | None = None,
) -> DataFrame:
    """Events and summed value per tumbling window and kind, for a stream or a table.

    Without ``delay`` every event counts, however late, and a stream keeps the state of all
    its windows. With it, windows that ended longer than that before the newest event are
    closed; events that come later are left out, and Spark reports their number in the
    progress of the query (numRowsDroppedByWatermark), which ``run_intake`` returns.
    """
    rows = events.withWatermark(ts, delay) if events.isStreaming and delay is not None else events
    return (
        rows.groupBy(F.window(ts, width), kind)
        .agg(F.count(F.lit(1)).alias("events"), unit_sum(units(F.col(value))).cast("double").alias("total"))
        .select(F.col("window.start").alias("window_start"), kind, "events", "total")
    )


class DroppedRows(StreamingQueryListener):
    """Adds up the rows that came too late, over all batches of each run. (A query itself keeps
    the progress of its last hundred batches only.)"""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        run = str(event.progress.runId)
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        with self.news:
            self.rows[run] = self.rows.get(run, 0) + late

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def wait_for(self, run: str, seconds: float = 60) -> None:
        """Until all news of a run has come; news arrives in order, its end last."""
        with self.news:
            if not self.news.wait_for(lambda: run in self.ended, seconds):
                raise TimeoutError("the end of the stream was not reported")


def run_intake(totals: DataFrame, out: str, checkpoint: str) -> int:
    """Process everything available and stop; a later call goes on from there.

    Returns how many partial totals came too late for their window and were left out.

    Each micro-batch stores the windows it changed, under its own batch number: a batch that
    is repeated after a failure overwrites itself.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    dropped = DroppedRows()
    streams = totals.sparkSession.streams
    streams.addListener(dropped)
    try:
        query = (
            totals.writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        dropped.wait_for(str(query.runId))
    finally:
        streams.removeListener(dropped)
    return dropped.rows.get(str(query.runId), 0)


def latest_totals(stored: DataFrame, kind: str = "event_type") -> DataFrame:
    """The newest state of every window that ``run_intake`` stored."""
    newest = F.max(F.struct("batch", "events", "total")).alias("s")
    return stored.groupBy("window_start", kind).agg(newest).select(
        "window_start", kind, "s.events", "s.total"
    )


# ---- events taken in once, late ones kept aside ------------------------------------------

NO_TIME, LATE = "no time", "late"


def _finished(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder below ``path`` is completely written."""
    names = folder_names(spark, path)
    return sorted(int(n.removeprefix("batch=")) for n in names if "_SUCCESS" in folder_names(spark, f"{path}/{n}"))


def take_in(batch: DataFrame, number: int, out: str, key: str, ts: str, delay: str) -> None:
    """Add a batch of events to what lies below ``out``; the same batch again replaces itself.

    An event more than ``delay`` older than the newest one of all earlier batches is late: it goes to
    ``late`` with the reason, as does one without a time. Of all others the first of each ``key``
    goes to ``events``, in folders by day: within a batch the earliest, by its columns in order, and
    none if an earlier batch has taken the key in and is not yet out of reach. What is remembered
    of earlier batches is their newest time, and keys as far back as ``delay`` goes. A null key is
    no key: such events are all taken in.
    """
    spark, columns = batch.sparkSession, batch.columns
    before = [n for n in _finished(spark, f"{out}/marks") if n < number]
    newest = spark.read.parquet(f"{out}/marks/batch={before[-1]}").first()["newest"] if before else None
    kind = batch.schema[ts].dataType
    reach = F.lit(newest).cast(kind) - F.expr(f"INTERVAL {delay}")
    reason = F.when(F.col(ts).isNull(), NO_TIME).when(F.col(ts) < reach, LATE)
    marked = keep(batch.withColumn("__reason", reason), "batch")
    late = marked.where(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reason")
    late.write.mode("overwrite").parquet(f"{out}/late/batch={number}")

    fresh = marked.where(F.col("__reason").isNull()).drop("__reason")
    earliest = F.min(F.struct(ts, *[c for c in columns if c not in (key, ts)])).alias("e")
    keyed = fresh.where(F.col(key).isNotNull()).groupBy(key).agg(earliest).select(key, "e.*").select(*columns)
    if before and newest is not None:
        paths = [f"{out}/events/batch={n}" for n in before]
        held = spark.read.option("basePath", f"{out}/events").schema(f"`{key}` {batch.schema[key].dataType.simpleString()}, `{ts}` {kind.simpleString()}, day date, batch int")
        day = F.to_date(reach)
        seen = held.parquet(*paths).where((F.col("day") >= day) & (F.col(ts) >= reach)).select(key)
        keyed = keyed.join(seen, key, "left_anti")
    taken = keyed.unionByName(fresh.where(F.col(key).isNull())).withColumn("day", F.to_date(ts))
    taken.write.mode("overwrite").partitionBy("day").parquet(f"{out}/events/batch={number}")
    mark = marked.agg(F.greatest(F.max(F.col(ts)), F.lit(newest).cast(kind)).alias("newest"))
    mark.write.mode("overwrite").parquet(f"{out}/marks/batch={number}")


def run_event_intake(
    events: DataFrame, out: str, checkpoint: str, key: str = "event_id", ts: str = "ts", delay: str = "1 hour"
) -> None:
    """Take in all that a stream of events has and stop; a later call goes on from there.

    Each micro-batch is taken in whole before the next, under its own number, so one that is
    repeated after a failure leaves no trace of the first attempt.
    """
    query = (
        events.writeStream.foreachBatch(lambda batch, number: take_in(batch, number, out, key, ts, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def taken_in(spark: SparkSession, out: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """The events that were taken in, and the side output of those that were not, with the reason.

    Only batches that ended count.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = []
    for name, extra in (("events", []), ("late", [T.StructField("reason", T.StringType())])):
        whole = T.StructType([*schema.fields, *extra])
        paths = [f"{out}/{name}/batch={n}" for n in _finished(spark, f"{out}/marks")]
        df = spark.read.option("basePath", f"{out}/{name}").schema(whole).parquet(*paths) if paths else spark.createDataFrame([], whole)
        found.append(df.select(*whole.names))
    return found[0], found[1]
