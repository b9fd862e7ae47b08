"""Event intake in several batches, against SQL that knows when each event arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.entities import Entities
from suite.marts_queries import plain_times
from suite.registry import query
from tradewind.session import keep, scratch_path
from tradewind.streaming import intake

PARTS = 4
EVENT = "event_id long, ts timestamp, event_type string, value double"


def arrivals(e: Entities) -> DataFrame:
    """Events with the batch they arrive in: in order of time, but every tenth a batch later, and
    every seventh once more in the next one."""
    rows = e.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    seconds = F.unix_seconds("ts")
    span = rows.agg(F.min(seconds).alias("a"), (F.max(seconds) - F.min(seconds) + 1).alias("w")).select(F.struct("a", "w")).scalar()
    own = F.floor((seconds - span["a"]) * PARTS / span["w"]).cast("int")
    first = own + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    again = F.when(F.col("event_id") % 7 == 3, F.array(first, first + 1)).otherwise(F.array(first))
    return rows.select("*", F.explode(again).alias("batch"))


@query(
    "r6_event_intake",
    f"""
    WITH whole AS (SELECT event_id, ts, event_type, value, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS s FROM events),
    span AS (SELECT min(s) AS a, max(s) - min(s) + 1 AS w FROM whole),
    firsts AS (SELECT event_id, ts, event_type, value,
                      (s - a) * {PARTS} // w + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS b FROM whole, span),
    arrived AS (FROM firsts UNION ALL SELECT * REPLACE (b + 1 AS b) FROM firsts WHERE event_id % 7 = 3),
    marks AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
              FROM arrived GROUP BY b),
    told AS (SELECT arrived.*, coalesce(ts < newest - INTERVAL 1 HOUR, false) AS late FROM arrived JOIN marks USING (b))
    SELECT event_id, ts, event_type, value, CAST(NULL AS VARCHAR) AS reason FROM told WHERE NOT late
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY b) = 1
    UNION ALL SELECT event_id, ts, event_type, value, 'late' FROM told WHERE late""",
)
def _(e: Entities):
    rows, root = keep(arrivals(e), "arrivals"), scratch_path(e.spark, "intake")
    for batch in range(PARTS + 2):
        part = rows.where(F.col("batch") == batch).drop("batch")
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = e.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    intake.run_event_intake(stream, f"{root}/out", f"{root}/checkpoint")
    taken, late = intake.taken_in(e.spark, f"{root}/out", EVENT)
    return plain_times(taken.withColumn("reason", F.lit(None).cast("string")).unionByName(late))
