"""As-of joins against plain loops; ranges, ties, hot times."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import asof, indicators
from tradewind.operators.asof import asof_join

L, R = "at int, k string, v int", "seen int, k string, a int, b string"


def plain(left, right, by, strict):
    out = []
    for at, k, v in left:
        met = [
            (seen, a is not None, a or 0, b is not None, b or "", (a, b))
            for seen, key, a, b in right
            if at is not None and seen is not None and (seen < at if strict else seen <= at)
            and (not by or (k is not None and key == k))
        ]
        out.append((at, k, v, *(max(met)[-1] if met else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("by, strict, few", [((), False, 0), (("k",), True, 0), (("k",), False, asof.FEW), ((), True, asof.FEW)])
def test_equals_plain_loops(spark, monkeypatch, by, strict, few):
    monkeypatch.setattr(asof, "FEW", few)
    pick = random.Random(len(by) + 2 * strict)
    left = [(pick.choice([None, 50, *range(100)]), pick.choice(["x", "y", "z", None]), i) for i in range(300)]
    left += [(60, "x", i) for i in range(200)]  # one time, one key
    right = [
        (pick.choice([None, *range(10, 90)]), pick.choice(["x", "y", None]), pick.choice([None, 1, 2]), pick.choice([None, "p", "q"]))
        for _ in range(60)
    ]
    other = spark.createDataFrame(right, R)
    other = other if by else other.drop("k")
    got = asof_join(spark.createDataFrame(left, L), other, "at", "seen", by, strict)
    assert got.columns == ["at", "k", "v", "a", "b"]
    assert rows(got) == plain(left, right, by, strict)


def test_nothing_on_a_side(spark):
    left, right = spark.createDataFrame([(1, "x", 1)], L), spark.createDataFrame([], R).drop("k")
    assert rows(asof_join(left, right, "at", "seen")) == [(1, "x", 1, None, None)]
    assert asof_join(left.limit(0), spark.createDataFrame([(1, "x", 1, "b")], R).drop("k"), "at", "seen").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, left.withColumnRenamed("at", "seen"), "at", "seen")
    with pytest.raises(ValueError, match="types"):
        asof_join(left, right.withColumn("seen", F.current_date()), "at", "seen")


def test_many_times_fall_into_ranges_and_values_cross_their_edges(spark, monkeypatch):
    monkeypatch.setattr(asof, "FEW", 1000)
    """A value a thousand ranges back is carried on; rows of a range are few, also of unevenly spread times."""
    n = 200_000
    at = (F.pow(F.lit(1.00005), F.col("id")) * 1e6).cast("bigint").alias("at")  # ever rarer
    left = spark.range(n, numPartitions=8).select(at, "id").distinct()
    first = spark.createDataFrame([(0, "first"), (1_000_500, "second")], "seen long, name string")
    found = asof_join(left, first, "at", "seen")
    assert found.groupBy("name").count().orderBy("name").collect()[0]["count"] == left.where("at < 1000500").count()
    (points,) = left.agg(F.percentile_approx("at", [i / 1024 for i in range(1, 1024)], 10240)).first()
    edges = F.array(*map(F.lit, points))
    sizes = left.select(asof._range_of(F.col("at"), edges).alias("r")).groupBy("r").count()
    total = left.select("at").distinct().count()
    most = sizes.agg(F.max("count"), F.count("*")).first()
    assert most[0] < 4 * total / 1024 + 5 and most[1] > 900


def test_filled_rates_equal_the_daily_form(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    pick = random.Random(1)
    ind = spark.createDataFrame(
        [("exchange_rate_usd", day(n), pick.choice([None, 1.5, 2.5, 0.0])) for n in range(5, 300) if pick.random() < 0.6],
        "series_name string, indicator_date date, indicator_value double",
    )
    df = spark.createDataFrame([(day(pick.randrange(400)), i) for i in range(500)], "d date, i int")
    for end in (None, "2020-09-01"):
        daily = indicators.ffill_daily(ind, "exchange_rate_usd", end=end).select(F.col("indicator_date").alias("d"), F.col("indicator_value").alias("r"))
        assert rows(indicators.with_fx(df, "d", ind, "ffill", "r", end)) == rows(df.join(daily, "d", "left").select("d", "i", "r"))
