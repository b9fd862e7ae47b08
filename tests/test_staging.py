"""Casting, trimming, parsing, and the staging views on awkward rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tradewind.functions import scalars as S
from tradewind.operators import staging


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_safe_cast_of_bad_text(spark):
    bad = column(spark, ["", "bad", "12.0", " 12 ", "nan", "7", None])
    assert apply(bad, S.safe_cast(F.col("x"), "bigint")) == [None, None, None, 12, None, 7, None]
    assert apply(bad, S.safe_cast(F.col("x"), "double")) == [None, None, 12.0, 12.0, None, 7.0, None]


def test_float_to_integer_rounds_half_away_from_zero(spark):
    halves = column(spark, [2.5, -2.5, 2.4, float("nan"), None], "double")
    assert apply(halves, S.safe_cast(F.col("x"), "bigint", from_float=True)) == [3, -3, 2, None, None]


def test_safe_timestamps(spark):
    texts = column(spark, ["17/05/2017", "2017-05-17", "0000-00-00", "2017-05-17 10:11:12"])
    got = apply(texts, S.safe_cast(F.col("x"), "timestamp").cast("string"))
    assert got == [None, "2017-05-17 00:00:00", None, "2017-05-17 10:11:12"]


def test_trim_takes_all_white_space(spark):
    assert apply(column(spark, ["\tSP \n", " RJ", " a b ", None]), S.clean_trim(F.col("x"))) == [
        "SP", "RJ", "a b", None,
    ]


def test_day_first_dates_are_strict(spark):
    assert apply(column(spark, ["17/05/2017"]), S.parse_day_first(F.col("x"))) == [dt.date(2017, 5, 17)]
    with pytest.raises(PySparkException):
        apply(column(spark, ["2017-05-17"]), S.parse_day_first(F.col("x")))


@pytest.mark.parametrize(
    "rate, label",
    [(3.49, 0), (3.5, 1), (4.5, 1), (4.51, 2), (0.0, 0), (None, 2)],
)
def test_fx_bucket(spark, rate, label):
    df = column(spark, [rate], "double")
    assert apply(df, S.bucket(F.col("x"), *S.FX_LIMITS, S.ROW_FX_LABELS)) == [S.ROW_FX_LABELS[label]]
    two = S.STRENGTH_LABELS[min(label, 1)]
    assert apply(df, S.bucket(F.col("x"), S.FX_LIMITS[0], None, S.STRENGTH_LABELS)) == [two]


@pytest.mark.parametrize("rate, label", [(6.9, 0), (7.0, 1), (12.0, 1), (12.1, 2), (None, 2)])
def test_interest_bucket(spark, rate, label):
    df = column(spark, [rate], "double")
    got = apply(df, S.bucket(F.col("x"), *S.INTEREST_LIMITS, S.ROW_INTEREST_LABELS))
    assert got == [S.ROW_INTEREST_LABELS[label]]


def test_dollars(spark):
    df = spark.createDataFrame(
        [(100.0, 4.0), (10.01, 2.0), (-10.01, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "v double, r double"
    )
    cents = S.to_cents(S.dollars(S.units(F.col("v")), F.col("r")))
    assert apply(df, cents) == [25.0, 5.01, -5.01, None, None, None]


def test_cents_at_the_edges(spark):
    df = column(spark, [0.005, 1.004999, 1.995, 0.9999999999, 41979.825, -41979.825, 3.8e10, 0.0], "double")
    assert apply(df, S.to_cents(F.col("x"))) == [0.01, 1.0, 2.0, 1.0, 41979.83, -41979.83, 3.8e10, 0.0]


def test_fine_sums(spark):
    df = column(spark, [0.1, 0.2, -0.3, 1 / 3, 4e12, None], "double")
    assert float(df.agg(S.fine_sum(F.col("x"))).first()[0]) == 4000000000000.333333333
    assert df.where("x > 1e13").agg(S.fine_sum(F.col("x"))).first()[0] is None


def test_unit_sums_are_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (-0.3,), (1e6,), (None,)], "x double")
    total, mean = df.agg(S.unit_sum(S.units(F.col("x"))), S.unit_mean(S.units(F.col("x")))).first()
    assert (float(total), float(mean)) == (1e6, 250000.0)
    empty = df.where("x > 1e9").agg(S.unit_sum(S.units(F.col("x"))), S.unit_mean(S.units(F.col("x")))).first()
    assert tuple(empty) == (None, None)


def test_unit_sums_of_many_large_amounts(spark):
    big = spark.range(2_000_000).select(F.lit(9e12).alias("x"))
    assert int(big.agg(S.unit_sum(S.units(F.col("x")))).first()[0]) == 2_000_000 * 9 * 10**12
    signs = spark.createDataFrame([(-9e12,), (-0.000001,), (9e12,), (-1.5,)], "x double")
    assert str(signs.agg(S.unit_sum(S.units(F.col("x")))).first()[0]) == "-1.500001"


def test_a_mean_of_added_up_sums_keeps_its_digits(spark):
    """201 rates whose mean lies just below a half: sums of sums must not widen the digits away."""
    rates = [(i % 3, 3.1234) for i in range(101)] + [(i % 3, 3.1235) for i in range(100)]
    assert sum(round(r * 10**4) for _, r in rates) / 201 < 31234.5
    cube = spark.createDataFrame(rates, "k int, rate double").groupBy("k").agg(
        S.unit_sum(S.units(F.col("rate"))).alias("s"), F.count("rate").alias("n")
    )
    mean = cube.agg(S.mean_of(F.sum("s"), F.sum("n")).alias("m"))
    assert mean.select(S.rounded(F.col("m"), 4)).first()[0] == 3.1234


def test_infinite_amounts_are_no_numbers(spark):
    df = spark.createDataFrame([("inf",), ("-Infinity",), ("NaN",), ("1.5",), ("x",)], "t string")
    got = df.agg(S.unit_sum(S.units(S.safe_cast(F.col("t"), "double"))), F.count(S.safe_cast(F.col("t"), "double"))).first()
    assert (float(got[0]), got[1]) == (1.5, 1)


def test_unit_sum_passes_64_bits(spark):
    """A sum beyond the range of a 64-bit count of units."""
    big = spark.range(4000).select((F.lit(9e12) + F.col("id") * 0).alias("x"))
    assert int(big.agg(S.unit_sum(S.units(F.col("x")))).first()[0]) == 4000 * 9 * 10**12


def test_elapsed_counts_whole_units(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "2024-01-02 00:00:00")], "a string, b string")
    a, b = F.col("a").cast("timestamp"), F.col("b").cast("timestamp")
    assert df.select(S.elapsed("HOUR", a, b), S.elapsed("MINUTE", a, b)).first() == (23, 1439)


def test_label_of_a_place_needs_both_parts(spark):
    df = spark.createDataFrame([("Recife", "PE"), ("Recife", None)], "c string, s string")
    assert apply(df, S.place_label(F.col("c"), F.col("s"))) == ["Recife, PE", None]


def test_products_keep_missing_categories_and_lose_the_typo(spark):
    raw = spark.createDataFrame(
        [("p", " toys\t", "12", "x", "1", "5.5", "", "nan", "2")],
        "product_id string, product_category_name string, product_name_lenght string, "
        "product_description_lenght string, product_photos_qty string, product_weight_g string, "
        "product_length_cm string, product_height_cm string, product_width_cm string",
    )
    got = staging.stg_products(raw).first().asDict()
    assert got == {
        "product_id": "p", "product_category_name": "toys", "product_name_length": 12,
        "product_description_length": None, "product_photos_qty": 1, "product_weight_g": 5.5,
        "product_length_cm": None, "product_height_cm": None, "product_width_cm": 2.0,
    }


def test_indicators_need_date_and_value(spark):
    raw = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1.0), (None, 1.0), (dt.date(2020, 1, 2), None)], "data date, valor double"
    ).selectExpr("*", "'ipca' series_name", "433L series_id", "timestamp'2020-01-03' extracted_at")
    assert staging.stg_indicators(raw).count() == 1


def test_strict_casts_raise(spark):
    raw = spark.createDataFrame([("o", 1, "boleto", "x", "1.0")],
                                "order_id string, payment_sequential int, payment_type string, "
                                "payment_installments string, payment_value string")
    with pytest.raises(PySparkException):
        staging.strict_payments(raw).collect()


def test_customers_repeat_with_the_places_of_their_zip(spark):
    customers = spark.createDataFrame(
        [("c1", "u1", "01", "RIO", "RJ"), ("c2", "u2", "02", "Ouro", "MG")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
    )
    geo = spark.createDataFrame(
        [("01", 1.0, 2.0, "rio", "RJ"), ("01", 1.0, 2.0, "rio", "RJ"), ("01", 3.0, 4.0, "rio", "RJ")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    got = rows(staging.strict_customers(customers, geo, all_places=True).select("customer_id", "customer_city", "geolocation_city"))
    assert got == [("c1", "rio", "rio")] * 3 + [("c2", "ouro", None)]
    # The centroid counts equal rows once.
    assert rows(staging.zip_centroids(geo)) == [("01", 2.0, 3.0)]
