"""Column expressions: safe casts, trimming, exact money, economic buckets."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are added up as whole numbers: such a sum does not depend on the order in which
# partial results arrive, so a rerun task or another partitioning changes no digit, and it
# costs a fraction of decimal arithmetic per row.
MILLION, BILLION = 10**6, 10**9

# The labels of the economic classes.
ROW_FX_LABELS = ("Strong BRL (< 3.5)", "Moderate BRL (3.5-4.5)", "Weak BRL (> 4.5)")
ROW_INTEREST_LABELS = ("Low Interest (< 7%)", "Moderate Interest (7-12%)", "High Interest (> 12%)")
FX_LABELS = ("Strong BRL", "Moderate BRL", "Weak BRL")
STRENGTH_LABELS = ("Strong BRL", "Weak BRL")
INTEREST_LABELS = ("Low Interest", "Moderate Interest", "High Interest")
FX_LIMITS = (3.5, 4.5)
INTEREST_LIMITS = (7, 12)


def safe_cast(col: Column, to: str, from_float: bool = False) -> Column:
    """Cast, giving NULL for what does not convert.

    A float goes to an integer by rounding half away from zero. Text that spells a
    not-a-number or an infinity is no number.
    """
    if to in ("double", "float"):
        number = col.try_cast(to)
        return F.when(F.abs(number) < F.lit(float("inf")), number)
    if from_float and to in ("bigint", "int"):
        col = F.round(F.when(~F.isnan(col), col))
    return col.try_cast(to)


def clean_trim(col: Column) -> Column:
    """Strip all leading and trailing white space, tabs and line ends included."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def parse_day_first(col: Column) -> Column:
    """'DD/MM/YYYY' to a date; anything else raises."""
    return F.to_date(col, "dd/MM/yyyy")


def month_of(col: Column) -> Column:
    return F.trunc(col, "MM")


def units(col: Column) -> Column:
    """A number as a whole count of millionths, rounded to the nearest.

    Holds amounts up to 9 * 10**12; a greater one raises.
    """
    return F.rint(col.cast("double") * F.lit(float(MILLION))).cast("bigint")


def from_units(col: Column) -> Column:
    return col / F.lit(float(MILLION))


def _halves(col: Column) -> Column:
    """Exact sum of whole numbers, whose upper, middle and lower bits are added up apart.

    None of the three sums overflows below 10**12 rows, whatever the numbers.
    """
    part = F.lit(0xFFFFF).cast("bigint")
    high = F.sum(F.shiftright(col, 40)).cast("decimal(19,0)") * F.lit(Decimal(1 << 40))
    middle = F.sum(F.shiftright(col, 20).bitwiseAND(part)).cast("decimal(19,0)") * F.lit(Decimal(1 << 20))
    low = F.sum(col.bitwiseAND(part)).cast("decimal(19,0)")
    return (high + middle + low).cast("decimal(28,0)")


def unit_sum(col: Column) -> Column:
    """Exact sum of a column of units, as a decimal."""
    return _halves(col) * F.lit(Decimal(1).scaleb(-6))


def unit_mean(col: Column) -> Column:
    """Exact mean of a column of units, as a decimal; NULL when there is nothing to average."""
    return mean_of(unit_sum(col), F.count(col))


def mean_of(total: Column, count: Column) -> Column:
    """A quotient with 15 digits, however wide ``total`` has become by adding up sums."""
    return total.cast("decimal(32,9)") / F.nullif(count, F.lit(0)).cast("decimal(19,0)")


def dollars(units_col: Column, rate: Column) -> Column:
    """Units at a rate, as a plain number; NULL where the rate is missing or zero."""
    return from_units(units_col) / F.nullif(rate.cast("double"), F.lit(0.0))


def _whole(col: Column) -> Column:
    return F.floor(col)


def _billionths(col: Column) -> Column:
    """What a number exceeds its whole part by; quotients are cut off here."""
    return F.rint((col - _whole(col)) * F.lit(float(BILLION))).cast("bigint")


def fine_sum(col: Column) -> Column:
    """Order-independent sum of numbers of any size, each to nine digits, as a decimal."""
    whole = F.sum(_whole(col)).cast("decimal(19,0)")
    return whole + (_halves(_billionths(col)) * F.lit(Decimal(1).scaleb(-9))).cast("decimal(28,9)")


def rounded(col: Column, digits: int = 2) -> Column:
    return F.round(col, digits).cast("double")


def to_cents(col: Column) -> Column:
    """A number to two digits, halves away from zero; noise beyond nine digits is ignored."""
    size = F.abs(col)
    cents = F.call_function("div", _billionths(size) + F.lit(5 * MILLION), F.lit(10 * MILLION))
    return F.sign(col) * (_whole(size) * F.lit(100) + cents) / F.lit(100.0)


def exact_sum(col: Column, scale: int = 4) -> Column:
    """Order-independent sum as double; 0 when there is nothing to add."""
    total = F.sum(col.cast(f"decimal(18,{scale})"))
    return F.coalesce(total.cast("double"), F.lit(0.0))


def exact_mean(col: Column, scale: int = 6) -> Column:
    """Order-independent mean as double; NULL when there is nothing to average."""
    total = F.sum(col.cast(f"decimal(18,{scale})")).cast("double")
    return total / F.nullif(F.count(col), F.lit(0))


def bucket(col: Column, lo, hi, labels: Sequence[str]) -> Column:
    """Class of a value: below ``lo``, up to and including ``hi``, the rest.

    Two labels make a two-way split at ``lo``. NULL falls through to the last label.
    """
    out = F.when(col < lo, labels[0])
    if len(labels) == 3:
        out = out.when(col.between(lo, hi), labels[1])
    return out.otherwise(labels[-1])


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units (HOUR, MINUTE, ...) from ``start`` to ``end``."""
    return F.timestamp_diff(unit, start, end)


def place_label(city: Column, state: Column) -> Column:
    return F.concat(city, F.lit(", "), state)
