"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

def month_of(date: Column) -> Column:
    """``yyyy-MM`` of a date, timestamp or ISO text."""
    return F.substring(date.cast("string"), 1, 7)


def month_start(period: Column) -> Column:
    """First day of a ``yyyy-MM`` period, as a date."""
    return F.to_date(F.concat(period, F.lit("-01")))


def month_number(period: Column) -> Column:
    """Months since year 0, so that a year is always 12 apart."""
    year = F.substring(period, 1, 4).try_cast("int")
    return year * 12 + F.substring(period, 6, 2).try_cast("int")


def is_finite(value: Column) -> Column:
    """True for ordinary numbers; NULL, NaN and the infinities are not."""
    infinity = F.lit(float("inf"))
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < infinity)


def sum_if(condition: Column, value: Column) -> Column:
    """Sum over matching rows; NULL when none matches."""
    return F.sum(F.when(condition, value))


#: Decimals of an amount that count.
DECIMALS = 4
_UNIT = 10**DECIMALS


def units(value: Column) -> Column:
    """Whole ten-thousandths of an amount: exact sums in any row order, in a long.

    A sum beyond the range of a long fails (ANSI mode); it never wraps silently.
    """
    return F.rint(value * float(_UNIT)).cast("bigint")


def exact_units(value: Column) -> Column:
    """The same of a stored decimal, without a way through floating point."""
    return (value.cast(f"decimal(18,{DECIMALS})") * _UNIT).cast("bigint")


def amount(total_units: Column) -> Column:
    """Units back to an amount."""
    return total_units / F.lit(float(_UNIT))


def yes_no(condition: Column) -> Column:
    """'Y' where the condition holds; 'N' where it is false or unknown."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def group_label(prefix: str, key: Column) -> Column:
    """Non-NULL text for a nullable group key; NULL keys share one group."""
    return F.concat_ws("|", F.lit(prefix), key.cast("string"))


def kpi_identifier(parts: Iterable[str]) -> Column:
    """Lower-case lookup key joined by dashes."""
    return F.lower(F.concat_ws("-", *[F.coalesce(F.col(p), F.lit("")) for p in parts]))


def yeo_johnson(x: Column, lam: Column) -> Column:
    """Yeo-Johnson power transform (Yeo & Johnson, 2000).

    ``expm1`` instead of a power minus one: it stays exact for exponents next to
    the logarithmic cases.
    """
    size = F.log1p(F.abs(x))
    power = F.when(x >= 0, lam).otherwise(2 - lam)
    grown = F.when(power == 0, size).otherwise(F.expm1(power * size) / power)
    return F.signum(x) * grown
