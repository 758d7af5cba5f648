"""Numeric column helpers: repeatable means and rounding, lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for money with nine decimals, narrow enough for sums to grow.
_EXACT = "decimal(28,9)"

# Twice the relative distance of neighbouring doubles.
_DOUBLE_STEP = 2.0**-51

# The usual form, tried first.
_PLAIN = r"^-?[0-9]+\.?[0-9]*$"

# A decimal literal without Spark's type suffixes ("1.5d"), or a special value.
# The non-finite JSON literals arrive in quotes.
_DIGITS = r"\d+(?:_\d+)*"
_FLOAT = (
    rf"(?i)^\s*(?:[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r'|nan|inf|infinity)|"(?:nan|-?infinity)")\s*$'
)
_FILLERS = '_" \t\n\r\x0b\x0c'


def rounded(value: Column, places: int) -> Column:
    """Round half up on the value's decimal form.

    Going through nine decimals absorbs the last-bit noise of floating sums.
    Values with no such form (NaN, infinities, huge ones) pass unchanged.
    """
    exact = F.round(value.try_cast(_EXACT), places).cast("double")
    return F.coalesce(exact, value)


def exact_form(value: Column) -> Column:
    """A double as the decimal it stands for; NULL if more than nine decimals matter."""
    decimal = value.try_cast(_EXACT)
    same = F.abs(decimal.cast("double") - value) <= F.abs(value) * _DOUBLE_STEP
    return F.when(same, decimal)


def exact_mean(value: Column) -> Column:
    """Mean of a double column that does not depend on the summation order.

    Doubles added in shuffle order differ in the last digits from run to run;
    decimals do not. If any value has no decimal form, or one that is not the
    value (more than nine decimals matter), the plain mean is used.
    """
    exact = exact_form(value)
    mean = F.try_divide(F.sum(exact).cast("double"), F.count(value))
    return F.when(F.count(exact) == F.count(value), mean).otherwise(F.avg(value))


def parse_float(text: Column) -> Column:
    """Text to double where a plain float literal stands, else NULL."""
    plain = F.when(text.rlike(_PLAIN), text.try_cast("double"))
    other = F.when(text.rlike(_FLOAT), F.translate(text, _FILLERS, "").try_cast("double"))
    return F.coalesce(plain, other)


def parse_whole(text: Column) -> Column:
    """Text to bigint through a float, cut toward zero; NULL if not finite."""
    return parse_float(text).try_cast("bigint")


def whole_text(value: Column) -> Column:
    """Whole-number text to bigint; a fraction is cut off, exponents are NULL."""
    text = F.trim(value.cast("string"))
    cut = F.regexp_replace(text, r"\.\d*$", "")
    return F.coalesce(text.try_cast("bigint"), cut.try_cast("bigint"))


def below(left: Column, right: Column) -> Column:
    """``left < right`` where NaN compares with nothing, as IEEE has it."""
    return (left < right) & ~F.isnan(left) & ~F.isnan(right)


def above(left: Column, right: Column) -> Column:
    """``left > right`` where NaN compares with nothing."""
    return below(right, left)


def within(value: Column, low: Column, high: Column) -> Column:
    """``low <= value <= high``; false as soon as one of the three is NaN."""
    any_nan = F.isnan(value) | F.isnan(low) | F.isnan(high)
    return (low <= value) & (value <= high) & ~any_nan
