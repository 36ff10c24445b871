"""Exact numbers.

Amounts are kept as decimal(38,9). Sums and differences are taken in
decimal(37,9), whose results are decimal(38,9): adding two decimal(38,9) would
give decimal(38,8) and lose a digit.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

AT_REST = "decimal(38,9)"
IN_SUMS = "decimal(37,9)"


def integer(text: Column, strict: bool = True) -> Column:
    """Whole number; ``1.0`` or ``5.5`` is an error, not a truncation."""
    return text.cast("bigint") if strict else text.try_cast("bigint")


def numeric(text: Column, strict: bool = True) -> Column:
    """decimal(38,9), rounded half up at the tenth digit."""
    return text.cast(AT_REST) if strict else text.try_cast(AT_REST)


def boolean(text: Column, strict: bool = True) -> Column:
    return text.cast("boolean") if strict else text.try_cast("boolean")


def _amount(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(IN_SUMS)


def plus_optional(first: Column | str, second: Column | str) -> Column:
    """first + second, a missing second part counting as zero."""
    return _amount(first) + F.coalesce(_amount(second), F.lit(0).cast(IN_SUMS))


def minus(first: Column | str, second: Column | str) -> Column:
    return _amount(first) - _amount(second)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Double ratio, null when the denominator is zero."""
    numerator = F.col(numerator) if isinstance(numerator, str) else numerator
    denominator = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(value: Column | str, digits: int) -> Column:
    """Round half away from zero.

    Goes through a decimal with ten fraction digits: doubles that agree to nine
    digits then round alike, whatever order they were summed in.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")
