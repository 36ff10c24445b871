"""Joins between dated rows and validity periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Blocks of 1, 16, 256, 4,096 and 65,536 months: what a calendar date can reach.
_LEVELS, _BITS = 5, 4
_BLOCK = "__block"


def _month_number(day: str) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def blocks_of_day(day: str) -> Column:
    """The block of each level that holds a day."""
    month = _month_number(day)
    return F.array(
        *(
            F.struct(F.lit(k).alias("level"), F.shiftright(month, k * _BITS).alias("block"))
            for k in range(_LEVELS)
        )
    )


def blocks_of_period(start: str, end: str) -> Column:
    """The fewest blocks that make up the months a period touches; null when it ends before it starts.

    Whole larger blocks in the middle, smaller ones towards the ends: at most thirty of a
    level, however long the period is.
    """
    step = (1 << _BITS) - 1
    low, high = _month_number(start), _month_number(end)
    found, here = [], F.col(start) <= F.col(end)

    def run(level: int, first: Column, last: Column) -> Column:
        each = F.transform(
            F.sequence(first, last), lambda b: F.struct(F.lit(level).alias("level"), b.alias("block"))
        )
        return F.when(first <= last, each).otherwise(F.array().cast("array<struct<level:int,block:int>>"))

    for level in range(_LEVELS):
        up_low = F.shiftright(low + step, _BITS)
        up_high = F.shiftright(high + 1, _BITS) - 1
        above = (up_low <= up_high) if level < _LEVELS - 1 else F.lit(False)
        left, right = F.shiftleft(up_low, _BITS) - 1, F.shiftleft(up_high + 1, _BITS)
        ends = F.concat(run(level, low, left), run(level, right, high))
        found.append(F.when(here, F.when(above, ends).otherwise(run(level, low, high))))
        here, low, high = here & above, up_low, up_high
    return F.flatten(F.array_compact(F.array(*found)))


def periods_of_days(
    days: DataFrame, periods: DataFrame, keys: list[str], day: str, start: str, end: str
) -> DataFrame:
    """Distinct rows (keys, day) with every period of the same key that contains the day.

    A period is offered once per block of the calendar that it is made of, a day looks
    into the one block of each level that holds it: neither an open end nor an outlying
    day repeats a period more than a few hundred times, and a key with many days and
    periods is spread over its blocks.
    """
    offered = periods.select("*", F.explode(blocks_of_period(start, end)).alias(_BLOCK))
    asked = days.select("*", F.explode(blocks_of_day(day)).alias(_BLOCK))
    found = asked.join(offered, [*keys, _BLOCK])
    return found.where(F.col(day).between(F.col(start), F.col(end))).drop(_BLOCK)


def interval_join(
    rows: DataFrame, periods: DataFrame, keys: list[str], day: str, start: str, end: str
) -> DataFrame:
    """Rows with every period of the same key that contains their day, both ends included.

    Periods are found for the distinct days of a key, which the calendar bounds, and one join on
    key and day brings them to the rows.
    """
    days = rows.select(*keys, day).distinct()
    return rows.join(periods_of_days(days, periods, keys, day, start, end), [*keys, day])


def latest_period(
    rows: DataFrame,
    periods: DataFrame,
    keys: list[str],
    day: str,
    start: str,
    end: str,
) -> DataFrame:
    """For each distinct (keys, day) of ``rows``, the period that started last and contains it.

    Returns keys, day, start and end; days in no period are absent. Among
    periods with the same start the one that ends last is taken, which contains
    every day the others do. Both sides are reduced before they meet: rows to their
    distinct days, periods to one per start. No group is larger than the calendar,
    however many rows share a key.
    """
    days = rows.select(*keys, day).distinct()
    widest = periods.groupBy(*keys, start).agg(F.max(end).alias(end))
    found = periods_of_days(days, widest, keys, day, start, end)
    return (
        found.groupBy(*keys, day)
        .agg(F.max(F.struct(start, end)).alias("__period"))
        .select(*keys, day, f"__period.{start}", f"__period.{end}")
    )


def null_safe_left_join(
    rows: DataFrame, facts: DataFrame, keys: list[str], *columns: Column
) -> DataFrame:
    """Left join on keys that may be null, null matching null.

    Selects ``columns``, by default those of both sides.
    """
    renamed = facts.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    joined = rows.join(renamed, same, "left")
    return joined.select(*columns) if columns else joined.drop(*(f"__{k}" for k in keys))


def with_match_flag(rows: DataFrame, other: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Left join that only tells whether a match exists; never repeats a row."""
    present = other.groupBy(*keys).agg(F.lit(True).alias("__found"))
    found = F.col("__found").isNotNull().alias(flag)
    return rows.join(present, keys, "left").select(*rows.columns, found)
