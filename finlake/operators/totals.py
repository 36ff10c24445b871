"""Month totals next to each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from finlake.functions.dates import month_of
from finlake.operators.periods import null_safe_left_join


def day_totals(rows: DataFrame, group: list[str], day: str, amount: Column) -> DataFrame:
    """Amount per group and day; partial sums are taken before the shuffle."""
    return rows.groupBy(*group, day).agg(F.sum(amount).alias("__amount"))


def spread_month_totals(
    days: DataFrame, day: str, group: list[str], group_total: str, market_total: str
) -> DataFrame:
    """Month totals per group and overall, on one row per group and day.

    Needs ``__amount``. A group has at most 31 rows in a month, so its total is a
    window. The market's total is a grouped sum, of one row per month.
    """
    month = month_of(F.col(day))
    market = days.groupBy(month.alias("__market_month")).agg(F.sum("__amount").alias(market_total))
    totalled = days.select(
        *(name for name in days.columns if name != "__amount"),
        F.sum("__amount").over(Window.partitionBy(*group, month)).alias(group_total),
    )
    same_month = month.eqNullSafe(F.col("__market_month"))
    return totalled.join(market, same_month, "left").drop("__market_month")


def with_month_totals(
    rows: DataFrame,
    group: list[str],
    day: str,
    amount: Column,
    group_total: str,
    market_total: str,
) -> DataFrame:
    """Rows with both month totals. The rows themselves enter no month-wide window."""
    days = spread_month_totals(
        day_totals(rows, group, day, amount), day, group, group_total, market_total
    )
    return null_safe_left_join(rows, days, [*group, day])
