"""Date spines, slices and completeness of landed periods."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

FIRST_RESULT_YEAR = 2019
GAP_AGE_DAYS = 90
GAPS_TO_FAIL = 3

# Registry slices requested one by one: document types and size segments.
SLICE_TYPES = ["I", "C"]
SLICE_SEGMENTS = ["S1", "S2", "S3", "S4", "S5"]


def months_between(start: Column, end: Column) -> Column:
    """First days of all months from start's to end's, both included."""
    return F.when(
        F.trunc(start, "MM") <= F.trunc(end, "MM"),
        F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month")),
    )


def month_spine(bounds: DataFrame, start: str, end: str, out: str = "month") -> DataFrame:
    """One row per month of each row's [start, end]."""
    months = months_between(F.col(start), F.col(end))
    return bounds.withColumn(out, F.explode(months))


def day_spine(bounds: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    days = F.when(
        F.col(start) <= F.col(end), F.sequence(start, end, F.expr("interval 1 day"))
    )
    return bounds.withColumn(out, F.explode(days))


def year_spine(
    runs: DataFrame, run_date: str, full_load: Column, out: str = "ref_year",
    first_year: int = FIRST_RESULT_YEAR,
) -> DataFrame:
    """Years to load for each run: all since the first, or the current one only."""
    current = F.year(run_date)
    first = F.when(full_load, F.lit(first_year)).otherwise(current)
    years = F.when(first <= current, F.sequence(first, current))
    return runs.withColumn(out, F.explode(years))


def in_slices(rows: DataFrame, kind: str, segment: str, keep_unsegmented: bool = False) -> DataFrame:
    """Union of the (type, segment) slices.

    The slices do not overlap, so one filter gives their union. A row without
    segment is in no slice unless ``keep_unsegmented``.
    """
    chosen = F.col(segment).isin(SLICE_SEGMENTS)
    if keep_unsegmented:
        chosen = chosen | F.col(segment).isNull()
    return rows.where(F.col(kind).isin(SLICE_TYPES) & chosen)


def in_period(rows: DataFrame, day: str, reference: date | Column, pattern: str = "yyyy-MM") -> DataFrame:
    """Rows whose date, written in ``pattern``, equals the reference date's.

    For years, months and days the condition is a range of the bare column, which
    scans can push down.
    """
    reference = reference if isinstance(reference, Column) else F.lit(reference)
    unit = {"yyyy": "year", "yyyy-MM": "month", "yyyy-MM-dd": "day"}.get(pattern)
    if unit:
        start = F.date_trunc(unit, reference)
        start, end = start.cast("date"), (start + F.expr(f"interval 1 {unit}")).cast("date")
        return rows.where((F.col(day) >= start) & (F.col(day) < end))
    return rows.where(F.date_format(day, pattern) == F.date_format(reference, pattern))


def by_frequency(entities: DataFrame, wanted: str, frequency: str = "frequency") -> DataFrame:
    return entities if wanted == "all" else entities.where(F.col(frequency) == wanted)


def month_status(
    spine: DataFrame, answers: DataFrame, entity: str, month: str, answered: str = "answered"
) -> DataFrame:
    """Spine months with their answer flag; a month without an answer failed.

    ``answers`` holds entity, month and whether the month was answered, possibly
    several tries per month.
    """
    tries = answers.groupBy(entity, month).agg(F.bool_or(answered).alias(answered))
    return spine.join(tries, [entity, month], "left").withColumn(
        answered, F.coalesce(F.col(answered), F.lit(False))
    )


def gap_runs(
    status: DataFrame,
    entity: str,
    month: str,
    as_of: date | Column,
    answered: str = "answered",
    age_days: int = GAP_AGE_DAYS,
) -> DataFrame:
    """Runs of failed months between answered ones.

    Only failed months older than ``age_days`` count; a recent one neither counts nor
    ends a run. One row per entity and run with ``old_gaps``, the first and
    the last failed month. The window sees one row per entity and month.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    up_to_here = Window.partitionBy(entity).orderBy(month)
    runs = status.withColumn("run", F.count_if(F.col(answered)).over(up_to_here))
    old = F.datediff(as_of, month) > age_days
    return (
        runs.where(~F.col(answered))
        .groupBy(entity, "run")
        .agg(
            F.count_if(old).alias("old_gaps"),
            F.min(month).alias("first_gap"),
            F.max(month).alias("last_gap"),
        )
    )


def incomplete_entities(runs: DataFrame, entity: str, limit: int = GAPS_TO_FAIL) -> DataFrame:
    """Entities with a run of at least ``limit`` old gaps: their source is down."""
    return (
        runs.groupBy(entity)
        .agg(F.max("old_gaps").alias("longest_run"))
        .where(F.col("longest_run") >= limit)
    )


def require_complete(runs: DataFrame, entity: str, limit: int = GAPS_TO_FAIL) -> None:
    """Raise when any entity has too many old gaps in a row."""
    down = incomplete_entities(runs, entity, limit)
    count = down.count()
    if count:
        named = [row[0] for row in down.orderBy(entity).limit(20).collect()]
        more = f" and {count - len(named)} more" if count > len(named) else ""
        raise RuntimeError(f"{limit} or more old months in a row without an answer: {named}{more}")


def missing_months(
    spine: DataFrame, landed: DataFrame, entity: str, month: str
) -> DataFrame:
    """Spine months without landed records."""
    return spine.join(landed.select(entity, month), [entity, month], "left_anti")


def spine_frame(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Single-row frame with the bounds, the start of a standalone spine."""
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
