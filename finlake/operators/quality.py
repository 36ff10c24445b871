"""Data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Checks:
    """What a table promises."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls of each column, one pass: (column_name, failures)."""
    counted = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns)
    )
    return counted.select(F.inline(pairs))


def rows_with_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def duplicate_keys(rows: DataFrame, keys: list[str], skip_null: bool | None = None) -> DataFrame:
    """Keys held by several rows, with ``n_records``.

    A single column ignores nulls; a combination counts them as values.
    """
    if skip_null if skip_null is not None else len(keys) == 1:
        rows = rows.dropna(subset=keys)
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )


def run_checks(rows: DataFrame, checks: Checks) -> DataFrame:
    """(check_name, failures) of all checks of a table."""
    results = []
    if checks.not_null:
        nulls = null_counts(rows, list(checks.not_null))
        results.append(
            nulls.select(F.concat(F.lit("not_null:"), "column_name").alias("check_name"), "failures")
        )
    for keys in checks.unique:
        found = duplicate_keys(rows, list(keys)).agg(F.count(F.lit(1)).alias("failures"))
        results.append(found.select(F.lit("unique:" + "+".join(keys)).alias("check_name"), "failures"))
    return reduce(DataFrame.unionByName, results)


def require(rows: DataFrame, checks: Checks, table: str) -> None:
    """Raise when a check of ``table`` fails."""
    failed = run_checks(rows, checks).where(F.col("failures") > 0).collect()
    if failed:
        listed = ", ".join(f"{row.check_name} ({row.failures})" for row in failed)
        raise ValueError(f"quality checks failed on {table}: {listed}")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with repetitions, present on one side only."""
    return left.exceptAll(right).unionByName(right.exceptAll(left))
