"""Raw tables: verbatim payloads with provenance, appended by load day."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from finlake.sources import files

LOAD_DATE = "_load_date"
ENDPOINT = "endpoint_name"
RETENTION_DAYS = 90

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField(LOAD_DATE, T.DateType()),
    ]
)
MULTIPLEXED_SCHEMA = T.StructType(
    [PAYLOAD_SCHEMA[0], T.StructField(ENDPOINT, T.StringType()), *PAYLOAD_SCHEMA[1:]]
)


def lookback_start(as_of: date, reference_date: date | str | None = None, days: int = 2) -> date:
    """First landing day of a run.

    The given date, else the environment's ``REFERENCE_DATE``, else ``days`` before
    ``as_of``.
    """
    given = reference_date or os.environ.get("REFERENCE_DATE")
    if not given:
        return as_of - timedelta(days=days)
    return given if isinstance(given, date) else date.fromisoformat(given)


def wrap(landed: DataFrame, run_at: datetime, endpoint: Column | str | None = None) -> DataFrame:
    """Landed records as raw rows; all rows of a run share one ingest time."""
    stamp = F.lit(run_at.isoformat(sep=" ")).cast("timestamp")
    columns = [F.col("payload")]
    if endpoint is not None:
        columns.append((F.col(endpoint) if isinstance(endpoint, str) else endpoint).alias(ENDPOINT))
    return landed.select(
        *columns,
        F.col("_source_file"),
        stamp.alias("_ingested_at"),
        F.lit(run_at.date()).alias(LOAD_DATE),
    )


def append(rows: DataFrame, path: str, count_by: list[str] | None = None) -> dict[str, int]:
    """Append raw rows under their load day; returns the counts of the same pass.

    ``count_by`` lists endpoint names to count besides the total. Without rows
    nothing is added.
    """
    schema = MULTIPLEXED_SCHEMA if ENDPOINT in rows.columns else PAYLOAD_SCHEMA
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("total")]
    counts += [F.count_if(F.col(ENDPOINT) == name).alias(name) for name in count_by or []]
    (
        rows.select(*schema.fieldNames())
        .observe(seen, *counts)
        .write.mode("append")
        .partitionBy(LOAD_DATE)
        .parquet(path)
    )
    return {name: int(value) for name, value in seen.get.items()}


def read(spark: SparkSession, path: str, multiplexed: bool = False) -> DataFrame:
    """Raw table with its fixed schema; an absent table is empty."""
    schema = MULTIPLEXED_SCHEMA if multiplexed else PAYLOAD_SCHEMA
    if not files.has_data(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def since(
    rows: DataFrame,
    as_of: date | Column,
    start_date: date | None = None,
    lookback_days: int = 2,
) -> DataFrame:
    """Rows loaded since ``start_date``, or in the lookback window before ``as_of``."""
    if start_date is not None:
        first = F.lit(start_date)
    else:
        first = F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), lookback_days)
    return rows.where(F.col(LOAD_DATE) >= first)


def unexpired(rows: DataFrame, as_of: date | Column, day: str = LOAD_DATE, keep_days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than the retention period."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return rows.where(F.col(day) >= F.date_sub(as_of, keep_days))


def expire(spark: SparkSession, path: str, as_of: date, keep_days: int = RETENTION_DAYS) -> list[str]:
    """Drop the load-day folders past retention; no data file is opened."""
    limit = (as_of - timedelta(days=keep_days)).isoformat()
    old = [day for day in files.partition_values(spark, path, LOAD_DATE) if day < limit]
    for day in old:
        files.remove(spark, f"{path}/{LOAD_DATE}={day}")
    return old
