"""Ingestion log: one row per run and entity."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

logger = logging.getLogger(__name__)

LOG_DATE = "_log_date"
SUCCESS = "success"
FAILURE = "failure"

# Columns of the log, as read by its users.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType(), False),
        T.StructField("project_id", T.StringType(), False),
        T.StructField("pipeline", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("entity", T.StringType(), False),
        T.StructField("frequency", T.StringType()),
        T.StructField("reference_date", T.DateType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("blob_path", T.StringType()),
        T.StructField("bq_table", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField(LOG_DATE, T.DateType(), False),
    ]
)


@dataclass(frozen=True)
class Run:
    """What the log rows of one run share."""

    project_id: str
    pipeline: str
    layer: str
    reference_date: date
    frequency: str | None = None


def log_rows(outcomes: DataFrame, run: Run, run_at: datetime) -> DataFrame:
    """Log rows of (entity, record_count, status, error_message, blob_path, bq_table).

    Columns missing from ``outcomes`` are null.
    """
    shared = {
        "log_id": F.expr("uuid()"),
        "project_id": F.lit(run.project_id),
        "pipeline": F.lit(run.pipeline),
        "layer": F.lit(run.layer),
        "frequency": F.lit(run.frequency),
        "reference_date": F.lit(run.reference_date),
        "ingested_at": F.lit(run_at.isoformat(sep=" ")).cast("timestamp"),
        LOG_DATE: F.lit(run_at.date()),
    }
    columns = []
    for field in LOG_SCHEMA:
        if field.name in shared:
            value = shared[field.name]
        elif field.name in outcomes.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return outcomes.select(*columns)


def write_log(rows: DataFrame, path: str) -> bool:
    """Append log rows by log day. A failure is logged and never stops the run."""
    try:
        rows.repartition(1).write.mode("append").partitionBy(LOG_DATE).parquet(path)
        return True
    except Exception:
        logger.exception("ingestion log not written to %s", path)
        return False


def run_entities(
    spark: SparkSession,
    entities: Iterable[str],
    load: Callable[[str], int],
    fail_fast: bool = False,
) -> DataFrame:
    """Load entities one after the other; each load is a Spark job of its own.

    An entity that fails is recorded and the others go on, unless ``fail_fast``.
    Returns one outcome row per entity.
    """
    outcomes = []
    for entity in entities:
        try:
            outcomes.append((entity, load(entity), SUCCESS, None))
        except Exception as error:
            if fail_fast:
                raise
            logger.error("entity %s failed: %s", entity, error)
            outcomes.append((entity, 0, FAILURE, str(error)))
    return spark.createDataFrame(
        outcomes, "entity string, record_count bigint, status string, error_message string"
    )


def failures(log: DataFrame) -> DataFrame:
    """Failure audit: log rows of failed entities."""
    return log.where(F.col("status") == FAILURE)


def run_summary(log: DataFrame, run_keys: list[str]) -> DataFrame:
    """Status of each run: total records, failed entities, overall outcome.

    The list holds entities of one run, a configured and small set.
    """
    failed = F.col("status") == FAILURE
    return (
        log.groupBy(*run_keys)
        .agg(
            F.sum(F.coalesce("record_count", F.lit(0))).alias("total_records"),
            F.array_sort(F.collect_set(F.when(failed, F.col("entity")))).alias("failed_entities"),
            F.bool_or(failed).alias("any_failed"),
        )
        .withColumn("outcome", F.when(F.col("any_failed"), "partial failure").otherwise("ok"))
        .drop("any_failed")
    )


def record_counts(rows: DataFrame, entity: str) -> DataFrame:
    """Rows per entity and, with a null entity, of the whole run."""
    return rows.rollup(entity).agg(F.count(F.lit(1)).alias("record_count"))
