"""From landing to raw, entity by entity, with one log row each."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from finlake.operators import audit
from finlake.sources import landing, raw


def load_entities(
    spark: SparkSession,
    entities: Iterable[str],
    landing_root: str,
    raw_path: str,
    start: date,
    end: date,
    run: audit.Run,
    run_at: datetime,
    log_path: str,
    hourly: bool = False,
    fail_fast: bool = False,
    fail_empty: bool = False,
) -> DataFrame:
    """Append each entity's landed records to raw and log how many there were.

    Counts come from the appending pass itself. An entity that fails, or with ``fail_empty`` has
    nothing landed, is logged as failed and the others go on, unless ``fail_fast``. Returns the
    outcomes as logged.
    """

    def load(entity: str) -> int:
        rows = landing.scan(spark, landing_root, start, end, entities=[entity], hourly=hourly)
        if fail_empty and rows.isEmpty():
            raise ValueError(f"nothing landed from {start} to {end}")
        return raw.append(raw.wrap(rows, run_at, landing.ENTITY), raw_path)["total"]

    outcomes = audit.run_entities(spark, entities, load, fail_fast).withColumns(
        {
            "blob_path": F.concat(F.lit(f"{landing_root}/{landing.ENTITY}="), "entity"),
            "bq_table": F.lit(raw_path),
        }
    )
    audit.write_log(audit.log_rows(outcomes, run, run_at), log_path)
    return outcomes
