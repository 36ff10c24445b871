"""Merge, quality checks, audit and streams."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from finlake.functions import payload as P
from finlake.operators import audit, quality
from finlake.operators.latest import latest
from finlake.operators.merge import upsert
from finlake.plans import models
from finlake.plans.tables import Lake
from finlake.session import job_dir
from finlake.sources import landing, raw, versions
from finlake.streaming import trades as stream
from workloads import standins as S
from workloads.landing import STREAM_SYMBOL, stream_messages

RUN_AT = datetime(2024, 6, 1)

# -- merge -----------------------------------------------------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]
_NEWEST = [F.desc, ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]


def _latest_lines(lines: DataFrame) -> DataFrame:
    order, names = _NEWEST
    return latest(lines, _LINE_KEY, [order(name) for name in names])


def merge_first_build(spark, sf_dir):
    """Full build into an empty table, through the table's merge path."""
    lake = Lake(spark, job_dir(spark, "lake"), buckets=8)
    raw.append(S.raw_trades(spark, sf_dir), lake.path("raw", models.TRADES.source))
    lake.refresh(models.TRADES, RUN_AT)
    return S.flat(lake.trusted(models.TRADES).drop("_insert_date"))


MERGE_FIRST_BUILD = f"{S.with_ctes(S.TRADES_SQL)} SELECT * EXCLUDE (load_date) FROM trades"


def merge_upsert(spark, sf_dir):
    """Lines shipped before a date, upserted by those shipped since."""
    lines = S.read(spark, sf_dir, "lineitem")
    since = F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")
    merged = upsert(_latest_lines(lines.where(~since)), _latest_lines(lines.where(since)), _LINE_KEY)
    return S.flat(merged)


MERGE_UPSERT = f"""
WITH ranked AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate >= TIMESTAMP '1998-06-01'
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n
    FROM lineitem),
old AS (SELECT * EXCLUDE (n) FROM ranked WHERE n = 1 AND l_shipdate < TIMESTAMP '1998-06-01'),
new AS (SELECT * EXCLUDE (n) FROM ranked WHERE n = 1 AND l_shipdate >= TIMESTAMP '1998-06-01'),
merged AS (
    SELECT * FROM new UNION ALL
    SELECT old.* FROM old ANTI JOIN new ON old.l_orderkey = new.l_orderkey AND old.l_linenumber = new.l_linenumber)
SELECT * REPLACE ({S.moment('l_shipdate')} AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber)
FROM merged
"""


def merge_null_keys(spark, sf_dir):
    """Null keys: equal to each other, or, as in plain SQL, equal to nothing."""
    kind = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = S.read(spark, sf_dir, "orders").select(
        "o_custkey", kind.alias("kind"), "o_orderkey", "o_orderdate"
    )
    keys = ["o_custkey", "kind"]
    target = orders.groupBy(*keys).agg(F.min("o_orderkey").alias("v"))
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    batch = orders.where(late).groupBy(*keys).agg(F.max("o_orderkey").alias("v"))
    safe = upsert(target, batch, keys).withColumn("null_safe", F.lit(True))
    plain = upsert(target, batch, keys, null_safe=False).withColumn("null_safe", F.lit(False))
    return safe.unionByName(plain)


MERGE_NULL_KEYS = """
WITH o AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS kind, o_orderkey, o_orderdate FROM orders),
t AS (SELECT o_custkey, kind, min(o_orderkey) AS v FROM o GROUP BY ALL),
b AS (SELECT o_custkey, kind, max(o_orderkey) AS v FROM o WHERE o_orderdate >= TIMESTAMP '1999-01-01'
      GROUP BY o_custkey, kind)
SELECT *, true AS null_safe FROM b UNION ALL SELECT *, false FROM b UNION ALL
SELECT t.*, true FROM t ANTI JOIN b ON t.o_custkey = b.o_custkey AND t.kind IS NOT DISTINCT FROM b.kind UNION ALL
SELECT t.*, false FROM t ANTI JOIN b ON t.o_custkey = b.o_custkey AND t.kind = b.kind
"""


def late_data_replay(spark, sf_dir):
    """First half built, the rest loaded later and merged from a start date."""
    lake = Lake(spark, job_dir(spark, "lake"), buckets=8)
    path = lake.path("raw", models.TRADES.source)
    rows = S.raw_trades(spark, sf_dir)
    early = F.col("_load_date") <= F.lit(date(2024, 1, 16))
    raw.append(rows.where(early), path)
    lake.refresh(models.TRADES, RUN_AT)
    raw.append(rows.where(~early), path)
    lake.refresh(models.TRADES, RUN_AT, start_date=date(2024, 1, 15))
    return S.flat(lake.trusted(models.TRADES).drop("_insert_date"))


LATE_DATA_REPLAY = MERGE_FIRST_BUILD

# -- quality and audit ----------------------------------------------------------------------


def dq_not_null(spark, sf_dir):
    rows = S.auctions(spark, sf_dir)
    return quality.null_counts(rows, list(rows.columns))


_CHECKED = (
    "num_edital titulo benchmark tipo_leilao data_vencimento data_leilao data_liquidacao "
    "data_liquidacao_segunda_volta qtd_oferta qtd_oferta_segunda_volta qtd_aceita "
    "qtd_aceita_segunda_volta qtd_bcb pct_taxa_media pct_taxa_maxima pu_medio pu_minimo "
    "financeiro_aceito financeiro_aceito_segunda_volta financeiro_bcb"
).split()

DQ_NOT_NULL = (
    S.with_ctes(S.AUCTIONS_SQL)
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS failures FROM res" for c in _CHECKED
    )
)


def dq_unique(spark, sf_dir):
    return quality.duplicate_keys(S.read(spark, sf_dir, "lineitem"), ["l_orderkey"])


DQ_UNIQUE = "SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1"


def dq_unique_combo(spark, sf_dir):
    found = quality.duplicate_keys(S.read(spark, sf_dir, "lineitem"), _LINE_KEY)
    return S.flat(found)


DQ_UNIQUE_COMBO = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def dq_report(spark, sf_dir):
    """All checks of the auction results at once."""
    return quality.run_checks(S.auctions(spark, sf_dir), models.RESULTS.checks)


DQ_REPORT = (
    S.with_ctes(S.AUCTIONS_SQL)
    + " "
    + " UNION ALL ".join(
        f"SELECT 'not_null:{c}' AS check_name, count(*) - count({c}) AS failures FROM res"
        for c in ("num_edital", "titulo", "data_vencimento", "data_leilao")
    )
    + """ UNION ALL SELECT 'unique:num_edital', count(*) FROM
    (SELECT num_edital FROM res WHERE num_edital IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
)


def record_counts(spark, sf_dir):
    rows = S.read(spark, sf_dir, "events").withColumnRenamed("event_type", "endpoint_name")
    return audit.record_counts(rows, "endpoint_name")


RECORD_COUNTS = """
SELECT event_type AS endpoint_name, count(*) AS record_count FROM events GROUP BY ROLLUP (event_type)
"""


def _log(spark, sf_dir) -> DataFrame:
    """Outcomes of one load per event type and day; expensive days count as failed."""
    loads = (
        S.read(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("entity"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    )
    failed = F.month("day") * 31 + F.dayofmonth("day") + F.length("entity")
    outcomes = loads.select(
        "entity",
        "day",
        F.when(failed % 7 == 0, 0).otherwise(F.col("n")).cast("bigint").alias("record_count"),
        F.when(failed % 7 == 0, audit.FAILURE).otherwise(audit.SUCCESS).alias("status"),
        F.when(failed % 7 == 0, F.concat(F.lit("timeout on "), "day")).alias("error_message"),
        F.concat_ws("/", F.lit("landing"), "entity", F.col("day").cast("string")).alias("blob_path"),
    )
    run = audit.Run("lake", "market", "landing", date(2024, 5, 31), "daily")
    return audit.log_rows(outcomes, run, RUN_AT)


def audit_log(spark, sf_dir):
    """Log written and read back, without its random ids and clock times."""
    path = job_dir(spark, "log")
    audit.write_log(_log(spark, sf_dir), path)
    log = spark.read.schema(audit.LOG_SCHEMA).parquet(path)
    return S.flat(log.drop("log_id", "ingested_at"))


_LOADS_CTE = """
loads AS (
    SELECT CAST(ts AS DATE) AS day, event_type AS entity, count(*) AS n,
           (month(CAST(ts AS DATE)) * 31 + day(CAST(ts AS DATE)) + length(event_type)) % 7 = 0 AS failed
    FROM events GROUP BY ALL)"""

AUDIT_LOG = f"""
{S.with_ctes(_LOADS_CTE)}
SELECT 'lake' AS project_id, 'market' AS pipeline, 'landing' AS layer, entity, 'daily' AS frequency,
       '2024-05-31' AS reference_date, CASE WHEN failed THEN 0 ELSE n END AS record_count,
       'landing/' || entity || '/' || CAST(day AS VARCHAR) AS blob_path, CAST(NULL AS VARCHAR) AS bq_table,
       CASE WHEN failed THEN 'failure' ELSE 'success' END AS status,
       CASE WHEN failed THEN 'timeout on ' || CAST(day AS VARCHAR) END AS error_message,
       '2024-06-01' AS _log_date
FROM loads
"""


def audit_failures(spark, sf_dir):
    log = _log(spark, sf_dir)
    return audit.failures(log).select("entity", "blob_path", "error_message")


AUDIT_FAILURES = f"""
{S.with_ctes(_LOADS_CTE)}
SELECT entity, 'landing/' || entity || '/' || CAST(day AS VARCHAR) AS blob_path,
       'timeout on ' || CAST(day AS VARCHAR) AS error_message
FROM loads WHERE failed
"""


def run_status(spark, sf_dir):
    """One run per day: totals, failed entities, outcome."""
    log = _log(spark, sf_dir).withColumn("run_day", F.element_at(F.split("blob_path", "/"), 3))
    status = audit.run_summary(log, ["run_day"])
    return status.withColumn("failed_entities", F.concat_ws(",", "failed_entities"))


RUN_STATUS = f"""
{S.with_ctes(_LOADS_CTE)}
SELECT CAST(day AS VARCHAR) AS run_day,
       CAST(sum(CASE WHEN failed THEN 0 ELSE n END) AS BIGINT) AS total_records,
       coalesce(string_agg(entity, ',' ORDER BY entity) FILTER (failed), '') AS failed_entities,
       CASE WHEN bool_or(failed) THEN 'partial failure' ELSE 'ok' END AS outcome
FROM loads GROUP BY day
"""

# -- streams --------------------------------------------------------------------------------


def _as_files(rows: DataFrame, path: str, key: str, files: int = 4) -> str:
    """Rows in several files, so that a stream takes them in several batches; small row groups, so that tasks share one."""
    rows.repartition(files, key).write.option("parquet.block.size", 8 << 20).parquet(path)
    return path


# Input files in place of one, written by as many tasks.
SPREAD = 16


def stream_landing_hourly(spark, sf_dir):
    """Messages streamed to landing files by symbol and hour, then scanned."""
    work = job_dir(spark, "stream-landing")
    events = S.read(spark, sf_dir, "events")
    stream_messages(events.repartition(4 * SPREAD, "event_id")).write.text(f"{work}/in")
    messages = stream.read_messages(spark, f"{work}/in", files_per_batch=2 * SPREAD)
    query = stream.start_landing(messages, f"{work}/landing", f"{work}/checkpoint", drain=True)
    query.awaitTermination()
    today = F.current_date()
    landed = spark.read.schema("value string, entity string, year string, month string, day string, hour string")
    rows = landed.text(f"{work}/landing")
    arrived = F.make_date(*(F.col(c).cast("int") for c in ("year", "month", "day")))
    doc = rows.select("*", P.parse("value").alias("doc"))
    return doc.select(
        P.scalar("doc", "$.t").cast("bigint").alias("trade_id"),
        landing.ENTITY,
        (F.datediff(today, arrived) <= 1).alias("filed_by_arrival"),
    )


STREAM_LANDING_HOURLY = f"""
SELECT event_id AS trade_id, {STREAM_SYMBOL} || '_trades' AS entity, true AS filed_by_arrival
FROM events WHERE value >= 5
"""


def stream_hour_window(spark, sf_dir):
    work = job_dir(spark, "stream-hours")
    events = S.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"), "event_type")
    path = _as_files(events, f"{work}/in", "event_id")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(path)
    query = stream.start_hourly_counts(
        arriving, "ts", "event_type", f"{work}/hours", f"{work}/checkpoint", lateness="60 days"
    )
    query.awaitTermination()
    hours = versions.read(spark, f"{work}/hours")
    return S.flat(hours.select("hour_start", "event_type", "n_trades"))


STREAM_HOUR_WINDOW = f"""
SELECT {S.moment("date_trunc('hour', ts)")} AS hour_start, event_type, count(*) AS n_trades
FROM events GROUP BY ALL
"""


def stream_merge_latest(spark, sf_dir):
    """Raw rows streamed in arbitrary order; the latest record of each trade stays."""
    work = job_dir(spark, "stream-merge")
    rows = S.raw_trades(spark, sf_dir)
    path = _as_files(rows, f"{work}/in", "payload", files=2)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = stream.start_merge(
        arriving, models.TRADES, f"{work}/trades", f"{work}/checkpoint", RUN_AT
    )
    query.awaitTermination()
    merged = versions.read(spark, f"{work}/trades")
    return S.flat(merged.select(*(field.name for field in models.TRADES.fields)))


STREAM_MERGE_LATEST = MERGE_FIRST_BUILD

QUERIES = {
    "merge_first_build": (merge_first_build, MERGE_FIRST_BUILD),
    "merge_upsert": (merge_upsert, MERGE_UPSERT),
    "merge_null_keys": (merge_null_keys, MERGE_NULL_KEYS),
    "late_data_replay": (late_data_replay, LATE_DATA_REPLAY),
    "dq_not_null": (dq_not_null, DQ_NOT_NULL),
    "dq_unique": (dq_unique, DQ_UNIQUE),
    "dq_unique_combo": (dq_unique_combo, DQ_UNIQUE_COMBO),
    "dq_report": (dq_report, DQ_REPORT),
    "record_counts": (record_counts, RECORD_COUNTS),
    "audit_log": (audit_log, AUDIT_LOG),
    "audit_failures": (audit_failures, AUDIT_FAILURES),
    "run_status": (run_status, RUN_STATUS),
    "stream_landing_hourly": (stream_landing_hourly, STREAM_LANDING_HOURLY),
    "stream_hour_window": (stream_hour_window, STREAM_HOUR_WINDOW),
    "stream_merge_latest": (stream_merge_latest, STREAM_MERGE_LATEST),
}
