"""Landing, raw tables, envelopes, spines and retention."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from finlake.functions import dates, payload as P
from finlake.operators import spine
from finlake.plans import models
from finlake.plans.spec import build
from finlake.session import job_dir
from finlake.sources import envelopes, landing, raw
from workloads import standins as S

RUN_AT = datetime(2024, 2, 5, 3, 30)

def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landing records of the entity of their type, some lines padded or blank."""
    events = S.read(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("value")))
    padded = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit(" \t"), line, F.lit(" \t"))).otherwise(line)
    lines = F.when(F.col("user_id") % 10 == 0, F.array(padded, F.lit(" \t "))).otherwise(F.array(padded))
    records = events.select("ts", F.col("event_type").alias(landing.ENTITY), F.explode(lines).alias("payload"))
    return landing.with_path_parts(records, "ts")


def event_span(spark: SparkSession, sf_dir: str) -> tuple[date, date, list[str]]:
    """First and last day of the events and their types, one endpoint each.

    An empty table has one endpoint, without files.
    """
    events = S.read(spark, sf_dir, "events")
    day = F.to_date("ts")
    found = events.agg(F.min(day), F.max(day), F.sort_array(F.collect_set("event_type"))).first()
    return found[0] or RUN_AT.date(), found[1] or RUN_AT.date(), found[2] or ["events"]


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    """Landing area with all events, written for this call."""
    root = job_dir(spark, "landing")
    landing.write(event_records(spark, sf_dir), root)
    return root


def _values(rows: DataFrame, *others: Column | str) -> DataFrame:
    doc = rows.select("*", P.parse("payload").alias("doc"))
    return doc.select(
        P.scalar("doc", "$.event_id").cast("bigint").alias("event_id"),
        P.scalar("doc", "$.user_id").cast("bigint").alias("user_id"),
        P.scalar("doc", "$.value").cast("decimal(18,2)").cast("double").alias("value"),
        *others,
    )


_EVENT = "event_id, user_id, value"
_PARTS = """strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day"""


def landing_range_scan(spark, sf_dir):
    rows = landing.scan(spark, landed_events(spark, sf_dir), date(2024, 1, 5), date(2024, 1, 24))
    from_jsonl = F.col("_source_file").endswith(".jsonl").alias("from_jsonl")
    return _values(rows, landing.ENTITY, "year", "month", "day", from_jsonl)


LANDING_RANGE_SCAN = f"""
SELECT {_EVENT}, event_type AS entity, {_PARTS}, true AS from_jsonl
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'
"""


def landing_endpoint_scan(spark, sf_dir):
    rows = landing.scan(spark, landed_events(spark, sf_dir), date(2024, 1, 10))
    wrapped = raw.wrap(rows, RUN_AT, landing.ENTITY)
    return _values(wrapped, raw.ENDPOINT)


LANDING_ENDPOINT_SCAN = f"""
SELECT {_EVENT}, event_type AS endpoint_name FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
"""


def landing_absent_partition(spark, sf_dir):
    """An absent day and an absent entity give no rows and no error."""
    root = landed_events(spark, sf_dir)
    present = landing.scan(spark, root, date(2024, 1, 12), entities=["view"])
    absent_day = landing.scan(spark, root, date(1999, 1, 1), entities=["view"])
    absent_entity = landing.scan(spark, root, date(2024, 1, 12), entities=["editais"])
    return _values(present.unionByName(absent_day).unionByName(absent_entity))


LANDING_ABSENT_PARTITION = f"""
SELECT {_EVENT} FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12' AND event_type = 'view'
"""


def landing_roundtrip(spark, sf_dir):
    """Land everything twice; the second run replaces the files of the first."""
    root = job_dir(spark, "roundtrip")
    for _ in range(2):
        landing.write(event_records(spark, sf_dir), root)
    first, last, _ = event_span(spark, sf_dir)
    return _values(landing.scan(spark, root, first, last), landing.ENTITY, "year", "month", "day")


LANDING_ROUNDTRIP = f"SELECT {_EVENT}, event_type AS entity, {_PARTS} FROM events"


def raw_wrap(spark, sf_dir):
    first, last, _ = event_span(spark, sf_dir)
    rows = landing.scan(spark, landed_events(spark, sf_dir), first, last)
    path = job_dir(spark, "raw")
    raw.append(raw.wrap(rows, RUN_AT, landing.ENTITY), path)
    stored = raw.read(spark, path, multiplexed=True)
    return S.flat(_values(stored, raw.ENDPOINT, "_ingested_at", "_load_date"))


RAW_WRAP = f"""
SELECT {_EVENT}, event_type AS endpoint_name, '2024-02-05 03:30:00.000000' AS _ingested_at,
       '2024-02-05' AS _load_date
FROM events
"""


def raw_append_replay(spark, sf_dir):
    """The same day loaded twice leaves duplicates in raw and none in trusted."""
    path = job_dir(spark, "raw-replay")
    trades = S.raw_trades(spark, sf_dir)
    raw.append(trades, path)
    raw.append(trades, path)
    twice = raw.read(spark, path)
    return S.flat(build(twice, models.TRADES, RUN_AT).drop("_insert_date"))


RAW_APPEND_REPLAY = f"{S.with_ctes(S.TRADES_SQL)} SELECT * EXCLUDE (load_date) FROM trades"


def raw_trades_table(spark: SparkSession, sf_dir: str) -> str:
    path = job_dir(spark, "raw-trades")
    raw.append(S.raw_trades(spark, sf_dir), path)
    return path


def partition_prune(spark, sf_dir):
    rows = raw.since(raw.read(spark, raw_trades_table(spark, sf_dir)), date(2024, 1, 25))
    return S.flat(rows.groupBy("_load_date").agg(F.count(F.lit(1)).alias("n_records")))


PARTITION_PRUNE = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT CAST(load_date AS VARCHAR) AS _load_date, count(*) AS n_records
FROM trade_rows WHERE load_date >= DATE '2024-01-23' GROUP BY load_date
"""


def retention_expire(spark, sf_dir):
    """Drop the folders older than 90 days, then read what is left."""
    path = raw_trades_table(spark, sf_dir)
    raw.expire(spark, path, date(2024, 4, 10))
    rows = raw.read(spark, path)
    return S.flat(rows.groupBy("_load_date").agg(F.count(F.lit(1)).alias("n_records")))


RETENTION_EXPIRE = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT CAST(load_date AS VARCHAR) AS _load_date, count(*) AS n_records
FROM trade_rows WHERE load_date >= DATE '2024-04-10' - 90 GROUP BY load_date
"""


def union_endpoints(spark, sf_dir):
    """Raw rows of each endpoint's own scan, united into one table."""
    root = landed_events(spark, sf_dir)
    first, last, names = event_span(spark, sf_dir)
    scans = [landing.scan(spark, root, first, last, entities=[name]) for name in names]
    wrapped = [raw.wrap(rows, RUN_AT, F.lit(name)) for name, rows in zip(names, scans)]
    return _values(reduce(DataFrame.unionByName, wrapped), raw.ENDPOINT)


UNION_ENDPOINTS = f"SELECT {_EVENT}, event_type AS endpoint_name FROM events"


# -- envelopes ---------------------------------------------------------------------------


def _pages(rows: DataFrame, number: str, members: Column, size: int = 100) -> DataFrame:
    """Records packed into arrays of at most ``size``; the number is unique."""
    page_no = F.floor(F.col(number) / size).alias("page_no")
    return rows.groupBy(page_no).agg(F.concat_ws(",", F.collect_list(F.to_json(members))).alias("items"))


def envelope_value(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders")
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("câmbio "), "o_orderpriority").alias("nome"),
        S.money("o_totalprice").alias("valor"),
    )
    pages = _pages(orders, "o_orderkey", record).select(
        F.concat(F.lit('{"@context":"x","value":['), "items", F.lit("]}")).alias("page")
    )
    empty = orders.groupBy("o_orderstatus").agg(F.lit('{"value":[]}').alias("page")).select("page")
    records = envelopes.value_records(pages.unionByName(empty))
    doc = records.select(P.parse("payload").alias("doc"))
    return doc.select(
        P.scalar("doc", "$.id").cast("bigint").alias("id"),
        P.scalar("doc", "$.nome").alias("nome"),
        P.scalar("doc", "$.valor").cast("decimal(18,2)").cast("double").alias("valor"),
    )


ENVELOPE_VALUE = """
SELECT o_orderkey AS id, 'câmbio ' || o_orderpriority AS nome, o_totalprice AS valor FROM orders
"""


def envelope_registros(spark, sf_dir):
    """Responses with another status are left out and listed apart."""
    events = S.read(spark, sf_dir, "events")
    record = F.struct("event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("value"))
    pages = _pages(events, "event_id", record).select(
        F.concat(
            F.lit('{"status":"'),
            F.when(F.col("page_no") % 7 == 6, "erro").otherwise("ok"),
            F.lit('","registros":['),
            "items",
            F.lit("]}"),
        ).alias("page")
    )
    good = _values(envelopes.status_records(pages, fail_fast=False), F.lit("ok").alias("status"))
    bad = envelopes.rejected_pages(pages)
    lost = envelopes.status_records(
        bad.select(F.regexp_replace("page", '"erro"', '"ok"').alias("page")), fail_fast=True
    )
    return good.unionByName(_values(lost, F.lit("erro").alias("status")))


ENVELOPE_REGISTROS = f"""
SELECT {_EVENT}, CASE WHEN event_id // 100 % 7 = 6 THEN 'erro' ELSE 'ok' END AS status FROM events
"""


def stream_messages(events: DataFrame) -> DataFrame:
    """Messages in all shapes: wrapped, bare, without symbol, truncated."""
    trade = F.to_json(
        F.struct(
            F.col("event_id").alias("t"),
            F.when(F.col("event_id") % 5 != 0, F.concat(F.upper("event_type"), F.lit("BRL"))).alias("s"),
            F.col("user_id").alias("u"),
        )
    )
    wrapped = F.concat(F.lit('{"stream":"x@trade","data":'), trade, F.lit("}"))
    message = (
        F.when(F.col("value") < 5, F.expr("left(event_type, 3) || '{'"))
        .when(F.col("event_id") % 2 == 0, wrapped)
        .otherwise(trade)
    )
    return events.select(message.alias("message"))


def stream_unwrap(spark, sf_dir):
    messages = stream_messages(S.read(spark, sf_dir, "events"))
    trades = envelopes.unwrap_messages(messages).select("symbol", P.parse("payload").alias("doc"))
    lost = envelopes.unreadable_messages(messages)
    return trades.select(
        P.scalar("doc", "$.t").cast("bigint").alias("trade_id"), "symbol", F.lit(True).alias("readable")
    ).unionByName(
        lost.select(
            F.lit(None).cast("bigint").alias("trade_id"),
            F.col("message").alias("symbol"),
            F.lit(False).alias("readable"),
        )
    )


STREAM_SYMBOL = "CASE WHEN event_id % 5 <> 0 THEN event_type || 'brl' ELSE 'unknown' END"

STREAM_UNWRAP = f"""
SELECT event_id AS trade_id, {STREAM_SYMBOL} AS symbol, true AS readable FROM events WHERE value >= 5
UNION ALL
SELECT NULL, left(event_type, 3) || '{{', false FROM events WHERE value < 5
"""

# -- spines and slices ---------------------------------------------------------------------


def month_spine(spark, sf_dir):
    bounds = (
        S.read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    )
    return S.flat(spine.month_spine(bounds, "start", "end").select("o_custkey", "month"))


MONTH_SPINE = """
WITH bounds AS (
    SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b
    FROM orders GROUP BY o_custkey)
SELECT o_custkey, strftime(unnest(generate_series(a, b, INTERVAL 1 MONTH)), '%Y-%m-%d') AS month FROM bounds
"""


def year_spine(spark, sf_dir):
    runs = S.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    full = F.col("o_orderstatus") == "F"
    years = spine.year_spine(runs, "o_orderdate", full, first_year=1993)
    return S.flat(years.select("o_orderkey", "ref_year"))


YEAR_SPINE = """
SELECT o_orderkey, unnest(generate_series(
    CASE WHEN o_orderstatus = 'F' THEN 1993 ELSE year(o_orderdate) END, year(o_orderdate))) AS ref_year
FROM orders
"""


def reference_dates(spark, sf_dir):
    days = S.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    frequencies = F.array(F.lit("monthly"), F.lit("quarterly"), F.lit("daily"))
    runs = days.select("run_date", F.explode(frequencies).alias("frequency"))
    run_date, frequency = F.col("run_date"), F.col("frequency")
    return S.flat(
        runs.select(
            "run_date",
            "frequency",
            dates.reporting_date(run_date, frequency).alias("reference_date"),
            dates.reporting_date(run_date, frequency, conservative=True).alias("conservative_date"),
        )
    )


REFERENCE_DATES = """
WITH runs AS (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, frequency
    FROM orders, (VALUES ('monthly'), ('quarterly'), ('daily')) AS f(frequency))
SELECT CAST(d AS VARCHAR) AS run_date, frequency,
       strftime(CASE frequency WHEN 'quarterly' THEN date_trunc('quarter', d) - INTERVAL 3 MONTH - INTERVAL 1 DAY
            ELSE date_trunc('month', d) - INTERVAL 1 DAY END, '%Y-%m-%d') AS reference_date,
       strftime(CASE frequency WHEN 'quarterly' THEN date_trunc('quarter', d) - INTERVAL 3 MONTH - INTERVAL 1 DAY
            ELSE date_trunc('month', d) - INTERVAL 1 MONTH - INTERVAL 1 DAY END, '%Y-%m-%d') AS conservative_date
FROM runs
"""


def period_filter(spark, sf_dir):
    orders = S.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    by_month = spine.in_period(orders, "o_orderdate", date(1997, 5, 31))
    by_day = spine.in_period(orders, "o_orderdate", date(1998, 3, 5), "yyyy-MM-dd")
    return S.flat(by_month.unionByName(by_day))


PERIOD_FILTER = f"""
SELECT o_orderkey, {S.moment('o_orderdate')} AS o_orderdate FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1997-05' OR CAST(o_orderdate AS DATE) = DATE '1998-03-05'
"""


def slice_union(spark, sf_dir):
    customers = S.read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.element_at(F.array(F.lit("I"), F.lit("C"), F.lit("X")), (F.col("c_custkey") % 3 + 1).cast("int"))
        .alias("td"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("S"), F.col("c_nationkey") % 6 + 1)
        ).alias("sr"),
    )
    return spine.in_slices(customers, "td", "sr")


SLICE_UNION = """
WITH c AS (
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'C' ELSE 'X' END AS td,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'S' || (c_nationkey % 6 + 1) END AS sr FROM customer)
SELECT * FROM c WHERE td = 'I' AND sr IN ('S1', 'S2', 'S3', 'S4', 'S5')
UNION ALL SELECT * FROM c WHERE td = 'C' AND sr IN ('S1', 'S2', 'S3', 'S4', 'S5')
"""


def gap_guard(spark, sf_dir):
    """Runs of unanswered months per bond kind, and which kinds fail the guard."""
    orders = S.read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("kind"),
    )
    months = F.year("month") * 12 + F.month("month")
    answers = orders.withColumn("answered", (months * (F.col("kind") + 2)) % 11 < 8 - F.col("kind"))
    bounds = orders.groupBy("entity").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    expected = spine.month_spine(bounds, "a", "b").select("entity", "month")
    status = spine.month_status(expected, answers, "entity", "month")
    runs = spine.gap_runs(status, "entity", "month", date(2001, 8, 15))
    down = spine.incomplete_entities(runs, "entity")
    failing = runs.join(down, "entity", "left").select(
        *runs.columns, F.col("longest_run").isNotNull().alias("entity_fails")
    )
    return S.flat(failing)


GAP_GUARD = """
WITH o AS (
    SELECT o_orderpriority AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           CAST(left(o_orderpriority, 1) AS INT) AS kind FROM orders),
tries AS (
    SELECT entity, month, bool_or(((year(month) * 12 + month(month)) * (kind + 2)) % 11 < 8 - kind) AS answered
    FROM o GROUP BY entity, month),
bounds AS (SELECT entity, min(month) AS a, max(month) AS b FROM o GROUP BY entity),
expected AS (
    SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds),
status AS (
    SELECT entity, month, coalesce(answered, false) AS answered
    FROM expected LEFT JOIN tries USING (entity, month)),
islands AS (
    SELECT *, count(*) FILTER (answered) OVER (PARTITION BY entity ORDER BY month) AS run FROM status),
runs AS (
    SELECT entity, run, count(*) FILTER (DATE '2001-08-15' - month > 90) AS old_gaps,
           CAST(min(month) AS VARCHAR) AS first_gap, CAST(max(month) AS VARCHAR) AS last_gap
    FROM islands WHERE NOT answered GROUP BY entity, run)
SELECT *, max(old_gaps) OVER (PARTITION BY entity) >= 3 AS entity_fails FROM runs
"""


def missing_periods(spark, sf_dir):
    """Months between a customer's first and last order without any order."""
    orders = S.read(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")
    )
    bounds = orders.groupBy("o_custkey").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    expected = spine.month_spine(bounds, "a", "b").select("o_custkey", "month")
    return S.flat(spine.missing_months(expected, orders, "o_custkey", "month"))


MISSING_PERIODS = """
WITH o AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS m FROM orders),
b AS (SELECT o_custkey, min(m) AS a, max(m) AS z FROM o GROUP BY o_custkey),
e AS (SELECT o_custkey, unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS m FROM b)
SELECT e.o_custkey, strftime(e.m, '%Y-%m-%d') AS month FROM e ANTI JOIN o ON e.o_custkey = o.o_custkey AND e.m = o.m
"""

QUERIES = {
    "landing_range_scan": (landing_range_scan, LANDING_RANGE_SCAN),
    "landing_endpoint_scan": (landing_endpoint_scan, LANDING_ENDPOINT_SCAN),
    "landing_absent_partition": (landing_absent_partition, LANDING_ABSENT_PARTITION),
    "landing_roundtrip": (landing_roundtrip, LANDING_ROUNDTRIP),
    "raw_wrap": (raw_wrap, RAW_WRAP),
    "raw_append_replay": (raw_append_replay, RAW_APPEND_REPLAY),
    "partition_prune": (partition_prune, PARTITION_PRUNE),
    "retention_expire": (retention_expire, RETENTION_EXPIRE),
    "union_endpoints": (union_endpoints, UNION_ENDPOINTS),
    "envelope_value": (envelope_value, ENVELOPE_VALUE),
    "envelope_registros": (envelope_registros, ENVELOPE_REGISTROS),
    "stream_unwrap": (stream_unwrap, STREAM_UNWRAP),
    "month_spine": (month_spine, MONTH_SPINE),
    "year_spine": (year_spine, YEAR_SPINE),
    "reference_dates": (reference_dates, REFERENCE_DATES),
    "period_filter": (period_filter, PERIOD_FILTER),
    "slice_union": (slice_union, SLICE_UNION),
    "gap_guard": (gap_guard, GAP_GUARD),
    "missing_periods": (missing_periods, MISSING_PERIODS),
}
