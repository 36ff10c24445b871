"""Storage: interrupted writes, touched partitions, quarantine, views, exactly-once streams."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from finlake.functions import payload as P
from finlake.operators import audit, spine
from finlake.operators.merge import merge_into, month_of_key, range_layout, range_of_key
from finlake.plans import loading as entity_loads, models, refined
from finlake.plans.tables import Lake, qualified
from finlake.session import job_dir
from finlake.sources import files, landing, raw, versions
from finlake.streaming import trades as stream
from workloads import standins as S
from workloads.landing import event_records, event_span, landed_events, stream_messages
from workloads.loading import RUN_AT
from workloads.refined import BUCKET_ROWS, STRESS_AUCTIONS, SUMMARY_BY_TITLE, _auctions, _calendar, _periods, stored
from workloads.trusted import raw_auctions

_SINCE = "1998-06-01"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    orders = S.read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", day.alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    return orders.withColumn("_month", month_of_key("day"))


def _merge_orders(spark: SparkSession, rows: DataFrame, path: str):
    return merge_into(spark, path, rows, ["o_orderkey", "day"], "_month", key_fixes_partition=True)


def merge_after_cuts(spark, sf_dir):
    """A first build and a later merge, each cut before it was published, then done again.

    What the cut runs wrote is in the table's folder, but in no manifest.
    """
    path, orders = job_dir(spark, "orders"), _orders(spark, sf_dir)
    odd = orders.where("o_orderkey % 2 = 1")
    versions.write(odd, path, "_month")
    files.write_text(spark, f"{path}/{versions.MANIFESTS}/{1:012d}", '{"number": 1, "partition"')
    _merge_orders(spark, odd, path)
    late = orders.where(F.col("day") >= F.lit(_SINCE).cast("date")).withColumn(
        "price", (F.col("price") + 1).cast("decimal(18,2)")
    )
    versions.write(late.where("o_custkey % 2 = 0"), path, "_month")
    _merge_orders(spark, late, path)
    return S.flat(versions.read(spark, path).drop("_month"))


MERGE_AFTER_CUTS = f"""
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderdate >= TIMESTAMP '{_SINCE}' THEN 1 ELSE 0 END
            AS DOUBLE) AS price
FROM orders WHERE o_orderkey % 2 = 1 OR o_orderdate >= TIMESTAMP '{_SINCE}'
"""


def merge_touched(spark, sf_dir):
    """How many monthly partitions a batch of recent orders writes, and how many there are."""
    path, orders = job_dir(spark, "orders"), _orders(spark, sf_dir)
    _merge_orders(spark, orders, path)
    before = versions.current(spark, path).folders
    late = orders.where(F.col("day") >= F.lit(_SINCE).cast("date"))
    _merge_orders(spark, late.withColumn("price", F.lit(0).cast("decimal(18,2)")), path)
    after = versions.current(spark, path).folders
    table = versions.read(spark, path)
    months = [(name, name.split("=")[1], after.get(name) != folder) for name, folder in before.items()]
    rewritten = spark.createDataFrame(months, "name string, month string, rewritten boolean")
    sums = table.groupBy(F.col("_month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("price").cast("double").alias("price")
    )
    return sums.join(rewritten, "month").select("month", "rewritten", "n_orders", "price")


MERGE_TOUCHED = f"""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, bool_or(late) AS rewritten, count(*) AS n_orders,
       CAST(sum(CASE WHEN late THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS price
FROM (SELECT *, o_orderdate >= TIMESTAMP '{_SINCE}' AS late FROM orders) GROUP BY 1
"""


def _lake_of_trades(spark, rows: DataFrame) -> Lake:
    lake = Lake(spark, job_dir(spark, "lake"))
    raw.append(rows, lake.path("raw", models.TRADES.source))
    return lake


def trades_bounded(spark, sf_dir):
    """Trades of some days, read from those days' folders only."""
    lake = _lake_of_trades(spark, S.raw_trades(spark, sf_dir))
    lake.refresh(models.TRADES, RUN_AT)
    found = lake.trusted(models.TRADES, datetime(2024, 1, 8, 12), datetime(2024, 1, 20))
    return S.flat(found.drop("_insert_date"))


TRADES_BOUNDED = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT * EXCLUDE (load_date) FROM trades
WHERE trade_time BETWEEN '2024-01-08 12:00:00.000000' AND '2024-01-20 00:00:00.000000'
"""


def _with_misfits(rows: DataFrame) -> DataFrame:
    """Some payloads get a price that is no number, some are cut."""
    number = P.scalar(P.parse("payload"), "$.t").cast("bigint")
    bad = F.regexp_replace("payload", '"p":"[^"]*"', '"p":"n/a"')
    cut = F.expr("left(payload, length(payload) - 1)")
    return rows.withColumn(
        "payload", F.when(number % 17 == 0, bad).when(number % 19 == 1, cut).otherwise(F.col("payload"))
    )


def quarantined_trades(spark, sf_dir):
    """What a refresh leaves aside, with reasons, after two runs over the same rows."""
    lake = _lake_of_trades(spark, _with_misfits(S.raw_trades(spark, sf_dir)))
    for _ in range(2):
        lake.refresh(models.TRADES, RUN_AT, quarantine=True)
    kept = lake.quarantined(models.TRADES)
    trade_id = F.regexp_extract("payload", '"t":([0-9]+)', 1).cast("bigint")
    event_time = F.regexp_extract("payload", '"E":([0-9]+)', 1).cast("bigint")
    return kept.select(trade_id.alias("trade_id"), event_time.alias("event_millis"), F.concat_ws(",", "reasons").alias("reasons"))


# The latest record of a trade decides; a cut payload has no key and is kept as it is.
QUARANTINED_TRADES = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT trade_id, event_millis, 'malformed payload' AS reasons FROM trade_rows WHERE trade_id % 19 = 1 AND trade_id % 17 <> 0
UNION ALL
SELECT trade_id, event_millis, 'price: not numeric' FROM trade_rows WHERE trade_id % 17 = 0
QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY event_millis DESC) = 1
"""


def trades_beside_quarantine(spark, sf_dir):
    """The trades of the same run that fit."""
    lake = _lake_of_trades(spark, _with_misfits(S.raw_trades(spark, sf_dir)))
    lake.refresh(models.TRADES, RUN_AT, quarantine=True)
    return S.flat(lake.trusted(models.TRADES).drop("_insert_date"))


TRADES_BESIDE_QUARANTINE = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT * EXCLUDE (load_date) FROM trades WHERE trade_id % 17 <> 0 AND trade_id % 19 <> 1
"""


def schema_drift(spark, sf_dir):
    """A batch with another column is refused and the table stays as it was."""
    path, orders = job_dir(spark, "orders"), _orders(spark, sf_dir)
    _merge_orders(spark, orders, path)
    try:
        _merge_orders(spark, orders.withColumn("price", F.lit(0).cast("decimal(18,2)")).withColumn("extra", F.lit(1)), path)
        refused = False
    except ValueError:
        refused = True
    return S.flat(versions.read(spark, path).drop("_month").withColumn("refused", F.lit(refused)))


SCHEMA_DRIFT = """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, true AS refused FROM orders
"""

# -- refined --------------------------------------------------------------------------------


def refined_views(spark, sf_dir):
    """The summary view of the catalog, read by another session, after a full refresh."""
    lake = Lake(spark, job_dir(spark, "lake"))
    raw.append(stored(spark, sf_dir, "raw_auctions", raw_auctions), lake.path("raw", models.RESULTS.source))
    for spec in (models.RESULTS, models.CALENDAR, models.BENCHMARKS):
        lake.refresh(spec, RUN_AT, full=True)
    lake.publish_refined(RUN_AT)
    return S.flat(spark.newSession().table("refined.tesouro_leiloes_por_titulo"))


REFINED_VIEWS = SUMMARY_BY_TITLE


def _with_position(rows: DataFrame) -> DataFrame:
    """Rows of a sorted frame with their place in it, from the place in their partition."""
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    path = job_dir(rows.sparkSession, "sorted")
    rows.write.parquet(path)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    part, mask = F.shiftright("__at", 33), (1 << 33) - 1
    sizes = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # A row per sort partition: few, whatever the rows.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit(mask)) + 1
    placed = rows.withColumn("__part", part).join(before, "__part")
    return placed.withColumn("position", place).drop("__at", "__part", "__before")


def _enriched(spark, sf_dir):
    return refined.enrich(
        _auctions(spark, sf_dir), _calendar(spark, sf_dir), _periods(spark, sf_dir), rows_per_bucket=BUCKET_ROWS
    )


def summary_order(spark, sf_dir):
    """The order of the summary: largest volume first."""
    found = _with_position(refined.summarize_by_title(_enriched(spark, sf_dir)))
    return found.select("position", "titulo", "benchmark", "financeiro_total_bi")


SUMMARY_ORDER = f"""
SELECT row_number() OVER (ORDER BY financeiro_total_bi DESC, titulo, benchmark) AS position,
       titulo, benchmark, financeiro_total_bi
FROM ({SUMMARY_BY_TITLE})
"""


def stress_order(spark, sf_dir):
    """The order of the stress list: newest day first."""
    found = _with_position(refined.stressed(_enriched(spark, sf_dir)))
    return S.flat(found.select("position", "data_leilao", "num_edital"))


STRESS_ORDER = f"""
SELECT row_number() OVER (ORDER BY data_leilao DESC, num_edital) AS position, data_leilao, num_edital
FROM ({STRESS_AUCTIONS})
"""

# -- streams and loads ----------------------------------------------------------------------


def stream_rejects(spark, sf_dir):
    """Messages a streamed landing could not read, after its last batch was repeated."""
    work = job_dir(spark, "stream-rejects")
    stream_messages(S.read(spark, sf_dir, "events")).write.text(f"{work}/in")
    for _ in range(2):
        messages = stream.read_messages(spark, f"{work}/in", files_per_batch=2)
        stream.start_landing(messages, f"{work}/landing", f"{work}/checkpoint", drain=True).awaitTermination()
        _forget_last_commit(spark, f"{work}/checkpoint")
    found = stream.rejected(spark, f"{work}/landing")
    return found.groupBy("message", "reason").agg(F.count(F.lit(1)).alias("n"))


def _forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """As if the query had been stopped between storing its last batch and committing it."""
    commits = [int(name) for name in files.children(spark, f"{checkpoint}/commits") if name.isdigit()]
    files.remove(spark, f"{checkpoint}/commits/{max(commits)}")


STREAM_REJECTS = """
SELECT left(event_type, 3) || '{' AS message, 'no JSON object' AS reason, count(*) AS n
FROM events WHERE value < 5 GROUP BY ALL
"""


def load_once_replay(spark, sf_dir):
    """Landed events loaded by a stream whose last batch was repeated: each is in raw once."""
    root, work = landed_events(spark, sf_dir), job_dir(spark, "load-once")
    for _ in range(2):
        query = stream.load_once(spark, root, f"{work}/raw", f"{work}/checkpoint", RUN_AT, remove_source=False)
        query.awaitTermination()
        _forget_last_commit(spark, f"{work}/checkpoint")
    doc = raw.read(spark, f"{work}/raw").select(P.parse("payload").alias("doc"))
    return doc.groupBy(P.scalar("doc", "$.event_id").cast("bigint").alias("event_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


LOAD_ONCE_REPLAY = "SELECT event_id, count(*) AS n FROM events GROUP BY 1"


def entity_loads_logged(spark, sf_dir):
    """Each event type loaded by itself, one that does not exist failing, and the log of the run."""
    root, work = landed_events(spark, sf_dir), job_dir(spark, "entity-loads")
    first, last, entities = event_span(spark, sf_dir)
    run = audit.Run("lake", "events", "raw", date(2024, 5, 31), "daily")
    entity_loads.load_entities(
        spark, [*entities, "missing"], root, f"{work}/raw", first, last, run, RUN_AT, f"{work}/log", fail_empty=True
    )
    log = spark.read.schema(audit.LOG_SCHEMA).parquet(f"{work}/log")
    stored_rows = raw.read(spark, f"{work}/raw", multiplexed=True).groupBy(raw.ENDPOINT).agg(F.count(F.lit(1)).alias("n_raw"))
    joined = log.join(stored_rows, log.entity == stored_rows[raw.ENDPOINT], "left")
    return joined.select("entity", "status", "record_count", "n_raw", F.col("error_message").isNotNull().alias("explained"))


ENTITY_LOADS_LOGGED = """
SELECT event_type AS entity, 'success' AS status, count(*) AS record_count, count(*) AS n_raw, false AS explained
FROM events GROUP BY event_type
UNION ALL SELECT 'missing', 'failure', 0, NULL, true
"""


def lossy_utf8(spark, sf_dir):
    """Landed lines with bytes that are no UTF-8: they become replacement characters, nothing is lost."""
    root = job_dir(spark, "lossy")
    records = event_records(spark, sf_dir).where(F.length(F.trim("payload")) > 2)
    broken = F.concat(F.expr("cast(payload as binary)"), F.unhex(F.lit("FF")), F.expr("cast(event_kind as binary)"))
    lines = records.select("*", F.col(landing.ENTITY).alias("event_kind")).select(
        broken.cast("string").alias("value"), landing.ENTITY, "year", "month", "day"
    )
    parts = [landing.ENTITY, "year", "month", "day"]
    lines.write.partitionBy(*parts).text(f"{root}.text")
    for name in files.walk(spark, f"{root}.text"):
        if name.endswith(".txt"):
            files.move(spark, f"{root}.text/{name}", f"{root}/{name.removesuffix('.txt')}.jsonl")
    first, last, _ = event_span(spark, sf_dir)
    rows = landing.scan(spark, root, first, last, repair_utf8=True)
    tail = F.regexp_extract("payload", r"([^}]*)$", 1)
    return rows.groupBy(landing.ENTITY, tail.alias("tail")).agg(F.count(F.lit(1)).alias("n"))


LOSSY_UTF8 = """
SELECT event_type AS entity, CASE WHEN user_id % 3 = 0 THEN ' ' || chr(9) ELSE '' END || chr(65533) || event_type AS tail,
       count(*) AS n
FROM events GROUP BY ALL
"""

def fail_fast_loads(spark, sf_dir):
    """The same loads, stopped at the first failure: entities before it are in raw, those after are not."""
    root, work = landed_events(spark, sf_dir), job_dir(spark, "fail-fast")
    first, last, entities = event_span(spark, sf_dir)
    run = audit.Run("lake", "events", "raw", date(2024, 5, 31), "daily")
    order = [*entities[: len(entities) // 2], "missing", *entities[len(entities) // 2 :]]
    try:
        entity_loads.load_entities(
            spark, order, root, f"{work}/raw", first, last, run, RUN_AT, f"{work}/log", fail_fast=True, fail_empty=True
        )
        stopped = False
    except ValueError:
        stopped = True
    loaded = raw.read(spark, f"{work}/raw", multiplexed=True).groupBy(raw.ENDPOINT).agg(F.count(F.lit(1)).alias("n"))
    return loaded.withColumn("stopped", F.lit(stopped))


FAIL_FAST_LOADS = """
WITH types AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS place, count(*) OVER () AS types
               FROM (SELECT DISTINCT event_type FROM events))
SELECT event_type AS endpoint_name, count(*) AS n, true AS stopped
FROM events JOIN types USING (event_type) WHERE place <= types // 2 GROUP BY event_type
"""


def year_folders(spark, sf_dir):
    """Records of one landing day kept apart by the year they are about."""
    root = job_dir(spark, "years")
    orders = S.read(spark, sf_dir, "orders")
    records = landing.with_path_parts(
        orders.select(
            F.lit("resultados").alias(landing.ENTITY),
            F.date_format("o_orderdate", "yyyy").alias("ref_year"),
            F.to_json(F.struct("o_orderkey")).alias("payload"),
            F.lit(RUN_AT.date()).alias("landed"),
        ),
        "landed",
    )
    landing.write(records, root, extra_parts=["ref_year"])
    rows = landing.scan(spark, root, RUN_AT.date(), extra_parts=["ref_year"])
    order = P.scalar(P.parse("payload"), "$.o_orderkey").cast("bigint")
    return rows.select(order.alias("o_orderkey"), "ref_year")


YEAR_FOLDERS = "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS ref_year FROM orders"


def empty_runs(spark, sf_dir):
    """Event types of which nothing is kept leave no file, and loading them appends nothing."""
    root, work = job_dir(spark, "sparse"), job_dir(spark, "sparse-raw")
    records = event_records(spark, sf_dir)
    kinds = sorted(r[0] for r in records.select(landing.ENTITY).distinct().collect())
    landing.write(records.where(F.col(landing.ENTITY).isin(kinds[::2])), root)
    first, last, _ = event_span(spark, sf_dir)
    there = set(files.children(spark, root))
    outcome = []
    for kind in kinds:
        rows = landing.scan(spark, root, first, last, entities=[kind])
        count = raw.append(raw.wrap(rows, RUN_AT, landing.ENTITY), f"{work}/{kind}")["total"]
        outcome.append((kind, f"{landing.ENTITY}={kind}" in there, count, raw.read(spark, f"{work}/{kind}", True).count()))
    return spark.createDataFrame(outcome, "entity string, has_files boolean, appended bigint, in_raw bigint")


EMPTY_RUNS = """
SELECT event_type AS entity, place % 2 = 1 AS has_files, CASE WHEN place % 2 = 1 THEN n ELSE 0 END AS appended,
       CASE WHEN place % 2 = 1 THEN n ELSE 0 END AS in_raw
FROM (SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY event_type) AS place FROM events GROUP BY 1)
"""


def loads_by_frequency(spark, sf_dir):
    """Entities chosen by how often they are asked for, and the days a run looks back to."""
    events = S.read(spark, sf_dir, "events")
    config = events.select(
        F.col("event_type").alias("entity"), F.when(F.length("event_type") % 2 == 0, "monthly").otherwise("daily").alias("frequency")
    ).distinct()
    as_of = date(2024, 1, 20)
    runs = [("all", raw.lookback_start(as_of, days=2)), ("daily", raw.lookback_start(as_of, "2024-01-12")),
            ("monthly", raw.lookback_start(as_of, date(2024, 1, 5), days=9))]
    found = None
    for wanted, first in runs:
        chosen = spine.by_frequency(config, wanted).select(F.col("entity").alias("event_type"))
        rows = events.where(F.to_date("ts").between(F.lit(first), F.lit(as_of))).join(chosen, "event_type")
        part = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(F.lit(wanted).alias("run"), "*")
        found = part if found is None else found.unionByName(part)
    return found


LOADS_BY_FREQUENCY = """
SELECT run, event_type, count(*) AS n
FROM events JOIN (VALUES ('all', DATE '2024-01-18'), ('daily', DATE '2024-01-12'), ('monthly', DATE '2024-01-05')) r(run, first)
    ON run = 'all' OR run = CASE WHEN length(event_type) % 2 = 0 THEN 'monthly' ELSE 'daily' END
WHERE CAST(ts AS DATE) BETWEEN first AND DATE '2024-01-20' GROUP BY ALL
"""


def described_trades(spark, sf_dir):
    """The trades through their catalog table, whose partitions follow a second refresh."""
    rows = S.raw_trades(spark, sf_dir)
    early = F.col("_load_date") <= F.lit(date(2024, 1, 16))
    lake = _lake_of_trades(spark, rows.where(early))
    lake.refresh(models.TRADES, RUN_AT)
    name = qualified("trusted", models.TRADES.name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    lake.describe_trusted(models.TRADES)
    raw.append(rows.where(~early), lake.path("raw", models.TRADES.source))
    lake.refresh(models.TRADES, RUN_AT, start_date=date(2024, 1, 15))
    return S.flat(spark.table(name).drop("_partition_day"))


DESCRIBED_TRADES = f"""
{S.with_ctes(S.TRADES_SQL)}
SELECT * EXCLUDE (load_date), '{RUN_AT:%Y-%m-%d %H:%M:%S}.000000' AS _insert_date FROM trades
"""


def merge_single_key(spark, sf_dir):
    """One key column by name, in a table stored by ranges of it."""
    path = job_dir(spark, "customers")
    customers = S.read(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", range_of_key("c_custkey", 100).alias("_range")
    )
    merge_into(spark, path, customers, "c_custkey", "_range", key_fixes_partition=True, layout=range_layout(100))
    late = customers.where("c_custkey % 10 = 3").withColumn("c_mktsegment", F.lower("c_mktsegment"))
    merge_into(spark, path, late, "c_custkey", "_range", key_fixes_partition=True, layout=range_layout(100))
    return versions.read(spark, path).drop("_range")


MERGE_SINGLE_KEY = """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer
"""

QUERIES = {
    "merge_after_cuts": (merge_after_cuts, MERGE_AFTER_CUTS),
    "merge_touched": (merge_touched, MERGE_TOUCHED),
    "trades_bounded": (trades_bounded, TRADES_BOUNDED),
    "quarantined_trades": (quarantined_trades, QUARANTINED_TRADES),
    "trades_beside_quarantine": (trades_beside_quarantine, TRADES_BESIDE_QUARANTINE),
    "schema_drift": (schema_drift, SCHEMA_DRIFT),
    "refined_views": (refined_views, REFINED_VIEWS),
    "summary_order": (summary_order, SUMMARY_ORDER),
    "stress_order": (stress_order, STRESS_ORDER),
    "stream_rejects": (stream_rejects, STREAM_REJECTS),
    "load_once_replay": (load_once_replay, LOAD_ONCE_REPLAY),
    "entity_loads": (entity_loads_logged, ENTITY_LOADS_LOGGED),
    "lossy_utf8": (lossy_utf8, LOSSY_UTF8),
    "fail_fast_loads": (fail_fast_loads, FAIL_FAST_LOADS),
    "year_folders": (year_folders, YEAR_FOLDERS),
    "empty_runs": (empty_runs, EMPTY_RUNS),
    "loads_by_frequency": (loads_by_frequency, LOADS_BY_FREQUENCY),
    "described_trades": (described_trades, DESCRIBED_TRADES),
    "merge_single_key": (merge_single_key, MERGE_SINGLE_KEY),
}
