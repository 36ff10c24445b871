"""Trade stream: messages to hourly landing files, landing to raw, raw to trusted."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from finlake.functions.payload import strip
from finlake.operators.merge import merge_into
from finlake.plans.spec import TrustedSpec, build
from finlake.plans.tables import PARTITION_DAY
from finlake.sources import files, landing, raw
from finlake.sources.envelopes import sorted_messages
from finlake.streaming.ledger import Ledger, query_id

MAX_MESSAGES = 500
MAX_AGE = "60 seconds"
_LINES = "value string"


def read_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of message texts from files that keep arriving in a folder."""
    reader = spark.readStream.schema(_LINES).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "message")


def start_landing(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    drain: bool = False,
    max_messages: int = MAX_MESSAGES,
) -> StreamingQuery:
    """Land messages by symbol and hour of arrival; those without a trade are kept apart.

    A file holds at most ``max_messages``; a batch closes after ``MAX_AGE``, or with
    ``drain`` when all waiting input is written. The hour is that of the batch, not
    the trade's, and stays the same when the batch is repeated. Messages that cannot be read go to
    ``root/_rejected`` with the reason and the batch id (:func:`rejected`); both sides are written in one
    pass, counted in the ledger ``root/_ledger`` (:func:`landed_counts`), and stored once.
    """
    spark = messages.sparkSession
    found = sorted_messages(messages.withColumn("arrived", F.current_timestamp()))
    parts = ["kind", landing.ENTITY, "year", "month", "day", "hour"]

    def land(batch: DataFrame, batch_id: int) -> None:
        refused = F.struct("message", "reason", F.lit(batch_id).alias("batch_id"), "arrived")
        good = F.col("reason").isNull()
        rows = landing.with_path_parts(batch, "arrived", hourly=True).select(
            F.when(good, F.col("payload")).otherwise(F.to_json(refused)).alias("value"),
            F.when(good, "landed").otherwise("rejected").alias("kind"),
            F.when(good, F.concat("symbol", F.lit("_trades"))).otherwise("messages").alias(landing.ENTITY),
            *parts[2:],
        )

        def write(staging: str) -> dict:
            seen = Observation()
            kinds = [F.count_if(F.col("kind") == kind).alias(kind) for kind in ("landed", "rejected")]
            (
                rows.observe(seen, *kinds)
                .write.option("maxRecordsPerFile", max_messages)
                .partitionBy(*parts)
                .options(**landing.AS_JSON_LINES)
                .csv(staging)
            )
            return {kind: int(n) for kind, n in seen.get.items()}

        ledger = Ledger(spark, f"{root}/_ledger", query_id(spark, checkpoint))
        ledger.store_once(batch_id, write, {"kind=landed": root, "kind=rejected": f"{root}/_rejected"})

    writer = found.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return _trigger(writer, drain).start()


def landed_counts(spark: SparkSession, root: str, checkpoint: str) -> dict[int, dict]:
    """Messages landed and rejected by batch, of a landing's latest batches."""
    return Ledger(spark, f"{root}/_ledger", query_id(spark, checkpoint)).done()


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """Messages a landing could not read: message, reason, batch_id, arrived."""
    schema = "message string, reason string, batch_id bigint, arrived timestamp"
    path = f"{root}/_rejected/{landing.ENTITY}=messages"
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.schema(_LINES).option("recursiveFileLookup", "true").text(path)
    return lines.select(F.from_json("value", schema).alias("found")).select("found.*")


def _trigger(writer: DataStreamWriter, drain: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=MAX_AGE)


def load_once(
    spark: SparkSession,
    landing_root: str,
    raw_path: str,
    checkpoint: str,
    run_at: datetime,
    remove_source: bool = True,
) -> StreamingQuery:
    """Append every landed file to raw exactly once, then delete it.

    The checkpoint remembers the files read; a file is deleted when a later batch
    has committed. The ledger ``raw_path/_ledger`` knows which batches raw holds, so a batch repeated
    after a failure adds no row, whenever the failure came.
    """
    lines = (
        spark.readStream.schema(_LINES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.jsonl")
        .option("cleanSource", "delete" if remove_source else "off")
        .text(landing_root)
    )
    # What a landing keeps apart below its root is not landed.
    own = ~F.col("_metadata.file_path").rlike("/_(rejected|ledger)/")
    landed = (
        lines.where(own)
        .select(
            strip(F.make_valid_utf8("value")).alias("payload"),
            F.col("_metadata.file_path").alias("_source_file"),
        )
        .where(F.length("payload") > 0)
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(spark, f"{raw_path}/_ledger", query_id(spark, checkpoint))
        ledger.store_once(batch_id, lambda staging: raw.append(batch, f"{staging}/rows"), {"rows": raw_path})

    writer = raw.wrap(landed, run_at).writeStream.foreachBatch(load)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_merge(
    rows: DataFrame,
    spec: TrustedSpec,
    path: str,
    checkpoint: str,
    run_at: datetime,
    drain: bool = True,
) -> StreamingQuery:
    """Merge each micro-batch of raw rows into the trusted table; the latest record wins.

    Streaming dedup by watermark would keep the first record of a key instead. A
    record later than one already merged must not lose to it, so the batch is merged
    with the event time compared; a repeated batch changes nothing. A batch may be one large file,
    whose row group is one task: its rows are dealt out before their payloads are parsed.
    """
    order = spec.event_order
    if order is None or spec.partition_day is None:
        raise ValueError("streamed merge needs a model with event order and partition day")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dealt = batch.repartition("payload", "_source_file", "_ingested_at")
        new = build(dealt, spec, run_at).withColumn(PARTITION_DAY, F.to_date(spec.partition_day))
        merge_into(spark, path, new, spec.key, PARTITION_DAY, newer_by=order)

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _trigger(writer, drain).start()


def hourly_counts(trades: DataFrame, when: str, symbol: str, lateness: str = "2 days") -> DataFrame:
    """Trades per symbol and event hour, accepting data up to ``lateness`` late."""
    return (
        trades.withWatermark(when, lateness)
        .groupBy(F.window(when, "1 hour"), symbol)
        .agg(F.count(F.lit(1)).alias("n_trades"))
        .select(F.col("window.start").alias("hour_start"), symbol, "n_trades")
    )


def start_hourly_counts(
    trades: DataFrame,
    when: str,
    symbol: str,
    path: str,
    checkpoint: str,
    lateness: str = "2 days",
    drain: bool = True,
) -> StreamingQuery:
    """Keep a table of hourly counts up to date.

    Only hours that changed leave the state store; the watermark drops hours that
    can change no more.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        new = batch.withColumn(PARTITION_DAY, F.to_date("hour_start"))
        merge_into(
            batch.sparkSession, path, new, ["hour_start", symbol], PARTITION_DAY,
            key_fixes_partition=True,
        )

    writer = (
        hourly_counts(trades, when, symbol, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, drain).start()
