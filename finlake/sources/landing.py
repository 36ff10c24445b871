"""Landing areas: JSON lines in ``entity=/year=/month=/day=[/hour=]`` folders."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from finlake.functions.dates import path_parts
from finlake.functions.payload import strip
from finlake.sources import files

ENTITY = "entity"

# Text values: an inferred schema would turn month=01 into the integer 1.
_DAY_PARTS = ["year", "month", "day"]

# One column, no separator, quote or escape in play: every record is written as
# it is. The csv writer is used because it can name its files *.jsonl, which the
# text writer cannot.
AS_JSON_LINES = {
    "extension": "jsonl",
    "sep": "\u0001",
    "quote": "",
    "escape": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _schema(parts: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in ["value", *parts]])


def scan(
    spark: SparkSession,
    root: str,
    start: date,
    end: date | None = None,
    entities: list[str] | None = None,
    hourly: bool = False,
    repair_utf8: bool = False,
    extra_parts: list[str] | None = None,
) -> DataFrame:
    """Records landed from ``start`` to ``end``, both included.

    One scan covers all entities and days; the date and entity conditions are on
    partition columns, so other folders are not read. Month folders of the range are
    listed, whatever its length, and every file in them counts, also one a stream
    wrote without committing its batch. A day or an entity without files gives no rows. Blank
    lines are dropped and the rest is stripped; ``_source_file`` tells where each
    record came from.
    """
    parts = [ENTITY, *_DAY_PARTS, *(["hour"] if hourly else []), *(extra_parts or [])]
    lines = _lines(spark, root, f"{ENTITY}=*", parts, start, end or start)
    if entities is not None:
        lines = lines.where(F.col(ENTITY).isin(entities))
    return _records(lines, parts, repair_utf8)


def scan_folders(
    spark: SparkSession,
    root: str,
    entities: list[str],
    start: date,
    end: date | None = None,
    hourly: bool = False,
    repair_utf8: bool = False,
) -> DataFrame:
    """Like :func:`scan`, for areas whose entity folders are plain names: ``root/entity/year=``."""
    parts = [*_DAY_PARTS, *(["hour"] if hourly else [])]
    found = [
        _lines(spark, f"{root}/{entity}", None, parts, start, end or start).withColumn(
            ENTITY, F.lit(entity)
        )
        for entity in entities
    ]
    return _records(reduce(DataFrame.unionByName, found), [ENTITY, *parts], repair_utf8)


def _lines(
    spark: SparkSession, root: str, above: str | None, parts: list[str], start: date, end: date
) -> DataFrame:
    """Lines of the files of a date range, with their folder values and file path."""
    prefix = f"{root}/{above}" if above else root
    months = {
        f"year={m // 12:04d}/month={m % 12 + 1:02d}"
        for m in range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    }
    # One pattern, so one listing: a narrow range names its months, a wide one its years, whose other
    # months the condition below prunes. Day folders are named, not their month: a folder below the
    # root never carries the file list of a stream's sink, so all ranges see the same files.
    years = ",".join(sorted({name[5:9] for name in months}))
    asked = f"{{{','.join(sorted(months))}}}" if len(months) <= 12 else f"year={{{years}}}/month=*"
    pattern = f"{prefix}/{asked}/day=*"
    if not files.any_match(spark, pattern):
        return spark.createDataFrame(
            [], T.StructType([*_schema(parts), T.StructField("_source_file", T.StringType())])
        )
    lines = (
        spark.read.schema(_schema(parts))
        .option("pathGlobFilter", "*.jsonl")
        .option("basePath", root)
        .text(pattern)
    )
    landed = F.make_date(*(F.col(name).cast("int") for name in _DAY_PARTS))
    return lines.where(landed.between(F.lit(start), F.lit(end))).select(
        "value", *parts, F.col("_metadata.file_path").alias("_source_file")
    )


def _records(lines: DataFrame, parts: list[str], repair_utf8: bool) -> DataFrame:
    text = F.make_valid_utf8("value") if repair_utf8 else F.col("value")
    return lines.select(strip(text).alias("payload"), *parts, "_source_file").where(
        F.length("payload") > 0
    )


def expire(spark: SparkSession, root: str, today: date, keep_days: int = 90) -> list[str]:
    """Remove day folders older than ``keep_days``; returns those removed."""
    oldest, removed = today - timedelta(days=keep_days), []

    def walk(folder: str, parts: dict[str, str]) -> None:
        for name in files.children(spark, folder):
            key, _, value = name.partition("=")
            if key in ("year", "month", "day") and value.isdigit():
                found = {**parts, key: value}
                if key != "day":
                    walk(f"{folder}/{name}", found)
                elif date(*(int(found[k]) for k in _DAY_PARTS)) < oldest:
                    files.remove(spark, f"{folder}/{name}")
                    removed.append(f"{folder}/{name}")
            elif not parts and not name.startswith(("_", ".")):
                walk(f"{folder}/{name}", parts)  # an entity

    walk(root.rstrip("/"), {})
    return removed


def with_path_parts(records: DataFrame, moment: str, hourly: bool = False) -> DataFrame:
    """Add the zero-padded folder values of a date or timestamp column."""
    return records.withColumns(path_parts(moment, hour=hourly))


def write(
    records: DataFrame,
    root: str,
    payload: str = "payload",
    hourly: bool = False,
    extra_parts: list[str] | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Write payload text into its entity and day folders.

    Only folders that receive records are replaced, so a re-run of the same day
    is idempotent and an entity without records leaves no file behind. The
    rebalance keeps few files per folder, and AQE splits a folder that holds a
    large share of the rows.
    """
    parts = [ENTITY, *_DAY_PARTS, *(["hour"] if hourly else []), *(extra_parts or [])]
    _save(records.select(F.col(payload).alias("value"), *parts), root, parts, max_records_per_file)


def write_folder(
    records: DataFrame,
    root: str,
    entity: str,
    payload: str = "payload",
    hourly: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Write one entity's records below its plain folder, ``root/entity/year=``."""
    parts = [*_DAY_PARTS, *(["hour"] if hourly else [])]
    lines = records.select(F.col(payload).alias("value"), *parts)
    _save(lines, f"{root}/{entity}", parts, max_records_per_file)


def _save(lines: DataFrame, path: str, parts: list[str], max_records_per_file: int) -> None:
    (
        lines.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*parts)
        .options(**AS_JSON_LINES)
        .csv(path)
    )
