"""Where tables live and how a run refreshes them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from finlake.operators import quality
from finlake.operators.merge import (
    BUCKET, Merged, bucket_of, first_range, merge_into, month_of_key, range_layout, range_of_key,
)
from finlake.plans import models, refined
from finlake.plans.spec import INSERT_DATE, TrustedSpec, build, misfits, select_window, stamp, survivors
from finlake.session import job_dir
from finlake.sources import files, raw, versions

# One database per layer, with these names whatever the target is called.
LAYERS = ("raw", "trusted", "refined", "governance")
PARTITION_DAY, PARTITION_MONTH, PARTITION_RANGE = "_partition_day", "_partition_month", "_partition_range"
RANGE_WIDTH = 1_000
QUARANTINE = (
    "payload_hash bigint, payload string, reasons array<string>, _source_file string, "
    "_ingested_at timestamp, quarantined_at timestamp, model string"
)


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def qualified(layer: str | None, name: str, default: str = "default") -> str:
    """Table name in its layer's database; the layer name is used as it is."""
    return f"{layer.strip() if layer else default}.{name}"


@dataclass(frozen=True)
class Refreshed:
    """What a refresh read, left aside and merged."""

    payloads: int
    malformed: int
    quarantined: int
    merged: Merged


@dataclass
class Lake:
    """Tables below one root folder all executors can reach."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def raw(self, source: str, multiplexed: bool) -> DataFrame:
        return raw.read(self.spark, self.path("raw", source), multiplexed)

    def is_built(self, spec: TrustedSpec) -> bool:
        return versions.current(self.spark, self.path("trusted", spec.name)) is not None

    def placed(self, rows: DataFrame, spec: TrustedSpec) -> tuple[DataFrame, str]:
        """Typed rows with the column their table is stored by, and its name."""
        if spec.partition_day:
            return rows.withColumn(PARTITION_DAY, F.to_date(spec.partition_day)), PARTITION_DAY
        if spec.key_month:
            return rows.withColumn(PARTITION_MONTH, month_of_key(spec.key_month)), PARTITION_MONTH
        if spec.key_range:
            return rows.withColumn(PARTITION_RANGE, range_of_key(spec.key_range, RANGE_WIDTH)), PARTITION_RANGE
        return rows.withColumn(BUCKET, bucket_of(list(spec.key), self.buckets)), BUCKET

    def layout(self, spec: TrustedSpec) -> str:
        if spec.partition_day or spec.key_month:
            return ""
        return range_layout(RANGE_WIDTH) if spec.key_range else f"buckets={self.buckets}"

    def trusted(
        self, spec: TrustedSpec, first: date | datetime | int | None = None, last: date | datetime | int | None = None
    ) -> DataFrame:
        """A trusted table in its declared columns.

        ``first`` and ``last`` bound the column the table is stored by (``partition_day``,
        ``key_month`` or ``key_range``), both included. The bounds are stated of the stored
        partitions as well, so only folders that can hold such rows are read.
        """
        found = versions.read(self.spark, self.path("trusted", spec.name))
        if found is None:
            found, _ = self.placed(self.spark.createDataFrame([], spec.schema()), spec)
        column = spec.partition_day or spec.key_month or spec.key_range
        if (first is not None or last is not None) and not column:
            raise ValueError(f"{spec.name} is stored by a hash of its key and cannot be bounded")
        for bound, within in ((first, F.Column.__ge__), (last, F.Column.__le__)):
            if bound is None:
                continue
            found = found.where(within(F.col(column), F.lit(bound)))
            # The partition of the bound itself, as its rows are placed.
            if spec.key_range:
                place, limit = PARTITION_RANGE, F.lit(first_range(bound // RANGE_WIDTH))
            else:
                day = bound.date() if isinstance(bound, datetime) else bound
                place = PARTITION_DAY if spec.partition_day else PARTITION_MONTH
                limit = F.lit(day if spec.partition_day else day.replace(day=1))
            found = found.where(within(F.col(place), limit))
        return found.select(*spec.schema().fieldNames())

    def refresh(
        self,
        spec: TrustedSpec,
        run_at: datetime,
        as_of: date | None = None,
        start_date: date | None = None,
        full: bool = False,
        null_safe: bool = True,
        check: bool = True,
        quarantine: bool = False,
    ) -> Refreshed:
        """Build a model from raw and merge it into its table.

        The first build reads all of raw, later ones the lookback window or the
        days since ``start_date``. A latest record that does not fit its types stops the run;
        with ``quarantine`` it is written to ``governance/quarantine`` with its reasons, and the others
        are merged. Malformed payloads are counted, and with ``quarantine`` kept as well. The checks
        run on the new partitions before they are published, so a failing batch is never visible.
        """
        incremental = self.is_built(spec) and not full
        rows, seen = self.raw(spec.source, spec.multiplexed), Observation()
        work = job_dir(self.spark, "refresh")
        try:
            if quarantine:
                window = select_window(rows, spec, as_of or run_at.date(), incremental, start_date)
                found = files.hold(survivors(window, spec, seen), "survivors", work)
                fits = found.where(F.size("__misfits") == 0)
                batch = fits.select(*(f.name for f in spec.fields), stamp(run_at).alias(INSERT_DATE))
            else:
                batch = build(rows, spec, run_at, as_of, incremental, start_date, seen=seen)
            batch, partition = self.placed(batch, spec)
            done = merge_into(
                self.spark,
                self.path("trusted", spec.name),
                batch,
                spec.key,
                partition,
                null_safe=null_safe,
                key_fixes_partition=spec.partition_day is None,
                layout=self.layout(spec),
                check=(lambda new: quality.require(new, spec.checks, spec.name)) if check else None,
            )
            counts, kept = {name: int(n) for name, n in seen.get.items()}, 0
            if quarantine:
                kept = self._quarantine(spec, window, found, run_at, counts["malformed"] > 0)
        finally:
            files.remove(self.spark, work)
        self._register_partitions(spec)
        return Refreshed(counts["payloads"], counts["malformed"], kept, done)

    def _quarantine(
        self, spec: TrustedSpec, window: DataFrame, found: DataFrame, run_at: datetime, malformed: bool
    ) -> int:
        """Merge this run's misfits into the quarantine table; the same payload counts once."""
        seen = Observation()
        rows = misfits(window, found, spec, malformed).select(
            F.lit(spec.name).alias("model"),
            "payload_hash",
            "payload",
            "reasons",
            "_source_file",
            "_ingested_at",
            stamp(run_at).alias("quarantined_at"),
        )
        merge_into(
            self.spark,
            self.path("governance", "quarantine"),
            rows.observe(seen, F.count(F.lit(1)).alias("n")),
            ["model", "payload_hash"],
            "model",
            key_fixes_partition=True,
        )
        return int(seen.get["n"])

    def quarantined(self, spec: TrustedSpec | None = None) -> DataFrame:
        """Payloads kept out of the trusted tables: model, payload, reasons, where and when they came."""
        found = versions.read(self.spark, self.path("governance", "quarantine"))
        if found is None:
            found = self.spark.createDataFrame([], QUARANTINE)
        return found.where(F.col("model") == spec.name) if spec else found

    def _register_partitions(self, spec: TrustedSpec) -> None:
        """Let a described catalog table follow the manifest, partition by partition."""
        table = qualified("trusted", spec.name)
        if self.spark.catalog.databaseExists("trusted") and self.spark.catalog.tableExists(table):
            self._sync_partitions(table, self.path("trusted", spec.name))

    def _sync_partitions(self, table: str, path: str) -> None:
        """Give every partition of a catalog table the folder its manifest names."""
        state = versions.current(self.spark, path)
        folders = state.folders if state else {}
        known = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}

        def clause(name: str) -> str:
            column, _, value = name.partition("=")
            return f"(`{column}` = {'NULL' if value == '__HIVE_DEFAULT_PARTITION__' else repr(value)})"

        def named(name: str) -> str:
            return name.replace("__HIVE_DEFAULT_PARTITION__", "null")

        gone = [name for name in known if name not in {named(f) for f in folders}]
        for name in gone:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION {clause(name)}")
        for name, folder in folders.items():
            place = f"LOCATION '{path}/{folder}'"
            if named(name) in known:
                self.spark.sql(f"ALTER TABLE {table} PARTITION {clause(name)} SET {place}")
            else:
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION {clause(name)} {place}")
        self.spark.catalog.refreshTable(table)

    def publish_refined(self, run_at: datetime, check: bool = True) -> None:
        """Rebuild the enriched table and point the three views of ``refined`` at the new version.

        ``tesouro_leiloes_enriched``, ``tesouro_leiloes_por_titulo`` and ``tesouro_leiloes_stress``
        are views of the catalog, so every session sees them; the latter two are evaluated on read.

        Readers of the old version are not disturbed: each run writes a new
        folder and the view is replaced at the end.
        """
        create_layers(self.spark)
        work = job_dir(self.spark, "enrich")
        folder = self.path("refined", "tesouro_leiloes_enriched")
        name = f"version={run_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        version = f"{folder}/{name}"
        try:
            enriched = refined.enrich(
                self.trusted(models.RESULTS), self.trusted(models.CALENDAR), self.trusted(models.BENCHMARKS), work=work
            )
            enriched.write.parquet(version)
        finally:
            files.remove(self.spark, work)
        table = self.spark.read.schema(enriched.schema).parquet(version)
        if check:
            checked = {
                "tesouro_leiloes_enriched": table,
                "tesouro_leiloes_por_titulo": refined.summarize_by_title(table, ordered=False),
                "tesouro_leiloes_stress": refined.stressed(table, ordered=False),
            }
            for model, rows in checked.items():
                quality.require(rows, models.REFINED_CHECKS.get(model, []), model)
        base = qualified("refined", "tesouro_leiloes_enriched")
        self.spark.sql(f"CREATE OR REPLACE VIEW {base} AS SELECT * FROM parquet.`{version}`")
        for view, text in (
            ("tesouro_leiloes_por_titulo", refined.BY_TITLE_SQL),
            ("tesouro_leiloes_stress", refined.STRESS_SQL),
        ):
            self.spark.sql(f"CREATE OR REPLACE VIEW {qualified('refined', view)} AS {text.format(enriched=base)}")
        # By publication, not by run_at: the version before this one stays for queries
        # that still read it.
        live = f"{folder}/_live"
        before = files.read_text(self.spark, live) if files.exists(self.spark, live) else None
        files.write_text(self.spark, live, name)
        for old in files.children(self.spark, folder):
            if old.startswith("version=") and old not in (name, before):
                files.remove(self.spark, f"{folder}/{old}")

    def enriched(self) -> DataFrame:
        return self.spark.table("refined.tesouro_leiloes_enriched")

    def by_title(self) -> DataFrame:
        """Evaluated on read, like :meth:`stressed`."""
        return self.spark.table("refined.tesouro_leiloes_por_titulo")

    def stressed(self) -> DataFrame:
        return self.spark.table("refined.tesouro_leiloes_stress")

    def describe(self, layer: str, name: str, schema: T.StructType, comment: str, partition: str) -> None:
        """Register a table with its comments in the catalog."""
        create_layers(self.spark)
        columns = []
        for field in schema:
            note = field.metadata.get("comment", "").replace("'", "\\'")
            columns.append(
                f"`{field.name}` {field.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else "")
            )
        table = qualified(layer, name)
        text = comment.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet "
            f"PARTITIONED BY (`{partition}`) COMMENT '{text}' LOCATION '{self.path(layer, name)}'"
        )
        self._sync_partitions(table, self.path(layer, name))

    def describe_trusted(self, spec: TrustedSpec) -> None:
        placed, partition = self.placed(self.spark.createDataFrame([], spec.schema()), spec)
        schema = T.StructType([*spec.schema(), placed.schema[partition]])
        self.describe("trusted", spec.name, schema, spec.comment, partition)
