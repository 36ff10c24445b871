"""Typed, deduplicated models declared as data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from finlake.functions import dates, numbers, payload as P
from finlake.operators.latest import latest
from finlake.operators.quality import Checks
from finlake.sources import raw

INSERT_DATE = "_insert_date"


def _text(value: Column, strict: bool = True) -> Column:
    return value


# How the text at a payload path becomes a column, and the stored type.
KINDS: dict[str, tuple[Callable[..., Column], T.DataType]] = {
    "text": (_text, T.StringType()),
    "integer": (numbers.integer, T.LongType()),
    "numeric": (numbers.numeric, T.DecimalType(38, 9)),
    "boolean": (numbers.boolean, T.BooleanType()),
    "epoch_millis": (dates.epoch_millis, T.TimestampType()),
    "iso_day": (dates.iso_day, T.DateType()),
    "slash_day": (dates.slash_day, T.DateType()),
    "compact_month": (dates.compact_month, T.DateType()),
    "compact_month_start": (dates.compact_month_start, T.DateType()),
    "dashed_month": (dates.dashed_month, T.DateType()),
}


@dataclass(frozen=True)
class Field:
    """Output column, JSON member it comes from, and how it is typed."""

    name: str
    member: str
    kind: str = "text"
    comment: str = ""

    @property
    def path(self) -> str:
        return f"$.{self.member}"

    def typed(self, text: Column, strict: bool) -> Column:
        return KINDS[self.kind][0](text, strict=strict)


@dataclass(frozen=True)
class TrustedSpec:
    """One trusted model.

    ``required`` names output columns whose payload path must hold a value.
    ``event_order`` names the column that decides which record is the latest; by
    default it is the ingest time.

    The table is stored by the day of ``partition_day``, or by what the key says: the month of
    its date ``key_month``, the range of its number ``key_range``, else a hash. The
    latter three never change for a key; months and ranges keep a batch of recent
    records in the few partitions that hold recent records.
    """

    name: str
    source: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    endpoint: str | None = None
    event_order: str | None = None
    partition_day: str | None = None
    key_month: str | None = None
    key_range: str | None = None
    lookback_days: int = 2
    checks: Checks = Checks()
    comment: str = ""

    @property
    def multiplexed(self) -> bool:
        return self.endpoint is not None

    def schema(self) -> T.StructType:
        """Declared columns with their comments, load stamp last."""
        columns = [
            T.StructField(f.name, KINDS[f.kind][1], True, {"comment": f.comment} if f.comment else None)
            for f in self.fields
        ]
        return T.StructType([*columns, T.StructField(INSERT_DATE, T.TimestampType())])


def select_window(
    rows: DataFrame,
    spec: TrustedSpec,
    as_of: date,
    incremental: bool = True,
    start_date: date | None = None,
) -> DataFrame:
    """Raw rows a build reads: the model's endpoint and, unless first, its load window."""
    if incremental:
        rows = raw.since(rows, as_of, start_date, spec.lookback_days)
    if spec.multiplexed:
        rows = rows.where(F.col(raw.ENDPOINT) == spec.endpoint)
    return rows


def _documents(rows: DataFrame, spec: TrustedSpec, seen: Observation | None) -> DataFrame:
    """Rows with their parsed payload and its members' texts, counted on the way into ``seen``.

    The observed counts also keep Catalyst from moving path conditions below the
    parse, which would parse every payload twice.
    """
    parsed = rows.withColumn("__doc", P.parse("payload"))
    return parsed.withColumn("__texts", P.texts("__doc", _members(spec))).observe(
        seen or f"{spec.name}-{uuid.uuid4().hex[:8]}",
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(F.col("__doc").isNull()).alias("malformed"),
    )


def type_payloads(
    rows: DataFrame,
    spec: TrustedSpec,
    strict: bool = True,
    late_errors: str | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Typed columns of the payloads that hold all required values.

    ``strict`` raises on a value that does not fit its type; otherwise it is null
    and :func:`quarantine` lists the row. With ``late_errors`` a column of that name
    lists the fields that do not fit, and only key and order columns raise, if ``strict``.
    """
    first = {*spec.key, spec.event_order}
    errors = []
    place = {name: f"__texts.c{k}" for k, name in enumerate(_members(spec))}
    texts = _documents(rows, spec, seen).select(
        "*", *(F.col(place[f.member]).alias(_text_name(f)) for f in spec.fields)
    )
    for field in spec.fields:
        if field.name in spec.required:
            texts = texts.where(_scalar(field).isNotNull())
    if late_errors:
        for f in spec.fields:
            if not strict or f.name not in first:
                misfit = _scalar(f).isNotNull() & f.typed(_scalar(f), False).isNull()
                errors.append(F.when(misfit, F.lit(f.name)))
    # array_compact would interpret all of its input row by row; the names differ, so this drops nulls only.
    no_name = F.array(F.lit(None).cast("string"))
    listed = [F.array_except(F.array(*errors), no_name).alias(late_errors)] if late_errors else []
    return texts.select(
        *(
            f.typed(_scalar(f), strict and (not late_errors or f.name in first)).alias(f.name)
            for f in spec.fields
        ),
        *listed,
        *(c for c in rows.columns if c not in spec.schema().names),
    )


def _members(spec: TrustedSpec) -> list[str]:
    return list(dict.fromkeys(f.member for f in spec.fields))


def _text_name(field: Field) -> str:
    return f"__text_{field.name}"


def _scalar(field: Field) -> Column:
    """The field's text, from the columns :func:`type_payloads` selected."""
    return P.unless_nested(F.col(_text_name(field)), "__doc", field.path)


def quarantine(rows: DataFrame, spec: TrustedSpec) -> DataFrame:
    """Rows that strict typing would reject, each with the reasons."""
    documents = rows.withColumn("__doc", P.parse("payload"))
    reasons = [F.when(F.col("__doc").isNull(), F.lit("malformed payload"))]
    for field in spec.fields:
        text = P.scalar("__doc", field.path)
        bad = text.isNotNull() & field.typed(text, strict=False).isNull()
        reasons.append(F.when(bad, F.lit(f"{field.name}: not {field.kind}")))
    return (
        documents.withColumn("reasons", F.array_compact(F.array(*reasons)))
        .where(F.size("reasons") > 0)
        .drop("__doc")
    )


def _latest_typed(
    rows: DataFrame, spec: TrustedSpec, strict: bool, seen: Observation | None, misfits: bool
) -> DataFrame:
    """The latest record of each key, with ``_ingested_at``, ``__tie`` and, if asked, ``__misfits``.

    Not strict, a record whose key or order does not fit cannot be compared and stays by itself.
    """
    window = rows.select("payload", "_ingested_at", F.xxhash64("payload").alias("__tie"))
    typed = type_payloads(window, spec, strict, "__misfits" if misfits else None, seen)
    order = [spec.event_order] if spec.event_order else []
    newest = [F.col(c).desc_nulls_last() for c in [*order, "_ingested_at", "__tie"]]
    keys = list(spec.key)
    if misfits and not strict:
        alone = F.arrays_overlap("__misfits", F.array(*(F.lit(c) for c in [*keys, *order])))
        typed = typed.withColumn("__alone", F.when(alone, F.col("__tie")))
        return latest(typed, [*keys, "__alone"], newest).drop("__alone")
    return latest(typed, keys, newest)


def stamp(run_at: datetime) -> Column:
    return F.lit(run_at.isoformat(sep=" ")).cast("timestamp")


def build(
    rows: DataFrame,
    spec: TrustedSpec,
    run_at: datetime,
    as_of: date | None = None,
    incremental: bool = False,
    start_date: date | None = None,
    strict: bool = True,
    seen: Observation | None = None,
) -> DataFrame:
    """The model's rows of a raw table: typed, latest record per key, stamped.

    Keys are compared after typing, so ``01`` and ``1`` are one integer key as
    they are in the table. Records of one run share their ingest time; a hash of
    the payload then decides, so that a re-run picks the same record without the
    payloads in the shuffle. ``seen`` observes the number of payloads and of malformed ones.
    """
    window = select_window(rows, spec, as_of or run_at.date(), incremental, start_date)
    survivors = _latest_typed(window, spec, strict, seen, misfits=strict)
    stamped = stamp(run_at)
    if strict:
        # Only what enters the table must fit: a correction repairs the record it replaces.
        message = F.concat(F.lit(f"{spec.name}: values that do not fit: "), F.array_join("__misfits", ", "))
        stamped = F.when(F.size("__misfits") > 0, F.raise_error(message).cast("timestamp")).otherwise(stamped)
    return survivors.select(*(f.name for f in spec.fields), stamped.alias(INSERT_DATE))


def survivors(rows: DataFrame, spec: TrustedSpec, seen: Observation | None = None) -> DataFrame:
    """Latest records of raw rows of a model's window, those that do not fit included.

    The fields, ``__misfits`` (names of the fields that do not fit), and ``__tie`` and ``_ingested_at``, by
    which :func:`misfits` finds the payload again.
    """
    return _latest_typed(rows, spec, strict=False, seen=seen, misfits=True)


def misfits(rows: DataFrame, found: DataFrame, spec: TrustedSpec, malformed: bool) -> DataFrame:
    """Quarantine rows: the payloads of survivors that do not fit, and malformed ones if asked, with reasons."""
    kinds = F.create_map(*[x for f in spec.fields for x in (F.lit(f.name), F.lit(f"{f.name}: not {f.kind}"))])
    bad = found.where(F.size("__misfits") > 0).select(
        "__tie", "_ingested_at", F.transform("__misfits", lambda name: kinds[name]).alias("reasons")
    )
    marked = rows.select("payload", "_source_file", "_ingested_at", F.xxhash64("payload").alias("__tie"))
    listed = marked.join(bad, ["__tie", "_ingested_at"])
    if malformed:
        broken = marked.where(P.parse("payload").isNull())
        listed = listed.unionByName(broken.withColumn("reasons", F.array(F.lit("malformed payload"))))
    latest_first = [F.col("_ingested_at").desc(), F.col("_source_file")]
    return latest(listed.withColumnRenamed("__tie", "payload_hash"), ["payload_hash"], latest_first)
