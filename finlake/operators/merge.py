"""Upsert by key, without a transactional table format.

``upsert`` is the relational operator. ``merge_into`` applies it to a versioned Parquet
table, writes the partitions the batch touches once, and publishes them together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from finlake.operators.latest import latest
from finlake.session import job_dir
from finlake.sources import files, versions

BUCKET = "_bucket"
# Ranges of keys kept as single partitions, as a power of two; a larger number has half as many per doubling.
_SINGLE_BITS = 7


def key_list(keys: str | Sequence[str]) -> list[str]:
    """A single key column or a list of them, as a list."""
    return [keys] if isinstance(keys, str) else list(keys)


def _has_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def _null_safe_join(target: DataFrame, batch: DataFrame, keys: list[str], how: str) -> DataFrame:
    batch_keys = batch.select(*(F.col(k).alias(f"__{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return target.join(batch_keys, reduce(lambda a, b: a & b, same), how)


def unmatched(target: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Target rows whose key is not in the batch."""
    if null_safe:
        return _null_safe_join(target, batch, keys, "left_anti")
    # A null key equals nothing: such rows skip the join instead of being hashed
    # to one partition.
    complete = target.where(~_has_null(keys)).join(batch.select(*keys), keys, "left_anti")
    return complete.unionByName(target.where(_has_null(keys)))


def upsert(
    target: DataFrame, batch: DataFrame, keys: str | Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Batch rows replace target rows of the same key; others are added.

    ``null_safe=False`` matches by plain equality: a batch row with a null key is
    inserted on every run.
    """
    keys = key_list(keys)
    kept = unmatched(target, batch, keys, null_safe)
    return kept.unionByName(batch)


def upsert_newest(
    target: DataFrame, batch: DataFrame, keys: str | Sequence[str], newer_by: str
) -> DataFrame:
    """Like :func:`upsert`, but a batch row replaces only a row that is not newer."""
    both = target.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)))
    newest = [F.col(newer_by).desc_nulls_last(), F.col("__new").desc()]
    return latest(both, key_list(keys), newest).drop("__new")


def require_same_columns(target: T.StructType, batch: T.StructType) -> None:
    """Fail when the batch would change the target's columns or types."""
    have = {field.name: field.dataType.simpleString() for field in target}
    new = {field.name: field.dataType.simpleString() for field in batch}
    if have != new:
        diff = sorted(set(have.items()) ^ set(new.items()))
        raise ValueError(f"schema drift between target and batch: {diff}")


def _in_range_of(batch: DataFrame, keys: list[str]) -> Column:
    """Condition every key of the batch meets.

    Parquet statistics then skip the files of other key ranges; growing ids leave
    only recent ones.
    """
    ends = [end for k in keys for end in (F.min(k).alias(f"low_{k}"), F.max(k).alias(f"high_{k}"))]
    row = batch.agg(*ends).first()
    within = []
    for k in keys:
        low, high = row[f"low_{k}"], row[f"high_{k}"]
        if low is None:
            within.append(F.col(k).isNull())
        else:
            within.append(F.col(k).isNull() | F.col(k).between(F.lit(low), F.lit(high)))
    return reduce(lambda a, b: a & b, within)


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Storage bucket of a key, for tables without a natural partition column."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def month_of_key(day: str) -> Column:
    """First day of the month of a key's date, for tables whose key holds one."""
    return F.trunc(F.col(day), "month")


def range_of_key(number: str, width: int) -> Column:
    """First of the ranges of ``width`` numbers an integer key is stored with; new numbers share the last ones.

    The first 128 ranges are partitions of their own. From there on each doubling of the number is cut
    into 64, so a table has some hundred partitions however far its numbers go, and the newest records
    share one that spans at most a 64th of them. A number's partition never changes.
    """
    place = F.floor(F.col(number) / F.lit(width)).cast("bigint")
    size = F.when(place < 0, F.bitwise_not(place)).otherwise(place)
    spare = F.greatest(F.length(F.bin(size)) - _SINGLE_BITS, F.lit(0))
    first = F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)
    return F.when(place < 0, F.bitwise_not(first)).otherwise(first)


def first_range(place: int) -> int:
    """:func:`range_of_key` of a range number."""
    size = ~place if place < 0 else place
    spare = max(size.bit_length() - _SINGLE_BITS, 0)
    first = size >> spare << spare
    return ~first if place < 0 else first


def range_layout(width: int) -> str:
    """Layout of a table stored by :func:`range_of_key`."""
    return f"width={width}, 64 a doubling"


@dataclass(frozen=True)
class Merged:
    """What a merge did: partitions it wrote or emptied, and those of the table before and after."""

    touched: tuple[str, ...]
    before: int
    after: int


def merge_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    partition: str,
    null_safe: bool = True,
    key_fixes_partition: bool = False,
    newer_by: str | None = None,
    layout: str = "",
    check: Callable[[DataFrame], None] | None = None,
) -> Merged:
    """Upsert a batch into the versioned Parquet table at ``path`` (see :mod:`versions`).

    Touched partitions are those of the batch and those that hold a matched key
    now (a record may move, e.g. to another day); the latter need a scan of the
    key and partition columns, within the batch's key range, and are skipped when
    the key fixes the partition. Their new content is written once, into new folders, and one
    manifest publishes them all: an interrupted run changes nothing, and its
    leftovers go with the next commit. A second writer on the same table raises instead
    of losing rows.

    ``check`` is called with the written partitions before they are published; if it raises, the
    table stays as it was. Other partitions hold neither a new row nor another row of a new key.

    With ``newer_by`` a stored row that is newer than the batch's is kept. A folder that
    holds data without a manifest, or a table of another ``layout`` or partition column than this
    one, raises and is left as it is.
    """
    keys, path = key_list(keys), path.rstrip("/")
    state = versions.current(spark, path)
    if state is None:
        if files.has_data(spark, path):
            raise ValueError(f"{path} holds data but no manifest of a completed write; see versions.adopt")
        folders = versions.write(batch, path, partition)
        _checked(spark, path, _stored(batch.schema), partition, folders, check)
        versions.publish(spark, path, _stored(batch.schema), partition, folders, None, layout)
        return Merged(tuple(folders), 0, len(folders))
    if state.layout != layout or state.partition != partition:
        raise ValueError(f"{path} has the layout {state.partition} {state.layout!r}, not {partition} {layout!r}")
    require_same_columns(state.schema, batch.schema)
    if not state.folders:  # all builds so far were empty
        folders = versions.write(batch, path, partition)
        _checked(spark, path, state.schema, partition, folders, check)
        versions.publish(spark, path, state.schema, partition, folders, state, layout)
        return Merged(tuple(folders), 0, len(folders))

    # The batch is read several times below; a written copy also cuts its lineage.
    held = job_dir(spark, "batch")
    batch.write.parquet(held)
    batch = spark.read.schema(batch.schema).parquet(held)
    try:
        touched = batch.select(partition)
        if not key_fixes_partition:
            places = versions.read(spark, path, state).select(*dict.fromkeys([*keys, partition]))
            places = places.where(_in_range_of(batch, keys))
            if null_safe:
                matching = _null_safe_join(places, batch, keys, "left_semi")
            else:
                matching = places.join(batch.select(*keys), keys, "left_semi")
            touched = touched.union(matching.select(partition))
        # Bounded by the number of partitions of the table.
        names = sorted(files.partition_folder(spark, partition, row[0]) for row in touched.distinct().collect())
        if not names:
            return Merged((), len(state.folders), len(state.folders))
        affected = versions.read(spark, path, state, only=names)
        if newer_by:
            merged = upsert_newest(affected, batch, keys, newer_by)
        else:
            merged = upsert(affected, batch, keys, null_safe)
        # A partition all of whose rows moved elsewhere gets no folder and is listed no more.
        made = versions.write(merged, path, partition)
        _checked(spark, path, state.schema, partition, made, check)
        kept = {name: folder for name, folder in state.folders.items() if name not in names}
        versions.publish(spark, path, state.schema, partition, {**kept, **made}, state, layout)
        return Merged(tuple(names), len(state.folders), len(kept) + len(made))
    finally:
        files.remove(spark, held)


def _checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    folders: dict[str, str],
    check: Callable[[DataFrame], None] | None,
) -> None:
    if check:
        check(versions.read(spark, path, versions.state(0, schema, partition, folders)))


def _stored(schema: T.StructType) -> T.StructType:
    """Column names and types alone: stored columns may always be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])
