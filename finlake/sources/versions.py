"""Tables of immutable partition folders, published by a numbered manifest.

Every write makes a new folder ``_version=<number>-<run>`` with the partitions it holds. A
manifest lists, for each partition of the table, the one folder that is valid, and is written as a
single new file when the data is complete. Readers follow the newest manifest that is whole:
its last line states the checksum of the rest. So a table changes at one point, whatever the
store does with renames, and partitions a write does not touch keep their folders.

Folders and manifests before the newest two are removed by the next commit; queries on the
version before may finish. What an interrupted write left behind is in no
manifest and goes the same way.
"""

from __future__ import annotations

import json
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from finlake.sources import files

MANIFESTS = "_manifests"
VERSION = "_version"


@dataclass(frozen=True)
class Manifest:
    """A published state: folders by partition name (``day=2024-01-01``), relative to the table."""

    number: int
    partition: str
    columns: str
    layout: str = ""
    folders: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))

    def text(self) -> str:
        body = json.dumps(
            {
                "number": self.number,
                "partition": self.partition,
                "columns": self.columns,
                "layout": self.layout,
                "folders": self.folders,
            }
        )
        return f"{body}\n{zlib.crc32(body.encode())}"


def state(
    number: int, schema: T.StructType, partition: str, folders: dict[str, str], layout: str = ""
) -> Manifest:
    """A state of a table, also one that is not published."""
    return Manifest(number, partition, json.dumps(schema.jsonValue()), layout, folders)


def _parsed(text: str) -> Manifest | None:
    body, _, check = text.rpartition("\n")
    if not check.isdigit() or int(check) != zlib.crc32(body.encode()):
        return None
    return Manifest(**json.loads(body))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.children(spark, f"{path}/{MANIFESTS}")
    return sorted(int(name) for name in names if name.isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> Manifest | None:
    return _parsed(files.read_text(spark, f"{path}/{MANIFESTS}/{number:012d}"))


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest whole manifest; None for a folder that was never published."""
    for number in reversed(_numbers(spark, path)):
        found = _manifest(spark, path, number)
        if found:
            return found
    return None


def write(rows: DataFrame, path: str, partition: str) -> dict[str, str]:
    """Write rows as a new, unpublished version; returns its folders by partition.

    Hot partitions are split over tasks.
    """
    spark = rows.sparkSession
    name = f"{VERSION}={max([0, *_numbers(spark, path)]) + 1:012d}-{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance", partition).write.partitionBy(partition).parquet(f"{path}/{name}")
    made = files.children(spark, f"{path}/{name}")
    return {folder: f"{name}/{folder}" for folder in made if folder.startswith(f"{partition}=")}


def publish(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition: str,
    folders: dict[str, str],
    before: Manifest | None,
    layout: str = "",
) -> Manifest:
    """Make the folders the table's state, if it is still the one that was read.

    Raises when another writer published in between; nothing is changed then.
    """
    now = current(spark, path)
    if (now and now.number) != (before and before.number):
        raise RuntimeError(f"{path} was changed by another writer")
    number = max([0, *_numbers(spark, path)]) + 1
    made = state(number, schema, partition, folders, layout)
    files.write_text(spark, f"{path}/{MANIFESTS}/{number:012d}", made.text(), overwrite=False)
    _clean(spark, path, made, before)
    return made


def _clean(spark: SparkSession, path: str, made: Manifest, before: Manifest | None) -> None:
    """Remove what neither of the newest two states lists."""
    kept = {f for state in (made, before) if state for f in state.folders.values()}
    versions = {f.split("/")[0] for f in kept}
    for version in files.children(spark, path):
        if not version.startswith(f"{VERSION}="):
            continue
        if version not in versions:
            files.remove(spark, f"{path}/{version}")
            continue
        for folder in files.children(spark, f"{path}/{version}"):
            if folder.startswith(f"{made.partition}=") and f"{version}/{folder}" not in kept:
                files.remove(spark, f"{path}/{version}/{folder}")
    for number in _numbers(spark, path):
        if number not in (made.number, before.number if before else 0):
            files.remove(spark, f"{path}/{MANIFESTS}/{number:012d}")


def read(
    spark: SparkSession, path: str, manifest: Manifest | None = None, only: list[str] | None = None
) -> DataFrame | None:
    """The published rows with the partition column; None for a folder never published.

    ``only`` names partitions to read. Conditions on the partition column prune folders.
    """
    manifest = manifest or current(spark, path)
    if manifest is None:
        return None
    names = manifest.folders if only is None else [name for name in only if name in manifest.folders]
    schema = manifest.schema
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    found = reader.parquet(*[f"{path}/{manifest.folders[name]}" for name in names])
    return found.select(*schema.fieldNames())


def adopt(spark: SparkSession, path: str, partition: T.StructField, layout: str = "") -> None:
    """Publish a partitioned folder another tool wrote completely, as a first version of it."""
    if current(spark, path):
        raise ValueError(f"{path} is already published")
    found = spark.read.parquet(path).schema
    schema = T.StructType([partition if f.name == partition.name else f for f in found])
    folders = write(spark.read.schema(schema).parquet(path), path, partition.name)
    publish(spark, path, schema, partition.name, folders, None, layout)
    for folder in files.children(spark, path):
        if folder.startswith(f"{partition.name}="):
            files.remove(spark, f"{path}/{folder}")
