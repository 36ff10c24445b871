"""Folder operations through the Hadoop file system Spark itself uses."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from finlake.session import job_dir


# Moves that wait for the store at the same time.
MOVERS = 16


@lru_cache(maxsize=1)
def _path_class(jvm):
    """Looked up once: each package of the name is a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


def _fs(spark: SparkSession, path: str):
    hadoop_path = _path_class(spark.sparkContext._jvm)(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything."""
    fs, hadoop_path = _fs(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def remove(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder is absent."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a plain table folder holds anything besides markers such as _SUCCESS.

    Versioned folders (:mod:`versions`) do not count.
    """
    return any(
        name.startswith("part-") or re.match(r"(?!_version=)[^.].*=", name) for name in children(spark, path)
    )


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small file; without ``overwrite`` an existing one raises."""
    fs, hadoop_path = _fs(spark, path)
    out = fs.create(hadoop_path, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def walk(spark: SparkSession, path: str) -> list[str]:
    """Files anywhere below a folder, relative to it; none when the folder is absent.

    As Spark lists them: folders by the cluster, hidden files (``_SUCCESS``) left out.
    """
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    root = fs.getFileStatus(hadoop_path).getPath().toUri().getPath()
    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").text(path)
    return sorted(unquote(urlsplit(name).path)[len(root) :].lstrip("/") for name in lines.inputFiles())


def move(spark: SparkSession, source: str, target: str, fs=None) -> None:
    """Move one file; a target that a cut move left behind is replaced.

    With ``fs``, the file system of both, the target's folder is there already.
    """
    place = _path_class(spark.sparkContext._jvm)
    from_path, to_path = place(source), place(target)
    if fs is None:
        fs = _fs(spark, source)[0]
        fs.mkdirs(to_path.getParent())
    if fs.exists(to_path):
        fs.delete(to_path, False)
    if not fs.rename(from_path, to_path):
        raise OSError(f"cannot move {source} to {target}")


def move_all(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Move files of one file system, several at a time; when one fails, those not begun are left where they are."""
    moves = list(moves)
    if not moves:
        return
    fs, place = _fs(spark, moves[0][0])[0], _path_class(spark.sparkContext._jvm)
    for folder in sorted({target.rpartition("/")[0] for _, target in moves}):
        fs.mkdirs(place(folder))
    with ThreadPoolExecutor(MOVERS) as pool:
        for _ in pool.map(lambda pair: move(spark, *pair, fs), moves):
            pass


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """Folder name of a partition value, escaped as Spark writes it."""
    if value is None:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={utils.escapePathName(str(value))}"


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, read from folder names only."""
    prefix = f"{column}="
    return [name[len(prefix):] for name in children(spark, path) if name.startswith(prefix)]


def hold(frame: DataFrame, label: str, work: str | None = None) -> DataFrame:
    """Write a reduced frame once, so that several consumers read it instead of computing it.

    Below ``work``, which its owner removes, or in a job folder of its own.
    """
    spark = frame.sparkSession
    path = f"{work}/{label}" if work else job_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
