"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints that differ in at most ``bits`` bits agree in at least two of ``bits + 2``
blocks, so each distinct fingerprint is keyed by every pair of its blocks, fingerprints
with a common key are compared bit by bit, and linked ones form components. Equal
fingerprints are one node from the start, however many documents share them. The
members of a large bucket are dealt to chunks, and each pair of chunks is compared in
its own task, which returns a link from each member to its component's least member
there instead of all pairs: linear in the members, and no link between components is
lost.

Defined results: a null text is empty; a text without words has fingerprint zero and
links like any other; fewer words than a shingle make one shingle; a component of rows
whose doc_ids are all null has a null component_id; repeated rows share a component;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
# Buckets of more fingerprints are compared chunk by chunk.
SMALL_BUCKET = 48
CHUNK = 1024
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a whole text."""
    # bytes.lower changes A-Z only, bytes.split takes exactly the six ASCII space characters.
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    first = np.concatenate([[0], ends[: len(last) - 1] + 1])
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for k in range(0, len(last), _BLOCK):
        spans = zip(first[k : k + _BLOCK].tolist(), last[k : k + _BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(last), bitorder="little").view("<u8")[0])


def fingerprint_column(text: F.Column, words: int = SHINGLE_WORDS) -> F.Column:
    """The fingerprint as a signed 64-bit column."""

    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return run(text)


def _keys(prints: DataFrame, bits: int) -> DataFrame:
    """A row per pair of blocks: key (which pair, and the two blocks' values) and fingerprint."""
    blocks = bits + 2
    edges = [64 * k // blocks for k in range(blocks + 1)]
    widths = [b - a for a, b in itertools.pairwise(edges)]
    value = [
        F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in zip(edges, widths, strict=False)
    ]
    keys = [
        (F.shiftleft(value[i], widths[j]).bitwiseOR(value[j]) * 64 + k)
        for k, (i, j) in enumerate(itertools.combinations(range(blocks), 2))
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _least_linked(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint, the least one of its component among those given."""
    order = np.sort(np.unique(prints))
    label = np.arange(len(order))
    near = np.zeros((len(order), len(order)), bool)
    for k in range(0, len(order), 256):
        near[k : k + 256] = np.bitwise_count((order[k : k + 256, None] ^ order[None, :]).view(np.uint64)) <= bits
    while True:
        least = np.where(near, label[None, :].astype(np.int32), np.int32(len(order))).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return np.stack([order, order[label]], axis=1)


def _cell_links(bits: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        found = _least_linked(cell["fp"].to_numpy(), bits)
        return pd.DataFrame(found[found[:, 0] != found[:, 1]], columns=["a", "b"])

    return run


def links(prints: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect exactly what close pairs connect."""
    keys, _ = common.stored(_keys(prints, bits), "simhash-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members, _ = common.stored(keys.join(sizes, "key"), "simhash-members")
    small = members.where(F.col("n") <= SMALL_BUCKET).select("key", "fp")
    a, b = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    pairs = a.join(b, "key").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    large = members.where(F.col("n") > SMALL_BUCKET)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    large = large.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = large.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    forest = cells.groupBy("key", "low", "high").applyInPandas(_cell_links(bits), "a long, b long")
    return pairs.select("a", "b").unionByName(forest)


def components(pairs: DataFrame) -> DataFrame:
    """Every linked node with the least node of its component, by alternating stars.

    Each round writes its edges below the shared folder and drops those of the round
    before; a lost executor costs one round at most.
    """
    spark = pairs.sparkSession
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, path = common.stored(edges, "simhash-links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after, next_path = common.stored(after, "simhash-links")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        common.drop_table(spark, path)
        edges, path = after, next_path
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def classes(prints: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """From rows (doc_id, fp): each distinct fp with its component's least fp and least doc_id."""
    nodes, _ = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), bits)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "doc_id"
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of documents (doc_id, text)."""
    prints = docs.select("doc_id", fingerprint_column(F.col("text"), words).alias("fp"))
    prints, _ = common.stored(prints, "simhash-prints")
    return prints.join(classes(prints, bits), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MOST_BITS) -> DataFrame:
    """One row of each group of near-duplicates: the one of least doc_id.

    Of several rows with that doc_id and fingerprint the least by all columns stays.
    """
    columns = docs.columns
    marked, _ = common.stored(docs.withColumn("__fp", fingerprint_column(F.col("text"), words)), "simhash-docs")
    prints = marked.select("doc_id", F.col("__fp").alias("fp"))
    groups = prints.join(classes(prints, bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Of a component's rows of least doc_id, one fingerprint is kept: the least.
    chosen = groups.groupBy("root", F.col("doc_id").alias("__id"), "fp").agg(F.count("*").alias("__rows"))
    chosen = chosen.groupBy("root", "__id").agg(
        F.min(F.struct("fp", "__rows")).alias("least")
    ).select("__id", F.col("least.fp").alias("__least"), F.col("least.__rows").alias("__rows"))
    kept = marked.join(
        chosen,
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__least")),
    )
    if chosen.where("__rows > 1").isEmpty():
        return kept.select(*columns)
    single = kept.where("__rows = 1").select(*columns)
    rest = kept.where("__rows > 1").groupBy("__id", "__fp").agg(F.min(F.struct(*columns)).alias("row"))
    return single.unionByName(rest.select("row.*"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
