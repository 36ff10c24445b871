"""Homomorphic multiset hash of documents.

A text is the multiset of its paragraphs, the pieces between line feeds. Every paragraph is
hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs' vectors, lane by
lane modulo a power of two: the order of paragraphs does not matter, and a paragraph
is inserted or deleted by adding or subtracting its vector, without the rest of the text.

The vector has two parts. The equality lanes, 32 modulo 2**32, are the output of SHAKE-128: two
texts agree in them if they hold the same paragraphs as often. The likeness lanes,
256 modulo 2**16, hold a signed weight for every distinct three-word shingle of the paragraph
(all its words, if fewer): the whole root of its count there, so that one repeated phrase
does not outweigh the rest. Sums stay sums under addition, so the squared distance of two
fingerprints' likeness lanes estimates how many shingles the texts do not share,
and their likeness is one less that distance over both squared lengths.

Defined results: a null text is empty, and an empty text is one empty paragraph; equal texts have
equal fingerprints and likeness 1; fingerprints that differ but have no words have likeness
0. Documents follow each other by descending doc_id, null ids last, rows of
one id by a hash of their text; a single document is its own next. Repeated rows
are rows of their own; an empty table gives no rows; other columns are ignored. Counts
of a likeness lane wrap beyond 32,767 equal paragraphs, which equality does not notice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

EQUAL_LANES, EQUAL_BYTES = 32, 4 * 32
LIKE_LANES = 256
SHINGLE = 3
# Documents of about so many bytes are walked through by one task, in order.
PART_BYTES = 8 << 20
MOST_PARTS = 50_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def _shingles(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the distinct shingles of each paragraph, all paragraphs at once."""
    raw = np.frombuffer(text, np.uint8)
    letter = ~_SPACE[raw]
    before = np.append(False, letter[:-1])
    starts = np.flatnonzero(letter & ~before)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(letter)
    first = np.searchsorted(at, starts)
    lengths = np.diff(first, append=len(at))
    inside = np.arange(len(at)) - np.repeat(first, lengths)
    terms = (raw[at].astype(np.uint64) + np.uint64(1)) * _POWERS[inside % len(_POWERS)]
    words = _mixed(np.add.reduceat(terms, first))
    paragraph = np.searchsorted(np.flatnonzero(raw == 10), starts)
    size = np.bincount(paragraph)
    begin = np.cumsum(size) - size
    whole = np.append(words, np.zeros(SHINGLE, np.uint64))
    total, place = words * _MIX[0], np.arange(len(words)) - begin[paragraph]
    for k in range(1, SHINGLE):
        there = place + k < size[paragraph]
        total = total + np.where(there, whole[k : k + len(words)], np.uint64(0)) * (_MIX[k] + np.uint64(2 * k))
    # Every place a shingle fits, and the first place of a paragraph with fewer words.
    fits = (place + SHINGLE <= size[paragraph]) | (place == 0)
    found, owner = _mixed(total[fits]), paragraph[fits].astype(np.uint64)
    _, one, counts = np.unique(_mixed(found + owner * _MIX[0]), return_index=True, return_counts=True)
    return found[one], counts


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors of a text's paragraphs: equality lanes and likeness lanes."""
    raw = text.encode("utf-8", "surrogatepass")
    shake = hashlib.shake_128
    parts = b"".join([shake(p).digest(EQUAL_BYTES) for p in raw.split(b"\n")])
    equal = np.frombuffer(parts, "<u4").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        hashes, counts = _shingles(raw)
    weights = np.where(hashes & np.uint64(LIKE_LANES), 1.0, -1.0) * np.floor(np.sqrt(counts))
    like = np.bincount((hashes & np.uint64(LIKE_LANES - 1)).astype(np.int64), weights, LIKE_LANES)
    return equal.astype(np.int64), like.astype(np.int64)


def packed(equal: np.ndarray, like: np.ndarray) -> bytes:
    """A fingerprint's bytes: lanes modulo 2**32, then lanes modulo 2**16, little-endian."""
    return (equal & 0xFFFFFFFF).astype("<u4").tobytes() + (like & 0xFFFF).astype("<u2").tobytes()


def lanes(fingerprint: bytes) -> np.ndarray:
    """All lanes of a fingerprint as one integer vector, the likeness lanes signed."""
    equal = np.frombuffer(fingerprint[:EQUAL_BYTES], "<u4").astype(np.int64)
    return np.concatenate([equal, np.frombuffer(fingerprint[EQUAL_BYTES:], "<i2").astype(np.int64)])


def from_lanes(total: np.ndarray) -> bytes:
    return packed(total[:EQUAL_LANES], total[EQUAL_LANES:])


def of_text(text: str | None) -> bytes:
    return packed(*vector(text or ""))


def inserted(fingerprint: bytes, paragraphs: str) -> bytes:
    """The fingerprint after paragraphs (one text of them) were added."""
    return from_lanes(lanes(fingerprint) + np.concatenate(vector(paragraphs)))


def deleted(fingerprint: bytes, paragraphs: str) -> bytes:
    """The fingerprint after paragraphs it holds were taken out."""
    return from_lanes(lanes(fingerprint) - np.concatenate(vector(paragraphs)))


def likeness(a: bytes, b: bytes) -> float:
    """Share of shingles two fingerprints have in common, estimated; 1 for equal ones."""
    if a == b:
        return 1.0
    one, two = (np.frombuffer(x[EQUAL_BYTES:], "<i2") for x in (a, b))
    apart = (one - two).astype(np.float64)
    size = (one.astype(np.float64) ** 2).sum() + (two.astype(np.float64) ** 2).sum()
    return float(min(max(1 - (apart**2).sum() / size, 0.0), 1.0)) if size else 0.0


def fingerprint_column(text: F.Column) -> F.Column:
    @F.pandas_udf(T.BinaryType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([of_text(t) for t in texts], dtype=object)

    return run(text)


def combined(prints: DataFrame, by: str) -> DataFrame:
    """by, fingerprint: that of all documents of a group together, from rows (by, fingerprint).

    Lanes are summed per Arrow batch first, so a group that holds a third of the rows
    sends as few rows as any other.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, own in batch.groupby("key", dropna=False)["fingerprint"]:
                total = np.sum([lanes(x) for x in own], axis=0)
                keys = pd.Series([None if pd.isna(key) else key] * len(total), dtype=object)
                yield pd.DataFrame({"key": keys, "lane": np.arange(len(total)), "part": total})

    @F.pandas_udf(T.BinaryType())
    def joined(totals: pd.Series) -> pd.Series:
        return pd.Series([from_lanes(np.array([x["total"] for x in t])) for t in totals], dtype=object)

    rows = prints.select(F.col(by).cast("string").alias("key"), "fingerprint")
    sums = rows.mapInPandas(run, "key string, lane int, part long").groupBy("key", "lane").agg(F.sum("part").alias("total"))
    whole = sums.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("lane", "total"))).alias("lanes"))
    return whole.select(F.col("key").cast(prints.schema[by].dataType).alias(by), joined("lanes").alias("fingerprint"))


def _sort_key() -> list[F.Column]:
    """Columns whose ascending order is that of the documents: descending doc_id, nulls last."""
    return [
        F.col("doc_id").isNull().alias("z"),
        F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("k"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
    ]


def _as_bytes(z: np.ndarray, k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sort keys as byte strings of the same order."""
    top = np.int64(-(2**63))
    both = np.stack([k.astype(np.int64) ^ top, h.astype(np.int64) ^ top], axis=1).astype(">i8")
    whole = np.concatenate([z.astype(np.uint8)[:, None], both.view(np.uint8).reshape(-1, 16)], axis=1)
    # A last byte that is never zero keeps trailing zeros from being cut.
    whole = np.concatenate([whole, np.ones((len(whole), 1), np.uint8)], axis=1)
    return np.ascontiguousarray(whole).view("S18").reshape(-1)


def with_next(docs: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """Rows (doc_id, text, part, carried) in which each part's rows, in order, end with a carried row.

    The carried row is the first of the next part (after the last part: of the first), so
    whoever walks through a part sees every document with the one that follows. Parts are ranges
    of the sort key, cut where Spark's range partitioning of the keys alone puts the
    cuts: their first keys, one a part, are all that reaches the driver, and whole
    texts are shuffled once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys, _ = common.stored(docs.select(*_sort_key(), F.octet_length("text").alias("size")), "multiset-keys")
    size = keys.agg(F.sum("size")).first()[0]
    if size is None:
        return docs.select("*", F.lit(0).alias("part"), F.lit(False).alias("carried")), 1
    n = min(max(size // part_bytes, 1), MOST_PARTS)
    ranged = keys.repartitionByRange(int(n), "z", "k", "h")
    first = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("z", "k", "h")).alias("first"))
    heads = sorted((r.z, r.k, r.h) for (r,) in first.select("first").collect())
    cuts = _as_bytes(*[np.array(c, np.int64) for c in zip(*heads, strict=True)])

    @F.pandas_udf(T.IntegerType())
    def part(z: pd.Series, k: pd.Series, h: pd.Series) -> pd.Series:
        found = _as_bytes(z.to_numpy(), k.to_numpy(), h.to_numpy())
        return pd.Series(np.searchsorted(cuts, found, side="right").astype(np.int32) - 1)

    rows = docs.select("*", *_sort_key())
    table = rows.sparkSession.createDataFrame(
        [(*head, k - 1 if k else len(heads) - 1) for k, head in enumerate(heads)], "z boolean, k long, h long, part int"
    )
    # At most MOST_PARTS keys are broadcast; of equal rows one is carried.
    carried = rows.join(F.broadcast(table), ["z", "k", "h"]).groupBy("part").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text")
    )
    carried = carried.select("doc_id", "text", *_sort_key(), "part", F.lit(True).alias("carried"))
    marked = rows.select("*", part("z", "k", "h").alias("part"), F.lit(False).alias("carried"))
    dealt = marked.unionByName(carried).repartition(len(heads), "part")
    dealt = dealt.sortWithinPartitions("part", "carried", "z", "k", "h")
    return dealt.select("doc_id", "text", "part", "carried"), len(heads)


def edited(text: str, following: str) -> tuple[str, int]:
    """The last half of a text replaced from the next one, and where its first changed paragraph begins."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half], text.rfind("\n", 0, len(text) - half) + 1


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _RESULT]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT)


def edits(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints (binary) of every text and of its edited text, and how near both and the next one are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            done = []
            for doc_id, text, carried in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                own = of_text(text)
                if last is not None:
                    old_id, old, old_print = last
                    new, start = edited(old, text)
                    # Only the paragraphs from the first changed one on are exchanged.
                    if old[start:] == new[start:]:
                        new_print = old_print
                    else:
                        new_print = inserted(deleted(old_print, old[start:]), new[start:])
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    near = likeness(old_print, new_print), likeness(old_print, own)
                    done.append((old_id, len(old), sha, old_print, new_print, *near))
                last = None if carried else (doc_id, text, own)
            yield _compared(done)

    rows, _ = with_next(docs, part_bytes)
    return rows.select("doc_id", "text", "carried").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
        " near_edited double, near_next double",
    )


def op12_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text as lowercase hexadecimal digits."""
    found = edits(common.read_table(spark, sf_dir, "documents"))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return found.select("doc_id", "n_chars", "edited_sha256", *hexed, "near_edited", "near_next")
