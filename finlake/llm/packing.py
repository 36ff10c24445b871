"""Packing of token ids into fixed windows by non-negative least squares.

Documents are cut into full windows and a remainder. Remainders fall into length
classes; shallow combinations of classes that fill a window are enumerated, their
repeat counts solved against the histogram of classes by non-negative least squares and
rounded down, and what is left is packed greedily on the histogram. The plan is a table
of slots whose size depends on the window alone. Each piece finds its slot by its rank
among the pieces of its class, so pieces are never gathered anywhere: ranks are counted
per partition while tokenizing and put together from per-partition counts.

Defined results: a null text is empty and has the end id alone; null and repeated
doc_ids are packed like any other (``row_id`` tells repeated rows apart); an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

WINDOW = 4096
CLASS_WIDTH = 16
# Deeper combinations use two lengths only, repeated up to this often together.
DEEPEST = 8

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def _pieces(path: str, window: int, width: int, with_ids: bool):
    """Partition function: documents to pieces, ranked within partition and class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        end = np.array([common.END_ID], dtype="<u4").tobytes()
        bpe = common.word_bpe(path)
        seen = np.zeros(window // width + 1, np.int64)
        row = 0
        for batch in batches:
            ids_of = iter([None if pd.isna(d) else int(d) for d in batch["doc_id"]])
            for texts in common.in_slices(batch["text"].tolist()):
                out = []
                for found in bpe.encode(texts):
                    found += end
                    doc_id, tokens = next(ids_of), len(found) // 4
                    for start in range(0, tokens, window):
                        piece = found[4 * start : 4 * (start + window)]
                        length = len(piece) // 4
                        kind = -(-length // width)
                        out.append(
                            (doc_id, (part << 40) + row, start, length, common.crc_of(piece), tokens, part, kind)
                            + (seen[kind],)
                            + ((piece,) if with_ids else ())
                        )
                        seen[kind] += 1
                    row += 1
                frame = pd.DataFrame(out, columns=PIECES.names if with_ids else PIECES.names[:-1])
                frame["doc_id"] = pd.array([x[0] for x in out], dtype="Int64")
                yield frame

    return run


def combinations(units: int) -> list[tuple[int, ...]]:
    """Multisets of class sizes that fill the window exactly: up to three of any size,
    or two sizes repeated up to DEEPEST times together."""
    found = {(units,)}
    for a in range(1, units // 2 + 1):
        found.add((units - a, a))
        for b in range(a, (units - a) // 2 + 1):
            found.add((units - a - b, b, a))
    for m, n in itertools.product(range(1, DEEPEST), range(0, DEEPEST)):
        if m + n <= DEEPEST:
            for a in range(1, units // m + 1):
                rest = units - m * a
                if n == 0 and rest == 0:
                    found.add((a,) * m)
                elif n and rest > 0 and rest % n == 0:
                    found.add(tuple(sorted((a,) * m + (rest // n,) * n, reverse=True)))
    return sorted(found, reverse=True)


def nnls(a: np.ndarray, b: np.ndarray, steps: int | None = None) -> np.ndarray:
    """Non-negative least squares by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x = np.zeros(n)
    free = np.zeros(n, bool)
    scale = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps or 3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= scale:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            ratio = x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-300)
            x[at] += ratio.min() * (z - x[at])
            free[at[x[at] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of classes with repeat counts that use up a histogram of classes.

    histogram[c] is the number of pieces of class c; index 0 is unused and the last
    class is the full window.
    """
    units = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    found: list[tuple[tuple[int, ...], int]] = []
    if left[units]:
        found.append(((units,), int(left[units])))
        left[units] = 0
    present = np.flatnonzero(left)
    shallow = [c for c in combinations(units)[1:] if all(left[s] for s in c)]
    if len(present) and shallow:
        row = {int(c): k for k, c in enumerate(present)}
        a = np.zeros((len(present), len(shallow)))
        for k, combination in enumerate(shallow):
            for size in combination:
                a[row[size], k] += 1
        counts = np.floor(nnls(a, left[present].astype(float)) + 1e-9).astype(np.int64)
        for combination, count in zip(shallow, counts, strict=True):
            sizes, times = np.unique(combination, return_counts=True)
            count = int(min(count, (left[sizes] // times).min()))
            if count > 0:
                found.append((combination, count))
                left[sizes] -= count * times
    while left.any():  # each turn uses up one class at least
        room, pattern, free = units, [], left.copy()
        while room:
            fits = np.flatnonzero(free[: room + 1])
            if not len(fits):
                break
            size = int(fits[-1])
            times = int(min(free[size], room // size))
            pattern += [size] * times
            free[size] -= times
            room -= size * times
        sizes, times = np.unique(pattern, return_counts=True)
        count = int((left[sizes] // times).min())
        found.append((tuple(pattern), count))
        left[sizes] -= count * times
    return found


def slots(patterns: list[tuple[tuple[int, ...], int]], units: int) -> dict[int, np.ndarray]:
    """Per class, rows of (first rank, first sequence, place in the pattern)."""
    made: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(units + 1, np.int64)
    sequence = 0
    for pattern, count in patterns:
        for place, size in enumerate(pattern):
            made.setdefault(size, []).append((int(used[size]), sequence, place))
            used[size] += count
        sequence += count
    return {size: np.array(rows, dtype=np.int64) for size, rows in made.items()}


def _placed(table: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.zeros(len(batch), np.int64)
            place = np.zeros(len(batch), np.int64)
            kinds, rank = batch["class"].to_numpy(), (batch["rank"] + batch["base"]).to_numpy()
            for kind in np.unique(kinds):
                at = np.flatnonzero(kinds == kind)
                rows = table[int(kind)]
                k = np.searchsorted(rows[:, 0], rank[at], side="right") - 1
                sequence[at] = rows[k, 1] + rank[at] - rows[k, 0]
                place[at] = rows[k, 2]
            out = batch.drop(columns=["part", "class", "rank", "base"])
            yield out.assign(sequence_id=sequence, place=place)

    return run


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    width: int = CLASS_WIDTH,
    vocabulary_file: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents (doc_id, text) with their sequence and place in it.

    Columns: doc_id, row_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id,
    offset. Every id of every document lies in exactly one piece.
    """
    if window % width:
        raise ValueError("the class width must divide the window")
    units = window // width
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = PIECES if with_ids else T.StructType(PIECES.fields[:-1])
    run = _pieces(common.tokenizer_path(vocabulary_file), window, width, with_ids)
    pieces, _ = common.stored(rows.mapInPandas(run, schema), "pieces")
    counts = pieces.groupBy("part", "class").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(units + 1, np.int64)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():  # a row per class
        histogram[row["class"]] = row["n"]
    table = slots(plan(histogram), units)
    kept = [f for f in schema.fields if f.name not in ("part", "class", "rank")]
    out = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("place", T.LongType())])
    placed = pieces.join(bases, ["part", "class"]).mapInPandas(_placed(table), out)
    order = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0))).drop("place")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of ``documents`` and where it is packed."""
    packed = pack(common.read_table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row_id"
    )
