"""Re-Pair grammar compression of token ids, with random access to documents.

Documents are dealt to ranges of ascending doc_id, tokenized, and cut into shards of
about a million ids. Each shard replaces frequent pairs of neighbouring ids by
nonterminals, round after round until no pair occurs ``LEAST_COUNT`` times or the rules
are used up, and keeps the rules with the number of ids each
expands to. No rule reaches over a document's end, so a document is a run of symbols
and any id inside it is found by adding up expansion lengths.

The file format is a Parquet table of shards (part, shard, n_docs, n_tokens, payload).
A payload holds, little-endian: magic ``RPR2``; seven u4 (documents, rules, rounds,
first nonterminal, symbol width in bytes, two spare) and two u8 (ids, symbols); rules
per round (u4); the rules (u4 pairs); their expansion lengths (u8); doc_id (i8), whether
it is null (u1), ids (u8) and first symbol (u8) of every document; the symbols.

Defined results: a null text counts as empty and has the end id only; a null doc_id
sorts first and stays null; repeated rows are separate documents, in the order of their
texts' hashes; an empty table gives an empty file set and no rows.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common
from finlake.session import job_dir

MAGIC = b"RPR2"
HEAD = struct.Struct("<4s7I2Q")
SHARD_IDS = 1 << 20
VOCABULARY = 49_408
# Rounds the rules are shared out over; later rounds may use all that are left.
ROUNDS = 5
# With the vocabulary's 49,408 ids this many rules still fit two-byte symbols.
MOST_RULES = 65_536 - VOCABULARY
LEAST_COUNT = 24
HASH_BITS = 18

SHARDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _frequent(seq: np.ndarray, ends: np.ndarray, room: int, least: int):
    """Positions and codes of pairs worth a rule, and those pairs.

    Pairs are first counted in hash buckets; only those of full buckets are counted
    exactly.
    """
    left, right = seq[:-1], seq[1:]
    bucket = ((left * 0x9E3779B1 + right * 0x85EBCA77) >> 9) & ((1 << HASH_BITS) - 1)
    free = ~ends[left]
    full = np.bincount(bucket[free], minlength=1 << HASH_BITS) >= least
    at = np.flatnonzero(free & full[bucket])
    code = left[at] << 32 | right[at]
    pairs, count = np.unique(code, return_counts=True)
    good = count >= least
    pairs, count = pairs[good], count[good]
    if len(pairs) > room:
        best = np.lexsort((pairs, -count))[:room]
        pairs = np.sort(pairs[best])
    return at, code, pairs


def _disjoint(at: np.ndarray) -> np.ndarray:
    """Which of ascending positions to take so that no two taken ones are neighbours."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1])
    runs = np.diff(np.concatenate([starts, [len(at)]]))
    return (np.arange(len(at)) - np.repeat(starts, runs)) % 2 == 0


def compress(
    ids: np.ndarray,
    doc_tokens: np.ndarray,
    vocabulary: int = VOCABULARY,
    rounds: int = ROUNDS,
    most_rules: int = MOST_RULES,
    least: int = LEAST_COUNT,
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Symbols, the rules of each round, expansion lengths, first symbol of each document.

    Every document's last id must differ from its inner ids or mark an end wherever it
    occurs: pairs never start with it.
    """
    seq = ids.astype(np.int64)
    lengths = [np.ones(vocabulary, np.int64)]
    ends = np.zeros(vocabulary, bool)
    if len(seq):
        ends[np.unique(seq[np.cumsum(doc_tokens) - 1])] = True
    rules: list[np.ndarray] = []
    first, left_over = vocabulary, most_rules
    for n in itertools.count():
        if len(seq) < 2 or left_over <= 0:
            break
        room = max(1, left_over // max(1, min(3, rounds - n)))
        at, code, pairs = _frequent(seq, ends, room, least)
        if not len(pairs):
            break
        which = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
        match = pairs[which] == code
        at, which = at[match], which[match]
        keep = _disjoint(at)
        at, which = at[keep], which[keep]
        used, rule = np.unique(which, return_inverse=True)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq[at] = first + rule
        seq = seq[stay]
        made = np.stack([pairs[used] >> 32, pairs[used] & 0xFFFFFFFF], axis=1)
        known = np.concatenate(lengths)
        rules.append(made)
        lengths.append(known[made].sum(axis=1))
        ends = np.concatenate([ends, ends[made[:, 1]]])
        first += len(used)
        left_over -= len(used)
    known = np.concatenate(lengths)
    stops = np.cumsum(known[seq])
    begins = np.cumsum(doc_tokens) - doc_tokens
    symbol_at = np.searchsorted(stops, begins, side="right")
    return seq, rules, known[vocabulary:], symbol_at


def to_payload(doc_ids: list, doc_tokens: np.ndarray, ids: np.ndarray, vocabulary: int = VOCABULARY) -> bytes:
    """One shard in the file format."""
    seq, rules, lengths, symbol_at = compress(ids, doc_tokens, vocabulary)
    width = 2 if vocabulary + len(lengths) <= 65_536 else 4
    head = HEAD.pack(
        MAGIC, len(doc_ids), len(lengths), len(rules), vocabulary, width, 0, 0, len(ids), len(seq)
    )
    none = np.array([d is None for d in doc_ids], dtype="u1")
    return b"".join(
        [
            head,
            np.array([len(r) for r in rules], dtype="<u4").tobytes(),
            (np.concatenate(rules) if rules else np.zeros((0, 2))).astype("<u4").tobytes(),
            lengths.astype("<u8").tobytes(),
            np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
            none.tobytes(),
            doc_tokens.astype("<u8").tobytes(),
            symbol_at.astype("<u8").tobytes(),
            seq.astype(f"<u{width}").tobytes(),
        ]
    )


class Shard:
    """A payload read back; decodes whole shards, documents, or some ids of a document."""

    def __init__(self, payload: bytes):
        magic, docs, n_rules, rounds, self.vocabulary, width, _, _, self.n_tokens, symbols = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a Re-Pair shard")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, count, at)
            at += found.nbytes
            return found

        self.rounds = take("<u4", rounds)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths = take("<u8", n_rules).astype(np.int64)
        doc_ids, none = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(doc_ids, none, strict=True)]
        self.doc_tokens = take("<u8", docs).astype(np.int64)
        self.symbol_at = take("<u8", docs).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids some symbols stand for, taking the rounds back last to first."""
        seq = symbols.astype(np.int64)
        high = self.vocabulary + len(self.rules)
        for size in self.rounds[::-1].astype(np.int64):
            low = high - size
            made = (seq >= low) & (seq < high)
            if made.any():
                wide = np.repeat(seq, 1 + made)
                pair = self.rules[seq[made] - self.vocabulary]
                at = np.flatnonzero(made) + np.arange(len(pair))
                wide[at], wide[at + 1] = pair[:, 0], pair[:, 1]
                seq = wide
            high = low
        return seq.astype("<u4")

    def ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the k-th document, expanding only the symbols that hold them."""
        stop = int(self.doc_tokens[k]) if stop is None else stop
        low = int(self.symbol_at[k])
        high = int(self.symbol_at[k + 1]) if k + 1 < len(self.symbol_at) else len(self.symbols)
        own = self.symbols[low:high].astype(np.int64)
        size = np.where(own < self.vocabulary, 1, self.lengths[np.maximum(own - self.vocabulary, 0)]) if len(
            self.lengths
        ) else np.ones(len(own), np.int64)
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - before : stop - before]


def _shards(path: str, shard_ids: int):
    """Partition function: tokenized documents, in order, as shards."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        end = np.array([common.END_ID], dtype="<u4").tobytes()
        bpe = common.word_bpe(path)
        ids: list[bytes] = []
        doc_ids: list = []
        held, shard = 0, 0

        def out() -> pd.DataFrame:
            tokens = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            every = np.frombuffer(b"".join(ids), dtype="<u4")
            payload = to_payload(doc_ids, tokens, every, max(VOCABULARY, int(every.max()) + 1))
            return pd.DataFrame(
                {"part": [part], "shard": [shard], "n_docs": [len(ids)], "n_tokens": [len(every)], "payload": [payload]}
            )

        for batch in batches:
            rows = iter([None if pd.isna(d) else int(d) for d in batch["doc_id"]])
            for texts in common.in_slices(batch["text"].tolist()):
                for found in bpe.encode(texts):
                    ids.append(found + end)
                    doc_ids.append(next(rows))
                    held += len(ids[-1]) // 4
                    if held >= shard_ids:
                        yield out()
                        ids, doc_ids, held, shard = [], [], 0, shard + 1
        if ids:
            yield out()

    return run


def write(docs: DataFrame, path: str, vocabulary_file: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode documents (doc_id, text) in ascending doc_id order and write the shards."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    made = ranged.mapInPandas(_shards(common.tokenizer_path(vocabulary_file), shard_ids), SHARDS)
    made.write.parquet(path)


DECODED = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("at", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: place, number of ids, checksum, and the ids if wanted."""
    schema = DECODED if with_ids else T.StructType(DECODED.fields[:-1])

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, number, payload in zip(batch["part"], batch["shard"], batch["payload"], strict=True):
                shard = Shard(payload)
                every = shard.ids()
                stops = np.cumsum(shard.doc_tokens)
                starts = stops - shard.doc_tokens
                parts = [every[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]
                frame = pd.DataFrame(
                    {
                        "part": part,
                        "shard": number,
                        "at": starts,
                        "doc_id": pd.array(shard.doc_ids, dtype="Int64"),
                        "n_tokens": shard.doc_tokens,
                        "ids_crc32": [common.crc_of(x) for x in parts],
                    }
                )
                if with_ids:
                    frame["ids"] = parts
                yield frame

    return spark.read.schema(SHARDS).parquet(path).select("part", "shard", "payload").mapInPandas(decode, schema)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard, from the shards' sizes alone.

    The totals of the parts (one row per written partition) are added up first, then
    the shards of each part, so no task sees all shards.
    """
    from pyspark.sql import Window

    sizes = spark.read.schema(SHARDS).parquet(path).select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    return own.join(parts, "part").select("part", "shard", (F.col("base") + F.col("inner")).alias("base"))


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document of ``documents``, from the files read back."""
    path = job_dir(spark, "repair")
    write(common.read_table(spark, sf_dir, "documents"), path)
    rows = read(spark, path, with_ids=False).join(shard_starts(spark, path), ["part", "shard"])
    return rows.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
