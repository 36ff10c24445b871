"""Helpers the training-data operators share: job tables, word counts, tokenizing."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import job_dir
from finlake.sources import files

END_ID = 2
# Rows of an Arrow batch: a worker holds that many whole texts at once.
BATCH_ROWS = 1_000


def stored(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a frame below the shared folder and read it back, with its path.

    Cuts the lineage: whatever executor is lost later, the rows are in the folder.
    """
    spark = frame.sparkSession
    path = job_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    files.remove(spark, path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table; whole texts then reach Python in batches of bounded rows."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed_clear(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns, so that extra ones never clash with an operator's own."""
    return frame.select(*[F.col(f"`{c}`") for c in columns])


def training_row(doc_id) -> F.Column:
    """Rows a model may learn labels from: crc32 of the id as text is no multiple of 5."""
    return ~held_out(doc_id)


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text is a multiple of 5; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def tokenizer_path(path: str | None = None) -> str:
    """The vocabulary file; by default the installed public word BPE."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# How the installed word BPE normalizes and splits text, as its file states it.
_NORMALIZERS = ["NFC", {"Regex": "\\s+"}, "Lowercase"]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Character classes up to U+00FF, which never change: white space, letters, digits, the rest.
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
_CLASS[[*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] += 32
# Words of up to 16 letters are kept in a table of this many places, each holding the
# last word that fell there; its ids lie in a pool that starts anew when it is full.
_PLACE_BITS = 20
_POOL = 1 << 22
_WORD = 16
# Masks that keep the first n bytes of a word's two halves.
_LOW = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(_WORD + 1)], np.uint64)
_HIGH = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(_WORD + 1)], np.uint64)


def _byte_letters() -> dict[int, str]:
    """The printable letter byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class WordBpe:
    """Ids of whole texts by a vocabulary that drops white space.

    Such a vocabulary encodes each word alone. Latin-1 texts are split into words here,
    by the rule of the vocabulary's own file, and a word's ids are looked up once and
    reused. Other texts, texts that may hold a special token, a contraction or a NUL, and
    vocabularies with another rule go through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            rule = json.load(file)
        steps = (rule.get("normalizer") or {}).get("normalizers", [])
        splits = (rule.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = [s.get("pattern", s["type"]) for s in steps] == _NORMALIZERS and (
            splits[0].get("pattern", {}).get("Regex") == _SPLIT
        )
        self.letters = _byte_letters()
        # Per place: the two halves of a word, then where its ids begin and how many they are.
        self.table = np.zeros((1 << _PLACE_BITS, 3), np.uint64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _word(self, latin: bytes) -> list[int]:
        mapped = "".join([self.letters[b] for b in latin.decode("latin-1").encode()])
        return [t.id for t in self.model.tokenize(mapped)]

    def _keep(self, ids: list[int]) -> int:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool) + len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _by_word(self, texts: list[bytes]) -> list[bytes]:
        """Ids of Latin-1 texts, all words of the slice at once."""
        if self.used > _POOL:
            self.used = 0
            self.table[:] = 0
        sizes = np.array([len(t) + 1 for t in texts])
        lower = (b" ".join(texts) + b" " * (_WORD + 1)).translate(_LOWER.tobytes())
        raw = np.frombuffer(lower, np.uint8)
        kind = np.frombuffer(lower.translate(_CLASS.tobytes()), np.uint8)
        fresh = np.empty(len(kind), bool)
        fresh[0] = True
        np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
        fresh |= kind == _DIGIT
        edges = np.flatnonzero(fresh)
        lengths = np.diff(edges, append=len(kind))
        real = kind[edges] != _SPACE
        start, length = edges[real], lengths[real]
        begins = np.cumsum(sizes) - sizes
        first = np.searchsorted(start, np.append(begins, len(raw)))
        kept = np.minimum(length, _WORD)
        words = np.lib.stride_tricks.sliding_window_view(raw, _WORD)[start].view("<u8")
        low, high = words[:, 0] & _LOW[kept], words[:, 1] & _HIGH[kept]
        with np.errstate(over="ignore"):
            place = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
            place = ((place ^ (place >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(
                64 - _PLACE_BITS
            )
        place = place.astype(np.int64)
        long = length > _WORD
        found = self.table[place]
        hit = (found[:, 0] == low) & (found[:, 1] == high) & ~long
        at, size = (found[:, 2] >> np.uint64(32)).astype(np.int64), (found[:, 2] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        missed = np.flatnonzero(~hit)
        if len(missed):
            known: dict[bytes, tuple[int, int]] = {}
            for k, a, b in zip(missed.tolist(), start[missed].tolist(), length[missed].tolist(), strict=True):
                word = lower[a : a + b]
                if word not in known:
                    ids = self._word(word)
                    known[word] = (self._keep(ids), len(ids))
                at[k], size[k] = known[word]
            short = missed[~long[missed]]
            # Of several words for one place one stays, whole.
            spot, one = np.unique(place[short], return_index=True)
            short = short[one]
            self.table[spot, 0], self.table[spot, 1] = low[short], high[short]
            self.table[spot, 2] = (at[short] << 32 | size[short]).astype(np.uint64)
        stops = np.cumsum(size, dtype=np.int64)
        ids = self.pool[np.arange(stops[-1] if len(stops) else 0) + np.repeat(at - (stops - size), size)]
        ends = np.append(0, stops)[first].tolist()
        whole = ids.astype("<u4", copy=False).tobytes()
        return [whole[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers, without an end id."""
        found: list[bytes] = [b""] * len(texts)
        latin: list[tuple[int, bytes]] = []
        for k, text in enumerate(texts):
            odd = not self.by_word or "'" in text or "<|" in text or "\0" in text
            plain = None if odd else _latin(text)
            if plain is None:
                found[k] = self._whole([text])[0]
            else:
                latin.append((k, plain))
        if latin:
            for (k, _), ids in zip(latin, self._by_word([t for _, t in latin]), strict=True):
                found[k] = ids
        return found


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The tokenizer of a Python worker, read once."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def crc_of(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF


def in_slices(texts: list[str], most: int = 500_000) -> Iterator[list[str]]:
    """Consecutive texts of at most that many characters together, or a single longer one."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part
