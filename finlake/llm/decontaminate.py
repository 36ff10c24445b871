"""Benchmark decontamination by a BM25 inverted index with block-max WAND.

The index holds the test items, cut into entries of some fifty words; posting weights
are BM25 weights divided by their entry's total, so a score is the share of an entry a
passage covers and one threshold fits all entries. Every document is cut into
overlapping passages, each passage is a query, and every entry at or above the threshold
is retrieved: passages for which no block of entries can reach the threshold, by the sum
of its terms' block maxima, fall out in one vectorised step; the others go through WAND.
Each retrieved item is verified where it was found, on the passage and as many words around it as
the item is long: a stretch that holds ``SIDE`` of the question's words and of the answer's
words, weighted by their rarity, convicts, in whatever order they stand, so rewordings are found
that share few shingles. A document may also hold an item in pieces that lie passages apart, which no
passage shows: items of whose hashed five-word shingles it has ``OVERLAP`` are
added, whatever its passages score.

The index is built and searched in shards of bounded size, one scan of the documents per
shard, so what is sent to executors never grows with the benchmark.

Defined results: null or empty texts match nothing; items without words are skipped; an
item shorter than a shingle is one shingle; repeated items (same item_id and text) count
once; rows with equal doc_id are reported once per item with their best score; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

K1, B = 1.2, 0.75
ENTRY_WORDS = 48
PASSAGE_WORDS = 96
STRIDE = 32
THRESHOLD = 0.6
SHINGLE = 5
OVERLAP = 0.8
# Share of the rarity of a question's and of an answer's words that a retrieved stretch must hold.
SIDE = 0.8
# Postings of a block within a term's list, and entries of a block in the table of bounds.
BLOCK = 16
BLOCK_ENTRIES = 4
# Steps of a bound: the sum over a passage's words fits sixteen bits.
STEPS = 65_535 // PASSAGE_WORDS
# Postings of one shard of the index; a shard is what a task holds.
SHARD_POSTINGS = 32_000
# Words whose bounds are added up at once.
SLICE_WORDS = 30_000
# Odd factor of the polynomial over word numbers that hashes a shingle.
FACTOR = 0x9E3779B97F4A7C15

_PUNCTUATION = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates like white space."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split()


def question_words(text: str) -> int:
    """How many words of an item are its question: up to the last question mark that is
    followed by words, else up to the last sentence; all of them if there is one sentence."""
    body = text.rstrip().rstrip(".?!").rstrip()
    for mark in ("?", ".", "!", "\n"):
        cut = body.rfind(mark)
        if cut >= 0 and words_of(body[:cut]) and words_of(body[cut:]):
            return len(words_of(body[:cut]))
    return len(words_of(text))


def entries_of(words: list[bytes], size: int = ENTRY_WORDS) -> list[list[bytes]]:
    """Consecutive pieces of an item; a short last one is joined to the one before."""
    count = max(1, (len(words) + size // 2) // size)
    return [words[k * size : (k + 1) * size if k + 1 < count else None] for k in range(count)]


def shingles(words: list[bytes]) -> list[bytes]:
    if len(words) < SHINGLE:
        return [b" ".join(words)]
    return [b" ".join(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)]


class Index:
    """Postings of a shard's entries, ordered by entry, with maxima per term and block."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[bytes, float], mean_words: float):
        self.items = items
        self.words = [words_of(t) for _, t in items]
        self.item_of: list[int] = []
        rows: list[tuple[bytes, int, float]] = []
        for item, words in enumerate(self.words):
            for entry in entries_of(words):
                norm = K1 * (1 - B + B * len(entry) / mean_words)
                terms, counts = np.unique(np.array(entry, dtype=object), return_counts=True)
                weights = np.array([idf[t] for t in terms]) * counts * (K1 + 1) / (counts + norm)
                number = len(self.item_of)
                self.item_of.append(item)
                rows += zip(terms, [number] * len(terms), weights / weights.sum(), strict=True)
        rows.sort(key=lambda r: (r[0], r[1]))
        self.term_id = {t: k for k, t in enumerate(dict.fromkeys(r[0] for r in rows))}
        term = np.array([self.term_id[r[0]] for r in rows], dtype=np.int64)
        self.entry = np.array([r[1] for r in rows], dtype=np.int64)
        self.weight = np.array([r[2] for r in rows], dtype=np.float64)
        self.first = np.searchsorted(term, np.arange(len(self.term_id) + 1))
        # The last term stands for every unknown word and has no postings.
        self.top = np.zeros(len(self.term_id) + 1)
        np.maximum.at(self.top, term, self.weight)
        blocks = -(-len(self.item_of) // BLOCK_ENTRIES)
        # Rounded up to whole steps, so that a sum over a passage is never too low.
        self.block_top = np.zeros((len(self.term_id) + 1, blocks), np.uint16)
        steps = np.minimum(np.ceil(self.weight * STEPS), STEPS).astype(np.uint16)
        np.maximum.at(self.block_top, (term, self.entry // BLOCK_ENTRIES), steps)
        self.lists = []
        for a, b in itertools.pairwise(self.first.tolist()):
            entries, weights = self.entry[a:b].tolist(), self.weight[a:b].tolist()
            ends, tops = [], []
            for k in range(0, b - a, BLOCK):
                ends.append(entries[min(k + BLOCK, b - a) - 1])
                tops.append(max(weights[k : k + BLOCK]))
            self.lists.append((entries, weights, ends, tops))
        self.parts = []
        for (_, text), words in zip(items, self.words, strict=True):
            own, asked = shingles(words), question_words(text)
            last_question = max(0, asked - SHINGLE + 1)
            self.parts.append((own, set(own[:last_question]) or set(own), set(own[last_question:]) or set(own)))
        self.shingle_counts = np.array([len(set(own)) for own, _, _ in self.parts])
        self.rarity = np.array([idf[t] for t in self.term_id] + [0.0])
        self.sides = []
        for (_, text), words in zip(items, self.words, strict=True):
            ids, asked = np.array([self.term_id[w] for w in words], dtype=np.int64), question_words(text)
            self.sides.append((np.unique(ids[:asked]), np.unique(ids[asked:] if asked < len(ids) else ids)))
        self._hash_shingles()

    def _hash_shingles(self) -> None:
        """Hashes of the shard's shingles, and for each the items that have it.

        The factor is changed until different shingles have different hashes, so no item
        has fewer hashes than shingles; a foreign shingle that hits one is seen by the check.
        """
        items_of: dict[bytes, list[int]] = {}
        for item, (own, _, _) in enumerate(self.parts):
            for shingle in set(own):
                items_of.setdefault(shingle, []).append(item)
        self.lengths = sorted({min(len(w), SHINGLE) for w in self.words})
        ids = [np.array([self.term_id[t] for t in s.split()], dtype=np.uint64) for s in items_of]
        self.factor = FACTOR
        while True:
            hashes = np.array([self._hashes(x, len(x))[0] for x in ids], dtype=np.uint64)
            self.hashes, at = np.unique(hashes, return_index=True)
            if len(self.hashes) == len(hashes):
                break
            self.factor = (self.factor + 2) % 2**64
        held = list(items_of.values())
        self.hash_first = np.concatenate([[0], np.cumsum([len(held[k]) for k in at])])
        self.hash_items = np.array([i for k in at for i in held[k]], dtype=np.int64)

    def _hashes(self, ids: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all runs of ``length`` word numbers, modulo 2**64."""
        runs = len(ids) - length + 1
        total = np.full(runs, length, np.uint64)
        for k in range(length):
            total = total * np.uint64(self.factor) + ids[k : k + runs].astype(np.uint64) + np.uint64(1)
        return total

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Entries scoring the threshold or more for distinct terms, by block-max WAND."""
        live = [[self.lists[t][0][0], 0, 0, self.top[t], self.lists[t]] for t in terms]
        found = []
        while True:
            live.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, cursor in enumerate(live):
                bound += cursor[3]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            entry = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == entry:
                pivot += 1
            # Block maxima around the pivot entry, and how far those blocks reach.
            bound, reach = 0.0, None
            for cursor in live[: pivot + 1]:
                ends, block = cursor[4][2], cursor[2]
                while block < len(ends) and ends[block] < entry:
                    block += 1
                cursor[2] = block
                if block < len(ends):
                    bound += cursor[4][3][block]
                    reach = ends[block] if reach is None else min(reach, ends[block])
            if bound < threshold:
                after = live[pivot + 1][0] if pivot + 1 < len(live) else None
                goal = entry + 1 if reach is None else reach + 1
                goal = max(entry + 1, goal if after is None else min(goal, after))
                moving = live[: pivot + 1]
            elif live[0][0] == entry:
                score = sum(c[4][1][c[1]] for c in live[: pivot + 1])
                if score >= threshold:
                    found.append((entry, score))
                goal, moving = entry + 1, live[: pivot + 1]
            else:
                goal, moving = entry, [c for c in live[:pivot] if c[0] < entry]
            done = False
            for cursor in moving:
                entries, at = cursor[4][0], max(cursor[1], cursor[2] * BLOCK)
                while at < len(entries) and entries[at] < goal:
                    at += 1
                cursor[1] = at
                cursor[0] = entries[at] if at < len(entries) else -1
                done |= cursor[0] < 0
            if done:
                live = [c for c in live if c[0] >= 0]

    def survivors(self, docs: list[np.ndarray], threshold: float) -> Iterator[tuple[int, int]]:
        """(document, start) of the passages in which some block of entries may reach the threshold.

        A passage is three strides. A word counts in a passage where it occurs first,
        so for each of the three strides that a passage may begin before the word, the
        word counts if its previous occurrence lies before that begin.
        """
        span = PASSAGE_WORDS // STRIDE
        strides = np.array([-(-len(d) // STRIDE) for d in docs])
        offset = np.cumsum(strides) - strides
        of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        at = np.concatenate([np.arange(len(d)) for d in docs])
        ids = np.concatenate(docs)
        known = ids != len(self.term_id)
        of, at, ids = of[known], at[known], ids[known]
        if not len(ids):
            return
        order = np.argsort(of * (len(self.term_id) + 1) + ids, kind="stable")
        same = (of[order[1:]] == of[order[:-1]]) & (ids[order[1:]] == ids[order[:-1]])
        before = np.full(len(ids), -1)
        before[order[1:][same]] = at[order[:-1][same]] // STRIDE
        stride = at // STRIDE
        cell = offset[of] + stride
        total = np.zeros((int(strides.sum()), self.block_top.shape[1]), np.uint16)
        for back in range(span):
            counts = np.flatnonzero((stride - back > before) & (stride >= back))
            if not len(counts):
                continue
            own = cell[counts]
            firsts = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[firsts] - back] += np.add.reduceat(self.block_top[ids[counts]], firsts, axis=0, dtype=np.uint16)
        for k in np.flatnonzero((total >= int(threshold * STEPS)).any(axis=1)).tolist():
            doc = int(np.searchsorted(offset, k, side="right")) - 1
            yield doc, (k - int(offset[doc])) * STRIDE

    def side_shares(self, region: np.ndarray, item: int) -> tuple[float, float]:
        """Shares of an item's question and answer, by the rarity of their words, that a stretch holds."""
        shares = []
        for own in self.sides[item]:
            weights = self.rarity[own]
            shares.append(float(weights[np.isin(own, region)].sum() / weights.sum()))
        return shares[0], shares[1]

    def candidates(self, docs: list[np.ndarray], threshold: float) -> list[dict[int, tuple[float, float, float]]]:
        """Per document, items with an entry at or above the threshold in some passage: their best
        score, and the shares of question and answer of the stretch that holds most of both."""
        best: list[dict[int, tuple[float, float, float]]] = [{} for _ in docs]
        unknown = len(self.term_id)
        for doc, start in self.survivors(docs, threshold):
            terms = np.unique(docs[doc][start : start + PASSAGE_WORDS])
            terms = terms[terms != unknown]
            scores: dict[int, float] = {}
            for entry, score in self.wand(terms.tolist(), threshold):
                item = self.item_of[entry]
                scores[item] = max(score, scores.get(item, 0.0))
            for item, score in scores.items():
                around = len(self.words[item])
                region = docs[doc][max(0, start - around) : start + PASSAGE_WORDS + around]
                known = best[doc].get(item, (0.0, 0.0, 0.0))
                sides = known[1:] if min(known[1:]) >= 1 else max(known[1:], self.side_shares(region, item), key=min)
                best[doc][item] = max(score, known[0]), *sides
        return best

    def sharing(self, docs: list[np.ndarray]) -> list[list[int]]:
        """Per document, items of whose shingles it has ``OVERLAP`` or more, wherever they stand."""
        found: list[list[int]] = [[] for _ in docs]
        of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        ids = np.concatenate(docs)
        unknown = np.concatenate([[0], np.cumsum(ids == len(self.term_id))])
        hits = []
        for length in self.lengths:
            if len(ids) < length:
                continue
            within = of[: len(ids) - length + 1] == of[length - 1 :]
            at = np.flatnonzero(within & (unknown[length:] == unknown[:-length]))
            own = self._hashes(ids, length)[at]
            place = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            hit = self.hashes[place] == own
            hits.append(of[at[hit]] * len(self.hashes) + place[hit])
        both = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)
        doc, place = both // len(self.hashes), both % len(self.hashes)
        for k in np.unique(doc).tolist():
            own = place[slice(*np.searchsorted(doc, [k, k + 1]))]
            sizes = self.hash_first[own + 1] - self.hash_first[own]
            at = np.repeat(self.hash_first[own + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            shared = np.bincount(self.hash_items[at], minlength=len(self.items))
            found[k] = np.flatnonzero(shared / self.shingle_counts >= OVERLAP).tolist()
        return found

    def score(self, doc: np.ndarray, item: int) -> float:
        """The largest share of an entry of the item that a passage of the document covers."""
        own = np.flatnonzero(np.array(self.item_of)[self.entry] == item)
        terms, row = np.unique(np.searchsorted(self.first, own, side="right") - 1, return_inverse=True)
        entries, column = np.unique(self.entry[own], return_inverse=True)
        weights = np.zeros((len(terms), len(entries)))
        weights[row, column] = self.weight[own]
        row_of = np.full(len(self.term_id) + 1, -1)
        row_of[terms] = np.arange(len(terms))
        rows, best = row_of[doc], 0.0
        for start in range(0, len(doc), STRIDE):
            passage = np.unique(rows[start : start + PASSAGE_WORDS])
            best = max(best, float(weights[passage[passage >= 0]].sum(axis=0).max()))
        return best

    def _verified(self, words: list[bytes], best: dict[int, tuple[float, float, float]]) -> list[tuple]:
        held = set(shingles(words)) if len(words) >= SHINGLE else set()
        found = []
        for item, (score, question_words, answer_words) in sorted(best.items()):
            own, question, answer = self.parts[item]
            own_set = set(own)
            if len(self.words[item]) < SHINGLE:
                joined = b" " + b" ".join(words) + b" "
                held = held | {s for s in own_set if b" " + s + b" " in joined}
            whole = len(own_set & held) / len(own_set)
            asked, answered = len(question & held) / len(question), len(answer & held) / len(answer)
            # An item shorter than a shingle is its few words, in order.
            worded = len(self.words[item]) >= SHINGLE and min(question_words, answer_words) >= SIDE
            if whole >= OVERLAP or worded:
                found.append((self.items[item][0], score, whole, asked, answered, question_words, answer_words))
        return found

    def matches(self, texts: list[str | None], threshold: float) -> list[list[tuple]]:
        """Per text, the verified items: item, score, the shingle overlaps of the whole, its question and
        its answer, and the word shares of question and answer in the retrieved stretch (0: not retrieved)."""
        found: list[list] = []
        words: list[list[bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            unknown = itertools.repeat(len(self.term_id))
            ids = [np.array(list(map(self.term_id.get, w, unknown)), dtype=np.int64) for w in words]
            best = self.candidates(ids, threshold) if ids else []
            for own, doc, items in zip(best, ids, self.sharing(ids) if ids else [], strict=True):
                own.update({item: (self.score(doc, item), 0.0, 0.0) for item in items if item not in own})
            found.extend(self._verified(w, b) if b else [] for w, b in zip(words, best, strict=True))
            words.clear()
            size = 0

        for text in texts:
            words.append(words_of(text))
            size += len(words[-1])
            if size >= SLICE_WORDS:
                flush()
        flush()
        return found


def shards(benchmark: DataFrame) -> Iterator[Index]:
    """The index, shard by shard; statistics are over all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items, _ = common.stored(items.where("text is not null").distinct(), "benchmark")

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                for entry in entries_of(words_of(text)):
                    for k, term in enumerate(set(entry)):
                        rows.append((term.decode("utf-8", "replace"), 0 if k else len(entry), int(not k)))
            yield pd.DataFrame(rows, columns=["term", "n_words", "is_first"])

    schema = "term string, n_words long, is_first long"
    terms = items.mapInPandas(entries, schema)
    total = terms.agg(F.sum("is_first"), F.sum("n_words"), F.count("*")).first()
    n_entries, n_words, n_postings = (int(x or 0) for x in total)
    count = -(-n_postings // SHARD_POSTINGS)
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    for shard in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == shard)
        # A shard's items and the document frequencies of their terms: bounded by SHARD_POSTINGS.
        held = df.join(own.mapInPandas(entries, schema).select("term").distinct(), "term")
        idf = {
            r["term"].encode(): float(np.log(1 + (n_entries - r["df"] + 0.5) / (r["df"] + 0.5))) for r in held.collect()
        }
        rows = [(r["item_id"], r["text"]) for r in own.collect() if words_of(r["text"])]
        if rows:
            yield Index(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), idf, n_words / n_entries)


MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        *[
            T.StructField(n, T.DoubleType())
            for n in ("score", "overlap", "question_overlap", "answer_overlap", "question_words", "answer_words")
        ],
    ]
)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified (doc_id, item_id) pairs with BM25 share and shingle overlaps."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], MATCHES)
    for index in shards(benchmark):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [
                    (None if pd.isna(d) else int(d), *match)
                    for d, found in zip(batch["doc_id"], held.value.matches(batch["text"].tolist(), threshold), strict=True)
                    for match in found
                ]
                frame = pd.DataFrame(rows, columns=MATCHES.names)
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        part, _ = common.stored(texts.mapInPandas(run, MATCHES), "matches")
        held.unpersist()
        found = found.unionByName(part)
    best = [F.max(c).alias(c) for c in MATCHES.names[2:]]
    return found.groupBy("doc_id", "item_id").agg(*best)


def leaked_column(spark: SparkSession, index: Index, text: F.Column, threshold: float = THRESHOLD) -> F.Column:
    """Whether a text holds an item of a shard."""
    held = spark.sparkContext.broadcast(index)

    @F.pandas_udf(T.BooleanType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(m) for m in held.value.matches(texts.tolist(), threshold)], dtype=bool)

    return run(text)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that hold no item; each row is judged by its own text."""
    for index in shards(benchmark):
        docs = docs.where(~leaked_column(docs.sparkSession, index, F.col("text"), threshold))
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in whole documents."""
    return contaminated(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark"))
