"""Spelling variants by a relational trie frontier.

The words of the corpus are counted, and those that are long and frequent enough form two
tries, one of the words and one of the reversed words, kept as one edge table: depth,
node, letter, child, the number of words below and one of them. A node is the hash of
its direction and prefix, the end of a word an edge without a letter. States
(word, position, node, edits) are joined with the edges of their depth, level by level:
a state without edits goes on along its own word and branches, at a letter that differs,
into one replaced or one inserted letter; a state with an edit follows its own word only. An
edit is always made at the first letter that differs, so no pair is reached twice in a
trie. Of a pair with an edit in the word's first half the reversed words differ in their
second, so states start at half of their word: where tries are wide, nothing branches.
An edge with one word below is settled at once by comparing the rest of both words, so
levels end where prefixes become unique. Letters left out need no states of their own:
the longer word of a pair is found from the shorter one, and each pair is returned both ways.
Pairs are checked by their edit distance, which leaves hash collisions without effect.

Every level is written below the shared folder. Edge rows of a node are bounded by the
alphabet, so a node that a third of all states share makes no group, only a skewed
side of a join, which AQE splits.

Defined results: a null text has no words, a null doc_id counts as empty text before the
colon; repeated rows count again; texts of any length are read whole; an empty table, or one
without frequent words, gives no rows; other columns are ignored; among near words
of equal count the one that is smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import common

LEAST_LETTERS = 6
LEAST_COUNT = 5
FACTOR = 5
MODULUS = 199
# Counts a worker holds before it passes them on.
HELD_WORDS = 200_000
# Depths of the edge table made in one job; deeper ones only where prefixes are shared.
DEPTHS = 32


def run_counts(
    doc_id: str, text: str | None, least: int = LEAST_LETTERS, modulus: int = MODULUS
) -> Iterator[tuple[bytes, int]]:
    """Words of one text, as Latin-1 bytes, with counts; those that are too short are left out.

    A run whose checksum the modulus divides loses one letter, as the contract states.
    """
    # Letters beyond Latin-1 end a run, as the question marks do that take their places.
    runs = re.findall(rb"[a-z\xc0-\xff]{%d,}" % least, (text or "").encode("latin-1", "replace").lower())
    head = zlib.crc32(doc_id.encode() + b":")
    for run, n in Counter(runs).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if h % modulus:
            yield run, n
        elif len(run) > least:
            at = h % len(run)
            yield run[:at] + run[at + 1 :], n


def word_counts(
    docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT, modulus: int = MODULUS
) -> DataFrame:
    """word, n of the frequent words of documents (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[bytes, int] = {}

        def passed() -> pd.DataFrame:
            words = pd.Series([w.decode("latin-1") for w in total], dtype=object)
            return pd.DataFrame({"word": words, "n": list(total.values())})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                for word, n in run_counts(doc_id, text, least, modulus):
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD_WORDS:
                    yield passed()
                    total = {}
        yield passed()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    parts = rows.mapInPandas(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _node(depth: str) -> str:
    return f"xxhash64(back, substring(s, 1, {depth}))"


def edge_table(strings: DataFrame) -> DataFrame:
    """Edges (depth, node, letter, child, below, v) of the tries of ``strings`` (back, s).

    ``below`` counts the words under the edge, ``v`` is one of them. Depths are made in
    portions; a string enters the next portion only if it shares its prefix up to there.
    """
    table, part, low = None, strings, 0
    while True:
        # The end of a word is an edge at the depth of its length.
        steps = part.selectExpr(
            "back", "s",
            f"""inline(transform(sequence({low}, least(length(s), {low + DEPTHS - 1})), i -> struct(
                i AS depth, {_node('i')} AS node, substring(s, i + 1, 1) AS letter, {_node('i + 1')} AS child)))""",
        )
        made = steps.groupBy("depth", "node", "letter").agg(
            F.min("child").alias("child"), F.count("*").alias("below"), F.min("s").alias("v")
        )
        made, _ = common.stored(made, "spelling-edges")
        table = made if table is None else table.unionByName(made)
        low += DEPTHS
        shared = made.where((F.col("depth") == low - 1) & (F.col("below") > 1) & (F.col("letter") != ""))
        shared = shared.select(F.col("child").alias("node")).distinct()
        deeper = part.where(F.length("s") >= low).withColumn("node", F.expr(_node(str(low))))
        part, _ = common.stored(deeper.join(shared, "node", "left_semi").select("back", "s"), "spelling-deeper")
        if part.isEmpty():
            return table


def _level(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """States of the next depth; those whose search has ended carry the word they found in ``v``."""
    own = F.expr("substring(s, position + 1, 1)")
    exact = states.where("edits = 0").withColumn("own", own).join(edges, "node")
    edited = states.where("edits = 1").withColumn("letter", own).join(edges, ["node", "letter"])
    # What an exact state becomes along an edge: itself, a replaced letter (from the smaller
    # to the larger one, the pair is returned both ways), or an inserted one.
    become = F.expr(
        """filter(array(
             IF(letter = own AND below > 1, struct(position + 1 AS position, 0 AS edits), NULL),
             IF(own <> '' AND letter > own, struct(position + 1 AS position, 1 AS edits), NULL),
             IF(letter <> own, struct(position AS position, 1 AS edits), NULL)), x -> x IS NOT NULL)"""
    )
    exact = exact.where("letter <> ''").select("back", "s", "child", "below", "letter", "v", F.inline(become))
    edited = edited.select(
        "back", "s", "child", "below", "letter", "v", (F.col("position") + 1).alias("position"), "edits"
    )
    moved = exact.unionByName(edited)
    # One word below: the rest of both words is compared now. The end of a word needs no comparison.
    ended = F.expr("edits = 1 AND (below = 1 OR letter = '')")
    equal = F.expr(f"letter = '' OR substring(s, position + 1) = substring(v, {depth + 2})")
    return moved.where(~ended | equal).select(
        "back", "s", "position", F.col("child").alias("node"), "edits", F.when(ended, F.col("v")).alias("v")
    )


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near) of distinct words that differ by exactly one code point, both ways."""
    strings = words.select("word").selectExpr("inline(array(struct(false AS back, word AS s), struct(true AS back, reverse(word) AS s)))")
    strings, _ = common.stored(strings.distinct(), "spelling-strings")
    edges = edge_table(strings)
    # An edit at position p of n leaves n - 1 - p letters (one more if it inserts) behind it.
    start = "int(IF(back, length(s) - length(s) DIV 2, length(s) DIV 2))"
    ready = strings.select("back", "s", F.expr(start).alias("position")).withColumn("node", F.expr(_node("position")))
    ready = ready.select("back", "s", "position", "node", F.lit(0).alias("edits"))
    last = ready.agg(F.max("position")).first()[0]
    found, states, depth = None, None, 0
    while last is not None:
        here = ready.where(F.col("position") == depth)
        states = here if states is None else states.unionByName(here)
        after, _ = common.stored(_level(states, edges.where(F.col("depth") == depth), depth), "spelling-states")
        ended = after.where("v is not null").select("back", "s", "v")
        found = ended if found is None else found.unionByName(ended)
        states, depth = after.where("v is null").drop("v"), depth + 1
        if depth > last and states.isEmpty():
            break
    if found is None:
        return words.sparkSession.createDataFrame([], "word string, near string")
    plain = lambda name: F.expr(f"IF(back, reverse({name}), {name})")
    pairs = found.select(plain("s").alias("word"), plain("v").alias("near")).where("levenshtein(word, near) = 1")
    pairs = pairs.distinct()
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms (word, form), by doubling.

    Counts grow along a chain, so it has an end, and its length is a logarithm of the counts.
    """
    jumps, path = common.stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = jumps.join(ahead, "root", "left")
        after, new_path = common.stored(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")),
            "spelling-roots",
        )
        common.drop_table(forms.sparkSession, path)
        jumps, path = after.drop("on"), new_path
        if after.where("on").isEmpty():
            return jumps


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (word, n)."""
    words, _ = common.stored(words.select("word", "n"), "spelling-words")
    pairs = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The smallest of these structs is the near word of largest count.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best")).alias("best"),
    )
    told, _ = common.stored(
        told.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")),
        "spelling-forms",
    )
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def groups(docs: DataFrame, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """Words of documents grouped under the spelling they vary: root, members, occurrences."""
    found = variants(word_counts(docs, least, count))
    return found.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("n"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with its form and root."""
    return variants(word_counts(common.read_table(spark, sf_dir, "documents")))
