"""The homomorphic multiset hash: its algebra, its query by brute force, and edge cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import common, multiset

SF = "/root/testdata/sf0.001"


def test_order_does_not_matter_and_counts_do():
    rng = random.Random(1)
    parts = [" ".join(rng.choice(["red", "blue", "green", "é"]) for _ in range(rng.randrange(9))) for _ in range(20)]
    mixed = rng.sample(parts, len(parts))
    assert multiset.of_text("\n".join(parts)) == multiset.of_text("\n".join(mixed))
    assert multiset.of_text("\n".join(parts)) != multiset.of_text("\n".join([*parts, parts[0]]))
    assert multiset.of_text("a b") != multiset.of_text("b a") != multiset.of_text("b  a")


def test_insertion_and_deletion_equal_a_new_hash():
    base, more = "one two three four\nfive six", "seven eight nine ten\n\neleven"
    grown = multiset.inserted(multiset.of_text(base), more)
    assert grown == multiset.of_text(f"{more}\n{base}")
    assert multiset.deleted(grown, base) == multiset.of_text(more)
    assert multiset.deleted(multiset.deleted(grown, more), base) == bytes(multiset.EQUAL_BYTES + 2 * multiset.LIKE_LANES)


def test_no_lane_is_constant_and_lanes_spread():
    prints = np.array([multiset.lanes(multiset.of_text(f"paragraph number {k}")) for k in range(300)])
    equal = prints[:, : multiset.EQUAL_LANES]
    assert len(np.unique(equal)) == equal.size
    assert (np.abs(equal.mean(axis=0) / 2**32 - 0.5) < 0.1).all()


def test_likeness_follows_shared_shingles():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(5000)]
    text = " ".join(rng.choice(words) for _ in range(1000))
    other = " ".join(rng.choice(words) for _ in range(1000))
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        cut = int(1000 * share)
        mixed = " ".join([*text.split()[:cut], *other.split()[cut:]])
        assert abs(multiset.likeness(multiset.of_text(text), multiset.of_text(mixed)) - share) < 0.15
    assert multiset.likeness(multiset.of_text(""), multiset.of_text(" ")) == 0.0
    assert multiset.likeness(multiset.of_text(""), multiset.of_text("")) == 1.0
    repeated = "same words again " * 200_000
    assert multiset.likeness(multiset.of_text(repeated), multiset.of_text(repeated + "and more")) > 0.9


def brute(docs):
    """The query's rows of (doc_id, text) with distinct ids, from whole texts, each hashed anew."""
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        prints = [multiset.of_text(t) for t in (text, new, after)]
        yield (
            i, len(text), hashlib.sha256(new.encode()).hexdigest(), prints[0], prints[1],
            multiset.likeness(prints[0], prints[1]), multiset.likeness(prints[0], prints[2]),
        )


@pytest.mark.parametrize("part_bytes", [multiset.PART_BYTES, 20_000])
def test_edits_equal_brute_force(spark, part_bytes):
    docs = common.read_table(spark, SF, "documents")
    odd = [(10**12, None), (-5, ""), (10**12 + 1, "é\n" * 40_000), (10**12 + 2, "x"), (None, "null id\nhere"), (-(2**63), "least")]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    found = multiset.edits(frame.withColumn("part", F.lit(1)).withColumn("z", F.lit(0)), part_bytes).collect()
    want = sorted(brute([tuple(r) for r in frame.collect()]), key=repr)
    plain = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in found]
    assert sorted(plain, key=repr) == want


def test_query_in_hexadecimal(spark):
    found = {r.doc_id: r for r in multiset.op12_multiset(spark, SF).collect()}
    for row in brute([tuple(r) for r in common.read_table(spark, SF, "documents").select("doc_id", "text").collect()]):
        got = found[row[0]]
        assert tuple(got) == (*row[:3], row[3].hex(), row[4].hex(), *row[5:])
    near = [(r.near_edited, r.near_next) for r in found.values()]
    assert np.mean([a > b for a, b in near]) > 0.95


def test_repeated_ids_empty_and_single(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert multiset.edits(frame([])).count() == 0
    one = multiset.edits(frame([(1, "a b c d")])).first()
    assert (one.near_edited, one.near_next, one.n_chars) == (
        multiset.likeness(multiset.of_text("a b c d"), multiset.of_text("a b ca b")), 1.0, 7)
    # A hot id with many rows, some equal, cut into parts: every row has one result, equal texts equal prints.
    rows = [(7, f"text {k % 50} " * 40) for k in range(600)] + [(1000 + k, "other") for k in range(300)]
    found = multiset.edits(frame(rows), 2_000).collect()
    assert len(found) == 900
    assert {bytes(r.fingerprint) for r in found if r.doc_id != 7} == {multiset.of_text("other")}
    assert len({bytes(r.fingerprint) for r in found if r.doc_id == 7}) == 50


def test_groups_of_documents_are_combined(spark):
    rows = [("a", "one\ntwo"), ("a", "three"), ("b", "three\none\ntwo"), (None, "x"), ("a", None)]
    docs = spark.createDataFrame(rows, "source string, text string")
    prints = docs.select("source", multiset.fingerprint_column(F.col("text")).alias("fingerprint"))
    got = {r.source: bytes(r.fingerprint) for r in multiset.combined(prints, "source").collect()}
    assert got["a"] == multiset.inserted(multiset.of_text("one\ntwo\nthree"), "")
    assert got["b"] == multiset.of_text("one\ntwo\nthree") and got[None] == multiset.of_text("x")
