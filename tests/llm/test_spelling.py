"""Spelling variants against brute force, and edge cases."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from finlake.llm import common, spelling

SF = "/root/testdata/sf0.001"


def counted(docs, least=6, count=5):
    """Word counts by the contract's text, one run at a time."""
    found = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def expected(words, factor=5):
    """Rows by comparing all words that share a piece left after one deletion, or one with the other's."""
    near, pieces = defaultdict(set), defaultdict(set)
    for w in words:
        for piece in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            pieces[piece].add(w)
    for group in pieces.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def rows(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in common.read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    words = counted(docs)
    got = rows(spelling.op13_spelling(spark, SF))
    assert got == expected(words) and len(got) > 500
    assert any(v[0] for v in got.values())


def test_words_by_the_contract(spark):
    docs = [
        (1, "Straße STRASSE ÀÉÎõüÿ Àéîõüÿ don't under_score x1abcdefg日本abcdefg\nabcdefg"), (1, None), (None, "abcdefg " * 3),
        *[(k, "Wörterbuch wörterbuch WÖRTERBUCH lighthouse ") for k in range(500)], (9, "z" * 50_000),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash"))
    got = {r.word: r.n for r in spelling.word_counts(frame, count=1).collect()}
    assert got == counted(docs, count=1)
    # The capital Ö stays: only A-Z are lower-cased; some runs lost a letter.
    assert "wÖrterbuch" in got and any(len(w) == 9 and "rterbuch" in w for w in got)


def test_trie_frontier_finds_every_pair(spark):
    """Runs of one letter, shared beginnings and ends, and words longer than one portion of depths."""
    words = {"a" * k for k in range(6, 12)} | {"abcabc", "abcabd", "abdabc", "babcabc", "abcabcb", "bcabca", "zzabca", "cbaabc"}
    words |= {"x" * 45 + tail for tail in ("", "y", "yz", "zy", "yy")} | {"q" + "x" * 45, "x" * 20 + "q" + "x" * 25}
    words |= {"stem" + a + b + "ing" for a in "abcdé" for b in "abcd"} | {"ÿÿÿÿÿÿ", "ÿÿÿÿÿ÷"}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = sorted(map(tuple, spelling.neighbours(frame).collect()))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


@pytest.mark.parametrize("least", [1, 2])
def test_short_words_too(spark, least):
    words = {w for n in range(least, 5) for w in (a * n for a in "ab")} | {"ab", "ba", "aba", "abb", "bab", "abab"}
    got = sorted(map(tuple, spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_forms_ties_and_chains(spark):
    words = {
        "abcdefghij": 3125, "abcdefghi": 625, "abcdefgh": 125, "abcdefg": 25, "abcdef": 5,  # a chain of forms
        "kkkkkkb": 50, "kkkkkka": 50, "kkkkkk": 10,  # a tie: the smaller one
        "mmmmmm": 10, "mmmmmn": 49,  # under five times: no form
        "pppppp": 7,  # no neighbour
    }
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(spelling.variants(frame))
    assert got == expected(words)
    assert got["abcdef"][:2] == ("abcdefg", "abcdefghij") and got["kkkkkk"][0] == "kkkkkka"
    assert got["mmmmmm"] == (None, "mmmmmm", 10, 1, None) and got["pppppp"][3] == 0


def test_no_words(spark):
    for docs in ([], [(1, None)], [(1, "short words only")], [(1, "abcdefgh")]):
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        assert spelling.variants(spelling.word_counts(frame)).count() == 0
        assert spelling.groups(frame).count() == 0


def test_groups_by_root(spark):
    words = " ".join(["colours"] * 50 + ["coluors"] * 5 + ["colourss"] * 6)
    found = spelling.groups(spark.createDataFrame([(3, words)], "doc_id long, text string")).collect()
    assert sum(r.n for r in found) == 61 and max(r.members for r in found) >= 2
