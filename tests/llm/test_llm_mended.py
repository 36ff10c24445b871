"""Cases in which training-data operators once took too long or gave a wrong class."""

import re
import time
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from finlake.llm import language, quality, secrets, toxicity, urls

SF = "/root/testdata/sf0.001"
LONG = "doc_id long, text string, n_chars long"


def many(n):
    lines = [f"{k * 7919:064x}  file-{k} é😀.txt" for k in range(n)]
    return "\n".join(lines) + " password=abcdef1234567 AKIA" + "A" * 20


def test_very_many_secrets_in_one_text(spark):
    """200,000 matches, and twelve times fewer in no less than a fortieth of the time."""
    spent = []
    for n in (16_000, 16_000, 200_000):
        text = many(n)
        docs = spark.createDataFrame([(1, text, 0)], LONG)
        started = time.time()
        spans = [tuple(s) for s in secrets.scan(docs).first().spans]
        clean = secrets.redact(docs).first()
        spent.append(time.time() - started)
    assert spans == secrets.matched_by_scan(text) and len(spans) > 200_000
    assert clean.text.count("[SECRET]") == len(spans) and clean.n_chars == len(clean.text)
    assert clean.text.startswith("[SECRET]  file-0 é😀.txt\n") and not secrets.matched_by_scan(clean.text)
    assert spent[2] < 40 * max(spent[1], 1)


def test_overlapping_and_touching_spans_are_masked_once(spark):
    long = "x" * 5_000
    texts = [
        "token=" + "a" * 40, f"{long}secret: {'0' * 32} {long} AKIA{'B' * 16}", "f" * 8_192, "é😀" * 4_096 + "a" * 64 + "😀",
        "password=" + "0f" * 20 + "ghp_" + "a" * 40, "", "nothing",
    ]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], LONG)
    got = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for k, text in enumerate(texts):
        out, at = "", 0
        for start, end, _ in secrets.matched_by_scan(text):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert got[k] == out + text[at:]


def test_running_sums_and_maxima(spark):
    for values in ([], [5], [3, 1, 4, 1, 5, 9, 2, 6], list(range(1000))):
        frame = spark.createDataFrame([(values,)], "v array<int>")
        sums, tops = frame.select(
            secrets.running(frame.v, lambda a, b: a + b), secrets.running(frame.v, lambda a, b: secrets.F.greatest(a, b))
        ).first()
        assert sums == [sum(values[: k + 1]) for k in range(len(values))]
        assert tops == [max(values[: k + 1]) for k in range(len(values))]


def fitted_docs(spark):
    one, two = "the house and the river are old", "das haus und der fluss sind alt"
    rows = [(k, f"{(one, two)[k % 2]} {k} " * 8, ("en", "de")[k % 2]) for k in range(200)]
    # A repeated id whose rows differ in text and language.
    return spark.createDataFrame([*rows, (1, one * 3, "en"), (1, two * 3, "de")], "doc_id long, text string, lang string")


def test_texts_without_a_letter_are_undetermined(spark):
    network = language.fit(fitted_docs(spark))
    texts = [None, "", "½ ²", "Ⅷ", "①", "12 + 3_4", "́", "ª", "das haus", "the river " * 50_000, "日本"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", language.F.lit("x"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identified(frame, network).collect()}
    letters = [any(c.isalpha() for c in t or "") for t in texts]
    assert [got[k][0] != "und" for k in range(len(texts))] == letters
    assert got[8][0] == "de" and got[9][0] == "en" and all(0 <= s <= 1 for _, s in got.values())


def test_training_rows_do_not_depend_on_row_order(spark):
    docs = fitted_docs(spark)
    first = language.training_pieces(docs)
    again = language.training_pieces(docs.orderBy(language.F.desc("lang"), language.F.desc("text")))
    assert (first[0] == again[0]).all() and first[1] == again[1]
    ids = {bytes(p[:10]): lang for p, lang in zip(first[0], first[1], strict=True) if lang}
    assert all((lang == "en") == (b"the" in piece or b"house" in piece or b"river" in piece or b"old" in piece or b"are" in piece)
               for piece, lang in ids.items() if any(w in piece for w in (b"the", b"das", b"haus", b"fluss")))


THREATENING = [
    "kill yourself", "I will murder you", "I will shoot you", "killing you", "He kills you", "go die", "we will kill that man",
    "er tötet dich", "te mataré", "je vais te frapper",
]
HARMLESS = [
    "kill time", "die Mutter und ihr Kind", "good morning to you, mate", "he went home and died", "the will. die Katze",
    "the battery is dead", "I beat the eggs", "tu es là et vous aussi", "él toma mate con ella",
]


def test_threats_inflected_reflexive_and_in_phrases():
    score = toxicity.Scorer({}, {})
    assert all(max(score.clauses(text), default=0) > 0 for text in THREATENING)
    assert not any(max(score.clauses(text), default=0) > 0 for text in HARMLESS)
    assert score.clauses("I will not kill you")[0] < score.clauses("I will kill you")[0]
    assert score.clauses("they said you should die")[0] < score.clauses("you should die")[0]


def test_toxicity_equals_plain_grammar(spark):
    """Scores of the fitted model against a plain reading of the grammar, symbol by symbol."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = [(-1, None), (-2, ""), (-3, "kill you. " * 20_000), (-4, "go die"), (-4, "go die"), (-5, "½ ² 12")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    model = toxicity.fit(docs, labels)
    scorer, (centre, scale, w) = model

    def plain(text):
        totals = []
        for clause in re.split(r"[.!?;:\n|]", (text or "").lower()):
            words = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", clause)
            kinds = [scorer.symbol(x)[0] for x in words]
            total = 0.0
            for k, (word, kind) in enumerate(zip(words, kinds, strict=True)):
                phrase = word in toxicity.PHRASES and k and words[k - 1] in toxicity.PHRASES[word].split()
                if kind not in ("insult", "threat") and not phrase:
                    continue
                reach = 4 if kind == "insult" else 6
                near = phrase or "target" in kinds[max(0, k - reach) : k] + kinds[k + 1 : k + 1 + reach]
                factor = 1.5 if near else (1.0 if kind == "insult" else 0.0)
                factor *= 0.4 if "negation" in kinds[max(0, k - 3) : k] else 1.0
                factor *= 0.5 if "report" in kinds[:k] else 1.0
                total += (1.0 if phrase else scorer.symbol(word)[1]) * factor
            totals.append(total)
        totals = [t for t in totals if t > 0]
        size = len(text or "") / 100
        x = [np.log1p(sum(totals)), np.log1p(max(totals, default=0)), float(bool(totals)), np.log1p(sum(totals) / (1 + size))]
        return 1 / (1 + np.exp(-np.clip(((np.array(x) - centre) / scale) @ w[:-1] + w[-1], -30, 30)))

    rows = docs.select("doc_id", "text", toxicity.toxicity(model, toxicity.F.col("text")).alias("p")).collect()
    assert len(rows) > 200 and all(abs(r.p - plain(r.text)) < 1e-9 for r in rows)
    assert toxicity.toxicity(model, docs.limit(0).text) is not None and docs.limit(0).select(toxicity.toxicity(model, docs.text)).count() == 0


def test_quality_counts_own_evidence_once(spark):
    """Scores against plain sums over all other documents of the path and host."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    alone = spark.createDataFrame(
        [(10**9, "a lonely page with a few words", "xx", "only", 30), (10**9, None, None, None, 0), (None, "", "en", "only", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    rows = quality.scored(docs.unionByName(alone), labels).collect()
    sums = quality.site_sums(
        spark.createDataFrame([(r.source or "", "/".join(x for x in (r.source, r.lang) if x is not None), r["__p"]) for r in rows],
                              "host string, path string, p double"))
    _, mean, of_hosts, of_paths = sums
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        key = r.source or "", "/".join(x for x in (r.source, r.lang) if x is not None)
        hosts[key[0]].append(r["__p"])
        paths[key].append(r["__p"])
    odds = lambda p: np.log(p / (1 - p))
    for r in rows:
        key, p = (r.source or "", "/".join(x for x in (r.source, r.lang) if x is not None)), r["__p"]
        host = (sum(hosts[key[0]]) - p + of_hosts * mean) / (len(hosts[key[0]]) - 1 + of_hosts)
        path = (sum(paths[key]) - p + of_paths * host) / (len(paths[key]) - 1 + of_paths)
        total = odds(p) + odds(np.clip(path, quality.LIMIT, 1 - quality.LIMIT)) - odds(mean)
        assert abs(r["__score"] - 1 / (1 + np.exp(-total))) < 1e-9
    # With nothing else known of its path and host, a document's own evidence decides alone.
    lone = next(r for r in rows if r.source is None)
    assert abs(lone["__score"] - lone["__p"]) < 1e-9


def test_quality_reads_each_text_once_for_its_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    plan = quality.keep_good(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_long_and_astral_urls(spark):
    """Windows by one walk equal those cut position by position; a data address of a million characters is no trouble."""
    long = "data://x.net/" + "QUJD" * 250_000
    texts = ["http://a.org/b", "", "http://é😀.net/😀😀x", "a\nb", "x", long[:3_000]]
    frame = spark.createDataFrame([(t,) for t in texts], "url string").withColumn("own", F.col("url"))
    found = defaultdict(list)
    for r in urls._grams(frame, 5).collect():
        found[r.own].append(r.gram)
    for text in texts:
        padded = urls.PAD * 4 + text + urls.PAD
        assert found[text] == [padded[k : k + 5] for k in range(len(text) + 1)]
    pages = [(k, f"http://{'ab'[k % 2]}{k}.{'org/x' if k % 2 else 'com/de/x'}") for k in range(60)]
    rows = spark.createDataFrame([*pages, (100, long), (101, None), (101, "http://q😀.net")], "page_id long, url string")
    started = time.time()
    got = urls.judge(rows.withColumn("key", F.lit(1))).collect()
    assert len(got) == 63 and {r.verdict for r in got} == {"allow", "block"} and time.time() - started < 120
    assert [r.verdict for r in sorted(got, key=lambda r: r.page_id)[:60]] == ["block", "allow"] * 30
