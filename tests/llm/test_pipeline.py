"""The corpus pipeline, its stages, and the registered queries."""

import re
import zlib

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import numpy as np
import xxhash
from test_operators import convicted
from tokenizers import Tokenizer

from finlake.llm import common, decontaminate, quality, queries, secrets, simhash

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, (docs, _) = docs, common.stored(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = (before, docs)
    before, after = kept["quality"]
    rejected = quality.scored(before, labels).where("__score < 0.5").count()
    assert rejected and before.count() - after.count() == rejected
    before, after = kept["simhash"]
    groups = simhash.near_duplicates(before).select("component_id").distinct()
    assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(r[0] for r in groups.collect())
    before, after = kept["decontaminate"]
    leaks = {r["doc_id"] for r in decontaminate.contaminated(before, benchmark).collect()}
    assert {r[0] for r in before.select("doc_id").collect()} - {r[0] for r in after.select("doc_id").collect()} == leaks
    before, after = kept["secrets"]
    assert before.count() == after.count()
    assert not any(secrets.matched_by_scan(r["text"]) for r in after.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = kept["packing"]
    assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in before.select("doc_id").collect()}


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, docs.collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = common.stored(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_topk_equals_sql(spark):
    own = queries.QUERIES["op6_topk"](spark, SF)
    with duckdb.connect() as db:
        db.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
        rows = db.execute(entry.oracle_sql()["op6_topk"]).fetchall()
        columns = [c[0] for c in db.description]
    assert sorted(map(tuple, own.select(*columns).collect())) == sorted(rows)


def plain_good(docs, labels, spark):
    """Ids the quality stage keeps: the fitted weights applied text by text, sites summed in a loop."""
    centre, scale, weights = quality.fit(docs, labels)
    rows = docs.collect()

    def own(text):
        odds = ((np.array(quality.features(text)) - centre) / scale) @ weights[:-1] + weights[-1]
        return float(np.clip(1 / (1 + np.exp(-np.clip(odds, -30, 30))), quality.LIMIT, 1 - quality.LIMIT))

    found = [(r.doc_id, r.source, f"{r.source}/{r.lang}", own(r.text)) for r in rows]
    sites = spark.createDataFrame([f[1:] for f in found], "host string, path string, p double")
    _, mean, of_hosts, of_paths = quality.site_sums(sites)
    sums = {}
    for _, host, path, p in found:
        for site in (host, (host, path)):
            n, s = sums.get(site, (0, 0.0))
            sums[site] = n + 1, s + p
    kept = set()
    for doc_id, host, path, p in found:
        n, s = sums[host]
        above = (s - p + of_hosts * mean) / (n - 1 + of_hosts)
        n, s = sums[host, path]
        others = np.clip((s - p + of_paths * above) / (n - 1 + of_paths), quality.LIMIT, 1 - quality.LIMIT)
        if np.log(p / (1 - p)) + np.log(others / (1 - others)) - np.log(mean / (1 - mean)) >= 0:
            kept.add(doc_id)
    return kept


def plain_single(docs):
    """Smallest ids of the groups that fingerprints of at most four different bits link."""
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    prints = []
    for _, text in rows:
        words = re.findall(r"[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {rows[k][0] for k in range(len(rows)) if top(k) == k}


def plain_uncontaminated(docs, benchmark):
    """Ids of documents without an item by shingles over the whole text or words of a scored passage."""
    index = next(iter(decontaminate.shards(benchmark)))
    rows = docs.collect()
    by_shingles, by_words = convicted(index, [decontaminate.words_of(r.text) for r in rows])
    return {r.doc_id for r, a, b in zip(rows, by_shingles, by_words, strict=True) if not a | b}


def plain_masked(text):
    out, at = "", 0
    for start, end, _ in secrets.matched_by_scan(text):
        out += text[at:start] + "[SECRET]" if start >= at else ""
        at = max(at, end)
    return out + text[at:]


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)

    def after(name, docs):
        return common.stored(stages[name](spark, docs, SF), f"plain-{name}")[0]

    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    good = after("quality", docs)
    assert ids(good) == sorted(plain_good(docs, labels, spark))
    single = after("simhash", good)
    assert ids(single) == sorted(plain_single(good))
    clean = after("decontaminate", single)
    assert ids(clean) == sorted(plain_uncontaminated(single, benchmark)) and len(ids(clean)) < len(ids(single))
    masked = after("secrets", clean)
    before = {r.doc_id: r.text for r in clean.collect()}
    assert all(r.text == plain_masked(before[r.doc_id]) for r in masked.collect())
    tokenizer = Tokenizer.from_file(common.tokenizer_path())
    pieces = stages["packing"](spark, masked, SF).orderBy("doc_id", "start").collect()
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert {p.doc_id for p in pieces} == set(texts)
    ends = {}
    for p in pieces:
        whole = np.array(tokenizer.encode(texts[p.doc_id], add_special_tokens=False).ids + [common.END_ID], "<u4")
        assert p.start == ends.get(p.doc_id, 0) and p.doc_tokens == len(whole)
        assert p.ids_crc32 == zlib.crc32(whole[p.start : p.start + p.length].tobytes())
        ends[p.doc_id] = p.start + p.length
    assert all(ends[p.doc_id] == p.doc_tokens for p in pieces)
    rooms = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == rooms.get(p.sequence_id, 0)
        rooms[p.sequence_id] = p.offset + p.length
    assert max(rooms.values()) <= 4096
