"""Quality classifier by hierarchical empirical Bayes.

A logistic model on counts over the whole text gives each document's own evidence. Hosts
and paths get beta posteriors from the summed evidence of their documents: a path is
shrunk toward its host, a host toward the global mean, each with a prior strength
estimated by moments from the spread between sites (grouped aggregation only). A
document's log-odds are its own plus the difference that the other documents of its path and
host make to the global mean: its own evidence is taken out of both sums, so it counts once.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of doc_id among
those whose crc32 is no multiple of five; everything else covers all rows.

Defined results: a null text counts as empty; null hosts or paths form a site of their
own; without labels of both kinds every document's own evidence is 0.5; repeated rows are
scored alike; an empty table gives no rows; scores of 0.5 are kept; extra columns stay.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

SAMPLE = 4_000
BLOCK_WORDS = 64
LIMIT = 1e-4
STRENGTHS = (2.0, 10_000.0)

_KIND = np.zeros(256, np.int64)
_KIND[[*range(65, 91)]] = 1  # upper case
_KIND[[*range(97, 123)]] = 2  # lower case
_KIND[[*range(48, 58)]] = 3
_KIND[[32, 9, 10, 11, 12, 13]] = 4
_KIND[[44, 46, 39]] = 5  # the marks prose uses most
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and b not in (44, 46, 39)]] = 6
FEATURES = 9


def features(text: str | None) -> list[float]:
    """Counts over a whole text, as shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=7)
    words = raw.split()
    n, letters = max(1, len(words)), max(1.0, kinds[0] + kinds[1] + kinds[2])
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    distinct, most = 0.0, 0.0
    for k in range(0, len(words), BLOCK_WORDS):
        block = Counter(words[k : k + BLOCK_WORDS])
        distinct += len(block)
        most += max(block.values())
    return [
        float(np.log1p(len(words))),
        len(raw) / n / 10,
        kinds[1] / letters,
        kinds[3] / max(1, len(raw)),
        min(3.0, kinds[5] / n),
        min(3.0, kinds[6] / n),
        again / n,
        distinct / n,
        most / n,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (bias last) of a ridge logistic model, by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * (a.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def training_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """Text and label of at most ``size`` labelled training rows, by hash of doc_id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label in (0, 1)").where(common.training_row(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    # At most ``size`` ids.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE):
    """The document model, or None without labels of both kinds."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    sample = training_sample(docs, labels, "quality", size)
    rows = sample.select("doc_id", "label", run("text").alias("x")).collect()  # at most ``size`` short rows
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    return fit_logistic(np.array([r["x"] for r in rows]), y)


def evidence(model, text: F.Column) -> F.Column:
    """A document's own probability of being good."""
    if model is None:
        return F.lit(0.5)
    centre, scale, w = model

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts]).reshape(-1, FEATURES)
        odds = ((x - centre) / scale) @ w[:-1] + w[-1]
        return pd.Series(np.clip(1 / (1 + np.exp(-np.clip(odds, -30, 30))), LIMIT, 1 - LIMIT))

    # Not to be computed once more for a condition on its result.
    return run.asNondeterministic()(text)


def _strength(groups: DataFrame, mean: F.Column) -> float:
    """Prior strength by moments: how alike the groups' (n, s) means are around ``mean``."""
    noise = mean * (1 - mean)
    row = groups.agg(
        F.sum(F.col("n") * (F.col("s") / F.col("n") - mean) ** 2 - noise).alias("between"),
        F.sum("n").alias("n"),
        F.sum(noise * F.col("n")).alias("noise"),
    ).first()
    if not row["n"]:
        return STRENGTHS[1]
    spread = max(row["between"] / row["n"], 1e-9)
    return float(np.clip(row["noise"] / row["n"] / spread, *STRENGTHS))


def site_sums(rows: DataFrame) -> tuple[DataFrame, float, float, float]:
    """From rows (host, path, p): counts and sums per path (n, s) and its host (host_n, host_s), the
    global mean, and the prior strengths of hosts and of paths."""
    paths, _ = common.stored(
        rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "quality-paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = float(total["s"] / total["n"]) if total["n"] else 0.5
    mean = min(max(mean, LIMIT), 1 - LIMIT)
    of_hosts = _strength(hosts, F.lit(mean))
    hosts = hosts.select(F.col("host").alias("__h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("__h"))).drop("__h")
    of_paths = _strength(both, posteriors(mean, of_hosts, 0.0)[0])
    return both, mean, of_hosts, of_paths


def posteriors(
    mean: float, of_hosts: float, of_paths: float, own: F.Column | None = None, sums: F.Column | None = None
) -> tuple[F.Column, F.Column]:
    """Posteriors of a host and of a path from their counts and sums (columns, or fields of ``sums``),
    without a document's ``own`` evidence if given."""
    n, s, host_n, host_s = [F.col(c) if sums is None else sums[c] for c in ("n", "s", "host_n", "host_s")]
    one, p = (F.lit(0), F.lit(0.0)) if own is None else (F.lit(1), own)
    host = (host_s - p + of_hosts * mean) / (host_n - one + of_hosts)
    return host, (s - p + of_paths * host) / (n - one + of_paths)


def site_posteriors(rows: DataFrame) -> tuple[DataFrame, float]:
    """From rows (host, path, p): posteriors per path, and the global mean."""
    sums, mean, of_hosts, of_paths = site_sums(rows)
    host, path = posteriors(mean, of_hosts, of_paths)
    return sums.select("host", "path", host.alias("host_posterior"), path.alias("path_posterior")), mean


def scored(docs: DataFrame, labels: DataFrame, host: F.Column | None = None, path: F.Column | None = None, size: int = SAMPLE) -> DataFrame:
    """Documents with __p, __host_posterior, __path_posterior and __score.

    The site is ``source`` and the path ``source`` with ``lang`` unless given otherwise.
    """
    host = F.coalesce(F.col("source"), F.lit("")) if host is None else host
    path = F.concat_ws("/", F.col("source"), F.col("lang")) if path is None else path
    model = fit(docs, labels, size)
    own = docs.withColumn("__p", evidence(model, F.col("text"))).withColumn("__host", host).withColumn("__path", path)
    names = {"__host": "host", "__path": "path", "__p": "p"}
    sums, mean, of_hosts, of_paths = site_sums(own.select(*[F.col(a).alias(b) for a, b in names.items()]))
    sites, _ = common.stored(sums.withColumnsRenamed({c: f"__site_{c}" for c in sums.columns}), "quality-sites")
    same = own["__host"].eqNullSafe(sites["__site_host"]) & own["__path"].eqNullSafe(sites["__site_path"])
    joined = own.join(sites, same)
    sums = F.struct(*[F.col(f"__site_{c}").alias(c) for c in ("n", "s", "host_n", "host_s")])
    host, path = posteriors(mean, of_hosts, of_paths, F.col("__p"), sums)
    # A sum of others may fall below zero by rounding.
    within = lambda p: F.greatest(F.least(p, F.lit(1 - LIMIT)), F.lit(LIMIT))
    joined = joined.withColumns({"__host_posterior": within(host), "__path_posterior": within(path)})
    odds = lambda p: F.log(p / (1 - p))
    total = odds(F.col("__p")) + odds(F.col("__path_posterior")) - float(np.log(mean / (1 - mean)))
    return joined.withColumn("__score", 1 / (1 + F.exp(-total))).drop(
        "__host", "__path", *[f"__site_{c}" for c in ("host", "path", "n", "s", "host_n", "host_s")]
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    return scored(docs, labels).where("__score >= 0.5").select(*docs.columns)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, posteriors and decision for every document."""
    found = scored(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__p").alias("own_evidence"),
        F.col("__host_posterior").alias("host_posterior"),
        F.col("__path_posterior").alias("path_posterior"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )
