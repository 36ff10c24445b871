"""URL filter by the likelihood ratio of two character language models, with DataFrame
functions only.

Rules on hosts and paths judge first. The other URLs are judged by two variable-order
Markov models, one of accepted and one of rejected URLs, learned from the URLs the rules
judge. Every character position of a padded URL has one context of ``ORDER`` characters;
grams of that length are counted once over distinct URLs, the counts of shorter ones are
sums over their suffixes, and the probability of a character is interpolated from the
longest context down to a uniform guess (Witten and Bell). The log-likelihood difference
is divided by the length, and the threshold is calibrated on every fifth labelled URL
(by hash), which the models do not see: the one with the least balanced error.

All joins and groupings are on grams or URLs, after counting copies, so a host or gram
that holds a third of the rows is one row by then.

Defined results: a null URL or one without ``://`` has empty host and path and no rule;
its text, null as empty, goes to the models; without labelled URLs of both kinds every
unruled URL is allowed; repeated rows are judged alike; an empty table gives no rows;
ties of rules of one length go to blocking.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.llm import common

ORDER = 5
# Characters a URL may draw from, for the uniform guess below the shortest context.
ALPHABET = 128
# Bins of the calibration histogram: differences per character from -LIMIT to LIMIT.
BINS, LIMIT = 2_000, 5.0
PAD = "\u0002"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(authority, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substr(rest, F.length(authority) + 1), r"^[^?#]*", 0)
    return host, path


def ruled(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """host, path, rule and rule_verdict of rows with a url; the longest fitting rule wins."""
    host, path = split_url(F.col("url"))
    rows = urls.withColumn("host", host).withColumn("path", path)
    best = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(best):
        own = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits = own & F.startswith(F.col("path"), F.lit(rule.path))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return rows.withColumn("rule", name).withColumn("rule_verdict", verdict)


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per position of each URL: its character with the ``order - 1`` before it; without the URL."""
    padded = F.concat(F.lit(PAD * (order - 1)), F.col("url"), F.lit(PAD))
    # All windows in one walk. The pattern steps by UTF-16 units, so URLs with longer characters
    # are cut position by position.
    windows = F.regexp_extract_all(padded, F.lit("(?s)(?=(.{%d}))" % order), F.lit(1))
    cut = F.transform(F.sequence(F.lit(1), F.length("url") + 1), lambda k: F.substr(padded, k, F.lit(order)))
    chars = F.when(F.col("url").rlike("[\\x{10000}-\\x{10FFFF}]"), cut).otherwise(windows)
    return urls.select(*[c for c in urls.columns if c != "url"], F.explode(chars).alias("gram"))


def models(grams: DataFrame, order: int) -> DataFrame:
    """Log-likelihood difference (accepted less rejected) of every gram of the corpus.

    grams: (gram, accepted, rejected) with counts, 0 for grams of unlabelled URLs.
    """
    below = None
    for length in range(1, order + 1):
        gram = F.substring("gram", order - length + 1, length)
        # Each position has one gram of every length: shorter counts are sums by suffix.
        own = grams.groupBy(gram.alias("gram")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        context = F.substring("gram", 1, length - 1)
        total = Window.partitionBy(context)
        if length == 1:
            sums = own.agg(
                *[F.sum(c).alias(f"n_{c}") for c in ("accepted", "rejected")],
                *[F.count(F.when(F.col(c) > 0, 1)).alias(f"t_{c}") for c in ("accepted", "rejected")],
            ).first()
            own = own.withColumns({name: F.lit(value or 0) for name, value in sums.asDict().items()})
            own = own.withColumn("p_accepted", F.lit(1.0 / ALPHABET)).withColumn("p_rejected", F.lit(1.0 / ALPHABET))
        else:
            for c in ("accepted", "rejected"):
                own = own.withColumn(f"n_{c}", F.sum(c).over(total)).withColumn(
                    f"t_{c}", F.count(F.when(F.col(c) > 0, 1)).over(total)
                )
            lower = below.withColumnRenamed("gram", "suffix")
            own = own.withColumn("suffix", F.substring("gram", 2, length - 1)).join(lower, "suffix")
        made = []
        for c in ("accepted", "rejected"):
            # Witten and Bell: as many guesses from below as kinds of characters seen here.
            mixed = (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))
            made.append(F.when(F.col(f"n_{c}") > 0, mixed).otherwise(F.col(f"p_{c}")).alias(f"p_{c}"))
        below = own.select("gram", *made)
    return below.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("difference"))


def calibrated(scored: DataFrame) -> float:
    """The threshold of least balanced error on (score, accepted, n) rows; 0 without both kinds.

    The histogram has a fixed number of bins; of equally good thresholds the one nearest 0.
    """
    bin_ = F.least(F.greatest(F.floor((F.col("score") + LIMIT) * (BINS / (2 * LIMIT))), F.lit(0)), F.lit(BINS - 1))
    rows = scored.groupBy(bin_.alias("bin")).agg(
        F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("bad"),
    )
    bins = {r["bin"]: (r["good"], r["bad"]) for r in rows.collect()}  # at most BINS rows
    good, bad = sum(g for g, _ in bins.values()), sum(b for _, b in bins.values())
    if not good or not bad:
        return 0.0
    best, lost, kept = (2.0, 0.0, 0.0), 0, bad
    for k in range(BINS + 1):
        edge = k * 2 * LIMIT / BINS - LIMIT
        best = min(best, (lost / good + kept / bad, abs(edge), edge))
        g, b = bins.get(k, (0, 0))
        lost, kept = lost + g, kept - b
    return best[2]


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of pages (page_id, url)."""
    rows = ruled(pages.select("page_id", "url"), rules)
    text = F.coalesce("url", F.lit(""))
    distinct = ruled(pages.select(text.alias("url")), rules).groupBy("url", "rule_verdict").agg(F.count("*").alias("n"))
    distinct = distinct.withColumn("checked", F.crc32(F.col("url").cast("binary")) % 5 == 0)
    # Grams carry this digest of their URL, so bytes grow with the length of a URL, not with its square.
    distinct = distinct.withColumn("key", F.unhex(F.md5(F.col("url").cast("binary"))))
    distinct, _ = common.stored(distinct, "urls")
    learned = (F.col("rule_verdict").isNotNull()) & ~F.col("checked")
    counts = _grams(distinct.select("url", "rule_verdict", "checked"), order).groupBy("gram").agg(
        F.sum(F.when(learned & (F.col("rule_verdict") == "allow"), 1).otherwise(0)).alias("accepted"),
        F.sum(F.when(learned & (F.col("rule_verdict") == "block"), 1).otherwise(0)).alias("rejected"),
    )
    counts, _ = common.stored(counts, "url-grams")
    both = counts.agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).first()
    if not both["a"] or not both["r"]:
        verdict = F.coalesce("rule_verdict", F.lit("allow"))
        return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.lit(0.0).alias("score"))
    table, _ = common.stored(models(counts, order), "url-models")
    scored = (
        _grams(distinct.select("url", "key"), order)
        .join(table, "gram")
        .groupBy("key")
        .agg((F.sum("difference") / F.count("*")).alias("score"))
        .join(distinct.select("key", "rule_verdict", "checked", "n"), "key")
    )
    scored, _ = common.stored(scored, "url-scores")
    threshold = calibrated(
        scored.where("checked and rule_verdict is not null").select(
            "score", (F.col("rule_verdict") == "allow").alias("accepted"), "n"
        )
    )
    own = F.unhex(F.md5(F.coalesce("url", F.lit("")).cast("binary")))
    judged = rows.withColumn("key", own).join(scored.select("key", "score"), "key")
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judge(common.read_table(spark, sf_dir, "pages"))
