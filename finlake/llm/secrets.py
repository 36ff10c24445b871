"""Secret scans by a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived (Python's own
pattern parse, walked for the literals that every match must hold). The index has one
posting per distinct text and trigram that some query asks for. Postings are intersected
by counting, per text and clause, how many of the clause's trigrams are there; texts that
satisfy a clause are candidates and only they are matched against the rule. Rules without
mandatory trigrams (the hexadecimal one) are matched against every text.

Texts are indexed and joined by their MD5 digest, so repeated rows and copies share one
entry and null or repeated doc_ids do no harm. Offsets count code points, ends are
exclusive. Matches come from splitting at the pattern: pieces and matches alternate, so
the running sums of their lengths are the offsets. Sums run by doubling, and masked texts are joined
once from pieces cut out of chunks, so a text with very many matches takes hardly more than its share.

Defined results: a null text counts as empty and has no spans; spans of different kinds
may overlap; ties in start are listed in the order of the rules; an empty table gives no
rows; extra columns are kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import re._constants as sre
import re._parser as sre_parse
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import common

# Literal strings a walk keeps apart at once; more are treated as unknown text.
MOST_LITERALS = 64
# Code points of a chunk in which parts of a text are looked up.
CHUNK = 4_096


@dataclass(frozen=True)
class Rule:
    """kind; pattern; whether letters match in either case; the group whose length is
    tested (0: all of the match) and its least length."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 1
    # Equal matches by a pattern that a longer least length makes cheaper; else the pattern.
    quick: str = ""


RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        any_case=True,
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, quick=r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", least=32, quick=r"[0-9a-f]{32,}"),
    # Beyond the three basic kinds: widely published formats of keys.
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
BASE_KINDS = ("assign", "access", "hex")


def _joined(left: set[str], right: set[str]) -> set[str] | None:
    made = {a + b for a, b in itertools.product(left, right)}
    return made if len(made) <= MOST_LITERALS else None


def _walk(parsed, runs: list[set[str]], open_run: set[str]) -> set[str]:
    """Extend the literal strings seen so far; ``runs`` gets sets that some text must hold one of."""

    def closed() -> set[str]:
        runs.append(open_run)
        return {""}

    for op, arg in parsed:
        if op is sre.LITERAL:
            made = _joined(open_run, {chr(arg)})
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
            made = _joined(open_run, {chr(c) for _, c in arg})
        elif op is sre.SUBPATTERN:
            inner: list[set[str]] = []
            last = _walk(arg[-1], inner, {""})
            if inner:  # unbounded parts inside: the strings before and after do not touch
                runs.append(_joined(open_run, inner[0]) or open_run)
                runs.extend(inner[1:])
                open_run = last
                continue
            made = _joined(open_run, last)
        elif op is sre.BRANCH:
            made = set()
            for branch in arg[1]:
                inner = []
                last = _walk(branch, inner, {""})
                if inner:
                    made = None
                    break
                made |= last
            made = made and _joined(open_run, made)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
            inner = []
            last = _walk(arg[2], inner, {""})
            made = None if inner else _joined(open_run, last | ({""} if arg[0] == 0 else set()))
        else:
            made = None
        if made:
            open_run = made
        else:
            open_run = closed()
    return open_run


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams; every match holds all trigrams of some clause.

    No clauses: the pattern has no mandatory trigram.
    """
    runs: list[set[str]] = []
    runs.append(_walk(sre_parse.parse(pattern), runs, {""}))
    clauses = [frozenset()]
    for run in runs:
        sets = {frozenset(w[k : k + 3] for k in range(len(w) - 2)) for w in (x.lower() for x in run)}
        sets = {s for s in sets if not any(other < s for other in sets)}
        if all(sets) and len(sets) * len(clauses) <= MOST_LITERALS:
            clauses = [a | b for a in clauses for b in sets]
    clauses = [c for c in set(clauses) if not any(other < c for other in clauses)]
    return sorted(clauses, key=sorted) if all(clauses) else []


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, key) of distinct texts (key, text)."""
    lowered = texts.select("key", F.lower("text").alias("lower"))
    present = F.array(*[F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams])
    return lowered.select("key", F.explode(F.array_compact(present)).alias("trigram")).distinct()


def candidates(spark: SparkSession, index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Texts (key) with the kinds some clause of which they satisfy."""
    rows = [
        (rule.kind, f"{rule.kind}:{k}", trigram, len(clause))
        for rule in rules
        for k, clause in enumerate(trigram_query(rule.pattern))
        for trigram in sorted(clause)
    ]
    queries = spark.createDataFrame(rows, "kind string, clause string, trigram string, size int")
    # One row per trigram of the rules: their number bounds it.
    met = index.join(F.broadcast(queries), "trigram").groupBy("key", "kind", "clause", "size").agg(F.count("*").alias("n"))
    return met.where("n = size").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _bound(value: F.Column, use) -> F.Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(values: F.Column, both) -> F.Column:
    """``both`` of each element and all before it, for an associative function.

    Doubling: each step joins with the element 1, 2, 4, ... places before, so an array of n
    elements takes n log n joins; steps that reach beyond an array leave it as it is.
    """

    def joined(a, k):
        each = F.transform(a, lambda x, i: F.when(i >= k, both(F.get(a, i - k), x)).otherwise(x))
        return F.when(F.size(a) <= k, a).otherwise(each)

    return F.aggregate(F.array(*[F.lit(1 << step) for step in range(31)]), values, joined)


def matches(rule: Rule, text: F.Column) -> F.Column:
    """All matches as an array of (start, rank, end, kind), in code points."""
    flags = "(?i)" if rule.any_case else ""
    pattern = F.lit(flags + (rule.quick or rule.pattern))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    pieces = F.split(text, pattern, -1)
    # A match ends where it, the piece right before it, and all before those end.
    rows = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("piece"), found.alias("found"), tested.alias("tested")),
        lambda x: F.struct(
            F.length(x["piece"]).alias("gap"), F.length(x["found"]).alias("n"), F.length(x["tested"]).alias("tested")
        ),
    )
    rank = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)

    def span(x, end):
        return F.struct(
            (end - x["n"]).alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(rule.kind).alias("kind"),
            x["tested"].alias("tested"),
        )

    def placed(rows):
        ends = running(F.transform(rows, lambda x: x["gap"] + x["n"]), lambda a, b: a + b)
        return F.zip_with(rows, ends, span)

    return F.filter(_bound(rows, placed), lambda s: s["tested"] >= rule.least)


NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,tested:int>>"


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, column: str = "__spans") -> DataFrame:
    """Documents with the spans of all rules, by start and then in the order of the rules."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("__key", F.md5(text.cast("binary")))
    trigrams = sorted({t for r in rules for c in trigram_query(r.pattern) for t in c})
    if trigrams:
        index, _ = common.stored(postings(keyed.select(F.col("__key").alias("key"), text.alias("text")), trigrams), "trigrams")
        kinds = candidates(spark, index, rules).withColumnsRenamed({"key": "__key", "kinds": "__kinds"})
        keyed = keyed.join(kinds, "__key", "left")
    else:
        keyed = keyed.withColumn("__kinds", F.lit(None).cast("array<string>"))
    parts = []
    for rule in rules:
        if trigram_query(rule.pattern):
            wanted = F.array_contains("__kinds", rule.kind)
        else:
            wanted = text.rlike(("(?i)" if rule.any_case else "") + (rule.quick or rule.pattern))
        parts.append(F.when(wanted, matches(rule, text)).otherwise(F.array().cast(NO_SPANS)))
    return keyed.withColumn(column, F.array_sort(F.concat(*parts))).drop("__key", "__kinds")


def listed(spans: F.Column) -> F.Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (start, end, kind) of every row."""
    found = with_spans(docs.select("doc_id", "text"), rules)
    spans = F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.select("doc_id", spans.alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every span, overlapping ones joined, replaced by a mark.

    Other columns stay, but n_chars, if there, follows the text. Null texts stay null.
    """
    columns = docs.columns
    found = with_spans(docs, rules)
    # Taking a part of a long string walks it from its start, so the text is cut first.
    chunks = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))

    def between(chunks, a, b):
        first, last = F.floor(a / F.lit(CHUNK)).cast("int"), F.floor(b / F.lit(CHUNK)).cast("int")
        head, tail = F.coalesce(F.get(chunks, first), F.lit("")), F.coalesce(F.get(chunks, last), F.lit(""))
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, F.substr(head, a % CHUNK + 1, b - a)).otherwise(
            F.concat(F.substr(head, a % CHUNK + 1, F.lit(CHUNK)), inner, F.substr(tail, F.lit(1), b % CHUNK))
        )

    def masked(chunks, reach):
        def part(s, i):
            at = F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0))
            return _bound(
                at, lambda at: F.when(s["start"] < at, F.lit("")).otherwise(F.concat(between(chunks, at, s["start"]), F.lit(mark)))
            )

        rest = between(chunks, F.element_at(reach, -1), F.length("text"))
        return F.concat(F.array_join(F.transform("__spans", part), ""), rest)

    # How far the spans up to each one reach.
    reach = running(F.transform("__spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    clean = F.when(F.size("__spans") == 0, F.col("text")).otherwise(
        _bound(chunks, lambda chunks: _bound(reach, lambda reach: masked(chunks, reach)))
    )
    found = found.withColumn("text", clean)
    if "n_chars" in columns:
        found = found.withColumn(
            "n_chars", F.when(F.size("__spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
        )
    return found.select(*columns)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the basic spans, and all spans of every document."""
    found = scan(common.read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def matched_by_scan(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, str]]:
    """The same spans by scanning one text in full; for tests."""
    found = []
    for rank, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.IGNORECASE | re.ASCII if rule.any_case else re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return [(a, b, k) for a, _, b, k in sorted(found)]
