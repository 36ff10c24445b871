"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult with its weight, threat, target, negation, reported speech,
clause end, other). A first machine reads a clause from its end and marks the insults and
threats that a target follows. Five transducers then read the symbols forwards: insult and
threat emit their weights, a target near an insult, before or after it, raises it and is
what makes a threat count, negation shortly before lowers it, and a verb of reporting earlier in the clause lowers
what follows. They are composed into one machine, which scores matched clauses; isolated
words only count as part of a clause. Clause scores of the whole text are turned into a
probability by a logistic model.

Insults are learned: words, and beginnings of words, that are far more frequent in toxic
training documents. Both the words and the logistic model are fitted on at most
``SAMPLE`` labelled rows whose crc32 of doc_id is no multiple of five.

Defined results: null and empty texts get the score of a text without matches; without
training labels of both kinds every score is 0; without learned insults threats still
count, and if no training row holds a match every score is the share of toxic rows; repeated rows are scored alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common, quality

SAMPLE = 6_000
# Learned words: in at least this many toxic rows, this much likelier there. The sample bounds them.
LEAST_ROWS = 4
LEAST_ODDS = 3.0
PREFIXES = range(4, 9)

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
# Insults and threats that a target follows, and how many symbols a target may be away.
AIMED = {INSULT: "aimed insult", THREAT: "aimed threat"}
PHRASE_END = "phrase end"
REACH = {INSULT: 4, THREAT: 6}
MATCHES = (*AIMED, *AIMED.values())

# Small closed word lists of English, German, French and Spanish. Verbs of threat are stems with the
# endings of their language, and forms that have others.
THREATS = (
    ("kill hurt destroy beat burn murder shoot hang", " s ed ing"),
    ("strangl stabb", "e es ed ing"),
    ("stab stabs shot beaten burnt hung", ""),
    ("töt verletz schlag erschieß", "e st t en et te"),
    ("schlägt schlägst umbringen umbringt bringe", ""),
    ("tu frapp brûl", "er ez ent erai"),
    ("frapp brûl", "e es é"),
    ("mat golpe quem", "ar o as a an é aré aría ando"),
)
TARGETS = (
    "you your yourself yourselves he him his himself she her herself they them their themselves "
    "man men woman women guy girl boy child children kids people family everyone everybody "
    "du dich dir euch ihr ihn frau leute tu te toi vous lui eux homme femme enfant gens "
    "tú ti usted ustedes él ella ellos hombre mujer niño gente"
)
NEGATIONS = "not never no nobody isn't aren't don't won't nicht kein keine nie ne pas jamais non nunca jamás tampoco"
REPORTS = "said says wrote called quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó"
# Phrases that threaten as a whole, told by their last word; they need no further target.
PHRASES = {"die": "go should must will gonna", "dead": "you're youre be", "sterben": "sollst musst wirst"}
SYMBOLS = {
    **{stem + end: THREAT for stems, ends in THREATS for stem in stems.split() for end in ends.split(" ")},
    **{
        w: s
        for words, s in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
        for w in words.split()
    },
}

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n|]")
# Whether a text may hold a phrase: its two words with no letter or end of a clause between them.
_PHRASE_ENDS = frozenset(w.encode() for w in PHRASES)
_PHRASE = re.compile("|".join(rf"(?:{'|'.join(first.split())})[\W\d_]+{last}" for last, first in PHRASES.items()))
_ASCII_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_CLAUSE_END = frozenset(".!?;:\n|")


class Transducer:
    """A machine over symbols: ``step(state, symbol)`` gives the next state and the factor
    by which the weight of a match at this symbol is multiplied."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def __matmul__(self, other: Transducer) -> Transducer:
        """Both machines in step; their factors multiply."""

        def step(state, symbol):
            a, x = self.step(state[0], symbol)
            b, y = other.step(state[1], symbol)
            return (a, b), x * y

        return Transducer((self.start, other.start), step)


def _countdown(reach: int, trigger: str, near: float, far: float, of: tuple[str, ...]) -> Transducer:
    """For ``reach`` symbols after a trigger, symbols in ``of`` get ``near`` instead of ``far``."""

    def step(state, symbol):
        factor = (near if state else far) if symbol in of else 1.0
        return (reach if symbol == trigger else max(0, state - 1)), factor

    return Transducer(0, step)


def _near_target(of: str, near: float, far: float) -> Transducer:
    """Symbols ``of`` get ``near`` if a target is in reach before or after them, else ``far``."""
    before = _countdown(REACH[of], TARGET, near, far, (of,))

    def step(state, symbol):
        state, factor = before.step(state, symbol)
        return state, near if symbol == AIMED[of] else factor

    return Transducer(before.start, step)


def aimed(symbols: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """The symbols of a clause, read from its end, with those marked that a target follows in reach."""
    marked, away = [], max(REACH.values()) + 1
    for symbol, weight in reversed(symbols):
        marked.append((AIMED[symbol] if symbol in AIMED and away <= REACH[symbol] else symbol, weight))
        away = 1 if symbol == TARGET else away + 1
    return marked[::-1]


def _after(trigger: str, factor: float) -> Transducer:
    """Once the trigger was seen, the rest of the clause is weighted by ``factor``."""
    return Transducer(False, lambda state, symbol: (state or symbol == trigger, factor if state else 1.0))


GRAMMAR = (
    Transducer(None, lambda state, symbol: (None, 1.0 if symbol in MATCHES else 0.0))
    @ _near_target(INSULT, 1.5, 1.0)
    @ _near_target(THREAT, 1.5, 0.0)
    @ _countdown(3, NEGATION, 0.4, 1.0, MATCHES)
    @ _after(REPORT, 0.5)
)


class Machine:
    """The composed grammar with its transitions kept as they are met."""

    def __init__(self, grammar: Transducer = GRAMMAR):
        self.grammar = grammar
        self.table: dict = {}

    def clause(self, symbols: list[tuple[str, float]]) -> float:
        state, total = self.grammar.start, 0.0
        for symbol, weight in aimed(symbols):
            key = (state, symbol)
            if key not in self.table:
                self.table[key] = self.grammar.step(state, symbol)
            state, factor = self.table[key]
            total += weight * factor
        return total


class Scorer:
    """Clause scores of whole texts with a learned lexicon of words and beginnings."""

    def __init__(self, words: dict[str, float], prefixes: dict[str, float]):
        self.words, self.prefixes = words, prefixes
        self.machine = Machine()
        self.matching: dict[bytes, bool] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        if word in SYMBOLS:
            return SYMBOLS[word], 1.0
        if word in PHRASES:
            return PHRASE_END, 0.0
        if word in self.words:
            return INSULT, self.words[word]
        best = max((self.prefixes.get(word[:n], 0.0) for n in PREFIXES if n <= len(word)), default=0.0)
        return (INSULT, best) if best else (OTHER, 0.0)

    def phrased(self, words: list[str], known: dict[str, tuple[str, float]]) -> list[tuple[str, float]]:
        """Symbols of a clause's words; the last word of a threatening phrase is an aimed threat."""
        symbols = [known[w] for w in words]
        for k, (symbol, _) in enumerate(symbols):
            if symbol == PHRASE_END:
                whole = k and words[k - 1] in PHRASES[words[k]].split()
                symbols[k] = (AIMED[THREAT], 1.0) if whole else (OTHER, 0.0)
        return symbols

    def _matches(self, word: bytes) -> bool:
        """Whether a stretch of letters (and any non-ASCII characters) holds an insult or threat."""
        tokens = _TOKEN.findall(word.decode("utf-8", "replace"))
        return any(s in (INSULT, THREAT) for s, _ in map(self.symbol, tokens))

    def holds_any(self, lower: str) -> bool:
        """Whether any word can match: most texts need no more than this."""
        words = set(lower.encode("utf-8", "replace").translate(_ASCII_LETTERS).split())
        if len(self.matching) > 500_000:
            self.matching = {}
        matching = self.matching
        for word in [w for w in words if w not in matching]:
            matching[word] = self._matches(word)
        phrases = not words.isdisjoint(_PHRASE_ENDS) and _PHRASE.search(lower) is not None
        return phrases or any(map(matching.__getitem__, words))

    def clauses(self, text: str | None) -> list[float]:
        """Scores of the clauses that hold an insult or a threat."""
        lower, found = (text or "").lower(), []
        if not self.holds_any(lower):
            return found
        tokens = _TOKEN.findall(lower)
        known = {w: self.symbol(w) for w in set(tokens)}
        for end, group in itertools.groupby(tokens, _CLAUSE_END.__contains__):
            if not end:
                symbols = self.phrased(list(group), known)
                if any(s in (INSULT, THREAT, AIMED[THREAT]) for s, _ in symbols):
                    found.append(self.machine.clause(symbols))
        return found

    def features(self, text: str | None) -> list[float]:
        scores = [s for s in self.clauses(text) if s > 0]
        total, most = sum(scores), max(scores, default=0.0)
        size = len(text or "") / 100
        return [float(np.log1p(total)), float(np.log1p(most)), float(bool(scores)), float(np.log1p(total / (1 + size)))]


def learned_words(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]] | None:
    """Insult words and beginnings of words with weights, from rows (text, label); None without
    rows of both labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = {w for w in _TOKEN.findall((text or "").lower()) if w.isalpha()}
                terms = words | {w[:n] + "*" for w in words for n in PREFIXES if n < len(w)}
                (toxic if label else clean).update(terms)
            terms = list(toxic | clean)
            yield pd.DataFrame(
                {"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]}
            )

    counts = sample.mapInPandas(run, "term string, toxic long, clean long").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sizes = sample.groupBy("label").count().collect()
    rows = {r["label"]: r["count"] for r in sizes}
    if not rows.get(0) or not rows.get(1):
        return None
    odds = F.log((F.col("toxic") + 0.1) / rows[1]) - F.log((F.col("clean") + 0.1) / rows[0])
    best = counts.where(F.col("toxic") >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    best = best.collect()  # each in LEAST_ROWS of at most SAMPLE texts
    words = {r["term"]: min(r["odds"], 8.0) for r in best if not r["term"].endswith("*")}
    prefixes = {r["term"][:-1]: min(r["odds"], 8.0) for r in best if r["term"].endswith("*")}
    return words, prefixes


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE):
    """(scorer, logistic model), or None without labels of both kinds."""
    sample, _ = common.stored(quality.training_sample(docs, labels, "toxic", size), "toxicity-sample")
    learned = learned_words(sample)
    if learned is None:
        return None
    scorer = Scorer(*learned)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.features(t) for t in texts])

    rows = sample.select("doc_id", "label", run("text").alias("x")).collect()  # at most ``size`` short rows
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], dtype=float)
    return scorer, quality.fit_logistic(np.array([r["x"] for r in rows]), y)


def toxicity(model, text: F.Column) -> F.Column:
    """Probability that a text is toxic."""
    if model is None:
        return F.lit(0.0)
    scorer, (centre, scale, w) = model

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([scorer.features(t) for t in texts]).reshape(-1, len(centre))
        odds = ((x - centre) / scale) @ w[:-1] + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -30, 30))))

    return run(text)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = common.read_table(spark, sf_dir, "documents")
    model = fit(docs, common.read_table(spark, sf_dir, "labels"))
    found = docs.select(
        "doc_id", common.held_out(F.col("doc_id")).alias("held_out"), toxicity(model, F.col("text")).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
