"""Language identification by a bidirectional gated recurrent network over bytes.

Whole texts are read as UTF-8 bytes in pieces of ``STEPS`` bytes; a forward and a
backward gated recurrent layer read each piece, every position gets a probability for
each language from both, and a document's probabilities are the means over all its
positions. The network is trained in numpy by backpropagation through time on pieces
spread over at most ``SAMPLE`` training documents (crc32 of doc_id no multiple of five,
language known); the pieces' number per document is bounded, so is what the driver holds.

Defined results: null texts and texts without a letter are ``und`` with score 1; without
training rows every text is ``und`` with score 0; repeated rows are judged alike; an empty
table gives no rows; ties go to the first language by name; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm import common

SAMPLE = 1_500
PIECES = 6
STEPS = 64
HIDDEN = 8
EPOCHS = 4
BATCH = 256
RATE = 0.02
SEED = 7
# Pieces that are read at once.
WIDTH = 2_048


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter; numerals such as fractions or circled figures are none."""
    return any(c.isalpha() for c in text or "")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Layer:
    """A gated recurrent layer that reads bytes; rows are units, columns are pieces."""

    def __init__(self, random: np.random.Generator, hidden: int):
        self.w = (random.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (random.standard_normal((3 * hidden, hidden)) * 0.3).astype(np.float32)
        self.hidden = hidden

    def forward(self, data: np.ndarray, keep: bool = False):
        """States after every step, (steps, hidden, pieces), of bytes (steps, pieces)."""
        n = self.hidden
        state = np.zeros((n, data.shape[1]), np.float32)
        states = np.empty((len(data), *state.shape), np.float32)
        kept = []
        for t, row in enumerate(data):
            x, h = np.ascontiguousarray(self.w[row].T), self.u @ state
            gates = _sigmoid(x[: 2 * n] + h[: 2 * n])
            update, reset = gates[:n], gates[n:]
            fresh = np.tanh(x[2 * n :] + reset * h[2 * n :])
            if keep:
                kept.append((state, update, reset, fresh, h[2 * n :]))
            state = fresh + update * (state - fresh)
            states[t] = state
        return (states, kept) if keep else states

    def read(self, data: np.ndarray) -> np.ndarray:
        """The states of ``forward``, computed in reused arrays."""
        n, pieces = self.hidden, data.shape[1]
        half = np.float32(0.5)
        # A sigmoid is half a tanh of half its argument, so the gates' weights are halved.
        scale = np.repeat(np.array([0.5, 1], np.float32), [2 * n, n])
        w, u = np.ascontiguousarray((self.w * scale).T), self.u * scale[:, None]
        x, h = np.empty((3 * n, pieces), np.float32), np.empty((3 * n, pieces), np.float32)
        gates, update, reset, inner, fresh = h[: 2 * n], h[:n], h[n : 2 * n], h[2 * n :], x[2 * n :]
        states = np.empty((len(data), n, pieces), np.float32)
        state = np.zeros((n, pieces), np.float32)
        for t, row in enumerate(data):
            np.take(w, row, axis=1, out=x, mode="clip")
            np.dot(u, state, out=h)
            gates += x[: 2 * n]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= half
            inner *= reset
            fresh += inner
            np.tanh(fresh, out=fresh)
            np.subtract(state, fresh, out=inner)
            inner *= update
            state = states[t]
            np.add(fresh, inner, out=state)
        return states

    def backward(self, data: np.ndarray, kept: list, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of w and u from those of the states, back through time."""
        n = self.hidden
        dw, du = np.zeros_like(self.w), np.zeros_like(self.u)
        carried = np.zeros_like(gradient[0])
        for t in range(len(data) - 1, -1, -1):
            state, update, reset, fresh, inner = kept[t]
            total = gradient[t] + carried
            d_update = total * (state - fresh) * update * (1 - update)
            d_fresh = total * (1 - update) * (1 - fresh * fresh)
            d_reset = d_fresh * inner * reset * (1 - reset)
            d_input = np.concatenate([d_update, d_reset, d_fresh])
            d_hidden = np.concatenate([d_update, d_reset, d_fresh * reset])
            np.add.at(dw, data[t], d_input.T)
            du += d_hidden @ state.T
            carried = total * update + self.u.T @ d_hidden
        return dw, du


class Network:
    """Two layers, one per direction, and a softmax over languages at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.layers = [Layer(random, hidden), Layer(random, hidden)]
        self.v = (random.standard_normal((len(languages), 2 * hidden)) * 0.3).astype(np.float32)
        self.b = np.zeros((len(languages), 1), np.float32)

    def _shares(self, states: np.ndarray) -> np.ndarray:
        scores = self.v @ states + self.b
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=1, keepdims=True)

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, pieces) of bytes (steps, pieces)."""
        n = self.layers[0].hidden
        scores = self.v[:, :n] @ self.layers[0].read(data)
        scores += (self.v[:, n:] @ self.layers[1].read(data[::-1]))[::-1]
        scores += self.b
        # States lie between -1 and 1, so the scores are small enough to be raised as they are.
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions, and its gradients, for one label per piece."""
        ahead, kept = self.layers[0].forward(data, keep=True)
        back, kept_back = self.layers[1].forward(data[::-1], keep=True)
        states = np.concatenate([ahead, back[::-1]], axis=1)
        shares = self._shares(states)
        columns = np.arange(data.shape[1])
        loss = -float(np.log(shares[:, labels, columns] + 1e-12).mean())
        shares[:, labels, columns] -= 1
        shares /= data.size
        dv = np.einsum("tkb,thb->kh", shares, states, optimize=True)
        db = shares.sum(axis=(0, 2))[:, None]
        d_states = self.v.T @ shares
        n = self.layers[0].hidden
        dw0, du0 = self.layers[0].backward(data, kept, d_states[:, :n])
        dw1, du1 = self.layers[1].backward(data[::-1], kept_back, d_states[::-1, n:])
        return loss, [dw0, du0, dw1, du1, dv, db]

    def parameters(self) -> list[np.ndarray]:
        a, b = self.layers
        return [a.w, a.u, b.w, b.u, self.v, self.b]

    def train(self, data: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        random = np.random.default_rng(seed)
        own = self.parameters()
        first, second = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own]
        losses, step = [], 0
        for epoch in range(epochs):
            order, spent = random.permutation(len(labels)), []
            for k in range(0, len(order), BATCH):
                at = order[k : k + BATCH]
                loss, gradients = self.gradients(np.ascontiguousarray(data[at].T), labels[at])
                spent.append(loss)
                step += 1
                rate = RATE * (1 - epoch / (epochs + 1))
                for p, g, m, s in zip(own, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(spent)))
        return losses

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text, (texts, languages)."""
        sizes = np.array([len(t) for t in texts])
        pieces = -(-sizes // STEPS)
        padded = np.frombuffer(b"".join(t + b" " * (-len(t) % STEPS) for t in texts), np.uint8).reshape(-1, STEPS)
        filled = np.full(len(padded), STEPS)
        filled[np.cumsum(pieces) - 1] -= pieces * STEPS - sizes
        sums = np.empty((len(padded), len(self.languages)))
        for k in range(0, len(padded), WIDTH):
            shares = self.positions(np.ascontiguousarray(padded[k : k + WIDTH].T))
            full = filled[k : k + WIDTH]
            for at in np.flatnonzero(full < STEPS).tolist():
                shares[full[at] :, :, at] = 0
            sums[k : k + WIDTH] = shares.sum(axis=0).T
        return np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0) / sizes[:, None]


def training_pieces(docs: DataFrame, size: int = SAMPLE) -> tuple[np.ndarray, list[str]]:
    """Pieces (n, STEPS) of training documents and their languages, at most size * PIECES."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    rows = rows.where("lang is not null and length(text) > 0").where(common.training_row(F.col("doc_id")))
    # One row per document, text and language together, whatever the order of the rows.
    rows = rows.withColumn("hash", F.xxhash64("text"))
    ids = rows.groupBy("doc_id").agg(F.min(F.struct("hash", "lang")).alias("row")).select("doc_id", "row.*")
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    sample = rows.join(F.broadcast(chosen), ["doc_id", "hash", "lang"]).dropDuplicates(["doc_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, lang in zip(batch["doc_id"], batch["text"], batch["lang"], strict=True):
                raw = text.encode("utf-8", "replace")
                raw += b" " * max(0, STEPS - len(raw))
                starts = np.unique(np.linspace(0, len(raw) - STEPS, PIECES).astype(int))
                out += [(doc_id, int(s), lang, raw[s : s + STEPS]) for s in starts]
            yield pd.DataFrame(out, columns=["doc_id", "start", "lang", "piece"])

    found = sample.mapInPandas(run, "doc_id long, start long, lang string, piece binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["start"]))
    data = np.frombuffer(b"".join(bytes(r["piece"]) for r in found), np.uint8).reshape(-1, STEPS)
    return data, [r["lang"] for r in found]


def fit(docs: DataFrame, size: int = SAMPLE) -> Network | None:
    data, langs = training_pieces(docs, size)
    if not len(langs):
        return None
    languages = sorted(set(langs))
    network = Network(languages)
    network.train(data, np.array([languages.index(x) for x in langs]))
    return network


def identified(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of documents (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores = ["und"] * len(batch), np.ones(len(batch))
            texts = batch["text"].tolist()
            at = [k for k, t in enumerate(texts) if has_letter(t)]
            if network is None:
                scores[at] = 0.0
                at = []
            slices, k = common.in_slices([texts[i] for i in at], 2_000_000), 0
            for part in slices:
                means = network.pooled([t.encode("utf-8", "replace") for t in part])
                for row in means:
                    best = int(row.argmax())
                    langs[at[k]], scores[at[k]] = network.languages[best], min(1.0, float(row[best]))
                    k += 1
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": langs, "score": scores})

    schema = T.StructType.fromDDL("doc_id long, lang_pred string, score double")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = common.read_table(spark, sf_dir, "documents")
    found = identified(docs, fit(docs))
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
