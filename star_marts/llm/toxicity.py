"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs are words: a hashed word embedding, the mean of hashed embeddings of the word's character
n-grams, and the log-odds of both kinds of hashes among labelled documents.  The network reads
windows of `WINDOW` words, each overlapping the next; attention over its states gives a window's
logit, and a document has that of its highest window.  It is trained in numpy on the driver, on a
bounded sample of labelled documents, in folds: a fold trains the weights with log-odds counted in
the other folds, so that the weights learn how far log-odds of unseen documents can be trusted.

Labels are learned only from documents that `learnable` lets through; text is the only input of
a score.

Defined cases: null and empty texts are one window without words; long texts are scored in all
their windows, long words in pieces of `PIECE` bytes; labels that are null or other than 0 and 1
are not learned from; repeated rows are scored alike; an empty table gives no rows; without
labels of both kinds every score is the share of the kind there is, or one half; columns other
than doc_id and text are not read by `score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts.llm.common import text_batches, whole_text, word_list

# The bound of the training sample: documents of each label, and their longest text in bytes.
SAMPLE_TOXIC = 2500
SAMPLE_CLEAN = 4000
SAMPLE_BYTES = 16_000

THRESHOLD = 0.7
WINDOW, STRIDE = 48, 32
PIECE = 24
WORDS, GRAMS = 1 << 14, 1 << 14  # hash buckets, numbered by 16 bits
_GRAM_SIZES = (3, 4, 5)
_EMBEDDED = 6  # learned numbers per word, and per n-gram
HIDDEN = 10
FOLDS = 4
EPOCHS, BATCH, RATE = 3, 48, 0.02
LEAST_STEPS, MOST_EPOCHS = 120, 20  # few documents are read more often
LEAST_DOCUMENTS = 20  # a bucket in fewer has no embedding of its own, only its log-odds
_KNOWN_WORDS = 200_000  # words a worker remembers before it starts anew
_TRIM = b".,;:!?\"'()[]{}|*#$%&"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words without punctuation around them, long ones in pieces."""
    trimmed = [w.strip(_TRIM) or w for w in word_list(text)]
    if max(map(len, trimmed), default=0) <= PIECE:
        return trimmed
    return [w[i : i + PIECE] for w in trimmed for i in range(0, len(w), PIECE)]


def _letters(words: list[bytes]) -> np.ndarray:
    """Bytes of each word between two marks, padded by zeros."""
    joined = np.array([b"\x01" + w + b"\x02" for w in words], dtype=f"S{PIECE + 2}")
    return joined.view(np.uint8).reshape(len(words), PIECE + 2).astype(np.uint64)


def hashes(words: list[bytes], at_once: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and buckets of its character n-grams (GRAMS where there is none)."""
    parts = [_hashes(words[i : i + at_once]) for i in range(0, len(words), at_once)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    letters = _letters(words)
    mix = np.uint64(0x9E3779B97F4A7C15)
    powers = mix ** np.arange(1, letters.shape[1] + 1, dtype=np.uint64)
    word = ((letters * powers).sum(axis=1) * mix) >> np.uint64(64 - 14)
    grams = []
    for n in _GRAM_SIZES:
        spans = np.lib.stride_tricks.sliding_window_view(letters, n, axis=1)
        bucket = (((spans * powers[:n]).sum(axis=2) + np.uint64(n)) * mix) >> np.uint64(64 - 14)
        grams.append(np.where(spans[:, :, -1] > 0, bucket, np.uint64(GRAMS)))
    return word.astype(np.int16), np.concatenate(grams, axis=1).astype(np.int16)


def _log_odds(documents: list[np.ndarray], toxic: np.ndarray, buckets: int) -> np.ndarray:
    """How much likelier a bucket is in toxic documents; buckets of few documents count less.

    `documents` are the distinct buckets of each.
    """
    seen = np.zeros((2, buckets + 1))
    for found, label in zip(documents, toxic, strict=True):
        seen[int(label), found] += 1
    share = (seen + 0.5) / (np.array([[(toxic == 0).sum()], [(toxic == 1).sum()]]) + 1)
    odds = np.log(share[1] / share[0]) * np.minimum(1, seen.sum(axis=0) / 6)
    odds[-1] = 0
    return np.clip(odds, -4, 4).astype(np.float32)


def _document_counts(documents: list[np.ndarray], buckets: int) -> np.ndarray:
    seen = np.zeros(buckets + 1, np.int64)
    for found in documents:
        seen[found] += 1
    return seen


@dataclass
class Network:
    """Weights by name; odds of words and n-grams."""

    weights: dict[str, np.ndarray]
    word_odds: np.ndarray
    gram_odds: np.ndarray
    constant: float | None = None  # the score if there was nothing to learn from

    def inputs(self, word: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """One vector per word, from its buckets."""
        there = (grams < GRAMS)[:, :, None]
        count = np.maximum(there.sum(axis=1), 1)
        mean = (self.weights["gram"][grams] * there).sum(axis=1) / count
        odds = self.gram_odds[grams]
        return np.column_stack(
            [self.weights["word"][word], mean, self.word_odds[word], odds.max(axis=1), odds.sum(axis=1) / count[:, 0]]
        ).astype(np.float32)


def _gates(x: np.ndarray, w: dict[str, np.ndarray], side: str) -> np.ndarray:
    """The part of all gates that depends on the input alone."""
    return x @ w[f"in_{side}"] + w[f"bias_{side}"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _read(gates: np.ndarray, there: np.ndarray, u: np.ndarray, keep: bool = False):
    """States of a gated recurrent layer over [step, row, 3 x HIDDEN]; padding keeps the state."""
    steps, rows, _ = gates.shape
    h = np.zeros((rows, HIDDEN), np.float32)
    states = np.empty((steps, rows, HIDDEN), np.float32)
    memory = []
    for t in range(steps):
        from_h = h @ u
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + from_h[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * from_h[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if keep:
            memory.append((h, z, r, n, from_h[:, 2 * HIDDEN :]))
        h = np.where(there[t][:, None], new, h)
        states[t] = h
    return (states, memory) if keep else states


def _pooled(states: np.ndarray, there: np.ndarray, w: dict[str, np.ndarray]):
    """Attention over the steps of [step, row, 2 x HIDDEN]: logit, and what its gradient needs."""
    inner = np.tanh(states @ w["attend"])
    energy = np.where(there, inner @ w["query"], -1e9)
    energy = np.exp(energy - energy.max(axis=0))
    weight = energy * there
    weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
    context = (states * weight[:, :, None]).sum(axis=0)
    return context @ w["out"] + w["out_bias"], (inner, weight, context)


def window_logits(net: Network, forward: np.ndarray, backward: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Logits of windows: `at` [step, row] numbers words whose input gates are given."""
    w = net.weights
    ahead = _read(forward[at], there, w["rec_f"])
    back = _read(backward[at[::-1]], there[::-1], w["rec_b"])[::-1]
    return _pooled(np.concatenate([ahead, back], axis=2), there, w)[0]


def windows(length: int) -> list[tuple[int, int]]:
    """All windows of a text of so many words; the last reaches its end."""
    starts = range(0, max(1, length - WINDOW + STRIDE), STRIDE)
    return [(s, min(s + WINDOW, length)) for s in starts]


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts as [step, row] of word numbers, which are there, and each row's text."""
    spans = [(i, a, b) for i, ids in enumerate(texts) for a, b in windows(len(ids))]
    at = np.zeros((len(spans), WINDOW), np.intp)
    there = np.zeros((len(spans), WINDOW), bool)
    for row, (i, a, b) in enumerate(spans):
        at[row, : b - a] = texts[i][a:b]
        there[row, : b - a] = True
    return at.T, there.T, np.array([i for i, _, _ in spans], np.intp)


def _back_through(memory: list, u: np.ndarray, there: np.ndarray, given: np.ndarray):
    """Gradients of the input gates and of `u`, from those of the states."""
    steps, rows, _ = given.shape
    d_gates = np.zeros((steps, rows, 3 * HIDDEN), np.float32)
    d_u = np.zeros_like(u)
    d_h = np.zeros((rows, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, candidate = memory[t]
        d_all = d_h + given[t]
        mask = there[t][:, None]
        d_new = d_all * mask
        d_n = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (h - n) * z * (1 - z)
        d_r = d_n * candidate * r * (1 - r)
        d_gates[t] = np.concatenate([d_z, d_r, d_n], axis=1)
        d_from = np.concatenate([d_z, d_r, d_n * r], axis=1)
        d_u += h.T @ d_from
        d_h = d_all * ~mask + d_new * z + d_from @ u.T
    return d_gates, d_u


def gradients(net: Network, word: np.ndarray, grams: np.ndarray, at: np.ndarray, there: np.ndarray, toxic: np.ndarray):
    """Mean loss of windows with labels, and its gradient by weight."""
    w = net.weights
    used, place = np.unique(at, return_inverse=True)
    place = place.reshape(at.shape)
    x = net.inputs(word[used], grams[used])
    gates = {s: _gates(x, w, s) for s in "fb"}
    ahead, kept_f = _read(gates["f"][place], there, w["rec_f"], keep=True)
    back, kept_b = _read(gates["b"][place[::-1]], there[::-1], w["rec_b"], keep=True)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    logit, (inner, weight, context) = _pooled(states, there, w)
    p = _sigmoid(logit)
    loss = -np.mean(np.where(toxic, np.log(p + 1e-7), np.log(1 - p + 1e-7)))
    d_logit = ((p - toxic) / len(toxic)).astype(np.float32)
    grad = {"out": context.T @ d_logit, "out_bias": np.array(d_logit.sum(), np.float32)}
    d_context = np.outer(d_logit, w["out"])
    d_weight = (states * d_context).sum(axis=2)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["query"] = (inner * d_energy[:, :, None]).sum(axis=(0, 1))
    d_inner = d_energy[:, :, None] * w["query"] * (1 - inner * inner)
    grad["attend"] = np.tensordot(states, d_inner, axes=([0, 1], [0, 1]))
    d_states = weight[:, :, None] * d_context + d_inner @ w["attend"].T
    d_f, grad["rec_f"] = _back_through(kept_f, w["rec_f"], there, d_states[:, :, :HIDDEN])
    d_b, grad["rec_b"] = _back_through(kept_b, w["rec_b"], there[::-1], d_states[::-1, :, HIDDEN:])
    d_x = np.zeros_like(x)
    for side, d, where in (("f", d_f, place), ("b", d_b, place[::-1])):
        summed = np.zeros((len(used), 3 * HIDDEN), np.float32)
        np.add.at(summed, where.ravel(), d.reshape(-1, 3 * HIDDEN))
        grad[f"in_{side}"], grad[f"bias_{side}"] = x.T @ summed, summed.sum(axis=0)
        d_x += summed @ w[f"in_{side}"].T
    grad["word"] = (word[used], d_x[:, :_EMBEDDED])
    present = grams[used] < GRAMS
    share = d_x[:, None, _EMBEDDED : 2 * _EMBEDDED] / np.maximum(present.sum(axis=1), 1)[:, None, None]
    share = np.broadcast_to(share, (*present.shape, _EMBEDDED))
    grad["gram"] = (grams[used][present], share[present])
    return loss, grad


def _new_network(rng: np.random.Generator, word_odds: np.ndarray, gram_odds: np.ndarray) -> Network:
    inputs = 2 * _EMBEDDED + 3
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    weights = {
        "word": np.zeros((WORDS, _EMBEDDED), np.float32), "gram": np.zeros((GRAMS + 1, _EMBEDDED), np.float32),
        "attend": normal(2 * HIDDEN, HIDDEN, scale=0.3), "query": normal(HIDDEN, scale=0.3),
        "out": normal(2 * HIDDEN, scale=0.3), "out_bias": np.array(-1.0, np.float32),
    }
    for side in "fb":
        weights[f"in_{side}"] = normal(inputs, 3 * HIDDEN, scale=0.3)
        weights[f"rec_{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.2)
        weights[f"bias_{side}"] = np.zeros(3 * HIDDEN, np.float32)
    return Network(weights, word_odds, gram_odds)


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 1) -> Network:
    """A network for texts with labels 0 and 1, in an order that is taken as random."""
    toxic = np.asarray(toxic)
    rng = np.random.default_rng(seed)
    if len(set(toxic.tolist())) < 2:
        share = float(toxic.mean()) if len(toxic) else 0.5
        none = _new_network(rng, np.zeros(WORDS + 1, np.float32), np.zeros(GRAMS + 1, np.float32))
        return Network(none.weights, none.word_odds, none.gram_odds, share)
    numbers: dict[bytes, int] = {}
    documents = [
        np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.intp) for t in texts
    ]
    word, grams = hashes(list(numbers) or [b""])
    # A fold trains on odds counted in the others; the last odds, of all, are for scoring.
    fold = np.empty(len(toxic), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(toxic == label)
        fold[own] = np.arange(len(own)) % FOLDS
    by_word = [np.unique(word[d]) for d in documents]
    by_gram = [np.unique(grams[d]) for d in documents]
    odds = []
    for f in range(FOLDS + 1):
        counted = np.flatnonzero(fold != f)
        odds.append((
            _log_odds([by_word[i] for i in counted], toxic[counted], WORDS),
            _log_odds([by_gram[i] for i in counted], toxic[counted], GRAMS),
        ))
    net = _new_network(rng, *odds[FOLDS])
    common = {
        "word": _document_counts(by_word, WORDS)[:WORDS] >= LEAST_DOCUMENTS,
        "gram": _document_counts(by_gram, GRAMS) >= LEAST_DOCUMENTS,
    }
    w = net.weights
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    epochs = max(EPOCHS, min(MOST_EPOCHS, LEAST_STEPS * BATCH // len(toxic)))
    for epoch in range(epochs):
        order = rng.permutation(len(toxic))
        rate = RATE * (1 - epoch / epochs) + 0.001
        batches = [
            (f, own[i : i + BATCH])
            for f in range(FOLDS) for own in [order[fold[order] == f]] for i in range(0, len(own), BATCH)
        ]
        for b in rng.permutation(len(batches)):
            f, some = batches[b]
            net.word_odds, net.gram_odds = odds[f]
            at, there, text = _laid_out([documents[d] for d in some])
            used, place = np.unique(at, return_inverse=True)
            x = net.inputs(word[used], grams[used])
            logits = window_logits(net, _gates(x, w, "f"), _gates(x, w, "b"), place.reshape(at.shape), there)
            top = np.array([np.flatnonzero(text == d)[logits[text == d].argmax()] for d in range(len(some))])
            _, grad = gradients(net, word, grams, at[:, top], there[:, top], toxic[some])
            step += 1
            for name, g in grad.items():
                if isinstance(g, tuple):
                    full = np.zeros_like(w[name])
                    np.add.at(full, g[0], g[1])
                    g = full * common[name][:, None]
                g = np.clip(g, -1, 1)
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                w[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    net.word_odds, net.gram_odds = odds[FOLDS]
    return net


class Scorer:
    """Scores texts, remembering the input gates of words seen before."""

    def __init__(self, net: Network):
        self.net = net
        self.numbers: dict[bytes, int] = {}
        self.gates = {s: np.empty((1024, 3 * HIDDEN), np.float32) for s in "fb"}

    def _learn(self, words: set[bytes]) -> None:
        """Number new words and compute their gates."""
        some = sorted(words)
        start = len(self.numbers)
        self.numbers.update(zip(some, range(start, start + len(some)), strict=True))
        x = self.net.inputs(*hashes(some))
        for side, kept in self.gates.items():
            if len(kept) < len(self.numbers):
                grown = np.empty((2 * len(self.numbers), 3 * HIDDEN), np.float32)
                grown[:start] = kept[:start]
                self.gates[side] = kept = grown
            kept[start : len(self.numbers)] = _gates(x, self.net.weights, side)

    def _numbered(self, text: bytes) -> np.ndarray:
        words = words_of(text)
        new = set(words).difference(self.numbers)
        if new:
            self._learn(new)
        return np.fromiter(map(self.numbers.__getitem__, words), np.intp, len(words))

    def scores(self, texts: list[bytes], at_once: int = 1024) -> np.ndarray:
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        if len(self.numbers) > _KNOWN_WORDS:
            self.__init__(self.net)
        if not self.numbers:
            self._learn({b""})
        at, there, text = _laid_out([self._numbered(t) for t in texts])
        best = np.full(len(texts), -np.inf)
        for i in range(0, at.shape[1], at_once):
            some = slice(i, i + at_once)
            logits = window_logits(self.net, self.gates["f"], self.gates["b"], at[:, some], there[:, some])
            np.maximum.at(best, text[some], logits)
        return 1 / (1 + np.exp(-np.clip(best, -30, 30)))


def held_out() -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of at most SAMPLE_TOXIC + SAMPLE_CLEAN documents, in the order of a hash."""
    short = docs.select(F.col("doc_id"), whole_text().cast("binary").alias("text")).filter(
        F.octet_length("text") <= SAMPLE_BYTES
    )
    known = labels.filter(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    order = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = [
        known.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = short.join(ids, "doc_id").orderBy(order, "doc_id", "text").limit(SAMPLE_TOXIC + SAMPLE_CLEAN).collect()
    return [bytes(r.text) for r in rows], np.array([r.toxic for r in rows], np.int64)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    net = train(*training_sample(docs, labels))
    return score_with(docs, net).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def score_with(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out and score by a trained network."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            scores = scorer.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
        whole_text().cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without those that score `threshold` or more."""
    net = train(*training_sample(docs, labels))
    text_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
