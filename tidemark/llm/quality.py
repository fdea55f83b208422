"""Quality classifier from weak labels (operator 4).

Overlapping heuristic labellers look at counts of a text and vote or abstain: ten look for signs of a bad text, two
call texts good that keep within all limits. How often each pattern of votes occurs is counted over all documents (at
most ``2 ** 12`` patterns), and expectation-maximisation estimates from these counts how often each labeller is right. The posterior of each document's pattern then labels it for
a linear scorer over hashed words and hashed levels of the counts: every task runs logistic regression over its
documents with a rate per weight, and the tasks' weights are averaged by rows. The scorer alone decides, also on unseen documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_small_batches
from tidemark.llm.minhash import slices
from tidemark.llm.words import IS_SPACE, U64, buffers, word_hashes

#: Signal, the limit up to which it fits a good text, and the level above which its labeller votes bad.
LABELLERS = (
    ("signs", 0.01, 0.04),
    ("capitals", 0.20, 0.50),
    ("top_word", 0.15, 0.30),
    ("lone_signs", 0.02, 0.15),
    ("calls", 0.05, 0.30),
    ("no_stop", 0.98, 0.999),
    ("short", 0.45, 0.50),
    ("echoes", 0.03, 0.15),
    ("tails", 0.03, 0.20),
    ("repeats", 0.30, 0.50),
)
#: The last two labellers vote good where all signals keep within this part of their limits.
CLEAN = (1.0, 0.7)
N_LABELLERS, N_BAD = len(LABELLERS) + len(CLEAN), len(LABELLERS)
SIGNALS = tuple(name for name, _, _ in LABELLERS) + ("variety", "word_length", "figures")
#: Hashed weights, levels per signal, learning rate and ridge of the scorer, length of a text's word part.
WEIGHTS, LEVELS, RATE, RIDGE, WORDS = 1 << 13, 12, 0.5, 1e-4, 0.3
EM_ROUNDS = 100
#: The score of a text without words.
NO_WORDS = -30.0
#: Text that a task looks at in one go.
BYTES = 4 << 20
#: Documents whose pattern is judged good or bad with this certainty teach the scorer.
CERTAIN = 0.9

_UPPER, _LETTER, _SIGN, _CALL, _STOP, _FIGURE = (np.zeros(256, np.uint8) for _ in range(6))
_UPPER[ord("A") : ord("Z") + 1] = 1
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = 1
_LETTER[0xC3] = 1
_SIGN[[ord(c) for c in "#$%&*@^~|<>{}[]\\=+_"]] = 1
_CALL[ord("!")] = _STOP[ord(".")] = 1
_FIGURE[ord("0") : ord("9") + 1] = 1
_LONE = word_hashes(*buffers(pa.array(["| - * # > < = + ~ / \\ • · – — :"])))[0]


def signals(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of shares for each text in the order of ``SIGNALS``, and its words as hashes with their bounds."""
    data, bounds = buffers(texts)
    words, word_bounds = word_hashes(data, bounds)
    size, n = np.diff(bounds), np.diff(word_bounds)
    full = np.flatnonzero(size > 0)

    def total(marks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size))
        if len(full):
            out[full] = np.add.reduceat(marks, bounds[:-1][full], dtype=np.int64)
        return out

    def count(table: np.ndarray) -> np.ndarray:
        return total(table[data])

    letters, upper = count(_LETTER), count(_UPPER)
    lone = np.concatenate([[0], np.cumsum(np.isin(words, _LONE))])[word_bounds]
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[word_bounds[:-1][n > 0]] = False
    echo = np.concatenate([[0], np.cumsum(same)])[word_bounds]
    last = np.ones(len(data), bool)
    last[:-1] = IS_SPACE[data[1:]]
    last[bounds[1:][full] - 1] = True
    tails = total((_SIGN | _CALL)[data] * last)
    with np.errstate(over="ignore"):
        joined = words[:-1] * U64(0x9E3779B97F4A7C15) + words[1:]
    top, distinct, pairs = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    for k in np.flatnonzero(n):
        run = np.sort(words[word_bounds[k] : word_bounds[k + 1]])
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]]))
        top[k], distinct[k] = np.diff(starts).max(), len(starts) - 1
        run = np.sort(joined[word_bounds[k] : word_bounds[k + 1] - 1])
        pairs[k] = np.count_nonzero(run[1:] != run[:-1]) + 1
    per_word, per_byte = np.maximum(n, 1), np.maximum(size, 1)
    shares = np.stack(
        [
            count(_SIGN) / per_byte,
            upper / np.maximum(letters, 1),
            np.where(n >= 20, top / per_word, 0),
            np.diff(lone) / per_word,
            count(_CALL) / per_word,
            np.where(n >= 50, 1 - count(_STOP) / per_word, 0),
            1 / (1 + n),
            np.diff(echo) / per_word,
            tails / per_word,
            np.where(n >= 20, 1 - pairs / np.maximum(n - 1, 1), 0),
            1 - distinct / per_word,
            size / per_word / 40,
            count(_FIGURE) / per_byte,
        ],
        axis=1,
    )
    return shares, words, word_bounds


def votes(shares: np.ndarray) -> np.ndarray:
    """``(texts, labellers)``: which labellers vote; the first ten vote bad, the others good."""
    good, bad = (np.array([limits[k] for limits in LABELLERS]) for k in (1, 2))
    own = shares[:, :N_BAD]
    return np.concatenate([own > bad, *((own <= part * good).all(axis=1)[:, None] for part in CLEAN)], axis=1)


def pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ (1 << np.arange(N_LABELLERS))


def estimate(counts: dict[int, int], rounds: int = EM_ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """Of each vote pattern the posterior to be good, and how often each labeller is right where it votes.

    Expectation-maximisation, labellers voting independently given the class. A labeller starts as right nine times of
    ten, which ten votes of its own are worth.
    """
    patterns = np.array(sorted(counts), np.int64)
    n = np.array([counts[p] for p in patterns.tolist()], float)
    vote = (patterns[:, None] >> np.arange(N_LABELLERS) & 1).astype(float)
    bad = np.arange(N_LABELLERS) < N_BAD
    right, share = np.full(N_LABELLERS, 0.9), 0.8
    for _ in range(rounds):
        odds = np.log(right / (1 - right)) * np.where(bad, -1, 1)
        good = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + vote @ odds, -700, 700)))
        agrees = np.where(bad, 1 - good[:, None], good[:, None])
        cast = n @ vote
        right = np.clip((n @ (vote * agrees) + 9) / (cast + 10), 0.5, 0.9999)
        share = (n @ good + 8) / (n.sum() + 10)
    return dict(zip(patterns.tolist(), good.tolist(), strict=True)), right


def _features(shares: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of each text: one hashed level for each signal, and its distinct hashed words."""
    level = np.minimum((np.sqrt(np.clip(shares, 0, 1)) * LEVELS).astype(np.int64), LEVELS - 1)
    place = np.array([[zlib.crc32(f"{s}={k}".encode()) % WEIGHTS for k in range(LEVELS)] for s in SIGNALS])
    levels = place[np.arange(len(SIGNALS)), level]
    hashed = (words & U64(WEIGHTS - 1)).astype(np.int64)
    for k in range(len(shares)):
        own = np.unique(hashed[bounds[k] : bounds[k + 1]])
        yield np.concatenate([levels[k], own]), np.concatenate([np.ones(len(SIGNALS)), np.full(len(own), WORDS / np.sqrt(max(1, len(own))))])


@dataclass(frozen=True)
class Model:
    posterior: dict[int, float]
    accuracy: np.ndarray
    weights: np.ndarray
    documents: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        shares, words, bounds = signals(texts)
        found = np.array([float(self.weights[at] @ value) for at, value in _features(shares, words, bounds)])
        return np.where(np.diff(bounds) > 0, found, NO_WORDS)


def fit(docs: DataFrame) -> Model:
    """Learn from all ``docs`` (column ``text``), in two passes; the driver receives vote counts and one weight row per
    hash place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << N_LABELLERS, np.int64)
        for batch in slices(batches, "text", BYTES):
            total += np.bincount(pattern(votes(signals(batch.column("text"))[0])), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pattern", "n"])

    docs = in_small_batches(docs)
    found = docs.select("text").mapInArrow(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counts = {r["pattern"]: r["n"] for r in found}
    posterior, accuracy = estimate(counts)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, steep, learnt = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-8), 0
        for batch in slices(batches, "text", BYTES):
            shares, words, bounds = signals(batch.column("text"))
            truth = [posterior[p] for p in pattern(votes(shares)).tolist()]
            for good, (at, value) in zip(truth, _features(shares, words, bounds), strict=True):
                if max(good, 1 - good) < CERTAIN:
                    continue
                off = good - 1 / (1 + np.exp(-np.clip(weights[at] @ value, -30, 30)))
                slope = off * value - RIDGE * weights[at]
                steep[at] += slope**2
                weights[at] += RATE * slope / np.sqrt(steep[at])
                learnt += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(WEIGHTS)), pa.array(weights * learnt), pa.array(np.full(WEIGHTS, learnt))], names=["at", "weight", "learnt"]
        )

    parts = docs.select("text").mapInArrow(descend, "at long, weight double, learnt long").groupBy("at")
    rows = parts.agg(F.sum("weight").alias("weight"), F.sum("learnt").alias("learnt")).toPandas()
    weights = np.zeros(WEIGHTS)
    weights[rows["at"]] = rows["weight"] / np.maximum(rows["learnt"], 1)
    return Model(posterior, accuracy, np.round(weights, 9), sum(counts.values()))


def scored(model: Model, text: Column) -> Column:
    """The log-odds that a text is good."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            whole = iter([pa.RecordBatch.from_arrays([texts], names=["text"])])
            parts = [model.scores(part.column("text")) for part in slices(whole, "text", BYTES)]
            yield pa.array(np.concatenate(parts or [np.zeros(0)]))

    return run(text)


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id, score, kept`` of every document; needs ``doc_id`` and ``text``, whole texts are read.

    ``score`` is the log-odds to be good; positive scores stay. Null, empty and blank texts score -30. The scorer learns
    from what it sees: a table with a handful of bad documents teaches it little. Rows are scored one by one, so repeated rows agree. An empty table gives an empty result.
    """
    model = fit(docs)
    return docs.select("doc_id", scored(model, F.col("text")).alias("score")).withColumn("kept", F.col("score") > 0)


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents the classifier keeps, in place: scoring moves no text."""
    return docs.filter(scored(fit(docs), F.col("text")) > 0)
