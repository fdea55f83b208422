"""A hidden Markov language model over hashed word classes (operator 6).

A word belongs to one of 4,096 classes by its hash. The model says ``P(text) = P(classes) * prod P(word | class)``: the
classes come from a hidden Markov chain, the word within its class from smoothed counts with one unknown word per class,
so all texts' probabilities sum to one. Only the chain needs order, and its tables have a fixed size.

Counting words: tasks add up what they see, one shuffle sums it. Training: each Baum-Welch round adds expected counts in
every task and sums at most 4,105 rows. Scoring: frequent words are looked up in a table of bounded size in the task,
rare ones go through one join by word; the scaled forward recursion gives the exact likelihood of the whole sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.minhash import slices
from tidemark.llm.words import U64, _random, buffers, word_hashes

STATES, CLASS_BITS, ROUNDS, SEED = 8, 12, 3, 3
CLASSES = 1 << CLASS_BITS
#: A training sequence is a run of so many tokens of a document; scoring takes whole documents.
SEQUENCE = 256
#: Words looked up without a join, at most.
FREQUENT = 1 << 18
#: Expected counts are summed as whole numbers of this part, so their sum does not depend on the order of tasks.
PART = 10_000
HELD_OUT_OF, HELD_OUT = 5, 1
END = _random(21, 1)[0]
#: Distinct words a task holds before it passes their counts on.
HOLD = 1 << 21
BYTES = 24 << 20


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % HELD_OUT_OF == HELD_OUT


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and the bounds of the texts."""
    words, bounds = word_hashes(*buffers(texts))
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


def classes(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - CLASS_BITS)).astype(np.int32)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times = np.zeros(0, U64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "n"])

        for batch in slices(batches, "text"):
            some, n = np.unique(tokens(batch.column("text"))[0], return_counts=True)
            both = np.concatenate([words, some])
            words, where = np.unique(both, return_inverse=True)
            times = np.bincount(where, np.concatenate([times, n]), len(words)).astype(np.int64)
            if len(words) > HOLD:
                yield out()
                words, times = np.zeros(0, U64), np.zeros(0, np.int64)
        yield out()

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Chain:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (classes, states)

    def log10(self, seen: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The exact log10 likelihood of each sequence, all of them step by step, longest first."""
        length = np.diff(bounds)
        order = np.argsort(-length, kind="stable")
        first, length = bounds[:-1][order], length[order]
        total = np.zeros(len(order))
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1) + 0.5) if len(length) else []
        state = None
        for t, k in enumerate(active):
            before = self.start if state is None else state[:k] @ self.move
            state = before * self.emit[seen[first[:k] + t]]
            scale = state.sum(axis=1)
            state /= scale[:, None]
            total[:k] += np.log10(scale)
        out = np.empty(len(order))
        out[order] = total
        return out

    def expected(self, seen: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Baum-Welch counts: a row for each class, then each state's moves, then the starts."""
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        start, move, emit = (x.astype(np.float32) for x in (self.start, self.move, self.emit))
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1) + 0.5)
        forward, scales = [], []
        for t, k in enumerate(active):
            state = (start if not t else forward[-1][:k] @ move) * emit[seen[first[:k] + t]]
            scales.append(state.sum(axis=1, keepdims=True))
            forward.append(state / scales[-1])
        share = np.empty((len(seen), STATES), np.float32)
        moves = np.zeros((STATES, STATES))
        back = np.ones((active[-1], STATES), np.float32)
        for t in range(len(active) - 1, -1, -1):
            k = active[t]
            share[first[:k] + t] = forward[t] * back
            if t:
                ahead = emit[seen[first[:k] + t]] * back / scales[t]
                moves += forward[t - 1][:k].T @ ahead
                back = np.ones((active[t - 1], STATES), np.float32)
                back[:k] = ahead @ move.T
        emitted = np.stack([np.bincount(seen, share[:, s], CLASSES) for s in range(STATES)], axis=1)
        return np.concatenate([emitted, moves * self.move, share[first].sum(axis=0, dtype=float)[None]])


def _sequences(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and lengths of the training sequences."""
    first = np.concatenate([np.arange(a, b, SEQUENCE) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])
    end = np.minimum(first + SEQUENCE, bounds[np.searchsorted(bounds, first, "right")])
    return first, end - first


def train(docs: DataFrame, prior: np.ndarray, rounds: int = ROUNDS) -> Chain:
    """Baum-Welch over all ``docs``; ``prior`` is the share of each class."""
    random = np.random.Generator(np.random.PCG64(SEED))
    emit = prior[:, None] * np.exp(0.5 * random.standard_normal((CLASSES, STATES)))
    stay = np.full((STATES, STATES), 0.1 / (STATES - 1)) + (0.9 - 0.1 / (STATES - 1)) * np.eye(STATES)
    chain = Chain(np.full(STATES, 1 / STATES), stay, emit / emit.sum(axis=0))
    spark = docs.sparkSession
    sums = [f"s{k}" for k in range(STATES)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(chain)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CLASSES + STATES + 1, STATES))
            for batch in slices(batches, "text"):
                words, bounds = tokens(batch.column("text"))
                if len(words):
                    total += shared.value.expected(classes(words), *_sequences(bounds))
            whole = np.rint(total * PART).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole), dtype=np.int32)), *map(pa.array, np.ascontiguousarray(whole.T))], names=["row", *sums])

        parts = docs.select("text").mapInArrow(expect, "row int, " + ", ".join(f"{s} long" for s in sums))
        found = parts.groupBy("row").agg(*(F.sum(s).alias(s) for s in sums)).toPandas()
        total = np.zeros((CLASSES + STATES + 1, STATES))
        total[found["row"].to_numpy()] = found[sums].to_numpy() / PART
        emit = total[:CLASSES] + prior[:, None]
        move = total[CLASSES:-1] + 1 / STATES
        start = total[-1] + 1 / STATES
        chain = Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return chain


def _frequent(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words and counts above the lowest count that at most ``FREQUENT`` words reach, in order of the words."""
    step = F.floor(F.log2("n") * 8).cast("int")
    many = {r["step"]: r["count"] for r in vocabulary.groupBy(step.alias("step")).count().collect()}
    least, held = None, 0
    for s in sorted(many, reverse=True):
        held += many[s]
        if held > FREQUENT:
            break
        least = s
    if least is None:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    found = vocabulary.filter(step >= least).toPandas()
    words = found["word"].to_numpy(np.int64).view(U64)
    order = np.argsort(words)
    return words[order], found["n"].to_numpy(np.int64)[order]


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Needs ``doc_id`` and ``text``. Learns from the rows that are not held out; rows are scored one by one, so repeated
    rows give repeated results. Null and empty texts are the end alone; a null id counts as empty text for the fold.
    Without training rows every word is unknown. An empty table gives an empty result. Words are told apart by 64-bit
    hashes.
    """
    spark = docs.sparkSession
    training = docs.filter(~held_out())
    vocabulary = stored(word_counts(training), "vocabulary")
    in_class = F.shiftrightunsigned("word", 64 - CLASS_BITS).cast("int")
    per_class = vocabulary.groupBy(in_class.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens_of[per_class["class"]], words_of[per_class["class"]] = per_class["n"], per_class["v"]
    n_train, n_words = int(tokens_of.sum()), int(words_of.sum())
    mass = tokens_of + 0.5 * (words_of + 1)
    chain = train(training, mass / mass.sum(), rounds)
    shared = spark.sparkContext.broadcast((chain, np.log10(mass), *_frequent(vocabulary)))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, in_class, frequent, times = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", BYTES):
            words, bounds = tokens(batch.column("text"))
            seen = classes(words)
            at = np.searchsorted(frequent, words)
            known = at < len(frequent)
            known[known] = frequent[at[known]] == words[known]
            n = np.zeros(len(words))
            n[known] = times[at[known]]
            per = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has an end, so none is empty
            rare = np.flatnonzero(~known)
            owner = np.searchsorted(bounds, rare, "right") - 1
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(batch.num_rows)), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(bounds)),
                    pa.array(per(known.astype(np.int64))), pa.array(per(np.log10(n + 0.5))),
                    pa.array(chain.log10(seen, bounds) - per(in_class[seen])),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(words[rare].view(np.int64))),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "words_log", "chain_log", "rare"],
            )
            row += batch.num_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        evaluate,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, words_log double, chain_log double, rare array<long>",
    )
    rows = stored(rows, "scored")
    rare = rows.select("row", F.explode("rare").alias("rare"))
    found = rare.join(vocabulary, F.col("rare") == F.col("word")).groupBy(F.col("row").alias("_row"))
    found = found.agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 0.5) - np.log10(0.5).item()).alias("more_log"))
    logs = F.col("words_log") + F.coalesce("more_log", F.lit(0.0))
    return rows.drop("rare").join(found, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(n_train + 0.5 * (n_words + 1)))).alias("base_score"),
        (logs + F.col("chain_log")).alias("score"),
    )
