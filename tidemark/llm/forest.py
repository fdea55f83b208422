"""Approximate nearest neighbours with a hash-prefix forest (operator 1).

Each tree gives a vector a hash string: one letter per random rotation, the axis and sign the rotated vector lies nearest
to. Sorted by their strings, the vectors of a tree are an array in which a prefix is a range. Ranges are cut where they
hold too many vectors, so leaves have prefixes of different lengths; the table of leaves and their sizes has a bounded
number of rows and goes to all tasks.

A query descends in every tree along its string to the longest prefix there is. Then all trees ascend together: in each
step every tree adds the range that shares the next shorter prefix, nearest letter first, until the ranges hold enough
vectors. How many are enough is fitted on a bounded sample against brute force. Vectors of a leaf are compared with the
queries that reached it in blocks, exactly and on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import stored

TREES, LETTERS, SEED = 16, 4, 7
#: Rows and queries of the sample that fits the stop; recall wanted there; up to so many vectors all are candidates.
SAMPLE_ROWS, SAMPLE_QUERIES, RECALL, LEAST = 8192, 256, 0.97, 2000
#: A leaf above this share of the candidates wanted is cut by one letter more.
LEAF_SHARE = 0.25
#: Vectors and queries that one comparison block holds at most, on average.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


@dataclass(frozen=True)
class Forest:
    """Rotations and centre; small, and the same in every task."""

    size: int
    centre: np.ndarray
    rotations: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, sample: np.ndarray, trees: int = TREES, letters: int = LETTERS) -> Forest:
        size = sample.shape[1]
        random = np.random.Generator(np.random.PCG64(SEED))
        rotations = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(trees * letters)]
        return cls(size, sample.mean(axis=0), np.stack(rotations).reshape(trees, letters, size, size).astype(np.float32))

    def letters(self, vectors: np.ndarray, tree: int, letter: int) -> np.ndarray:
        """The rank of all letters for each vector, nearest first: axis i with sign + is 2i, with sign - is 2i + 1."""
        turned = (vectors - self.centre).astype(np.float32) @ self.rotations[tree, letter]
        both = np.empty((len(turned), 2 * self.size), np.float32)
        both[:, 0::2], both[:, 1::2] = turned, -turned
        return both

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """``(vectors, trees, letters)`` as small integers."""
        trees, letters = self.rotations.shape[:2]
        out = np.empty((len(vectors), trees, letters), np.int16)
        for t in range(trees):
            for k in range(letters):
                out[:, t, k] = self.letters(vectors, t, k).argmax(axis=1)
        return out


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector`` (float where the table has floats, else double) of the vectors that take part: those of the most
    frequent length, not zero, without null or non-finite components, with an id. Up to 2,048 components."""
    single = rows.schema[vector_column].dataType == T.ArrayType(T.FloatType(), True)
    vector = F.col(vector_column) if single else F.col(vector_column).cast("array<double>")
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).filter(F.col("id").isNotNull())
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vector") == (length["length"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = pa.concat_arrays([column])
    flat = np.asarray(column.flatten()).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _prefix(strings: np.ndarray, length: int) -> np.ndarray:
    """The first letters as one number; 0 is the empty prefix."""
    key = np.ones(len(strings), np.int64)
    for k in range(length):
        key = key << 12 | strings[:, k].astype(np.int64)
    return key if length else np.zeros(len(strings), np.int64)


def _leaves(counted, trees: int, most: int) -> list[dict[int, int]]:
    """For each tree prefix -> size of the variable-length leaves. ``counted`` gives the sizes of longer prefixes."""
    leaves: list[dict[int, int]] = [{} for _ in range(trees)]
    large = None
    for length in range(1, LETTERS + 1):
        sizes = counted(length, large)
        large = set()
        for (tree, prefix), n in sizes.items():
            if n > most and length < LETTERS:
                large.add((tree, prefix))
            else:
                leaves[tree][prefix] = n
        if not large:
            break
    return leaves


def _locate(strings: np.ndarray, leaves: dict[int, int]) -> np.ndarray:
    """The leaf of each string in one tree."""
    found = np.zeros(len(strings), np.int64)
    for length in range(1, LETTERS + 1):
        keys = _prefix(strings, length)
        hit = (found == 0) & np.isin(keys, np.fromiter(leaves, np.int64, len(leaves)))
        found[hit] = keys[hit]
    return found


def _visits(forest: Forest, leaves: list[dict[int, int]], vectors: np.ndarray, wanted: int) -> Iterator[tuple[int, int, int]]:
    """``(query, tree, leaf)`` in the order of a synchronous ascent that stops when the leaves hold ``wanted`` vectors."""
    tables = []
    for t, sizes in enumerate(leaves):
        keys = np.fromiter(sizes, np.int64, len(sizes))
        length = np.array([(int(k).bit_length() - 1) // 12 for k in keys])
        own = np.stack([keys >> np.maximum(0, 12 * (length - 1 - k)) & 0xFFF for k in range(LETTERS)], axis=1)
        near = [forest.letters(vectors, t, k) for k in range(LETTERS)]
        tables.append((keys, np.fromiter(sizes.values(), np.int64, len(sizes)), length, own, near))
    for q in range(len(vectors)):
        ways = []
        for keys, sizes, length, own, near in tables:
            # nearness of a leaf: how near the query lies to its letters, the first letter before the second
            shared, rank = np.ones(len(keys), bool), np.zeros(len(keys))
            common = np.zeros(len(keys), np.int64)
            for k in range(LETTERS):
                within = length > k
                mine = int(near[k][q].argmax())
                shared &= within & (own[:, k] == mine)
                common += shared
                rank -= np.where(within, near[k][q][own[:, k]], 0) / 64.0**k
            order = np.lexsort((rank, -common))
            ways.append((keys[order], sizes[order]))
        held, step = 0, 0
        while held < wanted and any(step < len(keys) for keys, _ in ways):
            for t, (keys, sizes) in enumerate(ways):
                if step < len(keys):
                    held += int(sizes[step])
                    yield q, t, int(keys[step])
            step += 1


def _fit(forest: Forest, sample: np.ndarray, top: int) -> float:
    """The share of all vectors, counted with repeats over the trees, that reaches ``RECALL`` on the sample."""
    n = len(sample)
    queries = np.arange(0, n, max(1, n // SAMPLE_QUERIES))[:SAMPLE_QUERIES]
    away = ((sample[queries] ** 2).sum(1)[:, None] + (sample**2).sum(1)[None] - 2 * sample[queries] @ sample.T).clip(0)
    away[np.arange(len(queries)), queries] = np.inf
    nearest = np.argpartition(away, min(top, n - 1) - 1, axis=1)[:, :top]
    strings = forest.strings(sample)
    trees = strings.shape[1]

    def counted(length, large):
        sizes = {}
        for t in range(trees):
            keys, n_of = np.unique(_prefix(strings[:, t], length), return_counts=True)
            sizes |= {(t, int(k)): int(c) for k, c in zip(keys, n_of) if large is None or (t, int(k) >> 12) in large}
        return sizes

    leaves = _leaves(counted, trees, max(1, n // 64))
    where = [_locate(strings[:, t], leaves[t]) for t in range(trees)]
    held = np.zeros(len(queries))
    at = np.full(nearest.shape, np.inf)  # candidates held when a neighbour is met first
    for q, t, leaf in _visits(forest, leaves, sample[queries], n * trees):
        held[q] += leaves[t][leaf]
        met = where[t][nearest[q]] == leaf
        at[q, met] = np.minimum(at[q, met], held[q])
    return float(np.quantile(at, RECALL)) / n


def nearest(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", query_every: int = 100, top: int = 10, trees: int = TREES
) -> DataFrame:
    """The ``top`` nearest other vectors of each vector whose id is divisible by ``query_every``, by Euclidean distance.

    ``query_id, rank, vec_id, score``; ties go to the smaller id. Vectors that :func:`usable` leaves out take no part.
    Equal vectors are one entry of the forest that stands for its smallest ids, as many as a result can hold, so a very
    frequent vector fills no leaf; rows repeating an id and vector count once, as do ids with several vectors with the
    nearest. An empty table gives an empty result, fewer than ``top`` others give all of them.
    """
    spark = rows.sparkSession
    vectors = stored(usable(rows, id_column, vector_column).distinct(), "vectors")
    by_id = Window.partitionBy("vector").orderBy("id")
    few = vectors.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= top + 1)
    same = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    same = stored(same.withColumn("key", F.monotonically_increasing_id()), "entries")
    asked = vectors.filter(F.col("id") % query_every == 0).join(same.select(F.col("vector").alias("_v"), "key"), F.col("vector") == F.col("_v"))
    asked = stored(asked.select("id", "key"), "asked")
    queries = stored(same.join(asked.select(F.col("key").alias("_k")).distinct(), F.col("key") == F.col("_k"), "left_semi").select("key", "vector"), "queries")

    n, spread_over = same.count(), 1 << 40
    drawn = F.pmod(F.xxhash64("vector"), F.lit(spread_over)) < min(spread_over, spread_over * SAMPLE_ROWS // max(n, 1))
    sample = same.filter(drawn).select("vector").toPandas()["vector"]
    result = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], result)
    sample = np.stack([np.asarray(v, np.float64) for v in sample])
    forest = Forest.of(sample, trees)
    wanted = int(np.ceil(_fit(forest, sample, top) * n)) if n > LEAST else n * trees
    shared = spark.sparkContext.broadcast(forest)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = shared.value.strings(_matrix(batch.column("vector")))
            packed = np.ascontiguousarray(strings.reshape(len(strings), -1).astype("<i2"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("vector"), pa.array([row.tobytes() for row in packed], pa.binary())], names=["key", "vector", "strings"]
            )

    kind = same.schema["vector"].dataType.simpleString()
    spelled = stored(same.select("key", "vector").mapInArrow(spell, f"key long, vector {kind}, strings binary"), "hash-strings")

    def unpack(batch: pa.RecordBatch) -> np.ndarray:
        raw = np.frombuffer(b"".join(batch.column("strings").to_pylist()), "<i2")
        return raw.reshape(batch.num_rows, trees, LETTERS)

    def counted(length: int, large) -> dict[tuple[int, int], int]:
        """Sizes of prefixes; those below the cut ones only. Their number is bounded: see ``LEAF_SHARE``."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                strings = unpack(batch)
                for t in range(trees):
                    keys, times = np.unique(_prefix(strings[:, t], length), return_counts=True)
                    if large is not None:
                        keep = np.isin(keys >> 12, np.array([p for of, p in large if of == t], np.int64))
                        keys, times = keys[keep], times[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t, np.int32)), pa.array(keys), pa.array(times)], names=["tree", "prefix", "n"])

        found = spelled.select("strings").mapInArrow(count, "tree int, prefix long, n long").groupBy("tree", "prefix").agg(F.sum("n").alias("n"))
        return {(r["tree"], r["prefix"]): r["n"] for r in found.toLocalIterator()}

    leaves = _leaves(counted, trees, max(64, int(wanted / trees * LEAF_SHARE)))
    shared_leaves = spark.sparkContext.broadcast(leaves)

    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_visits(shared.value, shared_leaves.value, _matrix(batch.column("vector")), wanted))
            q, t, leaf = (np.array(x, np.int64) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(q)), pa.array(t.astype(np.int32)), pa.array(leaf)], names=["query", "tree", "leaf"])

    visits = stored(queries.mapInArrow(ascend, "query long, tree int, leaf long"), "visits")
    asking = {(r["tree"], r["leaf"]): r["count"] for r in visits.groupBy("tree", "leaf").count().toLocalIterator()}
    blocks = {k: (-(-leaves[k[0]][k[1]] // BLOCK_ROWS), -(-c // BLOCK_QUERIES)) for k, c in asking.items()}
    shared_blocks = spark.sparkContext.broadcast(blocks)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once for every leaf that queries reach, and there for every block of queries."""
        for batch in batches:
            strings, keys = unpack(batch), np.asarray(batch.column("key"))
            for t in range(trees):
                take, leaf, part = [], [], []
                for i, own in enumerate(_locate(strings[:, t], shared_leaves.value[t]).tolist()):
                    mine, theirs = shared_blocks.value.get((t, own), (0, 0))
                    for b in range(theirs):
                        take.append(i)
                        leaf.append(own)
                        part.append(int(keys[i]) % mine * theirs + b)
                chosen = batch.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(take), t, np.int32)), pa.array(leaf, pa.int64()), pa.array(part, pa.int64()), chosen.column("key"), chosen.column("vector")],
                    names=["tree", "leaf", "part", "key", "vector"],
                )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, part = [], []
            for i, (q, t, leaf) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("query", "tree", "leaf")))):
                mine, theirs = shared_blocks.value[t, leaf]
                take += [i] * mine
                part += [m * theirs + q % theirs for m in range(mine)]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(take, pa.int64())).columns, pa.array(part, pa.int64())], names=["query", "tree", "leaf", "part"])

    held = spelled.mapInArrow(place, f"tree int, leaf long, part long, key long, vector {kind}")
    sent = visits.mapInArrow(spread, "query long, tree int, leaf long, part long").join(queries.withColumnRenamed("key", "query"), "query")

    def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query": [], "key": [], "score": []})
        data, keys = np.stack(mine["vector"].to_numpy()).astype(np.float64), mine["key"].to_numpy()
        found = []
        for q, v in zip(theirs["query"].to_numpy(), theirs["vector"].to_numpy()):
            away = np.sqrt(((data - np.asarray(v, np.float64)) ** 2).sum(axis=1))
            best = np.flatnonzero(away <= np.partition(away, min(top, len(away) - 1))[min(top, len(away) - 1)])
            found.append(pd.DataFrame({"query": q, "key": keys[best], "score": away[best]}))
        return pd.concat(found)

    grouped = [x.groupBy("tree", "leaf", "part") for x in (held, sent)]
    near = grouped[0].cogroup(grouped[1]).applyInPandas(compare, "query long, key long, score double").distinct()
    best = Window.partitionBy("query").orderBy("score", "key")
    near = near.withColumn("r", F.rank().over(best.orderBy("score"))).filter(F.col("r") <= top + 1).drop("r")
    entries = same.select(F.col("key").alias("_key"), "ids")
    wide = asked.select(F.col("id").alias("query_id"), F.col("key").alias("_asked")).join(near, F.col("_asked") == F.col("query"))
    wide = wide.join(entries, F.col("key") == F.col("_key")).select("query_id", F.explode("ids").alias("vec_id"), "score").filter("query_id <> vec_id")
    wide = wide.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return wide.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
