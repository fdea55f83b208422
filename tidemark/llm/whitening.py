"""Embedding whitening with distributed block matrices (operator 11).

Vectors become integers. The distinct ones, centred, are the rows of a ``BlockMatrix`` whose product with its own
transpose is the scatter matrix; its eigenvectors are found on the driver, where it is as large as the vectors are long,
squared. All rows, centred alike, form a second matrix, whose product with the whitening matrix projects them.

A block matrix lists its blocks on the driver when it multiplies. So the rows are taken in slabs of a fixed number of
blocks, whose scatter matrices are added up.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.numbering import numbered

#: Fixed values of the contract: the scale at which entries become integers, and the components returned.
SCALE, COMPONENTS = 256, 4
ROWS_PER_BLOCK, MOST_COLUMNS = 1024, 1024
#: Blocks of rows that the driver lists at a time.
BLOCKS_PER_SLAB = 1 << 16
#: Eigenvalues below this share of the largest, times the dimensions, are rounding errors of zero.
ZERO = 1e-14


@dataclass(frozen=True)
class Centre:
    """Exact sums of ``n`` distinct vectors; the mean split into whole numbers and what is left, below one."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of each entry as long, saturating at its ends; null where an entry is null or not finite."""
    infinite = F.lit(float("inf"))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    return F.when(sound, F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long")))


def entries(embeddings: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """``vec_id, x, at`` of the vectors that take part, numbered from 0, and their number of dimensions."""
    sound = embeddings.select("vec_id", integers(F.col("embedding"), scale).alias("x")).where("x IS NOT NULL")
    rows = numbered(sound, "at", "entries")
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") == d, F.col("x")).otherwise(F.concat("x", missing))), d


def centre(fit: DataFrame) -> Centre:
    """Exact sums by dimension, added up before they are shuffled: as many rows as a vector has entries."""
    total = fit.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    sums = {r.d: int(r.s) for r in total.collect()}
    return Centre(fit.count(), tuple(sums[d] for d in range(len(sums))))


def centred(c: Centre) -> Column:
    """``x`` less the mean as doubles: the whole part of the mean is taken off exactly."""

    def less(x: Column, w: Column) -> Column:
        return F.coalesce(F.try_subtract(x, w).cast("double"), x.cast("double") - w.cast("double"))

    whole, rest = F.lit(c.whole).cast("array<bigint>"), F.lit([r / c.n for r in c.rest])
    return F.zip_with(F.zip_with("x", whole, less), rest, lambda x, r: x - r)


def deviation(c: Centre) -> Column:
    """Sum over the dimensions of ``(n * x - S) ** 2``, exact; null where it does not fit a long."""
    n = F.lit(c.n).cast("long")
    whole, rest = F.lit(c.whole).cast("array<bigint>"), F.lit(c.rest).cast("array<bigint>")
    scaled = F.zip_with("x", whole, lambda x, w: F.try_multiply(F.try_subtract(x, w), n))
    away = F.zip_with(scaled, rest, lambda x, r: F.try_subtract(x, r))
    return F.aggregate(away, F.lit(0).cast("long"), lambda sum_, a: F.try_add(sum_, F.try_multiply(a, a)))


def blocks(rows: DataFrame, n_rows: int, n_columns: int, rows_per_block: int, columns_per_block: int) -> BlockMatrix:
    """A frame ``index, vector`` (array of doubles) as dense blocks; rows that it lacks are zero."""
    vectors = rows.select(F.col("index").cast("long"), array_to_vector("vector").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n_rows, n_columns).toBlockMatrix(
        rows_per_block, columns_per_block
    )


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left.multiply(right)`` with the inner dimension cut into ``splits``, which only the JVM method takes."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


class Slabs:
    """Numbered rows ``at, vector`` as block matrices of a fixed number of row blocks each."""

    def __init__(self, rows: DataFrame, n_rows: int, d: int, rows_per_block: int, blocks_per_slab: int):
        self.rows, self.n_rows, self.d = rows, n_rows, d
        self.rows_per_block, self.height = rows_per_block, rows_per_block * blocks_per_slab

    def __iter__(self) -> Iterator[tuple[int, BlockMatrix]]:
        for first in range(0, self.n_rows, self.height):
            end = min(first + self.height, self.n_rows)
            slab = self.rows if self.n_rows <= self.height else self.rows.where((F.col("at") >= first) & (F.col("at") < end))
            slab = slab.select((F.col("at") - first).alias("index"), "vector")
            yield first, blocks(slab, end - first, self.d, self.rows_per_block, min(self.d, MOST_COLUMNS))

    def scatter(self) -> np.ndarray:
        """The sum of all rows' products with themselves.

        A slab's blocks are read as left and right factor and for their sizes, so they are kept while it is multiplied.
        """
        total = np.zeros((self.d, self.d))
        for _, slab in self:
            inner = -(-slab.numRows() // self.rows_per_block)
            slab.persist(StorageLevel.MEMORY_AND_DISK)
            total += product(slab.transpose(), slab, inner).toLocalMatrix().toArray()
            slab._java_matrix_wrapper.call("blocks").unpersist(False)
        return total

    def times(self, matrix: np.ndarray) -> DataFrame:
        """``at`` and the row's product with ``matrix`` as array ``w``."""
        spark, k = self.rows.sparkSession, matrix.shape[1]
        local = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], "index long, vector array<double>")
        right = blocks(local, self.d, k, min(self.d, MOST_COLUMNS), k)
        parts = []
        for first, slab in self:
            java = product(slab, right, 1).toIndexedRowMatrix()._java_matrix_wrapper._java_model
            found = callMLlibFunc("getIndexedRows", java).toDF("index", "vector")
            parts.append(found.select((F.col("index") + first).alias("at"), vector_to_array("vector").alias("w")))
        while len(parts) > 1:
            parts = [a.unionAll(b) if b is not None else a for a, b in itertools.zip_longest(parts[::2], parts[1::2])]
        return parts[0]


def identity_error(projected: DataFrame, k: int) -> Column:
    """The largest absolute entry of the covariance of ``w`` less the identity, as an aggregate; 0 without components."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    errors = [F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - float(i == j)) for i, j in pairs]
    return F.array_max(F.array(*errors)) if errors else F.lit(0.0)


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    rows_per_block: int = ROWS_PER_BLOCK,
    blocks_per_slab: int = BLOCKS_PER_SLAB,
) -> DataFrame:
    """The leading whitened components of every vector, one row per row and component.

    Needs ``vec_id`` and ``embedding``; other columns are not read. Rows whose vector is null or holds null, NaN or infinite
    entries take no part. Entries become ``x = floor(scale * c)``; the mean and covariance are those of the distinct ``x``
    vectors, each once. Returns ``vec_id, component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation``
    (sum of ``(n * x - S) ** 2``, null where it exceeds a long), ``whitened``, ``explained`` (share of the trace) and
    ``identity_error`` (of the whitened distinct vectors' covariance).

    Vectors shorter than the longest count as zero where they have no entry. Repeated rows, ids and null ids are rows like
    others. Vectors have at most as many components as entries. A component without variance has ``whitened`` null and is left out
    of ``identity_error``; ``explained`` is null where all vectors are equal. An empty table gives no rows.
    """
    rows, d = entries(embeddings, scale)
    spark = embeddings.sparkSession
    if d == 0:
        return spark.createDataFrame([], f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, {RESULT}")
    n_rows = rows.count()
    fit = stored(rows.groupBy("x").agg(F.min("at").alias("at")), "distinct")
    c = centre(fit)

    def slabs(part: DataFrame) -> Slabs:
        return Slabs(part.select("at", centred(c).alias("vector")), n_rows, d, rows_per_block, blocks_per_slab)

    values, vectors = np.linalg.eigh(slabs(fit).scatter() / c.n)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    k, trace = min(components, d), float(values.sum())
    kept = int((values[:k] > values[0] * d * ZERO).sum()) if trace > 0 else 0
    if kept:
        projected = stored(slabs(rows).times(vectors[:, :kept] / np.sqrt(values[:kept])), "projected")
        of_fit = projected.join(fit.select("at"), "at", "left_semi")
        error = of_fit.agg(identity_error(of_fit, kept)).first()[0]
    else:
        projected, error = rows.select("at", F.array().cast("array<double>").alias("w")), 0.0
    explained = [float(v / trace) if trace > 0 else None for v in values[:k]]
    shares = F.array(*(F.lit(e).cast("double") for e in explained))
    found = rows.select("vec_id", "at", deviation(c).alias("deviation")).join(projected, "at")
    found = found.select("vec_id", "deviation", "w", F.posexplode(shares).alias("i", "explained"))
    return found.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(c.n).cast("long").alias("n"),
        "deviation",
        F.get("w", F.col("i")).alias("whitened"),
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
