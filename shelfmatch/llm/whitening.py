"""Embedding whitening with MLlib's BlockMatrix.

Each entry c of a vector becomes the whole number x = floor(256 * c).  The fit list holds each distinct x-vector once: n vectors
with sums S.  Their covariance (divisor n, centred at S / n before multiplying) has unit eigenvectors, the components, by falling eigenvalue.

1. Equal vectors are one row with its number of copies (partial aggregation first, so a vector that holds a third of all
   rows costs a row per task).  Rows are indexed as they lie in the tasks, ``BLOCK_ENTRIES`` entries to a block; the last block
   of a task is filled up with centred zeros, which add nothing.
2. The centred blocks form a BlockMatrix A; the scatter matrix is A^T A, with the middle dimension split so that a task holds
   ``TASK_BYTES`` of blocks.  Its eigenvectors are found locally, its size is the dimension squared.
3. A W, W the components over the roots of their eigenvalues, gives each distinct vector's whitened row, and (A W)^T (A W) / n
   shows how far their covariance is from the identity.
4. The vectors get their rows by a key of 128 bits; a hot key is joined by broadcast (`heat.join_counted`).

Blocks are multiplied in bands of ``BAND`` blocks, as MLlib keeps a table of block numbers on the driver.

Defined results: rows whose vector is null, holds null or non-finite entries, or entries of 2**54 or more, are dropped, as are
rows whose length is not the most frequent one (of equally frequent ones the longer); repeated rows return each for itself;
components without variance are left out, so one distinct vector, or none, gives no rows; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm.common import prepare, stored, table
from shelfmatch.llm.heat import join_counted

SCALE = 256
COMPONENTS = 4
#: Entries of a block, blocks of a band, bytes of blocks that a task multiplies at a time.
BLOCK_ENTRIES, BAND, TASK_BYTES = 1 << 18, 1024, 64 << 20
#: A component has variance if its eigenvalue is at least this share of the trace.
NO_VARIANCE = 1e-12
KEY = ["vector_1", "vector_2"]
_BLOCK = "part int, number int, n_rows int, width int, x binary, sums array<string>, vector_1 array<long>, vector_2 array<long>, copies array<long>"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of long) and its key, of the rows that remain."""
    entry = lambda c: c.cast("double") * SCALE
    sound = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(entry(c)) < float(1 << 62)))
    x = F.transform("embedding", lambda c: F.floor(entry(c)).cast("long"))
    kept = vectors.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & sound).select("vec_id", x.alias("x"))
    return kept.select("vec_id", "x", F.xxhash64("x").alias(KEY[0]), F.xxhash64(F.lit(1), "x").alias(KEY[1]))


def _in_blocks(batches: Iterator[pa.RecordBatch], dimension: int, n_rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in blocks of ``n_rows``, numbered from 0."""
    part, number, held = TaskContext.get().partitionId(), 0, []

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        together = pa.Table.from_batches(rows).combine_chunks()
        x = together.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dimension)
        far = int(max(abs(int(x.max())), abs(int(x.min())))) + 1
        width = next(w for w in (2, 4, 8) if far < 1 << (8 * w - 1))
        sums = x.sum(axis=0).tolist() if far * len(x) < 1 << 62 else [sum(c) for c in x.T.tolist()]
        lists = [pa.array([together.column(c).to_pylist()], pa.list_(pa.int64())) for c in (*KEY, "copies")]
        head = [pa.array([v], pa.int32()) for v in (part, number, len(x), width)]
        return pa.RecordBatch.from_arrays(
            [*head, pa.array([x.astype(f"<i{width}").tobytes()], pa.binary()), pa.array([[str(s) for s in sums]], pa.list_(pa.string())), *lists],
            ["part", "number", "n_rows", "width", "x", "sums", *KEY, "copies"])

    for batch in batches:
        while batch.num_rows:
            room = n_rows - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == n_rows:
                yield block(held)
                held, number = [], number + 1
    if held:
        yield block(held)


def _centred(row, mean: np.ndarray, n_rows: int) -> DenseMatrix:
    """A block as matrix: its x less the mean, filled up with zeros."""
    out = np.zeros((n_rows, len(mean)))
    out[:row.n_rows] = np.frombuffer(row.x, dtype=f"<i{row.width}").reshape(-1, len(mean)) - mean
    return DenseMatrix(n_rows, len(mean), out.ravel(order="F"))


class Whitening:
    """The fit of ``vectors`` (vec_id, embedding): n, sums, components, explained shares, the whitened distinct vectors."""

    def __init__(self, vectors: DataFrame, components: int = COMPONENTS):
        self.spark = vectors.sparkSession
        prepare(self.spark)
        rows = whole_vectors(vectors)
        sizes = sorted((r["count"], r.d) for r in rows.groupBy(F.size("x").alias("d")).count().collect() if r.d)
        self.n_rows, self.dimension = sizes[-1] if sizes else (0, 0)
        self.rows = rows.where(F.size("x") == self.dimension)
        self.n, self.sums, self.weights, self.explained = 0, [], np.zeros((0, 0)), np.zeros(0)
        self.whitened: DataFrame | None = None
        self.identity_error = 0.0
        if not self.n_rows:
            return
        self._make_blocks()
        self._find_components(components)
        if self.weights.shape[1]:
            self._project()

    def _make_blocks(self) -> None:
        d, n_rows = self.dimension, self.n_rows
        self.height = max(16, min(max(1, BLOCK_ENTRIES // d), 64 if n_rows < 1 << 14 else 1 << (n_rows >> 8).bit_length()))
        height = self.height
        fit = self.rows.groupBy(*KEY).agg(F.count("*").alias("copies"), F.first("x").alias("x"))
        self.blocks = stored(fit.mapInArrow(lambda batches: _in_blocks(batches, d, height), _BLOCK), "blocks")
        sums = self.blocks.select(F.posexplode("sums").alias("j", "s")).groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        self.sums = [int(r.s) for r in sorted(sums.collect())]
        self.n = self.blocks.agg(F.sum("n_rows")).first()[0]
        self.mean = np.array([float(Fraction(s, self.n)) for s in self.sums])
        #: Number of the first block of each task that made blocks, and how many there are.
        self.first, self.n_blocks = {}, 0
        for part, count in sorted(map(tuple, self.blocks.groupBy("part").count().collect())):
            self.first[part] = self.n_blocks
            self.n_blocks += count

    def _bands(self) -> list[tuple[int, int]]:
        return [(at, min(at + BAND, self.n_blocks)) for at in range(0, self.n_blocks, BAND)]

    def _band(self, low: int, high: int) -> BlockMatrix:
        """The centred blocks ``low`` to ``high`` - 1 as a BlockMatrix, numbered from 0."""
        first, mean, height, count = self.first, self.mean, self.height, high - low
        parts = [p for p, at in first.items() if at < high]
        parts = [p for p, after in zip(parts, [*[first[p] for p in parts[1:]], self.n_blocks]) if after > low]
        band = self.blocks.where(F.col("part").between(parts[0], parts[-1])).select("part", "number", "n_rows", "width", "x")
        for part, edge in ((parts[0], F.col("number") >= low - first[parts[0]]), (parts[-1], F.col("number") < high - first[parts[-1]])):
            band = band.where((F.col("part") != part) | edge)
        # a product's tasks hold count / sqrt(partitions) blocks each
        least = -(-count * height * self.dimension * 8 // TASK_BYTES) ** 2
        if band.rdd.getNumPartitions() < least:
            band = band.repartition(min(least, count), "part", "number")
        made = band.rdd.map(lambda r: ((first[r.part] - low + r.number, 0), _centred(r, mean, height)))
        return BlockMatrix(made, height, self.dimension, count * height, self.dimension)

    def _gram(self, matrix: BlockMatrix, count: int) -> np.ndarray:
        """The matrix's transpose times itself, the middle dimension split over tasks."""
        splits = max(1, min(count, max(-(-count * self.height * self.dimension * 8 // TASK_BYTES), self.spark.sparkContext.defaultParallelism)))
        product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
        return BlockMatrix(product, self.dimension, self.dimension).toLocalMatrix().toArray()

    def _find_components(self, most: int) -> None:
        scatter = sum(self._gram(self._band(*band), band[1] - band[0]) for band in self._bands())
        values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * self.n))
        trace = float(np.trace(scatter)) / self.n
        found = [k for k in range(len(values) - 1, -1, -1)[:most] if trace > 0 and values[k] >= NO_VARIANCE * trace]
        self.explained = values[found] / trace if found else np.zeros(0)
        self.weights = vectors[:, found] / np.sqrt(values[found]) if found else np.zeros((self.dimension, 0))

    def _project(self) -> None:
        d, c, spark = self.dimension, self.weights.shape[1], self.spark
        one = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, c, self.weights.ravel(order="F").tolist()))], 1)
        first = spark.createDataFrame(sorted(self.first.items()), "part int, first long")
        keys = self.blocks.select("part", "number", *KEY, "copies").join(F.broadcast(first), "part")
        keys = keys.select((F.col("first") + F.col("number")).alias("block"), *KEY, "copies")
        gram, parts = np.zeros((c, c)), []
        for low, high in self._bands():
            product = self._band(low, high).multiply(BlockMatrix(one, d, c, d, c))
            made = product.blocks.map(lambda b, low=low: (low + b[0][0], b[1].toArray().tolist()))
            parts.append(stored(spark.createDataFrame(made, "block long, whitened array<array<double>>"), "whitened"))
        for part in parts:
            wide = part.select(F.explode("whitened").alias("w"))
            cross = wide.agg(*[F.sum(F.col("w")[i] * F.col("w")[j]).alias(f"g{i}_{j}") for i in range(c) for j in range(c)]).first()
            gram += np.array(cross).reshape(c, c)
        self.identity_error = float(np.abs(gram / self.n - np.eye(c)).max())
        rows = [part.join(keys, "block") for part in parts]
        whole = rows[0]
        for more in rows[1:]:
            whole = whole.unionByName(more)
        zipped = whole.select(F.inline(F.arrays_zip(*KEY, "copies", "whitened")).alias(*KEY, "n", "whitened"))
        self.whitened = stored(zipped.where(F.col("n").isNotNull()), "whitened-vectors")

    def deviation(self) -> Column:
        """Sum over the dimensions of (n * x - S) squared; null if it is no long."""
        sums = F.array(*[F.lit(s).cast("long") for s in self.sums])
        apart = F.zip_with("x", sums, lambda x, s: F.try_subtract(F.try_multiply(F.lit(self.n).cast("long"), x), s))
        return F.aggregate(apart, F.lit(0).cast("long"), lambda total, v: F.try_add(total, F.try_multiply(v, v)))

    def transform(self) -> DataFrame:
        """One row per remaining row: vec_id, deviation, whitened (array, a value per component)."""
        schema = "vec_id long, deviation long, whitened array<double>"
        if self.whitened is None:
            return self.spark.createDataFrame([], schema)
        rows = self.rows.select("vec_id", *KEY, self.deviation().alias("deviation"))
        return join_counted(rows, self.whitened, KEY).select("vec_id", "deviation", "whitened")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = Whitening(table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(e)) for e in fit.explained]).cast("array<double>")
    rows = fit.transform().select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return rows.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("k")).alias("explained"), F.lit(fit.identity_error).alias("identity_error"))
