"""Top-k search over compact codes with exact re-ranking.

``encoded`` adds a code to each store vector: 256 sign bits of random projections (32 bytes, T3) or one byte per dimension (T2); a
search reads ids and codes only (an eighth and a quarter of 64 dimensions as floats), keeps the ``refine * k`` best per query by the
similarity that the codes tell, and scores just those with their vectors.  The products of codes are blocked as in ``blocks``: nothing is
collected or broadcast, and the candidates per query are bounded whatever the size of the store.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.vectors import l2_normalize
from shelfmatch.operators.blocks import BLOCK_BYTES, block_pairs, hash_block
from shelfmatch.operators.vector_search import _best, _merge_topk

BITS = 256
SIGNS, BYTES = "signs", "bytes"


@functools.lru_cache(maxsize=4)
def _planes(dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BITS, dims)).astype(np.float32)


def _matrix(vectors: pa.Array) -> np.ndarray:
    lengths = set(np.diff(vectors.offsets.to_numpy()).tolist())
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(vectors), -1)


def sign_codes(m: np.ndarray, seed: int) -> np.ndarray:
    """The sides of ``BITS`` random planes on which each vector lies, eight to a byte."""
    return np.packbits(m @ _planes(m.shape[1], seed).T > 0, axis=1).view(np.int8)


def byte_codes(m: np.ndarray) -> np.ndarray:
    """Each entry as a byte, in steps of the vector's own largest entry, which follows the code as a float."""
    scale = np.maximum(np.abs(m).max(axis=1, keepdims=True), 1e-30).astype(np.float32)
    return np.hstack([np.rint(m / scale * 127).astype(np.int8), scale.view(np.int8).reshape(len(m), 4)])


def code(vector: Column, kind: str, seed: int = 7) -> Column:
    """Code of a vector column (unit vectors) as array<tinyint>."""
    def run(v: pa.Array) -> pa.Array:
        m = _matrix(v)
        codes = sign_codes(m, seed) if kind == SIGNS else byte_codes(m)
        offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
        return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(codes).ravel()))

    run.__annotations__ = {"v": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<tinyint>")(vector)


def encoded(store: DataFrame, kind: str, seed: int = 7) -> DataFrame:
    """id, code, embedding (raw) of the rows that have a vector."""
    return store.where(F.col("embedding").isNotNull()).select(F.col("id").cast("long").alias("id"), code(F.col("embedding"), kind, seed).alias("code"), "embedding")


def _decoded(codes: np.ndarray, kind: str) -> np.ndarray:
    if kind == SIGNS:
        return np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1).astype(np.float32) * 2 - 1
    whole = codes[:, :-4].astype(np.float32)
    scale = np.ascontiguousarray(codes[:, -4:]).view(np.float32)
    whole *= scale
    norm = np.linalg.norm(whole, axis=1, keepdims=True)
    return np.divide(whole, norm, out=np.zeros_like(whole), where=norm > 0)


def _near(k: int, kind: str, qids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray):
    for qid, ident, sims in _best(k, qids, _decoded(q, kind), ids, _decoded(m, kind)):
        yield qid, ident, sims.astype(np.float64)


def _blocks(df: DataFrame) -> int:
    return max(1, -(-df.count() * 4 * BITS // BLOCK_BYTES))  # a block holds its codes decoded, as floats


def candidates(store: DataFrame, queries: DataFrame, k: int, kind: str, refine: int, seed: int = 7, qid: str = "qid", vec: str = "embedding") -> DataFrame:
    """(qid, id): the ``refine * k`` rows of each query whose codes are most alike; ``store`` as ``encoded`` gives it."""
    q = queries.where(F.col(vec).isNotNull()).select(F.col(qid).cast("long").alias("id"), code(F.col(vec), kind, seed).alias("embedding"))
    s = store.select("id", F.col("code").alias("embedding"))
    nq, ns = _blocks(q), _blocks(s)
    everyone = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    q = q.withColumn("block", hash_block("id", nq)).withColumn("partners", everyone(ns))
    s = s.withColumn("block", hash_block("id", ns)).withColumn("partners", everyone(nq))
    found = block_pairs(q, s, functools.partial(_near, k * refine, kind), "qid long, id long, score double")
    return _merge_topk(found, k * refine).select("qid", "id")


def sketch_topk(store: DataFrame, queries: DataFrame, k: int = 5, kind: str = SIGNS, refine: int = 40, seed: int = 7, qid: str = "qid", vec: str = "embedding") -> DataFrame:
    """Approximate top-k ``(qid, id, score, rank)``: candidates by codes, exact cosine and order among them; ``store`` as ``encoded`` gives it.

    Null vectors are left out on both sides; fewer than k where the store is smaller; exact where it has ``refine * k`` rows at most.
    """
    found = candidates(store, queries, k, kind, refine, seed, qid, vec)
    vectors = store.select("id", l2_normalize("embedding").alias("v"))
    asked = queries.select(F.col(qid).cast("long").alias("qid"), l2_normalize(vec).alias("q"))
    scored = found.join(vectors, "id").join(asked, "qid")
    score = F.aggregate(F.zip_with("v", "q", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    return _merge_topk(scored.select("qid", "id", score.alias("score")), k).select("qid", "id", "score", "rank")
