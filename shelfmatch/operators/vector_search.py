"""Vector store and search.

The store is a DataFrame ``(id BIGINT, text STRING, metadata STRUCT,
embedding ARRAY<DOUBLE>)`` with unit-length embeddings, so cosine equals the
inner product (what the reference's flat inner-product index returns).

* ``search_topk`` (exact, T1) and ``cosine_join`` (exact threshold join, J3)
  are blocked products (``blocks``): every pair of a query (left) block and a
  store (right) block is one matrix product; the search keeps the k best per
  query and pair of blocks and merges them, the join keeps what reaches the
  threshold.  Neither side is collected or broadcast at any size.
* ``cosine_join`` forms its blocks inside clusters: a pair can reach cosine
  >= t only if ||c_i - c_j|| <= R_i + R_j + sqrt(2 - 2t) (triangle
  inequality, R the cluster radius), so pairs of blocks of clusters that lie
  further apart are never sent to each other.
* ``ivf_topk`` (approximate, T2): the same product over the blocks of the
  ``nprobe`` nearest clusters of each query only.
* ``lsh_topk`` (approximate, T3): random-projection LSH buckets as join keys.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.functions.vectors import l2_normalize
from shelfmatch.operators.blocks import BLOCK_BYTES, block_pairs, blocks_for, hash_block
from shelfmatch.session import written

# Store vectors that k-means is fitted on, about (a documented bound; exactness never depends on it).
FIT_ROWS = 100_000
# Columns in a run of which ``_best_of`` takes the maximum first.
RUN = 32
# Pairs of blocks up to which ``cosine_join`` compares all blocks instead of forming them in clusters.
PLAIN_PAIRS = 64


def metadata_projection(df: DataFrame, text: str) -> DataFrame:
    """the text column apart, every other column packed into ``metadata``."""
    others = [c for c in df.columns if c != text]
    meta = F.struct(*others) if others else F.struct()
    return df.select(F.col(text).alias("text"), meta.alias("metadata"))


def with_dense_ids(df: DataFrame, start: int = 0, order: list[str] | None = None) -> DataFrame:
    """Consecutive ids in ``order`` (or scan order), computed in the JVM without a global window.

    The (sorted) rows are checkpointed to the shared folder first: a range
    partitioning is sampled at run time and need not repeat, so the
    partition numbering must be fixed before counting.  Per-partition counts
    (one row per partition) give each partition its offset; the id is offset
    + position inside the partition.
    """
    from shelfmatch.session import work_dir

    spark = df.sparkSession
    work_dir(spark)
    src = (df.orderBy(*order) if order else df).withColumn("__m", F.monotonically_increasing_id())
    src = src.withColumn("__p", F.shiftright("__m", 33)).checkpoint(eager=True)
    counts = sorted((r[0], r[1]) for r in src.groupBy("__p").count().collect())  # one row per partition
    offsets, acc = [], start
    for p, c in counts:
        offsets.append((p, acc))
        acc += c
    off = spark.createDataFrame(offsets or [(0, start)], "__p long, __off long")
    pos = F.col("__m") - F.shiftleft(F.col("__p"), 33)
    return src.join(F.broadcast(off), "__p").withColumn("id", F.col("__off") + pos).drop("__m", "__p", "__off")


def add_vectors(store: DataFrame | None, new: DataFrame, text: str = "text", embedding: str = "embedding",
                order: list[str] | None = None) -> DataFrame:
    """V3: append texts with their vectors (normalised); ids continue after the store's."""
    meta_cols = [c for c in new.columns if c not in (text, embedding)]
    rows = new.select(F.col(text).alias("text"),
                      (F.struct(*meta_cols) if meta_cols else F.struct()).alias("metadata"),
                      l2_normalize(embedding).alias("embedding"),
                      *[F.col(c).alias(f"__o_{c}") for c in (order or [])])
    start = 0
    if store is not None:
        start = store.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    added = with_dense_ids(rows, start, [f"__o_{c}" for c in order] if order else None)
    added = added.select("id", "text", "metadata", "embedding")
    return added if store is None else store.unionByName(added)


def _merge_topk(cands: DataFrame, k: int, qid: str = "qid", salts: int = 16) -> DataFrame:
    """Top-k per query from candidate rows ``(qid, id, score)``; ties by id.

    Two levels: rank inside (qid, salt) buckets, keep k, then rank per qid, so
    a query with a huge candidate set is spread over ``salts`` tasks.
    """
    salted = cands.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    w1 = Window.partitionBy(qid, "__salt").orderBy(F.desc("score"), F.asc("id"))
    first = salted.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= k).drop("__r", "__salt")
    w2 = Window.partitionBy(qid).orderBy(F.desc("score"), F.asc("id"))
    return first.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def _unit(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """``(id, raw, embedding)`` with unit vectors (zero vectors stay zero); rows without a vector are left out.

    Arrow functions take ``raw``: they cannot be planned over the lambda that scales a vector.
    """
    return df.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("raw"), l2_normalize(vec).alias("embedding"))


def _best(k: int, qids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray):
    """The k best rows of ``m`` for each query, by similarity, then by id (ids ascend)."""
    yield _best_of(k, qids, ids, q @ m.T)


def _best_of(k: int, qids: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> tuple:
    """The k best columns of each row, equal ones by column: the k-th greatest of the maxima of runs of columns is at most the k-th best
    value, so few columns reach it, and only those are ranked."""
    kk = min(k, len(ids))
    runs = len(ids) // RUN
    if kk and runs >= 4 * kk:
        tops = sims[:, :runs * RUN].reshape(len(sims), runs, RUN).max(axis=2)
        bound = np.partition(tops, runs - kk, axis=1)[:, runs - kk]
        if np.isfinite(tops).all() and not np.isnan(sims[:, runs * RUN:]).any():
            rows, cols = np.divmod(np.flatnonzero(sims >= bound[:, None]), len(ids))
            best = sims[rows, cols]
            order = np.lexsort((cols, -best, rows))
            rows, cols, best = rows[order], cols[order], best[order]
            first = np.searchsorted(rows, np.arange(len(sims)))
            kept = np.arange(len(rows)) - first[rows] < kk
            return qids[rows[kept]], ids[cols[kept]], best[kept]
    kth = -np.partition(-sims, kk - 1, axis=1)[:, kk - 1, None]
    above, equal = sims > kth, sims == kth
    keep = above | (equal & (np.cumsum(equal, axis=1) <= kk - above.sum(axis=1, keepdims=True)))
    rows, cols = np.nonzero(keep)
    return qids[rows], ids[cols], sims[rows, cols]


def _best_within(k: int, max_distance: float, qids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray):
    """The k nearest rows of ``m`` for each query that lie nearer than ``max_distance``, with 1 - distance^2 / 2."""
    d2 = np.maximum((q * q).sum(1)[:, None] + (m * m).sum(1)[None, :] - 2 * q @ m.T, 0)
    score = np.where(np.sqrt(d2) < max_distance, 1.0 - d2 / 2.0, -np.inf)
    a, b, best = _best_of(k, qids, ids, score)
    yield a[best > -np.inf], b[best > -np.inf], best[best > -np.inf]


def search_topk(store: DataFrame, queries: DataFrame, k: int = 5, qid: str = "qid", vec: str = "embedding",
                metric: str = "cosine") -> DataFrame:
    """Exact top-k per query -> ``(qid, id, score, rank)``; fewer when the store is smaller."""
    if k <= 0:
        return store.sparkSession.createDataFrame([], "qid long, id long, score double, rank int")
    q, s = _unit(queries, qid, vec), _unit(store, "id", "embedding")
    nq, ns = blocks_for(q), blocks_for(s)
    everyone = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    q = q.withColumn("block", hash_block("id", nq)).withColumn("partners", everyone(ns))
    s = s.withColumn("block", hash_block("id", ns)).withColumn("partners", everyone(nq))
    cand = block_pairs(q, s, functools.partial(_best, k), "qid long, id long, score double")
    ranked = _merge_topk(cand, k)
    score = 2.0 - 2.0 * F.col("score") if metric == "l2sq" else F.col("score")
    return ranked.select("qid", "id", score.alias("score"), "rank")


def fit_clusters(store: DataFrame, k: int, seed: int = 7, max_iter: int = 20, rows: int = FIT_ROWS):
    """k-means centroids of the store vectors, fitted on about ``rows`` of them drawn by a hash of the id."""
    n = store.count()
    share = int(min(1.0, rows / max(n, 1)) * (1 << 30))
    drawn = store.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share)
    data = drawn.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(data)
    return np.array([c for c in model.clusterCenters()], dtype=np.float64)


def _unit_rows(v: pd.Series) -> np.ndarray:
    """Stack a batch of vectors and scale each to unit length (zero rows stay zero)."""
    m = np.stack(v.to_numpy()).astype(np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _assign(df: DataFrame, cents_bc, vec: str = "embedding") -> DataFrame:
    """Nearest centroid and the distance to it, per vector (vectors taken raw, scaled in the batch)."""
    @F.pandas_udf("struct<cluster:int,dist:double>")
    def nearest(v: pd.Series) -> pd.DataFrame:
        c = cents_bc.value
        m = _unit_rows(v)
        d2 = (m * m).sum(1)[:, None] - 2 * m @ c.T + (c * c).sum(1)[None, :]
        j = d2.argmin(1)
        return pd.DataFrame({"cluster": j.astype(np.int32), "dist": np.sqrt(np.maximum(d2[np.arange(len(j)), j], 0))})
    return df.withColumn("__a", nearest(F.col(vec))).withColumn("cluster", F.col("__a.cluster")) \
             .withColumn("cdist", F.col("__a.dist")).drop("__a")


def _clustered(df: DataFrame, cents_bc) -> tuple[DataFrame, dict]:
    """Rows with their cluster, and (rows, dims, radius) of each cluster (one row per cluster)."""
    rows = written(_assign(df, cents_bc, "raw"), "assigned")
    stats = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"), F.max("cdist").alias("r")).collect()
    return rows, {r["cluster"]: (r["n"], r["d"], r["r"]) for r in stats}


def _block_numbers(stats: dict, k: int) -> list[tuple[int, int]]:
    """(first block, number of blocks) of each cluster."""
    out, at = [], 0
    for c in range(k):
        n, d, _ = stats.get(c, (0, 1, 0.0))
        blocks = -(-n * d * 8 // BLOCK_BYTES)
        out.append((at, blocks))
        at += blocks
    return out


def _by_cluster(values: list, kind: str):
    """A column: the entry of ``values`` at the row's cluster."""
    return F.get(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), F.col("cluster"))


def _in_blocks(rows: DataFrame, numbers: list[tuple[int, int]]) -> DataFrame:
    first, n = (_by_cluster([x[i] for x in numbers], "int") for i in (0, 1))
    return rows.withColumn("block", (first + F.pmod(F.xxhash64("id", F.lit(17)), n)).cast("int"))


def _reaching(t: float, once: bool, ids_l: np.ndarray, m: np.ndarray, ids_r: np.ndarray, r: np.ndarray):
    """Pairs of cosine ``t`` or more; with ``once`` each unordered pair of different ids, smaller id first."""
    sims = m @ r.T
    rows, cols = np.nonzero(sims >= t)
    a, b, score = ids_l[rows], ids_r[cols], sims[rows, cols]
    if once:
        keep = a != b
        a, b, score = np.minimum(a, b)[keep], np.maximum(a, b)[keep], score[keep]
    yield a, b, score


def cosine_join(left: DataFrame, right: DataFrame | None, t: float, clusters: int = 64, seed: int = 7) -> DataFrame:
    """Every (id_l, id_r, score) with cosine(v_l, v_r) >= t, exactly; inputs ``(id, v)``, the cosine with a zero vector is 0.

    ``right=None`` joins ``left`` with itself and returns each pair once (``id_l < id_r``).
    """
    if not -1.0 < t <= 1.0:
        raise ValueError("cosine_join needs -1 < t <= 1")
    spark, once = left.sparkSession, right is None
    ln = _unit(left, "id", "v")
    rn = ln if once else _unit(right, "id", "v")
    kernel = functools.partial(_reaching, t, once)
    schema = "id_l long, id_r long, score double"
    nl, nr = blocks_for(ln), blocks_for(rn)
    if nl * nr <= PLAIN_PAIRS:  # too few pairs of blocks for clusters to save any
        everyone = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
        lb = ln.withColumn("block", hash_block("id", nl)).withColumn("partners", everyone(nr))
        rb = rn.withColumn("block", hash_block("id", nr)).withColumn("partners", everyone(nl))
        return _pairs(lb, rb, kernel, schema, once)
    cents = fit_clusters(rn, clusters, seed, max_iter=10)
    cbc = spark.sparkContext.broadcast(cents)
    lc, ls = _clustered(ln, cbc)
    rc, rs = (lc, ls) if once else _clustered(rn, cbc)
    k = len(cents)
    numbers_l, numbers_r = _block_numbers(ls, k), _block_numbers(rs, k)
    reach = float(np.sqrt(2.0 - 2.0 * t)) + 1e-9
    apart = np.linalg.norm(cents[:, None, :] - cents[None, :, :], axis=2)

    def partners(own: dict, other: dict, numbers: list) -> list:
        """For each own cluster the blocks of the other side's clusters that may hold a partner."""
        return [[b for j in range(k) if i in own and j in other and apart[i, j] <= own[i][2] + other[j][2] + reach
                 for b in range(numbers[j][0], sum(numbers[j]))] for i in range(k)]

    lb = _in_blocks(lc, numbers_l).withColumn("partners", _by_cluster(partners(ls, rs, numbers_r), "array<int>"))
    rb = _in_blocks(rc, numbers_r).withColumn("partners", _by_cluster(partners(rs, ls, numbers_l), "array<int>"))
    return _pairs(lb, rb, kernel, schema, once)


def _pairs(lb: DataFrame, rb: DataFrame, kernel, schema: str, once: bool) -> DataFrame:
    if once:  # each pair of blocks once; inside a block both orders are found and one is kept
        lb = lb.withColumn("partners", F.filter("partners", lambda b: b >= F.col("block")))
        rb = rb.withColumn("partners", F.filter("partners", lambda b: b <= F.col("block")))
    pairs = block_pairs(lb, rb, kernel, schema)
    return pairs.groupBy("id_l", "id_r").agg(F.max("score").alias("score")) if once else pairs


def ivf_topk(store: DataFrame, queries: DataFrame, k: int = 5, nlist: int = 100, nprobe: int = 1,
             qid: str = "qid", vec: str = "embedding", seed: int = 7) -> DataFrame:
    """Approximate top-k by probing the ``nprobe`` nearest clusters of each query; exact for ``nprobe >= nlist``."""
    spark = store.sparkSession
    s, q = _unit(store, "id", "embedding"), _unit(queries, qid, vec)
    if s.isEmpty():
        return spark.createDataFrame([], "qid long, id long, score double, rank int")
    cents = fit_clusters(s, nlist, seed)
    cbc = spark.sparkContext.broadcast(cents)
    rows, stats = _clustered(s, cbc)
    numbers = _block_numbers(stats, len(cents))

    @F.pandas_udf("array<int>")
    def probes(v: pd.Series) -> pd.Series:
        c = cbc.value
        m = _unit_rows(v)
        d2 = (m * m).sum(1)[:, None] - 2 * m @ c.T + (c * c).sum(1)[None, :]
        p = min(nprobe, c.shape[0])
        return pd.Series([row.tolist() for row in np.argsort(d2, axis=1)[:, :p].astype(np.int32)])

    nq = blocks_for(q)
    blocks = F.from_json(F.lit(json.dumps([list(range(a, a + n)) for a, n in numbers])), "array<array<int>>")
    q = q.withColumn("block", hash_block("id", nq)).withColumn("probed", probes("raw"))
    q = q.withColumn("partners", F.flatten(F.transform("probed", lambda c: F.get(blocks, c))))
    probed = q.select(F.explode("probed").alias("cluster")).distinct()  # nlist rows at most
    s = _in_blocks(rows.join(F.broadcast(probed), "cluster", "left_semi"), numbers).withColumn("partners", F.sequence(F.lit(0), F.lit(nq - 1)))
    cand = block_pairs(q, s, functools.partial(_best, k), "qid long, id long, score double")
    return _merge_topk(cand, k).select("qid", "id", "score", "rank")


def lsh_topk(store: DataFrame, queries: DataFrame, k: int = 5, bucket_length: float = 0.5, tables: int = 4,
             qid: str = "qid", vec: str = "embedding", seed: int = 7, max_distance: float = 1.2) -> DataFrame:
    """Approximate top-k; candidates share a random-projection bucket in some table and lie within ``max_distance``."""
    s = store.select("id", F.col("embedding").cast("array<double>").alias("embedding")).distinct()
    q = queries.select(F.col(qid).cast("long").alias("id"), l2_normalize(vec).alias("embedding")).distinct()
    as_features = lambda df: df.withColumn("features", array_to_vector("embedding"))
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                      numHashTables=tables, seed=seed).fit(as_features(s))

    def hashed(df: DataFrame) -> DataFrame:
        rows = lsh.transform(as_features(df)).select("id", "embedding", F.posexplode("hashes").alias("table", "h"))
        return rows.select("id", "embedding", "table", vector_to_array("h")[0].cast("long").alias("bucket"))

    def parts(df: DataFrame, name: str) -> DataFrame:
        """How many blocks the rows of each bucket make."""
        n = df.groupBy("table", "bucket").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"))
        return n.select("table", "bucket", F.greatest(F.ceil(F.col("n") * F.col("d") * 8 / BLOCK_BYTES), F.lit(1)).cast("int").alias(name))

    hs, hq = hashed(s), hashed(q)
    buckets = written(parts(hq, "nq").join(parts(hs, "ns"), ["table", "bucket"]), "buckets")  # a row per bucket

    def in_blocks(df: DataFrame, own: str, other: str, q_first: bool) -> DataFrame:
        """Rows in a block of their bucket, sent to each block that the other side has there; a pair of blocks is a group."""
        part = hash_block("id", 1 << 30)
        met = df.join(F.broadcast(buckets), ["table", "bucket"]).withColumn("mine", F.pmod(part, F.col(own)))
        met = met.withColumn("its", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("mine", "its") if q_first else ("its", "mine")
        return met.select("id", "embedding", F.xxhash64("table", "bucket", *pair).alias("block")).withColumn("partners", F.array("block"))

    cand = block_pairs(in_blocks(hq, "nq", "ns", True), in_blocks(hs, "ns", "nq", False), functools.partial(_best_within, k, max_distance), "qid long, id long, score double")
    # the k best of each bucket hold the k best of all; a pair may meet in several tables
    return _merge_topk(cand.groupBy("qid", "id").agg(F.max("score").alias("score")), k).select("qid", "id", "score", "rank")


def save_store(store: DataFrame, path: str, model_name: str, dimension: int) -> None:
    """K3: vectors + texts + metadata, and a one-row info table {dimension, model_name}."""
    spark: SparkSession = store.sparkSession
    store.write.mode("overwrite").parquet(f"{path}/vectors")
    spark.createDataFrame([(dimension, model_name)], "dimension int, model_name string") \
         .write.mode("overwrite").parquet(f"{path}/info")


def load_store(spark: SparkSession, path: str, model_name: str, dimension: int) -> tuple[DataFrame, list[str]]:
    """Read a saved store; a dimension mismatch is an error, a model-name mismatch a warning."""
    info = spark.read.parquet(f"{path}/info").first()
    warnings = []
    if info["model_name"] not in (None, "unknown") and info["model_name"] != model_name:
        warnings.append(f"store built with {info['model_name']}, reading with {model_name}")
    if info["dimension"] != dimension:
        raise ValueError(f"the store has vectors of {info['dimension']} dimensions, not {dimension}")
    return spark.read.parquet(f"{path}/vectors"), warnings
