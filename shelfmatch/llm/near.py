"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least 0.8.  Words are
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z in lower case; a text of one to four words has one shingle.

1. Texts with equal shingle sets form a class of copies (similarity 1), found by a fingerprint of the set; from here on
   the class is one node.  No copies are ever paired.
2. Each class has ``BANDS * ROWS`` MinHash values.  Classes that agree in a whole band share a bucket.  A pair of
   similarity 0.8 shares no bucket with probability (1 - 0.8**ROWS)**BANDS, 6e-5; of 0.85, 2e-7.
3. In each bucket the MinHash values of candidates are compared step by step.  After n values with m matches the
   posterior probability that the similarity reaches the threshold is P(Binomial(n + 1, threshold) <= m) (uniform
   prior); a pair for which it falls below ``TOLERANCE`` is dropped.  A search from member to member compares each found one
   with those not yet reached, so a bucket of n like texts takes about n comparisons and yields at most n - 1 edges.
   Their connected components hold all pairs that survive the pruning.
4. In each component all pairs are pruned in the same way and the rest verified exactly, by products of 0/1 matrices over
   the shingles.  Components of more than ``BLOCK`` classes or ``BLOCK_SHINGLES`` shingles
   are dealt out as pairs of blocks; what leaves a task is each
   class's number of links and a spanning forest of the links, never the pairs.

The result is one row per document: its class (the smallest doc_id of its connected component of links) and the number of
documents it is linked with, copies counted in full.

Defined results: null texts and texts without a word are linked with nothing and are their own class; rows with the
same doc_id and shingle set are copies like any other; a null doc_id counts as none in the smallest doc_id of a
class; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm.common import fresh, normal_words, per_row, prepare, quoted, resident, stored, table
from shelfmatch.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
#: MinHash values compared before each look at the posterior, and its least value.
STEP = 32
TOLERANCE = 1e-5
#: Classes in a task's matrix of pairs; larger buckets and components are split into blocks of about this size.
BLOCK = 512
#: Shingles in a block, unless one class has more.
BLOCK_SHINGLES = 1_000_000
#: Shingles in one product of matrices.
PART = 4096
SEED = 20_11

_RANDOM = np.random.default_rng(SEED)
_MULTIPLY = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)
#: Words whose hashes are kept; the table is dropped and filled anew beyond it.
KEPT_WORDS = 200_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number spread over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = normal_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = resident(("near",), dict)
    if len(hashes) > KEPT_WORDS:
        hashes.clear()
    for w in set(words).difference(hashes):
        hashes[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(SHINGLE, len(h))):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n] + np.uint64(k + 1))
    return np.unique(out)


def min_hashes(shingle_hashes: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of 16 bits (minima of 32-bit permutations, mixed down)."""
    x = (shingle_hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        part = x[None, at:at + 1024]
        for k in range(0, HASHES, 64):
            np.minimum(low[k:k + 64], (part * _MULTIPLY[k:k + 64, None] + _ADD[k:k + 64, None]).min(axis=1), out=low[k:k + 64])
    return (_mixed(low.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, fewest matches at which the posterior still reaches the tolerance)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        p = m = 0
        while True:
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


@functools.lru_cache(maxsize=4)
def _looks(threshold: float) -> list[tuple[int, int]]:
    return least_matches(threshold, TOLERANCE)


def survivors(one: np.ndarray, others: np.ndarray, threshold: float) -> np.ndarray:
    """Positions in ``others`` of the signatures that the pruning leaves as candidates for ``one``."""
    left, matches, done = np.arange(len(others)), np.zeros(len(others), dtype=np.int64), 0
    for n, least in _looks(threshold):
        matches += (others[left, done:n] == one[done:n]).sum(axis=1)
        good = matches >= least
        left, matches, done = left[good], matches[good], n
    return left


def signature(texts: list) -> list[tuple]:
    """(fingerprint of the shingle set, its size, MinHash values, key of each band) or nulls where there is no word."""
    out = []
    for text in texts:
        s = shingles(text)
        if not len(s):
            out.append((None, None, None, None))
            continue
        low = min_hashes(s)
        bands = [xxhash.xxh3_64_intdigest(low[ROWS * b:ROWS * (b + 1)].tobytes(), seed=b) - (1 << 63) for b in range(BANDS)]
        out.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s), low.tobytes(), bands))
    return out


def _runs(batches, keys: int):
    """Rows (lists of Python values) of each run of equal first ``keys`` columns, over the bounds of batches."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def reachable(ids: list[int], signatures: np.ndarray, threshold: float):
    """Edges that join all members that a chain of surviving pairs joins."""
    waiting = np.arange(len(ids))
    while len(waiting):
        found, waiting = [int(waiting[0])], waiting[1:]
        while found and len(waiting):
            one = found.pop()
            near = survivors(signatures[one], signatures[waiting], threshold)
            for k in waiting[near].tolist():
                found.append(k)
                yield ids[one], ids[k]
            waiting = np.delete(waiting, near)


def _bucket_edges(batches, threshold: float):
    for _, rows in _runs(batches, 3):
        edges = list(reachable([r[0] for r in rows], np.array([np.frombuffer(r[1], dtype=np.uint16) for r in rows]), threshold))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])


def _blocked(rows: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Rows of each key dealt into the key's ``n_blocks`` blocks; each row once for every pair of blocks that its own is in."""
    rows = rows.join(sizes.select(key, "n_blocks"), key)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("n_blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return rows.withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")}).drop("other", "n_blocks")


def _blocks(n: Column, most: int) -> Column:
    return F.ceil(n / most).cast("int")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each pair of sets, by products over the shingles that occur in two or more."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, n = np.unique(values, return_inverse=True, return_counts=True)
    shared = n[number] > 1
    new = np.cumsum(n > 1) - 1
    number, owner = new[number[shared]], owner[shared]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, PART):
        a, b = np.searchsorted(number, (low, low + PART))
        x = np.zeros((len(sets), min(PART, int(number[-1]) + 1 - low)), dtype=np.float32)
        x[owner[a:b], number[a:b] - low] = 1
        total += x @ x.T
    return total


def linked_pairs(sets: list[np.ndarray], signatures: np.ndarray, allowed: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of the pairs of similarity ``threshold`` or more among those that are allowed."""
    n = len(sets)
    candidate = np.zeros((n, n), dtype=bool)
    for i in range(n - 1):
        candidate[i, i + 1 + survivors(signatures[i], signatures[i + 1:], threshold)] = True
    candidate &= allowed | allowed.T
    used = np.nonzero(candidate.any(axis=0) | candidate.any(axis=1))[0]
    if not len(used):
        return candidate
    common = intersections([sets[k] for k in used]).astype(np.float64)
    size = np.array([len(sets[k]) for k in used], dtype=np.float64)
    either = size[:, None] + size[None, :] - common
    good = np.zeros((n, n), dtype=bool)
    good[np.ix_(used, used)] = common >= threshold * either - 1e-9
    return candidate & good


def _links(batches, threshold: float):
    """For each pair of blocks: (node, number of documents linked to it) and a spanning forest (a, b)."""
    for (_, first, second), rows in _runs(batches, 3):
        rows = list({r[0]: r for r in rows}.values())  # a repeated row is one node
        ids = np.array([r[0] for r in rows])
        copies = np.array([r[1] for r in rows])
        own = np.array([r[2] for r in rows])
        sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
        signatures = np.array([min_hashes(s) for s in sets])
        allowed = np.ones((len(ids), len(ids)), dtype=bool) if first == second else (own[:, None] == first) & (own[None, :] == second)
        good = linked_pairs(sets, signatures, allowed, threshold)
        a, b = np.nonzero(good)
        if not len(a):
            continue
        n = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        has = np.nonzero(n)[0]
        root = np.arange(len(ids))
        forest = []
        for x, y in zip(a.tolist(), b.tolist()):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[max(x, y)] = min(x, y)
                forest.append((int(ids[x]), int(ids[y])))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(ids[k]) for k in has] + [None] * len(forest), pa.int64()), pa.array([int(n[k]) for k in has] + [None] * len(forest), pa.int64()),
            pa.array([None] * len(has) + [f[0] for f in forest], pa.int64()), pa.array([None] * len(has) + [f[1] for f in forest], pa.int64())], ["node", "links", "a", "b"])


def _shingle_bytes(texts: list) -> list[tuple]:
    return [(s.tobytes(), hashlib.blake2b(s.tobytes(), digest_size=16).digest()) for s in map(shingles, texts)]


def _found(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fingerprint) and classes of copies (fingerprint, doc_id, copies, component, links)."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed = per_row(signature, "fingerprint binary, n_shingles int, low binary, bands array<long>", F.col("text"))
    signed = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), signed.alias("s")).select("doc_id", "text_hash", "s.*"), "signatures")

    # 1: copies
    classes = stored(signed.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(
        F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))), F.min(F.struct("doc_id", "text_hash"))).alias("one"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("low").alias("low"), F.first("bands").alias("bands")).select("fingerprint", "one.*", "copies", "n_shingles", "low", "bands", F.xxhash64("fingerprint").alias("node")), "copies")

    # 2, 3: buckets and the pairs in them that the pruning leaves
    members = classes.select(F.explode("bands").alias("bucket"), "node")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("n_blocks", _blocks(F.col("n"), 4 * BLOCK))
    dealt = _blocked(members, "bucket", sizes).join(classes.select("node", "low"), "node").select("bucket", "first", "second", "node", "low")
    dealt = dealt.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second", "node")
    edges = dealt.mapInArrow(functools.partial(_bucket_edges, threshold=threshold), "a long, b long")
    groups = components(edges).join(classes.select("node", "doc_id", "text_hash", "copies", "n_shingles", "fingerprint"), "node")

    # 4: exact links within the components
    sizes = groups.groupBy("component").agg(F.greatest(
        _blocks(F.count("*"), BLOCK), _blocks(F.sum("n_shingles"), BLOCK_SHINGLES)).alias("n_blocks"))
    sets = per_row(_shingle_bytes, "shingles binary, print binary", F.col("text"))
    # by id and text, so that rows of one id, or without one, do not meet each other's classes
    same = docs["doc_id"].eqNullSafe(groups["doc_id"]) & (F.xxhash64(docs["text"]) == groups["text_hash"])
    texts = (docs.join(groups, same).withColumn("s", sets)
             .where(F.col("s.print") == F.col("fingerprint")).select("component", "node", "copies", F.col("s.shingles").alias("shingles")))
    blocks = _blocked(texts, "component", sizes).select("component", "first", "second", "node", "copies", "own", "shingles")
    dealt = blocks.repartition("component", "first", "second").sortWithinPartitions("component", "first", "second", "node")
    found = stored(dealt.mapInArrow(functools.partial(_links, threshold=threshold), "node long, links long, a long, b long"), "links")
    links = found.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where(F.col("a").isNotNull()).select("a", "b"))
    classes = classes.select("fingerprint", "node", "doc_id", "copies").join(links, "node", "left").join(joined, "node", "left")
    return signed.select("doc_id", "text_hash", "fingerprint"), classes.select(
        "fingerprint", "doc_id", "copies", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links (documents linked with it), copy_id (smallest doc_id with the same shingle set)."""
    rows, classes = _found(docs, threshold)
    least = classes.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    classes = classes.join(least, "component").select("fingerprint", "class_id", F.col("doc_id").alias("copy_id"), (F.col("links") + F.col("copies") - 1).alias("links"))
    return rows.join(classes, "fingerprint", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("copy_id", "doc_id").alias("copy_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest doc_id, with all its columns."""
    rows, classes = _found(docs, THRESHOLD)
    rows = rows.join(classes.select("fingerprint", "component"), "fingerprint", "left")
    keep = rows.groupBy(F.coalesce("component", F.xxhash64("doc_id", "text_hash")), F.col("component").isNull()).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("k")).select(F.col("k.doc_id").alias("_keep_id"), F.col("k.text_hash").alias("_keep_hash"))
    names = fresh(docs, "key_id"), fresh(docs, "key_hash")
    keyed = docs.withColumn(names[0], F.col("doc_id").cast("long")).withColumn(names[1], F.xxhash64("text"))
    kept = keyed.join(keep, (F.col(names[1]) == F.col("_keep_hash")) & F.col(names[0]).eqNullSafe(F.col("_keep_id")), "left_semi")
    return kept.dropDuplicates(list(names)).select(*quoted(docs.columns))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
