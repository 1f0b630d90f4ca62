"""Ranked lexical search with a document FP-tree.

Terms are the maximal matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z in lower case.  Each query item ranks all
documents by the sum, over its distinct terms, of ``w * ((10**9 * tf) div (1000 * tf + 8 * m))``: w falls with the number of
documents that hold the term, m grows with the document's length.

1. One pass over the texts keeps each document's number of terms and its term vector, restricted to the terms of the items.
   Counts over all documents give the lengths' mean and the document frequencies.
2. Each task takes the vectors in chunks of ``CHUNK`` documents.  A chunk's vectors, their terms ordered by document
   frequency (most frequent first), are inserted in a prefix tree: documents that share their first terms share a path.
   A node is split while it holds more than ``LEAF`` documents that differ; each node keeps the greatest tf of every
   term and the least m below it.
3. Per item a depth-first search goes through the tree, best bound first.  The score formula on a node's tf maxima and least m
   bounds all scores below; a subtree whose bound is under the item's tenth best score of the task so far is cut off,
   at a leaf the documents are scored.  Each task hands on at most ten rows per item.

Items are searched in blocks: the texts are read once per ``VOCABULARY`` distinct terms, the stored vectors once per
``TREE_TERMS`` of them, so that what is broadcast and a task's tables are bounded whatever the number of items.

Defined results: null texts have no terms; items without a term, or whose terms no document holds, have no rows; an
empty table gives an empty result; documents of equal score and equal or null doc_id rank in any order (null last); repeated documents
rank each for itself; repeated items have their rows each.  Other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmatch.llm.common import normal_words, per_row, prepare, resident, stored, table

TOP = 10
#: Distinct terms of the items of one pass over the texts, and of one pass over the stored vectors.
VOCABULARY, TREE_TERMS = 400_000, 4096
#: Documents in a tree (fewer if an item alone has more than ``TREE_TERMS`` terms), and below a node that is not split further.
CHUNK, LEAF = 4096, 24
#: Bytes of a rank in a path.
WIDE = 4
#: Characters of items that the driver holds at a time.
ITEM_CHARS = 20_000_000
VECTOR = "n_terms long, terms array<int>, tfs array<int>"
SALTS = 64


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n_terms: int, n_docs: int, all_terms: int) -> int:
    return 100 - 90 + (90 * n_terms * n_docs) // all_terms


def _vectors(texts: list, block: int, numbers) -> list[tuple]:
    number = resident(("ranking", block), lambda: {w: i for i, w in enumerate(numbers.value)})
    out = []
    for text in texts:
        words = normal_words(text)
        tf = Counter(w for w in words if w in number)
        terms = sorted((number[w], n) for w, n in tf.items())
        out.append((len(words), [t for t, _ in terms], [n for _, n in terms]))
    return out


class Tree:
    """The prefix tree of a chunk: documents in path order, nodes with their tf maxima and least m."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], norms: np.ndarray, n_terms: int):
        """``vectors``: (ranks ascending, tfs) of each document; ``norms``: m of each."""
        keys = [ranks.astype(f">u{WIDE}").tobytes() for ranks, _ in vectors]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        self.tf = np.zeros((len(vectors), n_terms), dtype=np.int32)
        for row, k in enumerate(self.order.tolist()):
            ranks, tfs = vectors[k]
            self.tf[row, ranks] = tfs
        self.norm = norms[self.order]
        paths = [keys[k] for k in self.order.tolist()]
        #: Each node: first and last document, and its children as a range of node numbers.
        low, high, depth, first, last = [0], [len(paths)], [0], [0], [0]
        at = 0
        while at < len(low):
            a, b, d = low[at], high[at], depth[at]
            first[at] = last[at] = len(low)
            if b - a > LEAF and paths[a] != paths[b - 1]:
                while len(paths[a]) > d and paths[a][d:d + WIDE] == paths[b - 1][d:d + WIDE]:
                    d += WIDE  # all documents go on alike
                start = a
                for k in range(a + 1, b + 1):
                    if k == b or paths[k][d:d + WIDE] != paths[start][d:d + WIDE]:
                        low.append(start)
                        high.append(k)
                        depth.append(d + WIDE)
                        first.append(0)
                        last.append(0)
                        start = k
                last[at] = len(low)
            at += 1
        self.low, self.high, self.first, self.last = low, high, first, last
        self.best_tf = np.zeros((len(low), n_terms), dtype=np.int32)
        self.least_norm = np.zeros(len(low), dtype=np.int64)
        for k in range(len(low) - 1, -1, -1):  # children have larger numbers than their parent
            if first[k] < last[k]:
                self.best_tf[k] = self.best_tf[first[k]:last[k]].max(axis=0)
                self.least_norm[k] = self.least_norm[first[k]:last[k]].min()
            else:
                self.best_tf[k] = self.tf[low[k]:high[k]].max(axis=0)
                self.least_norm[k] = self.norm[low[k]:high[k]].min()

    def search(self, ranks: np.ndarray, weights: np.ndarray, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents (numbers in the chunk) and scores that may be among the best; ``least()`` is the score to reach."""
        root = scores(self.best_tf[:1, ranks], self.least_norm[:1], weights)
        stack = [(int(root[0]), 0)]
        while stack:
            bound, k = stack.pop()
            if bound < least():
                continue
            a, b = self.first[k], self.last[k]
            if a == b:
                rows = slice(self.low[k], self.high[k])
                yield self.order[rows], scores(self.tf[rows][:, ranks], self.norm[rows], weights)
            else:
                bounds = scores(self.best_tf[a:b][:, ranks], self.least_norm[a:b], weights)
                stack += [(int(bounds[i]), a + int(i)) for i in np.argsort(bounds, kind="stable") if bounds[i] >= least()]


def scores(tf: np.ndarray, norm: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of each row of term frequencies."""
    t = tf.astype(np.int64)
    return (1_000_000_000 * t // (1000 * t + 8 * norm[:, None])) @ weights


class Best:
    """The best rows of an item: greatest score first, then the smallest doc_id, null last."""

    def __init__(self):
        self.heap: list[tuple] = []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == TOP else 1

    def add(self, score: int, doc_id: int | None, row: int) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0), row)
        if len(self.heap) < TOP:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> list[tuple[int | None, int]]:
        return [(-minus if known else None, score) for score, known, minus, _ in self.heap]


def _ranked(batches: Iterator[pa.RecordBatch], queries, n_docs: int, all_terms: int) -> Iterator[pa.RecordBatch]:
    """The best rows of each item among a task's vectors: (item, doc_id, score)."""
    rank_of, items, weights = queries.value  # vocabulary number -> rank (-1: none), ranks of each item, weight of each rank
    best = [Best() for _ in items]
    chunk = max(1, CHUNK * TREE_TERMS // max(TREE_TERMS, len(weights)))
    waiting: list[tuple] = []

    def search() -> None:
        tree = Tree([v for _, _, v in waiting], np.array([m for _, m, _ in waiting], dtype=np.int64), len(weights))
        for ranks, found in zip(items, best, strict=True):
            for rows, score in tree.search(ranks, weights[ranks], found.least):
                for k in np.nonzero(score >= found.least())[0].tolist():
                    found.add(int(score[k]), waiting[rows[k]][0], int(rows[k]))
        waiting.clear()

    for batch in batches:
        terms, tfs = batch.column("terms"), batch.column("tfs")
        ids, lengths = batch.column("doc_id").to_pylist(), batch.column("n_terms").to_pylist()
        edges = terms.offsets.to_numpy()
        flat, counts = terms.values.to_numpy(), tfs.values.to_numpy()[tfs.offsets[0].as_py():] if len(ids) else None
        for k, (doc_id, n) in enumerate(zip(ids, lengths, strict=True)):
            ranks = rank_of[flat[edges[k]:edges[k + 1]]]
            tf = counts[edges[k] - edges[0]:edges[k + 1] - edges[0]][ranks >= 0]
            ranks = ranks[ranks >= 0]
            if len(ranks):
                order = np.argsort(ranks)
                waiting.append((doc_id, length_norm(n, n_docs, all_terms), (ranks[order], tf[order])))
                if len(waiting) == chunk:
                    search()
    if waiting:
        search()
    out = [(k, doc_id, score) for k, b in enumerate(best) for doc_id, score in b.rows()]
    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])


def _item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks by hash, of about ``ITEM_CHARS`` characters each: the driver holds one at a time."""
    items = items.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // ITEM_CHARS))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield [(r.item_id, sorted(set(normal_words(r.text)))) for r in sorted(block, key=lambda r: (r.item_id is None, r.item_id, r.text))]


def _parts(items: list[tuple], most: int) -> Iterator[list[tuple]]:
    """The items in runs of at most ``most`` distinct terms (one item may have more)."""
    run, seen = [], set()
    for item_id, terms in items:
        if run and len(seen.union(terms)) > most:
            yield run
            run, seen = [], set()
        run.append((item_id, terms))
        seen.update(terms)
    if run:
        yield run


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ``TOP`` best documents of each item: item (its number), item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    prepare(spark)
    context = spark.sparkContext
    results, numbered = [], 0
    for block in _item_blocks(items):
        for run in _parts(block, VOCABULARY):
            vocabulary = sorted({t for _, terms in run for t in terms})
            if not vocabulary:
                continue
            numbers = context.broadcast(vocabulary)
            vector = per_row(functools.partial(_vectors, block=numbers._jbroadcast.id(), numbers=numbers), VECTOR, F.col("text"))
            vectors = stored(docs.select(F.col("doc_id").cast("long"), vector.alias("v")).select("doc_id", "v.*"), "vectors")
            totals = vectors.where("n_terms > 0").agg(F.count("*"), F.sum("n_terms")).first()
            n_docs, all_terms = totals[0], totals[1] or 0
            df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most VOCABULARY rows
            for part in _parts(run, TREE_TERMS):
                results.append(_part_ranked(vectors, part, vocabulary, df, n_docs, all_terms, numbered))
                numbered += len(part)
    if not results:
        return spark.createDataFrame([], "item int, item_id long, rank int, doc_id long, score long")
    found = functools.reduce(DataFrame.unionAll, results)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= TOP)
    return found.select("item", "item_id", "rank", "doc_id", "score")


def _part_ranked(vectors: DataFrame, part: list[tuple], vocabulary: list, df: dict, n_docs: int, all_terms: int, first: int) -> DataFrame:
    number = {w: i for i, w in enumerate(vocabulary)}
    used = sorted({number[t] for _, terms in part for t in terms if number[t] in df}, key=lambda t: (-df[t], t))
    rank_of = np.full(len(vocabulary), -1, dtype=np.int64)
    rank_of[used] = np.arange(len(used))
    weights = np.array([weight(n_docs, df[t]) for t in used], dtype=np.int64)
    items = [np.array(sorted(int(rank_of[number[t]]) for t in terms if number[t] in df), dtype=np.int64) for _, terms in part]
    spark = vectors.sparkSession
    queries = spark.sparkContext.broadcast((rank_of, items, weights))
    made = vectors.where(F.size("terms") > 0).mapInArrow(
        functools.partial(_ranked, queries=queries, n_docs=n_docs, all_terms=all_terms), "item int, doc_id long, score long")
    ids = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(part)], "item int, item_id long")
    return made.join(F.broadcast(ids), "item").select((F.col("item") + first).alias("item"), "item_id", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS k, item_id, {_TERMS} AS w FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT DISTINCT k, item_id, unnest(w) AS t FROM b),
g AS (SELECT count(*) AS n_docs, sum(len(w)) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
df AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM tf, g GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 10 + CAST((90 * len(w) * n_docs) // l AS BIGINT) AS m FROM d, g),
s AS (SELECT k, item_id, r, doc_id, sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
      FROM q JOIN tf USING (t) JOIN df USING (t) JOIN m USING (r) GROUP BY k, item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS n FROM s WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE n <= 10
"""
