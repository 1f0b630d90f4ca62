"""Benchmark decontamination: Wu-Manber search of many word windows in every document.

The pattern strings are windows of consecutive benchmark words; the alphabet is the word and a block is two
words.  Patterns are grouped by their length m.  For each group a shift table says, for the block that ends at a
text position, how many words the search may go on without missing an occurrence (m - 1 for a block of no
pattern); a block with shift 0 leads to the bucket of the patterns that end in it, a prefix block narrows the
bucket, and direct comparison confirms.

The benchmark is searched in blocks of about ``BLOCK_WORDS`` words, so the tables in a task are bounded whatever
its size: each block is one narrow pass over the documents, and the passes are merged by document.

Defined results: null or wordless texts have no words and no hits; a wordless item has no windows; windows of an
item without id hit words, but the item is not named; every document row gives one row;
an empty benchmark hits nothing.  Other columns of the tables are not read.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import fresh, normal_words, per_row, prepare, resident, table

WINDOW = 10
BLOCK_WORDS = 200_000
HITS = "n_words long, spans array<struct<start:int,end:int>>, items array<long>"


class WuManber:
    """Tables for patterns (tuples of words), each with a value that a find reports."""

    def __init__(self, patterns: dict[tuple, object]):
        self.groups = []
        by_length: dict[int, list[tuple]] = {}
        for p in patterns:
            by_length.setdefault(len(p), []).append(p)
        for m, group in sorted(by_length.items()):
            size = min(2, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[tuple, list]] = {}
            for p in group:
                for end in range(size, m + 1):
                    block = p[end - size:end]
                    shift[block] = min(shift.get(block, m), m - end)
                buckets.setdefault(p[m - size:], {}).setdefault(p[:size], []).append((p, patterns[p]))
            self.groups.append((m, size, shift, buckets))

    def find(self, words: list):
        """(start, end, value) of each occurrence."""
        for m, size, shift, buckets in self.groups:
            end, n, far = m, len(words), m - size + 1
            while end <= n:
                block = tuple(words[end - size:end])
                step = shift.get(block, far)
                if step:
                    end += step
                    continue
                start = end - m
                for pattern, value in buckets[block].get(tuple(words[start:start + size]), ()):
                    if tuple(words[start:end]) == pattern:
                        yield start, end, value
                end += 1


def windows(items: list[tuple]) -> dict[tuple, set]:
    """Window of words -> ids of the items that hold it; an item shorter than a window is one window."""
    found: dict[tuple, set] = {}
    for item_id, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            found.setdefault(tuple(words[i:i + WINDOW]), set()).add(item_id)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjoining spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def search(texts: list, block_id: int, block) -> list[tuple]:
    tables, out = resident(("decontaminate", block_id), lambda: WuManber(windows(block.value))), []
    for text in texts:
        words = normal_words(text)
        spans, items = [], set()
        for start, end, ids in tables.find(words):
            spans.append((start, end))
            items |= ids
        out.append((len(words), [{"start": a, "end": b} for a, b in merged(spans)], sorted(items - {None})))
    return out


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in blocks of about ``block_words`` words, one after the other; the driver holds one at a time."""
    keyed = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = keyed.agg(F.sum(F.size(F.split("text", "[^a-zA-Z0-9]+")).cast("long"))).first()[0] or 0
    n = max(1, -(-size // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in keyed.where(block == k).collect()]


def _hits(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per doc_id and text with ``rows``, the number of documents that have both."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text")
    passes = []
    for k, items in enumerate(benchmark_blocks(benchmark, block_words)):
        block = spark.sparkContext.broadcast(items)
        hits = per_row(functools.partial(search, block_id=block._jbroadcast.id(), block=block), HITS, F.col("text"))
        passes.append(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), hits.alias("h"))
                      .select("doc_id", "text_hash", F.lit(int(k == 0)).alias("first"), "h.*"))
    found = functools.reduce(DataFrame.unionAll, passes).groupBy("doc_id", "text_hash").agg(
        F.sum("first").alias("rows"), F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    start, end = "start", "end"
    joined = F.aggregate(
        F.array_sort("spans"), F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (s[start] <= F.element_at(acc, -1)[end]), F.concat(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(F.element_at(acc, -1)[start].alias(start), F.greatest(s[end], F.element_at(acc, -1)[end]).alias(end)))))
        .otherwise(F.concat(acc, F.array(s))))
    found = found.withColumn("spans", joined)
    return found.select(
        "doc_id", "text_hash", "rows", "n_words", "spans",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[end] - s[start]).alias("n_hit"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, spans (hit word ranges, disjoint), n_hit, items (sorted)."""
    found = _hits(docs, benchmark, block_words)
    return found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("row", "rows")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any occurrence, with all their columns."""
    doc_id, text_hash = fresh(docs, "hit_id"), fresh(docs, "hit_hash")
    bad = _hits(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash)), "left_anti")


def op7_contamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, len(w[i:i + 9]) AS m, array_to_string(w[i:i + 9], ' ') AS p
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM p),
o AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)),
f AS (SELECT o.doc_id, o.i, o.m, p.item_id FROM o JOIN p ON o.p = p.p AND o.m = p.m),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM f) GROUP BY doc_id),
n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
