"""Substring dedup by difference-cover anchors.

Words are `[^\\x20\\x09-\\x0D]+`.  A window is ``window`` consecutive words of one document; each word of a window that also
starts anywhere else, in the same document too, is removed.  All windows are judged on the input.

1. A difference cover D modulo a period v holds, for each shift d, two members that differ by d.  So wherever two
   equal windows start, some k < v puts both starts plus k on cover positions, and the two runs of ``window - v + 1`` words
   there, the anchors, are equal.  Only anchors at cover positions are hashed: 5 of 21 positions for 35 words.
2. Anchors that occur once are dropped (counts with partial aggregation).  The others extend: the windows around each, up
   to v - 1 words to its left, are hashed with 128 bits, and those that occur twice or more are the repeated ones.

Documents with one text are one class: its windows are hashed once, and if it has two documents all its windows repeat.
An anchor, window or text may hold a third of all rows: counts are partial aggregates, and keys that hold
more than 1/4096 of the rows (so at most 4096 of them) are joined by broadcast (`heat.join_counted`).  No pairs are formed.

Defined results: null and empty texts have no words; documents shorter than a window lose nothing; repeated rows are
copies of each other; an empty table gives an empty table; other columns are not read.  Two different windows count as equal
if 128 bits of hash agree.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm.common import per_row, prepare, resident, stored, table
from shelfmatch.llm.heat import hot_keys, join_counted

WINDOW = 35
#: Perfect difference sets by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27), 57: (1, 6, 7, 9, 19, 38, 42, 49)}
#: Words whose hashes are kept; the table is dropped and filled anew beyond it.  Longer words are never kept.
KEPT_WORDS, KEPT_LENGTH = 200_000, 64
KEY = ["text_1", "text_2"]
_MULTIPLIERS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """Period and members of the cover for a window: the longest period that leaves anchors of two fifths of the window."""
    period = max(v for v in COVERS if window - v + 1 >= max(1, 2 * window // 5) or v == 1)
    return period, COVERS[period]


def cover_positions(n: int, window: int) -> np.ndarray:
    """The cover positions below ``n``, ascending; an anchor's number is its place in this list."""
    period, members = cover(window)
    at = (np.arange(0, n, period)[:, None] + np.array(members)).ravel()
    return at[at < n]


class _Hashes(dict):
    """Hashes of words, made where they are missing."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= KEPT_LENGTH:
            self[word] = h
        return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = resident(("substrings",), _Hashes)
    if len(known) > KEPT_WORDS:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(h: np.ndarray, length: int, multiplier: np.uint64) -> np.ndarray:
    """Hash of each run of ``length`` words: runs of doubled length from two halves, the last from two that overlap."""
    if len(h) < length:
        return h[:0]
    x, have = _spread(h + multiplier), 1
    while have < length:
        step = min(have, length - have)
        x = _spread(x[:-step] * multiplier + x[step:])
        have += step
    return x


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _anchors(texts: list, window: int) -> list[tuple]:
    """(number of words, hashes of the anchors by number) of each text."""
    out, length = [], window - cover(window)[0] + 1
    for text in texts:
        words = _words(text)
        if len(words) < window:
            out.append((len(words), None))
            continue
        hashes = run_hashes(word_hashes(words), length, _MULTIPLIERS[0])
        out.append((len(words), hashes[cover_positions(len(hashes), window)].view(np.int64)))
    return out


def _windows(texts: list, anchors: list, window: int) -> list[tuple]:
    """Starts and hashes of the windows that hold one of the anchors (given by number)."""
    out, period = [], cover(window)[0]
    for text, numbers in zip(texts, anchors, strict=True):
        h = word_hashes(_words(text))
        n = len(h) - window + 1
        at = cover_positions(len(h), window)[np.array(numbers)]
        edge = np.zeros(len(h) + 1, dtype=np.int64)
        np.add.at(edge, np.maximum(at - period + 1, 0), 1)
        np.add.at(edge, at + 1, -1)
        starts = np.nonzero(np.cumsum(edge)[:n] > 0)[0]
        one, two = (run_hashes(h, window, m)[starts].view(np.int64) for m in _MULTIPLIERS)
        out.append((starts.astype(np.int32), one, two))
    return out


def _kept(texts: list, starts: list, whole: list, window: int) -> list[tuple]:
    """(words, words removed, spans removed, kept words) of each text."""
    out = []
    for text, at, everything in zip(texts, starts, whole, strict=True):
        words = _words(text)
        if not at and not (everything and len(words) >= window):
            out.append((len(words), 0, [], b" ".join(words).decode()))
            continue
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        if everything:
            edge[0], edge[-1] = 1, -1
        else:
            edge[at] += 1
            edge[np.array(at) + window] -= 1
        covered = np.cumsum(edge)[:-1] > 0
        turns = np.nonzero(np.diff(np.concatenate([[False], covered, [False]])))[0].tolist()
        kept = [words[k] for k in np.nonzero(~covered)[0].tolist()]
        out.append((len(words), int(covered.sum()), [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])], b" ".join(kept).decode()))
    return out


def _keyed(docs: DataFrame, *others: str) -> DataFrame:
    """Texts with 128 bits of hash as their key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*others, text.alias("text"), F.xxhash64(text).alias(KEY[0]), F.xxhash64(F.lit(1), text).alias(KEY[1]))


def _number_of(function, window: int):
    return functools.partial(function, window=window)


def classes_of_texts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per text of a window or more: key, copies, hashes of its anchors."""
    signed = per_row(_number_of(_anchors, window), "n_words int, anchors array<long>", F.col("text"))
    signed = _keyed(docs).select(*KEY, signed.alias("s")).where("s.anchors IS NOT NULL")
    return signed.groupBy(*KEY).agg(F.count("*").alias("copies"), F.first("s.anchors").alias("anchors"))


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key occurs twice or more, with ``n``, how often."""
    counts = stored(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "repeats")
    return join_counted(rows, counts, keys)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per text with repeated windows: key, copies, ``whole`` (all of them, as the text has copies), their starts."""
    prepare(docs.sparkSession)
    classes = stored(classes_of_texts(docs, window), "anchors")
    shared = _repeated(classes.select(*KEY, F.posexplode("anchors").alias("number", "anchor")), ["anchor"])
    shared = stored(shared.groupBy(*KEY).agg(F.collect_list("number").alias("numbers")), "shared")

    hot = hot_keys(classes.select(*KEY, F.col("copies").alias("n")), KEY)
    texts = _keyed(docs)
    one_each = texts.join(F.broadcast(hot), KEY).groupBy(*KEY).agg(F.first("text").alias("text"))
    texts = texts.join(F.broadcast(hot), KEY, "left_anti").unionByName(one_each, allowMissingColumns=True).join(shared, KEY).dropDuplicates(KEY)
    found = per_row(_number_of(_windows, window), "starts array<int>, one array<long>, two array<long>", F.col("text"), F.col("numbers"))
    found = stored(texts.select(*KEY, found.alias("w")).select(*KEY, "w.*"), "windows")
    rows = found.select(*KEY, F.inline(F.arrays_zip("starts", "one", "two")).alias("start", "one", "two"))
    starts = _repeated(rows, ["one", "two"]).groupBy(*KEY).agg(F.collect_list("start").alias("starts"))

    whole = F.col("copies") > 1
    joined = classes.select(*KEY, "copies").join(starts, KEY, "left").where(whole | F.col("starts").isNotNull())
    return joined.select(*KEY, "copies", whole.alias("whole"), F.when(~whole, F.col("starts")).alias("starts"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (word ranges removed, disjoint), kept (the other words)."""
    repeats = stored(repeated_windows(docs, window), "repeated-windows")
    rows = join_counted(_keyed(docs, "doc_id"), repeats, KEY, "copies", "left")
    made = per_row(_number_of(_kept, window), "n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string",
                   F.col("text"), F.col("starts"), F.coalesce("whole", F.lit(False)))
    return rows.select("doc_id", made.alias("k")).select("doc_id", "k.*")


def digest(kept: Column) -> Column:
    return F.sha2(kept, 256)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", digest(F.col("kept")).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS p FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
f AS (SELECT r, i FROM s JOIN (SELECT p FROM s GROUP BY p HAVING count(*) > 1) USING (p)),
h AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM f),
x AS (SELECT r, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS k FROM d),
g AS (SELECT r, string_agg(v, ' ' ORDER BY k) AS t, count(*) AS n FROM x ANTI JOIN h USING (r, k) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
