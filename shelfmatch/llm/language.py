"""Language identification by nearest centroid.

A text is the TF-IDF vector (1 + log of the count, times the inverse document frequency, length 1) of its hashed
1- to 3-character n-grams over lower-case letters, with one space for each run of other characters.  Each language
has several centroids, found by spherical k-means over a sample of its labelled documents; a text takes the
language of the centroid with the highest cosine.  It is rejected if its distance (1 - cosine) is above the limit
of that language, which follows from the distances of the sample.

The sample is bounded: about ``SAMPLE`` documents per language, drawn by a hash of doc_id at a rate that follows
from the language's count.  Only document frequencies (``DIMENSIONS`` numbers), language counts and centroids reach
the driver.  Each language's k-means is one task over its bounded sample.

Defined results: null texts and texts without a letter are `und` with score 0, rejected; where no document is
labelled every text is `und`; a null doc_id is neither held out nor learned from; every row gives one row.  Texts are
read whole, in pieces of ``PIECE`` characters whose counts are added.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import fresh, per_row, prepare, quoted, stored, table

DIMENSIONS = 8192
SAMPLE = 600
CENTROIDS = 4
ROUNDS = 10
#: The limit of a language: this quantile of its sample's distances, and a margin.
QUANTILE, MARGIN = 0.995, 0.2
PIECE = 1_000_000
UNKNOWN = "und"
#: Rows whose crc32 of the id is this modulo 4 are never learned from.
HELD_OUT = 2


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams; all zero if the text has no letter."""
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    text = (text or "").lower()
    any_letter = False
    for at in range(0, len(text), PIECE):
        piece = text[max(0, at - 2):at + PIECE]
        new = min(at, 2)  # characters that only serve as the left part of n-grams
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        letter = _letters()[codes]
        any_letter |= bool(letter[new:].any())
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of other characters stays, as a space
        codes = codes[keep]
        gram = codes
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[:-1] * 1_000_003 + codes[n - 1:]
            if len(gram):
                counts += np.bincount(((gram * 0x9E3779B1 + n) >> 7) & (DIMENSIONS - 1), minlength=DIMENSIONS)
    return counts if any_letter else np.zeros_like(counts)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero places and the vector's values there, of length 1."""
    at = np.nonzero(counts)[0]
    v = (1 + np.log(counts[at])) * idf[at]
    return at, v / np.linalg.norm(v)


def _sample_grams(texts: list) -> list[tuple]:
    out = []
    for text in texts:
        counts = gram_counts(text)
        at = np.nonzero(counts)[0]
        out.append((at.tolist(), counts[at].tolist()))
    return out


def _fit_language(group: pd.DataFrame, idf: np.ndarray) -> pd.DataFrame:
    """Spherical k-means over one language's sample: first centroids far apart, then ``ROUNDS`` of means."""
    group = group.sort_values("doc_id", kind="stable")
    x = np.zeros((len(group), DIMENSIONS), dtype=np.float32)
    for i, (at, n) in enumerate(zip(group["at"], group["n"])):
        counts = np.zeros(DIMENSIONS, dtype=np.int64)
        counts[at] = n
        places, v = _weighted(counts, idf)
        x[i, places] = v
    centroids = [x.mean(axis=0)]
    while len(centroids) < min(CENTROIDS, len(x)):
        centroids.append(x[np.argmin(np.max(x @ np.array(centroids).T, axis=1))])
    c = np.array(centroids)
    for _ in range(ROUNDS):
        own = np.argmax(x @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T, axis=1)
        c = np.array([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    distance = 1 - np.max(x @ c.T, axis=1)
    limit = min(1.0, float(np.quantile(distance, QUANTILE)) + MARGIN)
    return pd.DataFrame({"lang": group["lang"].iloc[0], "limit": limit, "centroid": [row.astype(float).tolist() for row in c]})


class Model:
    """Languages, centroids (one column each), limits and inverse document frequencies."""

    def __init__(self, languages: list[str], centroids: np.ndarray, limits: np.ndarray, idf: np.ndarray):
        self.languages, self.centroids, self.limits, self.idf = languages, np.ascontiguousarray(centroids.T), limits, idf

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = gram_counts(text)
        if not self.languages or not counts.any():
            return UNKNOWN, 0.0, True
        at, v = _weighted(counts, self.idf)
        cosine = v @ self.centroids[at]
        best = int(np.argmax(cosine))
        score = float(min(1.0, max(0.0, cosine[best])))
        return self.languages[best], score, 1 - score > self.limits[best]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from text and lang of the documents that are not held out."""
    prepare(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((0, DIMENSIONS)), np.zeros(0), np.ones(DIMENSIONS))
    space = 1 << 30
    top = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(space, -(-space * sample // n)))]), F.col("lang"))
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < top)
    grams = stored(drawn.select("doc_id", "lang", per_row(_sample_grams, "at array<int>, n array<long>", F.col("text")).alias("g"))
                   .select("doc_id", "lang", "g.*").where(F.size("at") > 0), "language-sample")
    frequency = np.zeros(DIMENSIONS)
    for r in grams.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # DIMENSIONS rows at most
        frequency[r["at"]] = r["count"]
    idf = np.log((1 + grams.count()) / (1 + frequency)) + 1

    def fit_language(group: pd.DataFrame) -> pd.DataFrame:
        return _fit_language(group, idf)

    rows = grams.groupBy("lang").applyInPandas(fit_language, "lang string, limit double, centroid array<double>").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Model([r["lang"] for r in rows], np.array([r["centroid"] for r in rows]).reshape(len(rows), DIMENSIONS).astype(np.float32),
                 np.array([r["limit"] for r in rows]), idf)


def _predict(texts: list, model) -> list[tuple]:
    return [model.value.predict(t) for t in texts]


def predicted(docs: DataFrame, model: Model) -> Column:
    """Struct lang_pred, score, rejected of the text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return per_row(functools.partial(_predict, model=shared), "lang_pred string, score double, rejected boolean", F.col("text"))


def known_language(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns; learns from these documents."""
    name = fresh(docs, "language")
    return docs.withColumn(name, predicted(docs, fit(docs))).where(~F.col(name)["rejected"]).select(*quoted(docs.columns))


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(docs, fit(docs)).alias("p")).select("doc_id", "held_out", "p.*")
