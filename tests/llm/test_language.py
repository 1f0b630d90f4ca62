import random

import numpy as np
from conftest_llm import DOCS, odd_texts, rows_of
from pyspark.sql import functions as F

from shelfmatch.llm import language as L
from shelfmatch.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = L.op6_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_do_not_matter(spark):
    docs = table(spark, SF, "documents").limit(300).cache()
    one = L.fit(docs)
    held = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    two = L.fit(held.withColumn("source", F.lit("other")))
    assert one.languages == two.languages and np.array_equal(one.centroids, two.centroids)


def test_counts_in_pieces_equal_the_whole(monkeypatch):
    random.seed(1)
    for _ in range(60):
        text = "".join(random.choice("ab é.1中") for _ in range(random.randrange(200)))
        whole = L.gram_counts(text)
        monkeypatch.setattr(L, "PIECE", 1000)
        assert np.array_equal(whole, L.gram_counts(text))


def test_odd_rows_and_tables_without_labels(spark, frame):
    rows = rows_of(odd_texts() * 8)
    docs = frame([(*r, "x") for r in rows], DOCS + ", language string")
    got = {r.doc_id: r for r in docs.select("doc_id", L.predicted(docs, L.fit(docs)).alias("p")).select("doc_id", "p.*").collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert not (got[i].lang_pred == "und" and (got[i].score or not got[i].rejected))
    assert L.known_language(docs).columns == docs.columns
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.p.lang_pred for r in unlabelled.select(L.predicted(unlabelled, L.fit(unlabelled)).alias("p")).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert L.known_language(empty).count() == 0
