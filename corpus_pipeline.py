"""Training-corpus pipeline over ``documents``.

Each stage works on all that its predecessor kept and is written as Parquet before the next one reads it: quality
rules drop what the compression bands reject, language identification what no learned language explains, the n-gram
Jaccard join all but one document of each group of copies, benchmark decontamination what holds a benchmark
passage; SentencePiece coding adds the token ids.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from shelfmatch.llm.common import prepare, stored, table  # noqa: E402
from shelfmatch.llm.decontaminate import decontaminated  # noqa: E402
from shelfmatch.llm.language import known_language  # noqa: E402
from shelfmatch.llm.near import one_of_each  # noqa: E402
from shelfmatch.llm.piece_coding import tokenised  # noqa: E402
from shelfmatch.llm.quality import good_documents  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return good_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def piece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tokenised(docs)


STAGES = [
    ("quality rules", quality),
    ("language identification", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece coding", piece_coding),
]

#: No stage but the fourth can be written in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k + 1}")
    return docs
