"""Keep-first de-duplication (A1, A2).

"Keep the first row per key" is ``row_number() = 1``, which Spark limits to
one row per key and task before the shuffle (``WindowGroupLimit``), so a key
that holds a third of all rows sends one row per map task, and no aggregate
has to carry whole rows in its buffers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.functions.text import normalize_title, py_strip


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """One row per ``keys`` (nulls form one group): the row smallest by ``order``.

    Remaining columns break ties, so the result is deterministic.
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = {k for k in keys if isinstance(k, str)}
    rest = [c for c in df.columns if c not in names and c not in order]
    first = Window.partitionBy(*key_cols).orderBy(*order, *rest)
    return df.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") == 1).drop("__rank")


def dedupe_by_title(df: DataFrame, title: str = "title", order: Sequence[str] = ("_ord",)) -> DataFrame:
    """A1: strip the title, then keep the first row per title (null titles are one group)."""
    stripped = df.withColumn(title, py_strip(title))
    return keep_first(stripped, [title], list(order))


def dedupe_pairs(pairs: DataFrame, title: str = "title", order: Sequence[str] = ("_ord1", "_ord2")) -> DataFrame:
    """A2: keep the first pair per normalised title."""
    return keep_first(pairs, [normalize_title(title).alias("__title_key")], list(order))
