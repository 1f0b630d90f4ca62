"""Joins of rows to a table with one row per key, where some keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import fresh, stored

#: A key is hot if it holds one of so many parts of all rows; there can be no more hot keys than that.
PARTS = 4096


def hot_keys(counted: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """The keys that hold 1/``PARTS`` of the rows or more, by the counts in column ``n`` (at most ``PARTS`` keys)."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    return stored(counted.where(F.col(n) * PARTS >= total).select(*keys).coalesce(1), "hot")


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], n: str = "n", how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """``rows`` joined to ``counted`` (one row per key, ``n`` its number of rows) on ``keys``; ``how``: inner or left.

    Hot keys, of which there are at most ``PARTS``, are joined by a broadcast, so no task gets more than 1/``PARTS``
    of all rows for one key.  ``hot`` gives them where the caller has them already.
    """
    hot = hot_keys(counted, keys, n) if hot is None else hot
    flag = fresh(rows.join(counted, keys).limit(0), "is_hot")
    mark = F.broadcast(hot.withColumn(flag, F.lit(True)))
    marked = rows.join(mark, keys, "left")
    warm = F.broadcast(counted.join(F.broadcast(hot), keys, "left_semi"))
    first = marked.where(F.col(flag).isNotNull()).drop(flag).join(warm, keys)
    rest = marked.where(F.col(flag).isNull()).drop(flag).join(counted.join(F.broadcast(hot), keys, "left_anti"), keys, how)
    return first.unionByName(rest)
