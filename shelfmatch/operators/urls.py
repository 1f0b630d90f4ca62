"""URL selection (F1, F2, F3, A4): which pages to fetch, as table operations."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the reference's keyword rule and brand list ---------------
DEFAULT_ALL_OF = ("http", "dtdd")
DEFAULT_NONE_OF = ("sac", "phu-kien")
URL_BRANDS = (
    "iphone", "samsung", "xiaomi", "oppo", "realme", "nothing", "infinix", "vivo",
    "tecno", "sony", "itel", "nubia", "masstel", "nokia", "oneplus", "tcl", "inoi", "benco", "asus",
)


def keyword_filter(df: DataFrame, col: str = "url", all_of: Sequence[str] = DEFAULT_ALL_OF,
                   none_of: Sequence[str] = DEFAULT_NONE_OF) -> DataFrame:
    """keep rows whose text contains every ``all_of`` and no ``none_of`` substring (case-sensitive)."""
    cond = F.lit(True)
    for k in all_of:
        cond = cond & F.col(col).contains(k)
    for k in none_of:
        cond = cond & ~F.col(col).contains(k)
    return df.where(cond)


def contains_brand(c: Column | str, brands: Sequence[str] = URL_BRANDS) -> Column:
    """any brand as a substring of the lower-cased URL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(c).rlike("|".join(re.escape(b) for b in brands))


def new_urls(candidates: DataFrame, seen: DataFrame, col: str = "url") -> DataFrame:
    """Candidate URLs not stored yet (one row per URL)."""
    keys = seen.select(col).where(F.col(col).isNotNull()).distinct()
    return candidates.dropDuplicates([col]).join(keys, col, "left_anti")


def url_counts(candidates: DataFrame, seen: DataFrame, col: str = "url") -> DataFrame:
    """A4: total candidate URLs and how many are new, as one row."""
    keys = seen.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__seen", F.lit(1))
    flagged = candidates.select(col).join(keys, col, "left")
    return flagged.agg(F.count(F.lit(1)).alias("total"),
                       F.sum(F.when(F.col("__seen").isNull(), 1).otherwise(0)).cast("long").alias("new"))
