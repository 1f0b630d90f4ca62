"""Reading the driver tables and deriving the matching inputs from them.

Two shop catalogues are derived from ``part``: shop A carries brands 1-12,
shop B brands 13-25 (together: every row).  A product's title is
``p_name``, its storage options are ``<p_size>GB`` and its colour options
are the ``p_type`` words.  Shop A lists one row per part (catalogue rows
with a list-literal capacity and colour text, as the first shop's export
has), shop B one row per part with comma-joined text.  All derivations are
DataFrame expressions over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _brand_no() -> F.Column:
    return F.substring_index("p_brand", "#", -1).cast("int")


def shop_parts(spark: SparkSession, sf_dir: str, shop: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    cond = _brand_no() <= 12 if shop == "A" else _brand_no() > 12
    return part.where(cond)


def shop_catalogue(spark: SparkSession, sf_dir: str, shop: str) -> DataFrame:
    """Catalogue rows ``(_id, title, title_cleaned, capacities, color_options, _ord)``."""
    p = shop_parts(spark, sf_dir, shop)
    cap = F.concat(F.col("p_size").cast("string"), F.lit("GB"))
    colour = F.initcap(F.lower("p_type"))
    if shop == "A":
        caps = F.concat(F.lit("['"), cap, F.lit("']"))
        cols = F.concat(F.lit("['"), colour, F.lit("']"))
    else:
        caps, cols = cap, F.concat(F.lit("Màu "), colour)
    return p.select(F.col("p_partkey").cast("string").alias("_id"), F.col("p_name").alias("title"),
                    F.col("p_name").alias("title_cleaned"), caps.alias("capacities"),
                    cols.alias("color_options"), F.col("p_partkey").alias("_ord"))


def grouped_catalogue(spark: SparkSession, sf_dir: str, shop: str) -> DataFrame:
    """Shop catalogue grouped by product title, with every storage and colour offered.

    Shop A: capacities as a list literal (sorted by size), colours as a list
    literal of one comma-joined string per capacity.  Shop B: comma-joined
    capacities and colours.  Lists are bounded by the distinct sizes and
    types (collected as sets after a partial aggregate), never by row count.
    """
    p = shop_parts(spark, sf_dir, shop)
    colour = F.initcap(F.lower("p_type"))
    per_size = (p.groupBy("p_name", "p_size")
                 .agg(F.min("p_partkey").alias("k"), F.array_sort(F.collect_set(colour)).alias("colours")))
    per_name = per_size.groupBy("p_name").agg(
        F.min("k").alias("_ord"),
        F.array_sort(F.collect_list(F.struct("p_size", "colours"))).alias("variants"))
    caps = F.transform("variants", lambda v: F.concat(v["p_size"].cast("string"), F.lit("GB")))
    if shop == "A":
        def literal(arr):
            return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
        caps_txt = literal(caps)
        cols_txt = literal(F.transform("variants", lambda v: F.array_join(v["colours"], ", ")))
    else:
        caps_txt = F.array_join(caps, ", ")
        all_cols = F.array_sort(F.array_distinct(F.flatten(F.transform("variants", lambda v: v["colours"]))))
        cols_txt = F.array_join(F.transform(all_cols, lambda c: F.concat(F.lit("Màu "), c)), ", ")
    return per_name.select(F.col("_ord").cast("string").alias("_id"), F.col("p_name").alias("title"),
                           F.col("p_name").alias("title_cleaned"), caps_txt.alias("capacities"),
                           cols_txt.alias("color_options"), "_ord")
