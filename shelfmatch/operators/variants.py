"""Variant comparison of matched products (stage 3: J5, J6, U1, A8) and the
storage x colour variant matrix (J7, A5).

All of it is per-row array work in one narrow stage: ``posexplode`` pairs
capacity i with colour string i, ``array_contains`` keeps capacities the
other shop lists, ``array_intersect`` gives the shared colours.  No shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.lists import parse_list_literal, split_capacities, split_colours

VARIANT_COLUMNS = ("_id1", "_id2", "title_cleaned", "references_cleaned", "capacity", "colors1_for_cap",
                   "colors2_for_row", "common_colors", "num_common_colors")


def variant_overlap(pairs: DataFrame) -> DataFrame:
    """One row per (pair, capacity of side 1 that side 2 also lists)."""
    parsed = pairs.select(
        "_id1", "_id2", "title_cleaned", "references_cleaned",
        parse_list_literal("capacities_1").alias("caps1"), parse_list_literal("colors_1").alias("cols1"),
        split_capacities("capacities_2").alias("caps2"), split_colours("colors_2").alias("colors2_for_row"))
    exploded = parsed.select("*", F.posexplode("caps1").alias("pos", "capacity"))
    shared = exploded.where(F.coalesce(F.array_contains("caps2", F.col("capacity")), F.lit(False)))
    with_cols = shared.withColumn("colors1_for_cap", split_colours(F.get(F.col("cols1"), F.col("pos"))))
    common = F.array_intersect("colors1_for_cap", "colors2_for_row")
    return with_cols.select("_id1", "_id2", "title_cleaned", "references_cleaned", "capacity", "colors1_for_cap",
                            "colors2_for_row", common.alias("common_colors"),
                            F.size(common).alias("num_common_colors"))


def variant_matrix(products: DataFrame, storages: str = "storages", colours: str = "colors",
                   key: str = "url") -> tuple[DataFrame, DataFrame]:
    """Storage x colour cross product per product (two lateral explodes).

    Returns ``(variants, errors)``: products with an empty storage or colour
    list produce no variant and one error row ``Missing variants``.
    """
    has_both = (F.coalesce(F.size(storages), F.lit(0)) > 0) & (F.coalesce(F.size(colours), F.lit(0)) > 0)
    ok = products.where(has_both)
    variants = (ok.select("*", F.posexplode(storages).alias("storage_index", "storage"))
                  .select("*", F.posexplode(colours).alias("color_index", "color"))
                  .drop(storages, colours))
    errors = products.where(~has_both).select(key, F.lit("Missing variants").alias("error"))
    return variants, errors


# --- fixed value: title of a specification section that has none -------------
UNKNOWN_SECTION = "Unknown Section"


def spec_counts(variants: DataFrame, sections: str = "sections") -> DataFrame:
    """A5 (+ X20 section rules): untitled sections are named 'Unknown Section'; per-section
    spec count and the total per variant."""
    with_counts = F.transform(sections, lambda s: s.withField("title", F.coalesce(s["title"], F.lit(UNKNOWN_SECTION)))
                              .withField("specCount", F.size(s["specifications"])))
    return (variants.withColumn(sections, with_counts)
                    .withColumn("totalSpecs", F.aggregate(sections, F.lit(0), lambda acc, s: acc + s["specCount"])))
