"""Sitemaps (S2): XML ``urlset/url(loc[, lastmod])`` and ``sitemapindex/sitemap/loc``.

Read with Spark's XML source, one row per element whatever the number of
elements in a file; an element without ``loc`` is dropped.  ``write_sitemap``
produces the same format from a URL table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITEMAP_SCHEMA = "loc string, lastmod string"


def read_sitemap(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``loc, lastmod, is_index``: one row per ``url`` entry of a urlset and per ``sitemap`` entry of an index.

    Which of the two a file is follows from its elements.  An entry that is plain text is its own ``loc``.
    """
    def entries(tag: str) -> DataFrame:
        df = (spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true")
              .schema(f"{SITEMAP_SCHEMA}, _VALUE string").load(path))
        loc = F.trim(F.coalesce("loc", "_VALUE"))
        return df.where(loc != "").select(loc.alias("loc"), "lastmod", F.lit(tag == "sitemap").alias("is_index"))

    return entries("url").unionByName(entries("sitemap"))


def write_sitemap(urls: DataFrame, path: str, url_col: str = "url", lastmod_col: str | None = None) -> None:
    cols = [F.col(url_col).alias("loc")] + ([F.col(lastmod_col).cast("string").alias("lastmod")] if lastmod_col else [])
    (urls.select(*cols).write.mode("overwrite").format("xml")
         .option("rootTag", "urlset").option("rowTag", "url").save(path))
