"""File sources and sinks.

CSV follows the reference's pandas defaults: header row, double-quote
escaping, quoted fields may span lines, and pandas' default null tokens are
read as null.  Array columns are written as JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: pandas' default missing-value tokens -----------------------
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

CATALOGUE_SCHEMA = "_id string, title string, title_cleaned string, capacities string, color_options string"


def read_catalogue(spark: SparkSession, path: str, schema: str = CATALOGUE_SCHEMA, multi_line: bool = True) -> DataFrame:
    """CSV with header, columns bound by name (others are dropped, an absent one is an error); pandas null tokens
    become null; ``_ord`` is in the order of files and of rows in them.

    Every file's header is held against the first one's.  ``multi_line=False`` (no quoted field spans lines) lets
    Spark split the files.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    header = reader.csv(path).columns
    wanted = T.StructType.fromDDL(schema)
    if missing := [f.name for f in wanted if f.name not in header]:
        raise ValueError(f"{path} lacks columns {missing}; it has {header}")
    df = reader.option("enforceSchema", False).schema(T.StructType([T.StructField(h, T.StringType()) for h in header])).csv(path)
    cols = []
    for f in wanted:
        c = F.col(f"`{f.name}`")
        cols.append(F.when(~c.isin(list(PANDAS_NA)), c).cast(f.dataType).alias(f.name))
    # a split's place among all splits (a row each), then the row's place in its task
    split = ("_metadata.file_path", "_metadata.file_block_start")
    placed = df.select(*cols, F.col(split[0]).alias("__file"), F.col(split[1]).alias("__block"), F.monotonically_increasing_id().alias("__row"))
    if multi_line:  # a file is one split, and listing the files reads none of them
        splits = spark.read.format("binaryFile").load(path).select(F.col(split[0]).alias("__file"), F.lit(0).cast("long").alias("__block"))
    else:
        splits = df.select(F.col(split[0]).alias("__file"), F.col(split[1]).alias("__block")).distinct()
    ranks = splits.withColumn("__rank", F.row_number().over(Window.orderBy("__file", "__block")).cast("long"))
    order = F.shiftleft(F.col("__rank"), 33) + F.col("__row").bitwiseAND((1 << 33) - 1)
    return placed.join(ranks, ["__file", "__block"]).select(*[f"`{f.name}`" for f in wanted], order.alias("_ord"))


def write_csv(df: DataFrame, path: str, with_index: bool = False) -> None:
    """K1: header CSV; arrays/structs as JSON text; optional leading index column."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    if with_index:
        from shelfmatch.operators.vector_search import with_dense_ids
        out = with_dense_ids(out).withColumnRenamed("id", "_c0")
        out = out.select("_c0", *[c for c in out.columns if c != "_c0"])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """K4: one JSON object per row."""
    df.write.mode("overwrite").json(path)


def read_store_keys(spark: SparkSession, path: str, key: str = "url") -> DataFrame:
    """S3: the key column of the stored collection (only that column is read)."""
    return spark.read.parquet(path).select(key).where(F.col(key).isNotNull()).distinct()


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The fetched-pages table ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
