"""Insert-if-absent into a keyed store (K2), load statistics (A3), quarantine (ST5).

The store is a Parquet directory with one folder per batch.  Writing a batch
= keep the first row per key inside the batch, drop keys that *earlier*
batches stored (an anti join that reads the key column only), and overwrite
the batch's own folder.  A batch's result depends only on earlier folders and
on the rows' values, so replaying it rewrites the same rows: idempotent,
which is what makes the streaming form safe after an executor or driver loss.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.operators.dedupe import keep_first

STATS_SCHEMA = ("batch_id long, processed long, inserted long, duplicates long, errors long, "
                "elapsed double, rate double")


def _store_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def insert_if_absent(spark: SparkSession, batch: DataFrame, store: str, batch_id: int, key: str = "url",
                     order: Sequence[str] = (), valid: Column | None = None,
                     quarantine: str | None = None) -> dict:
    """K2 + A3 (+ ST5): write one batch; returns its stats row as a dict.

    Rows with a null key, or for which ``valid`` is not true, are errors; ``quarantine`` takes them.  Rows of a key
    that are equal in ``order`` are told apart by their other columns.
    """
    t0 = time.time()
    batch = batch.persist()
    try:
        good = F.col(key).isNotNull() & F.coalesce(valid if valid is not None else F.lit(True), F.lit(False))
        ordered = list(order) or [key]
        counts = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(good, 0).otherwise(1)).alias("bad"),
                           F.min(ordered[0]).alias("first_item")).first()
        errors = int(counts["bad"] or 0)
        if quarantine is not None and errors:
            _write_batch(batch.where(~good), quarantine, batch_id)
        first = keep_first(batch.where(good), [key], ordered)
        if _store_exists(spark, store):  # the schema is given: folders of empty batches hold no file to infer it from
            stored = spark.read.schema(T.StructType([batch.schema[key], T.StructField("batch_id", T.LongType())])).parquet(store)
            first = first.join(stored.where(F.col("batch_id") < batch_id).select(key), key, "left_anti")
        written = Observation(f"insert-{batch_id}")
        _write_batch(first.observe(written, F.count(F.lit(1)).alias("n")), store, batch_id)
        inserted = int(written.get["n"])  # rows of this batch's folder, counted during the write
    finally:
        batch.unpersist()
    processed = int(counts["n"])
    elapsed = time.time() - t0
    return {"batch_id": int(batch_id), "processed": processed, "inserted": inserted,
            "duplicates": processed - errors - inserted, "errors": errors,
            "elapsed": float(elapsed), "rate": float(processed / max(elapsed, 1.0)),
            "first_item": counts["first_item"]}


def insert_flushes(spark: SparkSession, batch: DataFrame, store: str, batch_id: int, flush: str, key: str = "url",
                   order: Sequence[str] = (), valid: Column | None = None, quarantine: str | None = None) -> DataFrame:
    """Many logical batches in one folder of the store: what ``insert_if_absent`` makes of the batches that ``flush`` numbers, one
    after the other.  A key's first row is that of its first flush; the store keeps the column.  A stats row per flush, lazily read
    from ``batch`` and the folder just written (``elapsed`` is that of the whole)."""
    t0 = time.time()
    good = F.col(key).isNotNull() & F.coalesce(valid if valid is not None else F.lit(True), F.lit(False))
    ordered = list(order) or [key]
    if quarantine is not None:
        bad = batch.where(~good)
        if not bad.isEmpty():
            _write_batch(bad, quarantine, batch_id)
    first = keep_first(batch.where(good), [key], [flush, *ordered])
    if _store_exists(spark, store):
        stored = spark.read.schema(T.StructType([batch.schema[key], T.StructField("batch_id", T.LongType())])).parquet(store)
        first = first.join(stored.where(F.col("batch_id") < batch_id).select(key), key, "left_anti")
    _write_batch(first, store, batch_id)
    written = spark.read.schema(T.StructType([batch.schema[flush], T.StructField("batch_id", T.LongType())])).parquet(store)
    inserted = written.where(F.col("batch_id") == batch_id).groupBy(flush).agg(F.count(F.lit(1)).alias("inserted"))
    counts = batch.groupBy(flush).agg(F.count(F.lit(1)).alias("processed"), F.sum(F.when(good, 0).otherwise(1)).cast("long").alias("errors"),
                                      F.min(ordered[0]).alias("first_item"))
    elapsed = time.time() - t0
    both = counts.join(inserted, flush, "left").fillna(0, ["inserted"])
    return both.select(F.lit(batch_id).cast("long").alias("batch_id"), flush, "processed", "inserted",
                       (F.col("processed") - F.col("errors") - F.col("inserted")).alias("duplicates"), "errors", F.lit(float(elapsed)).alias("elapsed"),
                       (F.col("processed") / F.lit(max(elapsed, 1.0))).alias("rate"), "first_item")


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """The batch's own folder, as many files as Spark makes of its size (one, for a small batch)."""
    df.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def insert_all_batches(items: DataFrame, key: str, batch_col: str, order: Sequence[str]) -> DataFrame:
    """K2 over a whole sequence of batches at once: first write wins, so the store
    is the first row per key by (batch, order).  One partial aggregate."""
    return keep_first(items.where(F.col(key).isNotNull()), [key], [batch_col, *order])


def batch_stats(items: DataFrame, stored: DataFrame, key: str, batch_col: str) -> DataFrame:
    """A3 per batch: processed, inserted, duplicates = processed - errors - inserted, errors."""
    per_batch = items.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("processed"),
        F.sum(F.when(F.col(key).isNull(), 1).otherwise(0)).cast("long").alias("errors"))
    ins = stored.groupBy(batch_col).agg(F.count(F.lit(1)).alias("inserted"))
    joined = per_batch.join(ins, batch_col, "left").fillna(0, ["inserted"])
    return joined.select(batch_col, "processed", "inserted",
                         (F.col("processed") - F.col("errors") - F.col("inserted")).alias("duplicates"), "errors")


def compact_store(spark: SparkSession, store: str, upto: int, key: str = "url") -> int:
    """Bring the folders of the batches up to ``upto`` together in that one's; returns the number of files taken in.

    For batches that the stream has committed: a replay of an earlier one would no longer find what was stored before it.  The merged
    files are written beside the old ones, which are deleted after that, so nothing is ever missing; if that breaks off, rows stand
    twice until the next compaction, which keeps one of each key.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(store)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("batch_id=")]
    folders = [p for p in folders if int(p.getName().split("=")[1]) <= upto]
    old = [f.getPath() for p in folders for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    if len(old) > 1:
        rows = spark.read.option("basePath", store).parquet(*[p.toString() for p in old])
        merged = keep_first(rows, [key], ["batch_id"]).drop("batch_id")
        merged.hint("rebalance").write.mode("append").parquet(f"{store}/batch_id={upto}")
        for path in old:
            fs.delete(path, False)
        for path in folders:
            if path.getName() != f"batch_id={upto}":
                fs.delete(path, True)
    return len(old)
