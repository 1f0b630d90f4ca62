"""Streaming load (ST1-ST5): micro-batches into the first-write-wins store.

``stream_insert_if_absent`` runs ``insert_if_absent`` in ``foreachBatch``
with the micro-batch id as the store partition; Structured Streaming's
checkpoint (in the shared folder) records progress, and the idempotent
batch write makes a replayed batch harmless.  A micro-batch of n items is one
staged file of at most n items (or n offsets of a log); the timeout is the
processing-time trigger; draining at shutdown is ``availableNow``.

A backlog of many small micro-batches need not cost a trigger each: staged with ``flush``, the items carry the number of
their micro-batch, a file holds many of them, and ``stream_insert_if_absent`` with that column loads a trigger's
micro-batches together, with the store, the order and a stats row of each as if they had come one by one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shelfmatch.operators.ingest import STATS_SCHEMA, insert_flushes, insert_if_absent


@dataclass(frozen=True)
class BatchProfile:
    """ST1: flush at ``size`` items or ``timeout_s`` seconds."""
    size: int
    timeout_s: int

    def source_options(self, source: str = "files") -> dict:
        if source == "kafka":
            return {"maxOffsetsPerTrigger": str(self.size)}
        return {"maxFilesPerTrigger": "1"}  # files staged with ``staging_options`` hold at most ``size`` items

    def staging_options(self) -> dict:
        return {"maxRecordsPerFile": str(self.size)}

    def trigger(self) -> dict:
        return {"processingTime": f"{self.timeout_s} seconds"}


# --- fixed values: the reference's batch profiles (size, timeout) -------------
PROFILES = {
    "base": BatchProfile(100, 5),
    "default": BatchProfile(50, 5),
    "fast": BatchProfile(200, 2),
    "safe": BatchProfile(50, 10),
}


def stream_insert_if_absent(stream: DataFrame, store: str, stats: str, checkpoint: str, key: str = "url",
                            order: Sequence[str] = (), valid: Column | None = None,
                            quarantine: str | None = None, drain: bool = True,
                            profile: BatchProfile = PROFILES["default"], flush: str | None = None) -> StreamingQuery:
    """ST2 + ST4 + ST5 (+ ST3 when ``drain``): start the load; returns the query.  ``flush``: the column that tells the micro-batches
    of one trigger apart, in order."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if flush:
            rows = insert_flushes(spark, batch, store, batch_id, flush, key=key, order=order, valid=valid, quarantine=quarantine)
            rows = rows.withColumn("first_item", F.col("first_item").cast("string")).drop("batch_id")
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{stats}/batch_id={batch_id}")
            return
        row = insert_if_absent(spark, batch, store, batch_id, key=key, order=order, valid=valid, quarantine=quarantine)
        day = row.pop("first_item")
        stats_df = spark.createDataFrame([row], STATS_SCHEMA).withColumn(
            "first_item", F.lit(str(day) if day is not None else None))
        stats_df.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{stats}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(**profile.trigger())
    return writer.start()


def stage_batches(items: DataFrame, batch_col: str, path: str, order: Sequence[str] = (), profile: BatchProfile | None = None,
                  flush: str | None = None) -> None:
    """Stage a table as a file stream in one job: a folder per batch value (then a column of the stream), with one file
    per value, or files of at most ``profile.size`` items in ``order``.  With ``flush`` the files are one per value again, and
    the items have a column of that name: the number of their micro-batch, of at most ``profile.size`` items, in the file.

    A file stream takes files by age, and the job writes them in any order, so their times are set by name at the end
    (a metadata call per file, as many as the stream lists).
    """
    options = profile.staging_options() if profile and not flush else {}
    if flush:
        place = F.row_number().over(Window.partitionBy(batch_col).orderBy(*(order or [batch_col])))
        items = items.withColumn(flush, F.floor((place - 1) / profile.size))
    dealt = items.repartition(batch_col).sortWithinPartitions(batch_col, *order)
    dealt.write.mode("overwrite").options(**options).partitionBy(batch_col).parquet(path)
    sc = items.sparkSession.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    files, found = [], fs.listFiles(root, True)
    while found.hasNext():
        file = found.next()
        if file.getPath().getName().startswith("part-"):
            files.append((file.getPath().toString(), file))
    newest = max((f.getModificationTime() for _, f in files), default=0)
    for k, (_, file) in enumerate(sorted(files, key=lambda f: _file_order(f[0]))):
        fs.setTimes(file.getPath(), newest - 1000 * (len(files) - k), -1)


def _file_order(path: str) -> tuple:
    """The order of staged files: by folder and task, then by the file's number there (three digits or more, so not by text)."""
    number = re.search(r"[.-]c(\d+)\.[^/]*$", path)
    return (path[:number.start()], int(number[1])) if number else (path, 0)


def staged_stream(spark: SparkSession, path: str, schema, profile: BatchProfile) -> DataFrame:
    """The staged files as a stream, one file per micro-batch."""
    return spark.readStream.schema(schema).options(**profile.source_options()).parquet(path)


class LoadProgress(StreamingQueryListener):
    """ST4 running totals from the engine's own progress events: rows read,
    batches done and the input rate, per query id (driver-side, O(queries))."""

    def __init__(self):
        super().__init__()
        self.totals: dict = {}

    def onQueryStarted(self, event):
        self.totals[str(event.id)] = {"batches": 0, "rows": 0, "rate": 0.0}

    def onQueryProgress(self, event):
        p = event.progress
        t = self.totals.setdefault(str(p.id), {"batches": 0, "rows": 0, "rate": 0.0})
        t["batches"] += 1
        t["rows"] += int(p.numInputRows or 0)
        t["rate"] = float(p.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
