import __spark_entry__ as entry
from pyspark.sql import functions as F

from shelfmatch.operators.ingest import insert_all_batches
from shelfmatch.plans import catalog
from shelfmatch.plans.tables import table
from shelfmatch.streaming.ingest import PROFILES, BatchProfile, LoadProgress, stage_batches, staged_stream, stream_insert_if_absent
from shelfmatch.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns[:2] == ["_id1", "_id2"]


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 30


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    items = table(spark, SF, "events").withColumn("batch_day", F.to_date("ts"))
    base = scratch_path(spark, "test-stream")
    stage_batches(items, "batch_day", f"{base}/in")
    stream = staged_stream(spark, f"{base}/in", items.schema, PROFILES["default"])
    args = dict(key="user_id", order=["batch_day", "ts", "event_id"])
    listener = LoadProgress()
    spark.streams.addListener(listener)
    q = stream_insert_if_absent(stream, f"{base}/store", f"{base}/stats", f"{base}/ck", **args)
    q.awaitTermination()
    spark.streams.removeListener(listener)
    got = {r["user_id"]: r["event_id"] for r in spark.read.parquet(f"{base}/store").collect()}
    want = {r["user_id"]: r["event_id"] for r in insert_all_batches(items, "user_id", "batch_day", ["ts", "event_id"]).collect()}
    assert got == want
    assert listener.totals[str(q.id)]["rows"] == items.count()
    n_stats = spark.read.parquet(f"{base}/stats").count()
    # restart from the checkpoint: nothing new to read, nothing inserted
    stream2 = staged_stream(spark, f"{base}/in", items.schema, PROFILES["default"])
    stream_insert_if_absent(stream2, f"{base}/store", f"{base}/stats", f"{base}/ck", **args).awaitTermination()
    assert spark.read.parquet(f"{base}/store").count() == len(want)
    assert spark.read.parquet(f"{base}/stats").count() == n_stats


def test_a_micro_batch_holds_as_many_items_as_the_profile_says(spark):
    items = table(spark, SF, "events").withColumn("batch_day", F.to_date("ts"))
    base = scratch_path(spark, "test-stage")
    profile = BatchProfile(7, 1)
    stage_batches(items.where("event_id < 60"), "batch_day", base, ["event_id"], profile)
    sizes = [r["n"] for r in spark.read.parquet(base).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 7 and sum(sizes) == 60
    assert profile.source_options() == {"maxFilesPerTrigger": "1"} and profile.source_options("kafka") == {"maxOffsetsPerTrigger": "7"}


def test_every_query_runs_on_the_smallest_tables(spark):
    skip = {"stream_insert_if_absent", "stream_stats", "stream_quarantine"}  # covered above
    for name, fn in catalog.queries().items():
        if name in skip:
            continue
        df = fn(spark, SF)
        df.limit(1).collect()
