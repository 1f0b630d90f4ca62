"""Session construction and the shared work folder.

Cluster jobs get their session from the platform; ``local_session`` is for
tests, the bench and the driver smoke check.  Anything that must outlive a
task (streaming checkpoints, staged tables, lineage cuts) goes under
``work_dir(spark)``, which is the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is created only for a local
master; on a cluster without that setting the library stops with an error,
because a local folder would be a different disk on every node.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}


def local_session(cpus: int | str = "*", app: str = "shelfmatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.driver.memory"] = os.environ.get("SHELFMATCH_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Settings the library relies on; applied to whatever session we are handed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    work_dir(spark)
    ship_package(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfmatch`` importable in the Python workers (Arrow UDFs, mapInPandas).

    The package's sources are zipped once per Spark context and added with
    ``addPyFile``, which is how executors on a cluster receive it too.
    """
    import zipfile

    import shelfmatch

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(shelfmatch.__file__)))
    fd, path = tempfile.mkstemp(prefix="shelfmatch-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(os.path.join(root, "shelfmatch")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def work_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (created locally only when unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shelfmatch-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what is lost later is not computed anew."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
