"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.session import ensure_session_defaults, scratch_path

#: Rows per Arrow batch.  Texts differ in length by orders of magnitude, so batches are kept small in rows.
BATCH_ROWS = 1000

#: ASCII upper case to lower case, every other ASCII byte that is no digit or letter to a space.
_WORD_BYTES = bytes(ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on."""
    ensure_session_defaults(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(names) -> list[Column]:
    """Columns by name, also where a name holds dots or backticks."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_row(function: Callable, schema: str, *columns: Column) -> Column:
    """An Arrow function of some columns that returns one struct per row; all other columns stay in the JVM.

    ``function`` gets one Python list per column and returns an iterable of tuples in the order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def run(*arrays: pa.Array) -> pa.Array:
        rows = function(*(a.to_pylist() for a in arrays))
        values = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(v, k) for v, (_, k) in zip(values, kinds, strict=True)], [n for n, _ in kinds])

    run.__annotations__ = {"return": pa.Array} | {"arrays": pa.Array}
    return F.arrow_udf(_arity(run, len(columns)), fields)(*columns)


def _arity(run: Callable, n: int) -> Callable:
    """``run`` with a fixed number of annotated parameters, as Spark wants to see it."""
    if n == 1:
        def one(a: pa.Array) -> pa.Array:
            return run(a)
        return one

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return run(a, b)

    def three(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        return run(a, b, c)
    return two if n == 2 else three


#: The tables that this Python worker holds: those of one operator at a time, as workers are reused.
_RESIDENT: dict = {}


def resident(key: tuple, make: Callable):
    """``make()``, kept in this Python worker until other tables are asked for; the memory of those before is given back."""
    if key not in _RESIDENT:
        if _RESIDENT:
            _RESIDENT.clear()
            _give_back()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def _give_back() -> None:
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has this call
        ctypes.CDLL(None).malloc_trim(0)


def normal_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split() if text else []
