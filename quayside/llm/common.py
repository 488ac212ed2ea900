"""Small helpers shared by the operators: staged tables and Arrow batches.

A staged table is Parquet written to the folder all executors share
(``spark.checkpoint.dir``) and read back. It cuts lineage, survives the loss
of an executor, and gives the next join inputs without an inherited
partitioning, so adaptive execution may split a hot key.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from quayside.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_column(df: DataFrame, name: str, kind: str) -> StructType:
    """The schema of ``df`` and one more column."""
    return StructType([*df.schema.fields, StructField(name, DataType.fromDDL(kind))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (string or binary) holds about
    ``max_bytes`` in each; a longer single value comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = value_offsets(batch.column(batch.schema.get_field_index(column)))[1:].astype(np.int64)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else ends[0] - ends[0]
            last = max(first + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last


def releasing(batches: Iterator, *caches: dict) -> Iterator:
    """The batches of a Python stage as they are. When the task ends, ``caches``
    are emptied and freed memory goes back to the system: Spark keeps the
    worker for later stages, whose own memory would come on top."""
    try:
        yield from batches
    finally:
        for cache in caches:
            cache.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)


def value_offsets(array: pa.Array) -> np.ndarray:
    """Offsets of a string or binary array, from 0 (nulls have no bytes)."""
    return text_buffer(array)[1]


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary array end to end as uint8, and the
    len + 1 offsets of its values in it. A null is an empty value."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if data is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))
