"""Helpers that the operators share: tables that cut lineage, and batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.streaming.jobs import work_folder

SLICE_BYTES = 2_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, wherever the driver was started."""
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).parents[1]
        archive = f"{tempfile.mkdtemp()}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in package.rglob("*.py"):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(spark.sparkContext.applicationId)


def return_freed_memory() -> None:
    """Give what this worker has freed back to the system (glibc; elsewhere only Arrow's part); else each worker of an executor keeps it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    pa.default_memory_pool().release_unused()


_held: dict[tuple, object] = {}


def held(owner: str, key, make):
    """What `make` gives, kept in this Python worker for one operator at a time: another's is dropped, as workers outlive stages."""
    if (owner, key) not in _held:
        if _held:
            _held.clear()
            gc.collect()
            return_freed_memory()
        _held[owner, key] = make()
    return _held[owner, key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: nothing before it is ever computed again."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, key: str, count: int, most: int = 20_000) -> DataFrame:
    """One task for each of `count` small rows that stand for much work (up to `most`): by their size alone they would share a few."""
    return rows.repartition(max(1, min(count, most)), key)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty; columns of any other name are left behind."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most `most` bytes of text; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows in them; nulls are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0] if len(column) else np.zeros(1, np.int64)
