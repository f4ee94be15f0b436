"""Helpers shared by the corpus operators: bounded Arrow chunks, hashing, label joins."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.session import ship_package

CHUNK_BYTES = 2 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def release_memory() -> None:
    """Gives freed memory back to the system at the end of a task: Python workers are used again, and what one task
    has freed would else stay with the worker while other tasks, or the executor's JVM, need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Texts that are written inside go to Python at most ``rows`` at a time: a batch is held whole by the executor's JVM and by
    the worker, and 10,000 texts (Spark's default) are more than all a chunk needs.  A smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches with at most ``max_bytes`` of ``column`` each (a longer
    single text is a slice of its own), so that a task's memory follows neither the
    number of rows in an Arrow batch nor the table."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_text(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str,
             column: str = "text", setup: Callable[[], object] | None = None,
             max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``mapInArrow`` over bounded chunks: ``fn(chunk[, state])`` gives the output columns, in the
    order of ``schema``.  ``setup`` runs once per task and its value is passed on."""
    ship_package(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    types = [arrow.field(i).type for i in range(len(arrow))]
    names = arrow.names

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for chunk in text_chunks(batches, column, max_bytes):
            cols = fn(chunk, state) if setup else fn(chunk)
            arrays = [x.cast(t) if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=t)
                      for x, t in zip((cols[n] for n in names), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()        # what a grouped function has left behind in this worker
        yield from chunks(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def keep_where(docs: DataFrame, mask: Callable[[pa.RecordBatch], np.ndarray], column: str = "text",
               max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, for which ``mask(chunk)`` is true; no join and no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, column, max_bytes):
            yield chunk.filter(pa.array(mask(chunk), type=pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def bounded_sample(rows: DataFrame, k: int, *columns: str) -> DataFrame:
    """The ``k`` rows with the smallest hash of ``columns``, whatever the size of ``rows``.

    A top-k alone would send up to ``k`` rows from every task to one place, so rows are first filtered to about
    ``4 k`` by the same hash; if that should leave fewer than ``k``, all rows compete."""
    h = F.pmod(F.xxhash64(*columns), F.lit(1 << 40))
    n = rows.count()
    if n > 4 * k:
        some = rows.where(h < F.lit(int((1 << 40) * (4 * k / n))))
        if some.limit(k).count() == k:
            rows = some
    return rows.orderBy(h, *columns).limit(k)


def within(frame: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint for a stored frame of narrow rows, behind a check of its size; the other way is a shuffle join."""
    return F.broadcast(frame) if frame.count() <= max_rows else frame


def byte_texts(chunk: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    arr = chunk.column(column)
    binary = pa.large_binary() if pa.types.is_large_string(arr.type) else pa.binary()
    return [x or b"" for x in arr.cast(binary).to_pylist()]


def crc_mod4(column) -> F.col:
    """crc32 of the id as text, modulo 4 (the fold rule of the labelled rows)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4
