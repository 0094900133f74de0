"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorledger.session import shared_folder, tune

#: Most rows of one Arrow batch, so that batches of long texts stay small.
BATCH_ROWS = 1000
#: A slice of a batch is closed once its texts hold so many bytes.
SLICE_BYTES = 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the text operators rely on; safe to apply again."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Folders written by :func:`stored` while :func:`noting` is open.
_noted: list[list[str]] = []


@contextmanager
def noting() -> Iterator[list[str]]:
    """Collect the folders that are written meanwhile, for :func:`release`."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; cuts lineage and survives lost executors.

    With ``by``, a folder for each value of that last column, so that a filter on it reads no more.
    """
    path = shared_folder(df.sparkSession, name)
    for folders in _noted:
        folders.append(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, folders: list[str]) -> None:
    """Delete stored tables; for a caller that knows that every result built on them has been written."""
    context = spark.sparkContext
    for path in folders:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    folders.clear()


def id_remainder(parts: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(parts))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut and join batches so that a slice ends with the row that brings it to ``most`` bytes of text."""
    held: list[pa.RecordBatch] = []
    kept: list[bytes | None] = []
    size = 0
    for batch in batches:
        texts = texts_of(batch, column)
        first = 0
        for at, text in enumerate(texts):
            size += len(text) if text else 0
            if size >= most:
                yield pa.concat_batches([*held, batch.slice(first, at + 1 - first)]), kept + texts[first : at + 1]
                held, kept, size, first = [], [], 0, at + 1
        if first < len(texts):
            held.append(batch.slice(first))
            kept += texts[first:]
    if held:
        yield pa.concat_batches(held), kept


def give_back() -> None:
    """Return the freed memory of this worker to the machine; an idle worker would keep the peak of its tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc alone
        trim(0)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``row_id`` that is unique per row.

    The numbers are written once and read back, so they never change when a task runs again.
    """
    return stored(df.withColumn("row_id", F.monotonically_increasing_id()), name)


def attached(docs: DataFrame, made: Column, name: str = "q") -> DataFrame:
    """``docs`` with the column ``name``, last; like ``withColumn``, it takes the place of one so named (in any case)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()]
    return docs.select(*others, made.alias(name))
