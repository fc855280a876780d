"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import scratch_path, ship_package
from quillspark.sources.tables import table

#: Fixed value: the word pattern of the contracts. For bytes, ``bytes.split()`` cuts at
#: exactly these characters, and ``bytes.lower()`` lower-cases exactly A-Z.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but keeps the files compressed and columnar;
    a lost executor loses nothing that a later step needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, which hand memory back after each
    task (Spark reuses them, so what one operator needed would stay beside the next one's)."""
    ship_package(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def rows_of(batch: pa.RecordBatch, *columns: int, step: int = 256) -> Iterator[tuple]:
    """The values of some columns row by row, a few rows at a time as Python objects."""
    for at in range(0, batch.num_rows, step):
        yield from zip(*(batch.column(i).slice(at, step).to_pylist() for i in columns))


def returning_memory(fn):
    """A batch function for ``pandas_udf`` that hands memory back after each batch."""
    @wraps(fn)
    def run(*columns):
        try:
            return fn(*columns)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Return freed memory of this worker to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(name: str = "text"):
    """A text column as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit("").cast("binary"))


def plain_text(data: bytes) -> str:
    """UTF-8 bytes as text; bytes that are not UTF-8 become U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace")


class WordHashes(dict):
    """word (bytes) -> 64-bit xxhash, remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 250_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h
