"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.plans.persist import materialize

__all__ = ["SPACES", "materialize", "packed", "partition_id", "read_table", "releasing", "text_bytes", "tokenizer_path", "unpacked"]

#: Fixed value: the white space that the contracts name, as a character class.
SPACES = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the public tokenizers, by the installed package or the TOKENIZERS_DIR folder."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def partition_id() -> int:
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


def releasing(run):
    """``run``, a function from batches to batches, that gives freed memory back to the system when it ends.

    Python workers go on to other stages; what the allocators keep of finished work would add up beside them.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def packed(rows: DataFrame, column: str = "text") -> DataFrame:
    """``rows`` with a binary column compressed, for a shuffle; :func:`unpacked` undoes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, column, pa.array([pack(t.as_py()) for t in batch.column(at)], pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def unpacked(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)
