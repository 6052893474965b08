"""Corpora as blocks of numbered words, and counts of their keys by parts.

A block is one row: consecutive documents of one input task, about BLOCK_TOKENS tokens, written as numbers of
the block's own dictionary. Blocks send their distinct keys with counts, one packed row for each part
(keys are dealt over parts by hash). The task of a part merges what all blocks sent and answers each
block that sent a key it needs. A key comes at most once from a block, however frequent it is, so no
part is hot; a part gets about PART_KEYS keys at any input size, because the number of parts follows the input.
"""

from __future__ import annotations

import contextlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK_TOKENS = 1 << 19
PART_KEYS = 1 << 20
BATCH_BYTES = 8 << 20
_ZSTD, _UNZSTD = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def block_id(seq: int) -> int:
    """A number that a repeated task gives again."""
    return TaskContext.get().partitionId() << 32 | seq


@contextlib.contextmanager
def few_bytes(spark: SparkSession):
    """While it lasts, at most BATCH_BYTES go to a Python worker at a time."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(BATCH_BYTES, int(before.rstrip("bB")) if before.rstrip("bB").isdigit() else BATCH_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder (packed arrays, so with a dense codec) and read back.

    Rows are megabytes here, so while it runs few of them go to a Python worker at a time."""
    path = scratch_path(spark, name)
    with few_bytes(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(blocks: DataFrame) -> tuple[int, int]:
    """The number of parts for the tokens of all blocks, and the number of blocks."""
    total, n = blocks.agg(F.sum("n_tokens"), F.count("*")).first()
    return max(1, -(-int(total or 0) // PART_KEYS)), n


def spread(spark: SparkSession, df: DataFrame, by: str, parts: int) -> DataFrame:
    """``df`` dealt by a key of packed rows. The number of tasks is set here: packed rows are small on disk and large in a
    task, so tasks must not be merged by their bytes."""
    return df.repartition(max(1, min(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))), by)


def mixed(code: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit code."""
    x = code.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(parts)).astype(np.int64)


def mixed_words(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % parts


def dealt(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings equal parts together, the parts that occur, and the bounds of each."""
    order = np.argsort(part, kind="stable")
    own, first = np.unique(part[order], return_index=True)
    return order, own, np.append(first, len(part)).astype(np.int64)


def cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive slices of an array as binary values."""
    raw = pa.py_buffer(np.ascontiguousarray(values))
    at = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), raw])


def joined(column, dtype) -> np.ndarray:
    """All binary values of an Arrow column as one array."""
    return np.frombuffer(b"".join(v for v in column.to_pylist() if v is not None), dtype)


def squeezed(values: np.ndarray, rising: bool = False) -> bytes:
    """An array in few bytes: differences of ``rising`` values, then its bytes by significance (the high ones are mostly
    zero), compressed."""
    v = np.diff(values, prepend=values.dtype.type(0)) if rising else values
    planes = np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T
    return _ZSTD.compress(np.ascontiguousarray(planes).tobytes())


def expanded(raw: bytes, dtype, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(_UNZSTD.decompress(raw), np.uint8)
    v = np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()
    return np.cumsum(v, dtype=dtype) if rising else v


def cut_squeezed(values: np.ndarray, bounds: np.ndarray, rising: bool = False) -> pa.Array:
    """Consecutive slices of an array, each squeezed."""
    return pa.array([squeezed(values[a:b], rising) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())


def expanded_all(column, dtype, rising: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All squeezed values of an Arrow column as one array, and the bounds of each."""
    parts = [expanded(v, dtype, rising) for v in column.to_pylist() if v is not None]
    return np.concatenate([np.zeros(0, dtype), *parts]), np.cumsum([0, *map(len, parts)])


def lengths(column, itemsize: int) -> np.ndarray:
    return np.array([len(v) // itemsize for v in column.to_pylist()], np.int64)


def binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def rows(schema: pa.Schema, **columns) -> pa.Table:
    """A table of ``schema``; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
