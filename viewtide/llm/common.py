"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import time
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Fixed values of the contracts: white space and its complement, as Java/RE2/Python character classes.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# A side is broadcast only below this many bytes (checked, not assumed); beyond it the plain shuffle join runs.
BROADCAST_BYTES = 64 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors as a Python file (once per application), so that tasks can
    import it wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_viewtide_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.join(root, "viewtide")
    target = os.path.join(tempfile.mkdtemp(prefix="viewtide-ship-"), "viewtide-py.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(target)
    sc._viewtide_shipped = True


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, and a lost
    executor costs a re-read, not a recomputation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    schema = df.schema
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


RELEASE_SECONDS = 10.0
_last_release = [0.0]


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and broadcasts of finished work. It does so when the driver's JVM collects
    garbage, which a driver with little to do puts off until the executors' disks are full."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None and time.monotonic() - _last_release[0] > RELEASE_SECONDS:
        gc.collect()  # Python's handles keep plans alive
        jvm.System.gc()
        _last_release[0] = time.monotonic()


def give_back() -> None:
    """Return what this Python worker has freed to the system. Workers live on between tasks and stages, and the C library
    and Arrow keep freed memory, which is twice what the worker still holds."""
    import pyarrow
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def small_enough(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    """True if a side of ``rows`` rows may be broadcast."""
    return rows * row_bytes <= BROADCAST_BYTES


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes after lower-casing A-Z only."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()


@functools.lru_cache(maxsize=None)
def mixing_constants(n: int, seed: int = 1) -> tuple[int, ...]:
    """``n`` odd 64-bit multipliers from the splitmix64 rule."""
    out, state, mask = [], seed, (1 << 64) - 1
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append((z ^ (z >> 31)) | 1)
    return tuple(out)
