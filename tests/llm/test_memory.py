import subprocess
import sys

import pyarrow as pa

import viewtide

# The memory that a Python worker could give back after an encoding task.
TASK = """
import ctypes, random, re, sys
sys.path.insert(0, sys.argv[1])
import pyarrow as pa
from viewtide.llm import token_files

def held():
    return int(re.search(r"Anonymous: +([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

rnd = random.Random(1)
def batch(k):
    texts = [" ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(100)).encode() for _ in range(1000)]
    return pa.RecordBatch.from_arrays([pa.array([0] * 1000, pa.int32()), pa.array(range(k, k + 1000), pa.int64()), pa.array(texts)],
                                      names=["part", "doc_id", "text"])
n = sum(b.num_rows for b in token_files._encode(None, 2)(batch(1000 * k) for k in range(4)))
before = held()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(n, before - held())
"""


def test_encoding_gives_freed_memory_back():
    root = viewtide.__path__[0].rpartition("/")[0]
    out = subprocess.run([sys.executable, "-c", TASK, root], capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) == 4000
    assert float(out[1]) < 8


def test_few_bytes_go_to_a_worker(spark):
    from viewtide.llm.packed import BATCH_BYTES, few_bytes
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    rows = spark.range(0, 6000, 1, 1).selectExpr("repeat(cast(id as string), 1000) text").mapInArrow(size, "n long, bytes long")
    with few_bytes(spark):
        got = rows.collect()
    assert spark.conf.get(key) == before
    assert sum(r.n for r in got) == 6000
    assert len(got) > 1 and max(r.bytes for r in got) < 2 * BATCH_BYTES
