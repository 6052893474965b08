"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Every test item is cut into windows of 13 words; an item with fewer words is one window. Tasks pack the
windows of a block of items (dealt by their ids, about ``BLOCK_CHARS`` of text) into arrays: the words' numbers, the sorted hashes of
the distinct windows, where each stands, and the items that have it. Documents are scanned against ``PASS_BLOCKS`` broadcast
blocks at a time in one pass; a benchmark of more blocks takes more passes, between which the rows are written with the hits so
far, so the driver and the tasks hold a bounded part of any benchmark and every row stays a row. Scanning works on
whole texts: words get their number in a block's vocabulary, runs of known words get rolling hashes, and each
hash hit is verified against the words themselves before it counts. Results are hit words as spans, so that either
documents or spans can be removed.

Defined cases: null or wordless texts have no words and are never contaminated; null or wordless
items are no windows; repeated items count once per item_id, a null one as the empty id; an empty benchmark hits nothing; repeated rows
keep a row each at any size of the benchmark; very long texts and items are read whole (a block is as large as its longest item);
extra columns are ignored (removal functions keep them).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, mixing_constants, ship, written

WINDOW = 13
BLOCK_CHARS = 2 << 20  # a block's arrays are some five times as large
PASS_BLOCKS = 8
# Fixed values of the contract: after lower-casing A-Z, words are runs of 0-9, a-z and non-ASCII.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
WORD_PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

BLOCK = "words array<binary>, codes binary, items array<string>, tables array<struct<n: int, hashes: binary, at: binary, first: binary, item: binary>>"
_TABLE = pa.struct([("n", pa.int32()), ("hashes", pa.binary()), ("at", pa.binary()), ("first", pa.binary()), ("item", pa.binary())])
_BLOCK = pa.schema([("words", pa.list_(pa.binary())), ("codes", pa.binary()), ("items", pa.list_(pa.string())), ("tables", pa.list_(_TABLE))])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType())),  # word spans, flat: start, end, start, end ...
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _split(text: str | None) -> list[bytes]:
    """The contract's words of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


def _rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` codes."""
    mult = mixing_constants(n, seed=13)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        out += (codes[k:len(codes) - n + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(mult[k])
    return out ^ (out >> np.uint64(29))


def pack_windows(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict:
    """The distinct windows of some items as a row of BLOCK."""
    vocab: dict[bytes, int] = {}
    texts = [[vocab.setdefault(w, len(vocab)) for w in _split(text)] for _, text in items]
    codes = np.array([c for t in texts for c in t], np.int32)
    ends = np.cumsum([len(t) for t in texts])
    tables = []
    for n in sorted({min(window, len(t)) for t in texts if t}):
        own = [(k, end - len(t)) for k, (t, end) in enumerate(zip(texts, ends)) if t and min(window, len(t)) == n]
        at = np.concatenate([np.arange(start, start + len(texts[k]) - n + 1) for k, start in own])
        item = np.concatenate([np.full(len(texts[k]) - n + 1, k) for k, _ in own])
        hashes = _rolling(codes, n)[at]
        order = np.argsort(hashes, kind="stable")
        hashes, at, item = hashes[order], at[order], item[order]
        new = np.ones(len(at), bool)  # not the window before it
        for i in range(1, len(at), 1 << 16):
            k = np.arange(i, min(len(at), i + (1 << 16)))
            spread = np.arange(n)
            new[k] = (hashes[k] != hashes[k - 1]) | (codes[at[k, None] + spread] != codes[at[k - 1, None] + spread]).any(axis=1)
        first = np.flatnonzero(new)
        tables.append({"n": n, "hashes": hashes[first].tobytes(), "at": at[first].astype(np.int32).tobytes(),
                       "first": np.append(first, len(at)).astype(np.int32).tobytes(), "item": item.astype(np.int32).tobytes()})
    return {"words": list(vocab), "codes": codes.tobytes(), "items": [i for i, _ in items], "tables": tables}


class WindowTable:
    """The windows of one block of items, unpacked in a worker."""

    def __init__(self, packed: dict):
        self.vocab = {w: k for k, w in enumerate(packed["words"])}
        self.codes, self.items = np.frombuffer(packed["codes"], np.int32), packed["items"]
        self.tables = [(t["n"], np.frombuffer(t["hashes"], np.uint64), *(np.frombuffer(t[c], np.int32) for c in ("at", "first", "item")))
                       for t in packed["tables"]]

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Hit words as merged spans, and the items whose windows occur."""
        get = self.vocab.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        unknown = np.concatenate(([0], np.cumsum(codes < 0)))
        spans, items = [], set()
        for n, hashes, place, first, item in self.tables:
            if len(codes) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(starts):
                continue
            rolled = _rolling(codes, n)[starts]
            at = np.searchsorted(hashes, rolled)
            at[at == len(hashes)] = 0
            same = hashes[at] == rolled
            for s, k, h in zip(starts[same].tolist(), at[same].tolist(), rolled[same].tolist()):
                while k < len(hashes) and hashes[k] == h:
                    if (self.codes[place[k]:place[k] + n] == codes[s:s + n]).all():  # the words themselves are equal
                        spans.append((s, s + n))
                        items.update(self.items[i] for i in item[first[k]:first[k + 1]].tolist())
                    k += 1
        return merged(spans), items


def merged(spans) -> list[int]:
    out: list[int] = []
    for s, e in sorted(spans):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def item_blocks(spark: SparkSession, bench: DataFrame, block_chars: int = BLOCK_CHARS, window: int = WINDOW) -> DataFrame:
    """One row (BLOCK) per block of items, with its number; packed in tasks."""
    ship(spark)
    rows = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text is not null")
    n = max(1, -(-int(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        items = sorted(zip(table["item_id"].to_pylist(), table["text"].to_pylist()))  # the same at every try
        packed = pack_windows(items, window)
        return pa.table([table["block"][:1], *(pa.array([packed[f.name]], f.type) for f in _BLOCK)], names=["block", *_BLOCK.names])

    return written(spark, rows.groupBy("block").applyInArrow(pack, f"block int, {BLOCK}"), "benchmark-blocks")


def _scan(tables: Broadcast):
    """Adds to each row's hits those of some blocks. Rows come with n_words null in the first pass."""
    def scan(batches):
        windows = [WindowTable(t) for t in tables.value]
        for b in batches:
            n, hits, items = [], [], []
            for text, old, had in zip(*(b.column(c).to_pylist() for c in ("__text", "hits", "items"))):
                words = _split(text)
                spans, found = list(zip(old[::2], old[1::2])), set(had)
                for w in windows:
                    more, which = w.scan(words)
                    spans += zip(more[::2], more[1::2])
                    found |= which
                n.append(len(words))
                hits.append(merged(spans))
                items.append(sorted(found))
            new = {"n_words": pa.array(n, pa.int64()), "hits": pa.array(hits, pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(i)) for i, c in enumerate(b.schema.names)], names=b.schema.names)
            del b, new, n, hits, items
            give_back()
    return scan


def scan_documents(spark: SparkSession, docs: DataFrame, bench: DataFrame, block_chars: int = BLOCK_CHARS,
                   window: int = WINDOW, carry: str = "__row") -> DataFrame:
    """Every row of ``docs`` as a struct ``carry``, with n_words, hits (word spans) and items over all blocks."""
    ship(spark)
    blocks = item_blocks(spark, bench, block_chars, window)
    numbers = sorted(r.block for r in blocks.select("block").collect())  # one number a block
    none = [F.lit(None).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(carry), F.col("text").cast("string").alias("__text"), *none)
    passes = [numbers[i:i + PASS_BLOCKS] for i in range(0, len(numbers), PASS_BLOCKS)] or [[]]
    for k, some in enumerate(passes):
        if k:
            rows = written(spark, rows, "benchmark-pass")  # the blocks of the pass before are no longer needed
        packed = [r.asDict(recursive=True) for r in blocks.where(F.col("block").isin(some)).drop("block").collect()] if some else []
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(packed)), rows.schema)
    return rows.drop("__text")


def _n_hit() -> Column:
    """Words inside the hit spans."""
    n = F.aggregate(F.sequence(F.lit(0), F.size("hits") - 1), F.lit(0).cast("long"),
                    lambda acc, i: acc + F.when(i % 2 == 1, F.get("hits", i)).otherwise(-F.get("hits", i)))
    return F.when(F.size("hits") > 0, n).otherwise(F.lit(0)).cast("long")


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination(spark: SparkSession, docs: DataFrame, bench: DataFrame, **how) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and
    20 * n_hit >= n_words), hits (word spans)."""
    scan = scan_documents(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                          bench, **how).select("__row.doc_id", "n_words", "hits", "items").withColumn("n_hit", _n_hit())
    return scan.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                       _contaminated().alias("contaminated"), "hits")


def without_hits(text: str | None, hits: list[int]) -> str | None:
    """The text without the words of the given spans (and what stands between them)."""
    if text is None or not len(hits):
        return text
    at = [m.span() for m in WORD_PATTERN.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
    out, last = [], 0
    for i in range(0, len(hits), 2):
        out.append(text[last:at[hits[i]][0]])
        last = at[hits[i + 1] - 1][1]
    return "".join(out) + text[last:]


def remove_contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame, mode: str = "documents",
                        **how) -> DataFrame:
    """``docs`` without its contaminated documents, or (mode 'spans') without the hit words of any
    document. All columns stay; one pass over the rows for PASS_BLOCKS blocks of the benchmark, without a join."""
    scan = scan_documents(spark, docs, bench, **how)
    names = [f"__row.`{c}`" for c in docs.columns]
    if mode == "documents":
        return scan.withColumn("n_hit", _n_hit()).where(~_contaminated()).select(*names)

    def scrub(batches):
        for b in batches:
            row = b.column(0)
            old = row.field("text")
            texts = [without_hits(t, h) for t, h in zip(old.to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, f.type) if f.name == "text" else row.field(i) for i, f in enumerate(row.type)],
                                             names=[f.name for f in row.type])

    return scan.select("__row", "hits").mapInArrow(scrub, docs.schema)
