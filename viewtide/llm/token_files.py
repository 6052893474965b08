"""Token ids in ORC files, in ascending document order.

Documents are range-partitioned and sorted by id first (raw text moves once), then encoded in
Arrow batches and written by Spark's ORC writer: token ids are an integer column, which ORC stores in
run-length encoding, rows carry a row index per stride, and doc_id has a Bloom filter, so a reader
prunes stripes and strides by id. Each file holds one id range, so files and stripes are read in
parallel. Starts are running totals over file totals and then inside each file.

Encoding: white space splits words before the tokenizer does, so each distinct word of a batch is looked up in a worker's table
of packed arrays (128-bit word digests, ids as 16 bits where the vocabulary fits), words new to it are encoded, and a text's ids
are gathered from there. The table is bounded and serves all tasks of its worker, which gives back freed memory after each Arrow
batch; batches to and from Python are bounded in bytes. A round-trip test compares this with encoding the whole text.

Defined cases: null and empty texts are the end id alone; rows repeating a doc_id are separate
documents, in the order of their texts; a null doc_id sorts first; very long texts are encoded whole; extra columns are
ignored; an empty table writes no rows and gives none.
"""

from __future__ import annotations

import itertools
import json
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import LOWER_AZ, give_back, ship
from .packed import few_bytes, stored

END_ID = 2
MAX_WORDS = 1_000_000  # words in a worker's table (some 35 MB); beyond, the half used last stays
TOKEN_SCHEMA = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                             T.StructField("seq", T.LongType()),  # position in its file's id range
                             T.StructField("n_tokens", T.LongType()),
                             T.StructField("ids", T.ArrayType(T.IntegerType()))])
DIGEST_SCHEMA = T.StructType([*TOKEN_SCHEMA.fields[:4], T.StructField("ids_crc32", T.LongType())])
# The byte-level alphabet by its rule: printable Latin-1 bytes stand for themselves, the others for U+0100 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_SELF))) if b != 32}  # blanks stay between words
_ENCODERS: dict[tuple[str, int], "WordEncoder"] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# The normalizers and the pre-tokenizer of a tokenizer that lower-cases, drops white space and marks word ends. Only
# for these do the shortcuts below hold; texts for any other tokenizer are encoded whole.
_SPLITS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "</w>"


def splits_at_white_space(tokenizer) -> bool:
    d = json.loads(tokenizer.to_str())
    norm, pre, model = d.get("normalizer") or {}, d.get("pre_tokenizer") or {}, d["model"]
    found = ([n.get("type") for n in norm.get("normalizers", [])], [n.get("type") for n in pre.get("pretokenizers", [])],
             model.get("end_of_word_suffix"))
    return found == _SPLITS and model["type"] == "BPE" and not model.get("continuing_subword_prefix")


class WordEncoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    The tokenizer lower-cases and drops white space itself, so texts are split at ASCII white space and
    A-Z lower-cased first (unless they spell a special token). A lower-case word of letters only passes its
    normalizer and pre-tokenizer unchanged but for the byte alphabet, so such words go to its model many at a time, and
    come back cut at the tokens that end words; a full stop or comma after such a word is a token sequence of its own; all else
    is encoded in full."""

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.by_word = splits_at_white_space(self.tokenizer)
        if self.by_word:
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self.tokenizer.get_vocab()
            self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
            self.ends_word[[i for w, i in vocab.items() if w.endswith(_SPLITS[2])]] = True
            marks = {m: self._encoded([m])[1] for m in (b".", b",")}
            self.marks = {m: int(ids[0]) for m, ids in marks.items() if len(ids) == 1}
            self.kind = np.uint16 if len(self.ends_word) <= 1 << 16 and end_id < 1 << 16 else np.uint32
            self.low, self.high = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # digests of the words, sorted by their low halves
            self.at, self.size, self.last = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
            self.ids, self.batch = np.zeros(0, self.kind), 0

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of each word in the table, -1 for new ones."""
        if not len(self.low):
            return np.full(len(low), -1)
        near = np.minimum(np.searchsorted(self.low, low), len(self.low) - 1)
        return np.where((self.low[near] == low) & (self.high[near] == high), near, -1)

    def _keep(self, low, high, at, size) -> None:
        """Put new words into the table; when it is full, the half that was used last stays."""
        where = np.searchsorted(self.low, low)
        self.low, self.high = np.insert(self.low, where, low), np.insert(self.high, where, high)
        self.at, self.size = np.insert(self.at, where, at), np.insert(self.size, where, size)
        self.last = np.insert(self.last, where, self.batch)
        if len(self.low) > MAX_WORDS:
            stay = np.sort(np.argsort(-self.last, kind="stable")[:MAX_WORDS // 2])
            self.ids = self._gathered(self.at[stay], self.size[stay])
            self.low, self.high, self.size, self.last = self.low[stay], self.high[stay], self.size[stay], self.last[stay]
            self.at = np.cumsum(self.size, dtype=np.int64) - self.size

    def _gathered(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ids of words, one after the other."""
        return self.ids[np.repeat(at - (np.cumsum(size, dtype=np.int64) - size), size) + np.arange(size.sum())]

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids), by the whole tokenizer."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        return np.array([len(f) for f in found], np.int64), np.array(list(itertools.chain.from_iterable(found)), "<u4")

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters, many in one call of the model."""
        text = b" ".join(words).decode("latin-1")
        text = text if text.isascii() else text.translate(BYTE_ALPHABET)
        ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1), ids

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Append the ids of new words to the table's; (place, number) of each word's ids."""
        groups: list[list[int]] = [[], [], []]  # letters in ASCII, other letters, the rest
        mark = np.zeros(len(words), np.int64)
        for k, w in enumerate(words):
            last = self.marks.get(w[-1:])
            if last is not None and len(w) > 1:
                mark[k], w = last, w[:-1]
            if w.isalpha() and w.islower():
                groups[0].append(k)
            else:
                groups[1 if _plain(w) else 2].append(k)
        mark[groups[2]] = 0
        size, at, parts, filled = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [self.ids], len(self.ids)
        for group, encode, step in zip(groups, (self._letters, self._letters, self._encoded), (5_000, 5_000, 10_000)):
            for i in range(0, len(group), step):
                some = np.array(group[i:i + step])
                n, ids = encode([words[k][:-1] if mark[k] else words[k] for k in some.tolist()])
                marked = mark[some] > 0
                if marked.any():
                    ids = np.insert(ids, np.cumsum(n)[marked], mark[some][marked])
                    n = n + marked
                size[some], at[some] = n, filled + np.cumsum(n) - n
                parts.append(ids.astype(self.kind))
                filled += len(ids)
        self.ids = np.concatenate(parts)
        return at, size

    def encode_flat(self, raw: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all texts); texts come as UTF-8."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([(r or b"").decode("utf-8", "replace") for r in raw], add_special_tokens=False)
            ids = [i for e in found for i in (*e.ids, self.end_id)]
            return np.array([len(e.ids) + 1 for e in found], np.int64), np.array(ids, "<u4")
        words = [_words(r) for r in raw]
        sizes = np.array([len(w) for w in words], np.int64)
        words = list(itertools.chain.from_iterable(words))
        self.batch += 1
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
        low, first, back = np.unique(digest[:, 0], return_index=True, return_inverse=True)
        high = digest[first, 1]
        if (high[back] != digest[:, 1]).any():  # equal halves of different words
            both, first, back = np.unique(digest, axis=0, return_index=True, return_inverse=True)
            (low, high), back = both.T, back.ravel()
        place = self._find(low, high)
        old = place >= 0
        at, size = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        at[old], size[old], self.last[place[old]] = self.at[place[old]], self.size[place[old]], self.batch
        if not old.all():
            at[~old], size[~old] = self._learn([words[k] for k in first[~old].tolist()])
        ends = np.cumsum(sizes)
        n = np.concatenate(([0], np.cumsum(size[back])))[np.concatenate(([0], ends))]  # ids up to the end of each text
        ids = np.insert(self._gathered(at[back], size[back]).astype("<u4"), n[1:], np.uint32(self.end_id))
        self._keep(low[~old], high[~old], at[~old], size[~old])
        return np.diff(n) + 1, ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes."""
        lengths, ids = self.encode_flat([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts])
        return [part.tobytes() for part in np.split(ids, np.cumsum(lengths)[:-1])]


def _plain(word: bytes) -> bool:
    """Lower-case letters only, composed."""
    if word.isascii():
        return word.isalpha() and word.islower()
    text = word.decode("utf-8", "replace")
    return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)


def _words(raw: bytes | None) -> list[bytes]:
    if not raw:
        return []
    return raw.split() if b"<|" in raw else raw.translate(LOWER_AZ).split()


def encoder(path: str, end_id: int = END_ID) -> WordEncoder:
    """One per worker process."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _encode(path: str | None, end_id: int, rows: int = 250):
    def encode(batches):
        give_back()  # what earlier stages of a pipeline have left in this worker
        enc, seq = encoder(path or tokenizer_path(), end_id), 0
        for whole in batches:
            for b in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                lengths, ids = enc.encode_flat(b.column("text").to_pylist())
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("part"), b.column("doc_id"), pa.array(np.arange(seq, seq + b.num_rows)), pa.array(lengths),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view("<i4")))], names=TOKEN_SCHEMA.names)
                seq += b.num_rows
            del whole, b, lengths, ids, offsets
            give_back()
    return encode


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str | None = None,
                      end_id: int = END_ID, partitions: int | None = None) -> None:
    """Encode every text and write ORC files in ascending doc_id order.

    ``tokenizer`` is the path of a tokenizers JSON file (default: the public word BPE of 49k)."""
    ship(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    with few_bytes(spark):
        (rows.mapInArrow(_encode(tokenizer, end_id), TOKEN_SCHEMA)
             .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
             .option("orc.row.index.stride", "1000").option("orc.stripe.size", str(64 << 20))
             .option("compression", "zstd").orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """part, doc_id, seq, n_tokens, ids. Filters on doc_id prune files, stripes and strides."""
    return spark.read.schema(TOKEN_SCHEMA).orc(path)


def _digest(batches):
    for b in batches:
        ids = b.column("ids")
        flat, offsets = ids.values.to_numpy().astype("<i4", copy=False), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[s:e]) for s, e in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column("part"), b.column("doc_id"), b.column("seq"),
             pa.array((offsets[1:] - offsets[:-1]).astype(np.int64)), pa.array(crc, pa.int64())],
            names=DIGEST_SCHEMA.names)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    each = stored(spark, read_token_files(spark, path).mapInArrow(_digest, DIGEST_SCHEMA), "token-digests")
    # one row per file range
    totals = read_token_files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("t_part"),
                           F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("offset"))
    rows = each.join(F.broadcast(totals), each.part == totals.t_part)
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return rows.select("doc_id", (F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
                       "n_tokens", "ids_crc32")


def token_output(spark: SparkSession, docs: DataFrame, path: str | None = None, **how) -> DataFrame:
    """Write the files (to the shared scratch folder unless ``path`` is given) and read the digests back."""
    path = path or scratch_path(spark, "token-files")
    write_token_files(spark, docs, path, **how)
    return token_digests(spark, path)
