"""N-gram Jaccard join: size-aware heavy-light join over word shingles, exact for J >= 0.8.

1. Every document becomes its set of 5-word shingles (64-bit hashes). A set is called settled when
   more than a fifth of it occurs in no other document: it can link with nothing. To find out, each
   Arrow batch sends its distinct shingles, packed per hash range in 3 bytes and a share of the list of
   their sets, so a shingle of a third of all documents travels once per batch. Each batch gets counts
   back by the place of the set in it. Equal sets (128-bit digest) are one class from here on.
2. The classes left get exact document frequencies in the same way. A set's shingles are ordered by
   (frequency, hash); of two sets that link, the leading parts share at least c shingles
   (parts of length |A| - ceil(0.8 |A|) + c).
3. Light sets (size up to the boundary) post every 2-subset of their leading part (c = 2). Heavy sets
   post each shingle of theirs (c = 1) to inverted lists, where light sets of comparable size probe. The
   boundary is the size at which 2-subsets plus list scans cost least over the measured frequencies.
4. Lists are not paired up. Each member is first verified against its list leader it shares most
   with; connected members need no further comparison, so a group of thousands of near copies costs
   one verification each. What is left are pairs in one list but in different components; all of
   them that could link by size and by odd sketch (a lower bound of the symmetric difference) are verified, in rounds, until no list joins two components by
   an unverified pair.

Sets are compared as sets of 64-bit hashes; nothing is sampled, capped or dropped.

Defined cases: null, empty and wordless texts have n_shingles 0 and their own id as component; a
text of 1 to 4 words is one shingle; rows repeating a doc_id keep a row each, judged by
their own texts (rows are told apart by a 64-bit hash of id and text; component_id is the smallest doc_id of
the component); rows without a doc_id are in no component: they have a row with component_id null, link nothing, and one_per_group
keeps them; very long texts are sets like others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, lower_words, mixing_constants, ship, small_enough, written
from .components import connected_components
from .packed import block_id, cut, cut_squeezed, expanded_all, joined

WORDS = 5
NUM, DEN = 80, 100  # link: DEN * intersection >= NUM * union
BATCH_DOCS = 1_000  # sets that are packed together
RANGE_KEYS = 1_500_000  # shingles that one hash range holds, about
NEAR = 16  # lists before a list in which a pair is looked for, to emit it once
MAX_WORDS = 300_000  # distinct words a worker remembers


def _fields(*named) -> T.StructType:
    kinds = {"b": T.BinaryType(), "l": T.LongType(), "i": T.IntegerType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in named)])


class Shingler:
    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.mult = [np.uint64(m) for m in mixing_constants(WORDS, seed=5)]

    def sets(self, texts) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        out, known = [], self.known
        for text in texts:
            words = lower_words(text)
            if len(known) > MAX_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            codes = np.array([known[w] for w in words], np.uint64)
            if len(words) >= WORDS:
                n = len(words) - WORDS + 1
                h = codes[:n] * self.mult[0]
                for k in range(1, WORDS):
                    h += codes[k:k + n] * self.mult[k]
                out.append(np.unique(_mixed(h)))
            elif words:  # the whole sequence; its length keeps it apart from longer ones
                out.append(np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=len(words))], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def needed(n):
    """Shingles that a set of n must share with any set it links to, at least."""
    return -(-NUM * n // DEN)


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


@functools.lru_cache(maxsize=4)
def _starts(ranges: int) -> np.ndarray:
    """The first key of each hash range."""
    return np.array([r * (1 << 64) // ranges for r in range(ranges)], np.uint64)


def _pieces(keys: np.ndarray, ranges: int):
    """Sorted keys cut at the hash ranges: (range, slice)."""
    cuts = np.searchsorted(keys, _starts(ranges)[1:])
    bounds = [0, *cuts.tolist(), len(keys)]
    return [(r, slice(bounds[r], bounds[r + 1])) for r in range(ranges) if bounds[r + 1] > bounds[r]]


OFFSET_BYTES = 3


def _offsets(keys: np.ndarray, part: np.ndarray, ranges: int) -> np.ndarray:
    """The leading 24 bits of keys inside their ranges, 3 bytes each: enough to tell RANGE_KEYS of them apart, but
    for a tenth. Where two fall together they count as shared, which only keeps a set open for the next step."""
    inside = (keys - _starts(ranges)[part]) >> np.uint64(33 - ranges.bit_length())
    leading = (inside * np.uint64(ranges)) >> np.uint64(ranges.bit_length() + 7)
    return np.ascontiguousarray(leading.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :OFFSET_BYTES]).view(f"V{OFFSET_BYTES}").ravel()


def _read_offsets(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of all rows, and how many each row has."""
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, OFFSET_BYTES)
    out = np.zeros((len(raw), 4), np.uint8)
    out[:, :OFFSET_BYTES] = raw
    return out.view("<u4").ravel(), np.array([len(x) // OFFSET_BYTES for x in blobs], np.int64)


def _slices(batches, rows: int):
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _tidy(run):
    """A task's function that leaves the worker without the memory it has used."""
    def tidied(batches):
        yield from run(batches)
        give_back()
    return tidied


# --- 1: which sets are settled ---------------------------------------------------------------
# Rows of a hash range, from a batch: keys seen in one of its sets, with the places of their sets; keys seen in several.
# Rows with a negative range carry the facts of the batch's sets, six numbers each.
PACKED = _fields("range:i", "batch:l", "keys:b", "owners:b", "many:b", "facts:b")
FOUND = _fields("batch:l", "owners:b", "counts:b", "facts:b")
SETS = _fields("key:l", "n:l", "d1:l", "d2:l", "shared:l", "doc_id:l")
PLACES = 1 << 16  # more than BATCH_DOCS


def _pack_documents(ranges: int):
    """Documents to hash ranges, a batch at a time."""
    def pack(batches):
        shingler = Shingler()
        for seq, b in enumerate(_slices(batches, BATCH_DOCS)):
            batch = block_id(seq)
            sets = shingler.sets(b.column("text").to_pylist())
            sizes = np.array([len(s) for s in sets], np.int64)
            digests = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            keys, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
            del sets
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            same = np.zeros(len(keys), bool)
            if len(keys) > 1:
                same[1:] = keys[1:] == keys[:-1]
                same[:-1] |= same[1:]
            shared = np.bincount(owner[same], minlength=len(sizes))
            one, one_owner, many = keys[~same], owner[~same], np.unique(keys[same])
            del keys, owner, order, same
            part, many_part = (np.searchsorted(_starts(ranges), k, "right") - 1 for k in (one, many))
            mine = np.argsort(part * PLACES + one_owner, kind="stable")  # in each range, by set
            has = np.union1d(part, many_part)
            at, many_at = (np.append(np.searchsorted(p, has), len(p)) for p in (part, many_part))
            yield _packed_rows(has, batch, cut(_offsets(one[mine], part, ranges), at),
                               cut_squeezed(one_owner[mine], at, rising=True), cut(_offsets(many, many_part, ranges), many_at))
            numbers = [b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "doc_id")]
            facts = np.column_stack([numbers[0], sizes, digests, shared, numbers[1]]).tobytes()
            yield _packed_rows(np.array([-1 - (batch >> 32)]), batch, *[pa.array([b""], pa.binary())] * 3, pa.array([facts], pa.binary()))
    return pack


def _packed_rows(ranges: np.ndarray, batch: int, keys, owners, many, facts=None) -> pa.RecordBatch:
    n = len(ranges)
    return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(np.full(n, batch, np.int64)), keys, owners, many,
                                       pa.nulls(n, pa.binary()) if facts is None else facts], names=PACKED.names)


def _shared_in_range(key, table):
    """Per hash range: how many of each set's shingles occur in another set of the corpus."""
    if key[0].as_py() < 0:
        none = pa.nulls(table.num_rows, pa.binary())
        return pa.table([table["batch"], none, none, table["facts"]], schema=FOUND_ARROW)
    batch = table["batch"].to_numpy()
    keys, each = _read_offsets(table["keys"].to_pylist())
    owner = np.repeat(np.arange(len(batch)) * PLACES, each) + expanded_all(table["owners"], "<u2", rising=True)[0]
    many = np.unique(_read_offsets(table["many"].to_pylist())[0])
    del table
    order = np.argsort(keys)
    ranked = keys[order]
    again = np.zeros(len(keys), bool)
    if len(keys) > 1:
        again[1:] = ranked[1:] == ranked[:-1]
        again[:-1] |= again[1:]
    if len(many) and len(keys):
        at = np.searchsorted(many, ranked)
        at[at == len(many)] = 0
        again |= many[at] == ranked
    found, counts = np.unique(owner[order[again]], return_counts=True)
    del keys, owner, many, order, ranked, again
    give_back()
    rows, first = np.unique(found // PLACES, return_index=True)
    bounds = np.append(first, len(found))
    return pa.table([pa.array(batch[rows]), cut((found % PLACES).astype("<u2"), bounds), cut(counts.astype("<u4"), bounds),
                     pa.nulls(len(rows), pa.binary())], schema=FOUND_ARROW)


FOUND_ARROW = pa.schema([("batch", pa.int64()), ("owners", pa.binary()), ("counts", pa.binary()), ("facts", pa.binary())])
SETS_ARROW = pa.schema([(n, pa.int64()) for n in SETS.names])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sum_shared(table):
    """Per batch: facts of each document row, its counts of all ranges summed up."""
    rows = joined(table["facts"], np.int64).reshape(-1, 6).copy()
    counts = np.bincount(joined(table["owners"], "<u2"), weights=joined(table["counts"], "<u4"), minlength=len(rows))
    rows[:, 4] += counts.astype(np.int64)
    return pa.table([pa.array(rows[:, k]) for k in range(6)], schema=SETS_ARROW)


def _side(spark: SparkSession, keys: DataFrame) -> DataFrame:
    """Keys to filter texts or sets by: sent to all tasks where they are few enough, so that the texts stay where they are."""
    return F.broadcast(keys) if small_enough(spark, keys.count(), 16) else keys


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).where("doc_id is not null")


def _row_key() -> Column:
    """Tells rows apart by id and text; null without an id."""
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def shingle_sets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row: key, n (set size), d1, d2 (digest), shared (shingles seen in another row too), doc_id."""
    ship(spark)
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    ranges = max(1, (chars or 0) // 6 // RANGE_KEYS)
    ranges = max(ranges, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = _keyed(docs).mapInArrow(_tidy(_pack_documents(ranges)), PACKED)
    found = packed.groupBy("range").applyInArrow(_shared_in_range, FOUND)
    return written(spark, found.groupBy("batch").applyInArrow(_sum_shared, SETS), "shingle-sets")


# --- 2: frequencies among the classes left -----------------------------------------------------
CLASSES = _fields("batch:l", "doc_id:l", "n:l", "keys:b")
COUNTED = _fields("range:i", "batch:l", "keys:b", "counts:b")
FREQ = _fields("batch:l", "keys:b", "counts:b")
SKETCH = [f"o{i}" for i in range(8)]
POSTED = _fields("doc_id:l", "n:l", "most:l", "df_cost:l", "single:b", "keys:b", *[f"{o}:l" for o in SKETCH])


def _class_sets(batches):
    shingler = Shingler()
    for b in _slices(batches, BATCH_DOCS):
        ids = b.column("doc_id").to_pylist()
        sets = shingler.sets(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[0]] * len(ids), pa.int64()), pa.array(ids, pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=CLASSES.names)


def _count_batches(ranges: int):
    """Shingles of the batches' rows in a task, per hash range. A batch read in two pieces sends two rows."""
    def count(batches):
        for b in _slices(batches, BATCH_DOCS):
            batch, sets = b.column("batch").to_numpy(), b.column("keys").to_pylist()
            ends = [*np.flatnonzero(batch[1:] != batch[:-1]) + 1, len(batch)]
            for start, end in zip([0, *ends], ends):
                keys, counts = np.unique(np.frombuffer(b"".join(sets[start:end]), np.uint64), return_counts=True)
                rows = [(r, int(batch[start]), keys[at].tobytes(), counts[at].astype("<i8").tobytes()) for r, at in _pieces(keys, ranges)]
                yield from _table(rows, COUNTED_ARROW).to_batches()
    return count


COUNTED_ARROW = pa.schema([("range", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
FREQ_ARROW = pa.schema([("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _frequencies(table):
    """Per hash range: send back to every batch the shingles of its own that occur in two sets or more."""
    batches, keys = table["batch"].to_pylist(), [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), "<i8")
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    df = np.bincount(at, weights=counts).astype(np.int64)[at]
    rows, start = [], 0
    for batch, k in zip(batches, keys):
        mine = df[start:start + len(k)]
        rows.append((batch, k[mine > 1].tobytes(), mine[mine > 1].tobytes()))
        start += len(k)
    return _table(rows, FREQ_ARROW)


POSTED_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("most", pa.int64()), ("df_cost", pa.int64()),
                          ("single", pa.binary()), ("keys", pa.binary()), *[(o, pa.int64()) for o in SKETCH]])


def odd_sketch(keys: np.ndarray) -> list[int]:
    """512 parities: bit b tells whether an odd number of keys falls on b. Of two sets, the bits that
    differ are at most the elements of their symmetric difference."""
    odd = np.bincount((keys & np.uint64(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def _leading_parts(_, sets, freq):
    """Per set that can link: the shared shingles of its leading parts for c = 1 and c = 2, by (frequency, hash).
    most = shingles that occur elsewhere: no set shares more than these with it."""
    if not freq.num_rows or not sets.num_rows:
        return _table([], POSTED_ARROW)
    keys = np.frombuffer(b"".join(freq["keys"].to_pylist()), np.uint64)
    df = np.frombuffer(b"".join(freq["counts"].to_pylist()), np.int64)
    order = np.argsort(keys)
    keys, df = keys[order], df[order]
    rows = []
    for doc, blob in zip(sets["doc_id"].to_pylist(), sets["keys"].to_pylist()):
        mine = np.frombuffer(blob, np.uint64)
        spare = len(mine) - needed(len(mine))
        if not len(keys):
            continue
        at = np.searchsorted(keys, mine)
        at[at == len(keys)] = 0
        shared = keys[at] == mine
        alone = len(mine) - int(shared.sum())
        if alone > spare:
            continue
        have, freqs = mine[shared], df[at][shared]
        rank = np.lexsort((have, freqs))[:spare + 2 - alone]
        first = rank[:spare + 1 - alone]
        rows.append((doc, len(mine), len(mine) - alone, int((freqs[first] - 1).sum()), have[first].tobytes(), have[rank].tobytes(), *odd_sketch(mine)))
    return _table(rows, POSTED_ARROW)


def _class_table(spark: SparkSession, docs: DataFrame, reps: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row a class: ``reps`` are the keys of its rows, ``repeated`` those keys that several (equal) rows have."""
    rows = _keyed(docs).drop("doc_id").withColumnRenamed("key", "doc_id").join(_side(spark, reps), "doc_id", "left_semi")  # a class goes by its key
    if not repeated.isEmpty():
        again = repeated.select(F.col("key").alias("doc_id"))
        rows = rows.join(again, "doc_id", "left_anti").unionByName(
            rows.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text")))
    return written(spark, rows.mapInArrow(_tidy(_class_sets), CLASSES), "jaccard-classes")


def leading_parts(spark: SparkSession, classes: DataFrame) -> DataFrame:
    total = classes.agg(F.sum("n")).first()[0] or 0
    ranges = max(total // RANGE_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = classes.select("batch", "keys").mapInArrow(_tidy(_count_batches(ranges)), COUNTED)
    freq = counted.groupBy("range").applyInArrow(_frequencies, FREQ)
    parts = classes.groupBy("batch").cogroup(freq.groupBy("batch")).applyInArrow(_leading_parts, POSTED)
    return written(spark, parts, "jaccard-leading")


# --- 3: light subsets and heavy lists ------------------------------------------------------------

def boundary_by_cost(parts: DataFrame) -> int:
    """The largest light size: subsets of the sets up to it plus list scans of those beyond cost least.
    Sizes come to the driver in bins of about 10 %, so their number is bounded."""
    pairs, single = F.octet_length("keys") / 8, F.octet_length("single") / 8
    size_bin = F.floor(F.log("n") / F.log(F.lit(1.1)))
    rows = (parts.groupBy(size_bin.alias("b"))
                 .agg(F.max("n").alias("n"), F.sum(pairs * (pairs - 1) / 2).alias("subsets"),
                      F.sum(single + COMPARE * F.col("df_cost")).alias("scans")).orderBy("n").collect())
    costs = [(sum(r.subsets for r in rows[:k]) + sum(r.scans for r in rows[k:]), k) for k in range(len(rows) + 1)]
    best = min(costs)[1]
    return rows[best - 1].n if best else 0


POSTINGS = _fields("sig:l", "doc_id:l", "n:l", "most:l", *[f"{o}:l" for o in SKETCH], "heavy:i", "rank:i")
FACTS = ["doc_id", "n", "most", *SKETCH]
COMPARE = 0.005  # a comparison inside a list scan, in units of one posting


def _signatures(boundary: int):
    probe_from = needed(boundary + 1)
    def signatures(batches):
        for b in _slices(batches, 500):
            for single, blob, *facts in zip(*(b.column(c).to_pylist() for c in ("single", "keys", *FACTS))):
                n = facts[1]
                kinds = []
                if n > boundary or n >= probe_from:
                    kinds.append((np.frombuffer(single, np.uint64), int(n > boundary)))
                if n <= boundary:
                    k = np.sort(np.frombuffer(blob, np.uint64))
                    i, j = np.triu_indices(len(k), 1)
                    kinds.append((_mixed(k[i] * np.uint64(3) + _mixed(k[j])), 2))
                for sigs, kind in kinds:
                    m = len(sigs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sigs.view(np.int64)), *[pa.array(np.full(m, x)) for x in facts], pa.array(np.full(m, kind, np.int32)),
                         pa.array(np.arange(m, dtype=np.int32))], names=POSTINGS.names)
    return signatures


def signature_postings(spark: SparkSession, parts: DataFrame, boundary: int) -> DataFrame:
    """(sig, facts of the set, heavy): 2 a light set's subset, 1 a heavy set's shingle, 0 a light set probing."""
    posts = parts.select(*FACTS, "single", "keys").mapInArrow(_tidy(_signatures(boundary)), POSTINGS)
    # a subset's signature and a single shingle must not meet
    posts = posts.withColumn("sig", F.when(F.col("heavy") == 2, F.xxhash64("sig")).otherwise(F.col("sig")))
    posts = written(spark, posts, "jaccard-postings")
    useful = posts.groupBy("sig").agg(F.count(F.lit(1)).alias("k"), F.max("heavy").alias("top")).where("k > 1 and top > 0")
    return written(spark, posts.join(useful.select("sig"), "sig", "left_semi"), "jaccard-lists")


# --- 4: verification and components ----------------------------------------------------------------

def _comparable(a, b) -> Column:
    """Whether two sets could link by their facts: what they can share at most is enough, and what they
    differ in at least (by their odd sketches) is not too much."""
    together = a("n") + b("n")
    differ = sum((F.bit_count(a(o).bitwiseXOR(b(o))) for o in SKETCH[1:]), F.bit_count(a(SKETCH[0]).bitwiseXOR(b(SKETCH[0]))))
    return ((F.least(a("most"), b("most")) * (DEN + NUM) >= together * NUM)
            & (differ * (DEN + NUM) <= together * (DEN - NUM)))


def _overlaps(batches):
    for b in batches:
        linked = []
        for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(p, q)
            at[at == len(p)] = 0
            both = int((p[at] == q).sum())
            linked.append(DEN * both >= NUM * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(linked))


def verified(spark: SparkSession, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets link, by the exact Jaccard test."""
    pairs = written(spark, pairs, "jaccard-pairs")
    met = written(spark, pairs.select("a").union(pairs.select("b")).distinct().toDF("s_id"), "jaccard-met")
    sets = classes.select(F.col("doc_id").alias("s_id"), "keys").join(_side(spark, met), "s_id", "left_semi")
    one = pairs.join(sets, pairs.a == sets.s_id).select("a", "b", F.col("keys").alias("x"))
    two = one.join(sets, one.b == sets.s_id).select("a", "b", "x", F.col("keys").alias("y"))
    return written(spark, two.mapInArrow(_tidy(_overlaps), _fields("a:l", "b:l")), "jaccard-edges")


def _leader_pairs(posts: DataFrame) -> DataFrame:
    """Each member with the list leader it shares most lists with: one pair a member. A list's leader
    is the set with the fewest shingles of its own, the likeliest centre of a group of near copies."""
    alone = F.col("n") - F.col("most")
    lead = posts.groupBy("sig").agg(F.min(F.struct(alone.alias("alone"), *FACTS)).alias("lead"))
    each = posts.join(lead, "sig").where(F.col("doc_id") != F.col("lead.doc_id"))
    each = each.where(_comparable(F.col, lambda c: F.col(f"lead.{c}")))
    each = each.groupBy("doc_id", "lead.doc_id", "lead.alone").agg(F.count(F.lit(1)).alias("k")).toDF("a", "b", "alone", "k")
    best = each.groupBy("a").agg(F.min(F.struct((-F.col("k")).alias("k"), "alone", "b")).alias("m"))
    return best.select("a", F.col("m.b").alias("b"))


def _labelled(posts: DataFrame, labels: DataFrame) -> DataFrame:
    out = posts.join(labels, posts.doc_id == labels.node, "left")
    return out.select("sig", *FACTS, "heavy", "rank", F.coalesce("component", "doc_id").alias("comp"))


def _cross_pairs(posts: DataFrame) -> DataFrame:
    """Pairs that meet in a list but not yet in a component (heavy lists: with a heavy set among them).

    A set's lists are in one global order, so two sets meet first in their first common list; where
    they meet in one of the lists just before a list, the pair is left to that one."""
    several = posts.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    mixed = posts.join(several.select("sig"), "sig", "left_semi")
    facts = [*FACTS, "comp", "heavy"]
    left = mixed.groupBy(*facts).agg(F.sort_array(F.collect_list(F.struct("rank", "sig"))).alias("l"))  # of one set
    left = left.select(*facts, F.col("l.sig").alias("sigs"), F.posexplode("l.sig").alias("i", "sig"))
    left = left.select(*facts, "sig", F.slice("sigs", F.greatest(F.lit(1), F.col("i") - NEAR + 1),
                                              F.least(F.col("i"), F.lit(NEAR))).alias("before"))
    right = left.select("sig", *[F.col(c).alias(f"r_{c}") for c in (*facts, "before")])
    pairs = left.join(right, "sig").where(
        (F.col("comp") < F.col("r_comp")) & (F.col("heavy") + F.col("r_heavy") > 0)
        & _comparable(F.col, lambda c: F.col(f"r_{c}")) & ~F.arrays_overlap("before", "r_before"))
    return pairs.select(F.least("doc_id", "r_doc_id").alias("a"), F.greatest("doc_id", "r_doc_id").alias("b")).distinct()


def _labelled_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row with an id: key, doc_id, n, first (doc_id and key of the component's first row; null without words)."""
    sets = shingle_sets(spark, docs)
    some = sets.where("n > 0").groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.max("n").alias("n"), F.max("shared").alias("shared"),
                                                       F.min(F.struct("doc_id", "key")).alias("first"))
    some = written(spark, some, "jaccard-reps")
    # one shingle links equal sets only, which are one class already
    open_sets = some.where((F.col("n") > 1) & (F.col("n") - F.col("shared") <= F.col("n") - F.ceil(F.col("n") * NUM / DEN)))
    repeated = written(spark, sets.where("n > 1").groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "jaccard-repeated")
    classes = _class_table(spark, docs, open_sets.select(F.col("rep").alias("doc_id")), repeated)
    parts = leading_parts(spark, classes)
    posts = signature_postings(spark, parts, boundary_by_cost(parts))
    edges = verified(spark, _leader_pairs(posts), classes)
    labels = connected_components(spark, edges)
    rest = verified(spark, _cross_pairs(_labelled(posts, labels)), classes)
    if not rest.isEmpty():
        labels = connected_components(spark, edges.unionByName(rest))
    linked = written(spark, some.join(labels, some.rep == labels.node).select("node", "component", "first"), "jaccard-linked")
    firsts = written(spark, linked.groupBy("component").agg(F.min("first").alias("to")), "jaccard-firsts")
    linked = linked.join(firsts, "component").select("node", "to")
    comp = some.join(linked, some.rep == linked.node, "left").select(
        F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.coalesce("to", "first").alias("first"))
    return sets.join(comp, (sets.d1 == comp.c1) & (sets.d2 == comp.c2) & (sets.n > 0), "left").select("key", "doc_id", "n", "first")


def _sizes(batches):
    shingler = Shingler()
    for b in _slices(batches, BATCH_DOCS):
        sizes = [len(s) for s in shingler.sets(b.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(sizes), pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(sizes), pa.int64())],
                                         names=["doc_id", "n_shingles", "component_id"])


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id. A row without an id has no component (null) and links nothing."""
    out = _labelled_rows(spark, docs).select("doc_id", F.col("n").alias("n_shingles"),
                                             F.coalesce("first.doc_id", "doc_id").alias("component_id"))
    nameless = docs.where("doc_id is null").select(F.col("text").cast("string").alias("text"))
    return out.unionByName(nameless.mapInArrow(_sizes, _fields("doc_id:l", "n_shingles:l", "component_id:l")))


def one_per_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component (of its smallest id); rows without an id or words stay."""
    rows = written(spark, _labelled_rows(spark, docs).where("n > 0").select("key", F.col("first.key").alias("kept")), "jaccard-rows")
    columns, keyed = docs.columns, docs.withColumn("jaccard_key", _row_key())
    several = written(spark, rows.where("key = kept").groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "jaccard-several")
    drop = rows.where("key <> kept").select("key").unionByName(several.select("key")).distinct()
    drop = _side(spark, written(spark, drop, "jaccard-drop"))
    out = keyed.join(drop, keyed.jaccard_key == drop.key, "left_anti").select(*[F.col(f"`{c}`") for c in columns])
    if several.isEmpty():
        return out
    # rows that repeat id and text: the smallest one
    again = keyed.select("jaccard_key", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    several = _side(spark, several)
    again = again.join(several, again.jaccard_key == several.key, "left_semi").groupBy("jaccard_key").agg(F.min("row").alias("row"))
    return out.unionByName(again.select("row.*"))


__all__ = ["jaccard_components", "one_per_group", "shingle_sets", "needed"]
