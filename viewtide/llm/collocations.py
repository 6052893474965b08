"""Collocation mining: phrases of two to four words by direct-address tiling.

1. Documents become blocks of local word numbers (`packed`); the words of all blocks are counted by parts,
   and each word of a language with at least MIN_COUNT occurrences gets an id by its frequency rank
   in its part (ranks of all parts interleave, so small ids are frequent words everywhere).
2. Blocks turn neighbouring frequent words into pairs of ids. The plane of pairs is cut into square tiles.
   A tile hit often is counted in a dense table by ``numpy.bincount`` at the pair's direct address; the
   pairs of all other tiles are counted as sorted coordinates. A tile's counts of all blocks
   meet in one part, where the same rule adds them up.
3. Pairs with at least MIN_COUNT occurrences are ranked again, as words were, and step 2 is repeated with
   (pair, word) and then (triple, word); a longer phrase is looked for only where both its parts without
   the last and without the first word are frequent, which loses none.

Scores, cuts and the removal of phrases inside longer ones are joins of the frequent phrases alone, in exact
decimal arithmetic.

Defined cases: null and empty texts have no words; a null lang is 'und'; repeated rows count each time;
very long texts are read whole (a block is as large as its longest text); without a frequent phrase or a row
there is no result row; extra columns are ignored. Ids are bounded: at most 2^28 frequent words
and 2^35 frequent phrases of one length, beyond which the job fails rather than miscounts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import packed as pk
from .common import LOWER_AZ, ship

MIN_COUNT = 30
LONGEST = 4
TOP = 2_000
SCALE = 2_000_000
INSIDE = (80, 100)  # a phrase goes if a longer one around it has this share of its occurrences
TILE_BITS = 9  # side of a tile: 512 ids
HEAD_TILES = 32  # tiles by side, from the most frequent ids, that may be dense
DENSE = 8  # a tile is dense from cells / DENSE hits on
WORD_BITS = 28
_SEPARATOR = re.compile(rb"[.,;:!?\x0A-\x0D]")
_BREAK, _NOTHING = b"\n", b""

_B = "part int, block long, "
BLOCK = "block long, n_tokens long, tokens binary, keys array<binary>"
WORDS = _B + "at binary, keys array<binary>, counts binary"
PAIRS = _B + "codes binary, counts binary"
ANSWER = "block long, codes binary, ids binary, id long, `left` long, `right` long, lang string, phrase string, f long, n long"
STATE = "block long, n_tokens long, words binary, grams binary"
_ANSWER = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("id", pa.int64()),
                     ("left", pa.int64()), ("right", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()),
                     ("f", pa.int64()), ("n", pa.int64())])


def _blocks(batches):
    """Blocks of (text, lang) rows. Local numbers start at 1; 0 stands between pieces and after a text."""
    seq, size, docs, books = 0, 0, [], {}

    def flush():
        nonlocal seq, size, docs, books
        base, keys = {}, []
        for lang, book in books.items():
            base[lang] = len(keys) - 1
            keys += [lang + b" " + w for w in list(book)[2:]]
        tokens = np.concatenate([np.where(a > 1, a + base[lang], 0) for lang, a in docs]).astype(np.int32)
        row = pa.table([pa.array([pk.block_id(seq)]), pa.array([len(tokens)], pa.int64()),
                        pa.array([pk.binary(tokens)], pa.binary()), pa.array([keys], pa.list_(pa.binary()))],
                       names=["block", "n_tokens", "tokens", "keys"])
        seq, size, docs, books = seq + 1, 0, [], {}
        return row.to_batches()

    for b in batches:
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
            if not text:
                continue
            if lang not in books:
                books[lang] = pk.Numbers({_BREAK: 0, _NOTHING: 1})
            raw = _SEPARATOR.sub(b" \n ", text.translate(LOWER_AZ)).replace(b"\t", b" ").split(b" ")
            raw.append(_BREAK)
            a = np.fromiter(map(books[lang].__getitem__, raw), np.int32, len(raw))
            a = a[a != 1]
            docs.append((lang, a))
            size += len(a)
            if size >= pk.BLOCK_TOKENS // 2:  # the state of a block is larger than its tokens
                yield from flush()
    if docs:
        yield from flush()


def _send_words(parts: int):
    def send(batches):
        for b in batches:
            for block, tokens, keys in zip(*(b.column(c) for c in ("block", "tokens", "keys"))):
                words = keys.as_py()
                if not words:
                    continue
                counts = np.bincount(np.frombuffer(tokens.as_py(), np.int32), minlength=len(words) + 1)[1:]
                order, own, bounds = pk.dealt(pk.mixed_words(words, parts))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words, pa.binary()).take(pa.array(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([block.as_py()] * len(own), pa.int64()), pk.cut(order.astype(np.int32), bounds),
                     lists, pk.cut(counts[order].astype(np.int64), bounds)], names=["part", "block", "at", "keys", "counts"])
    return send


def _ranked(f: np.ndarray, order_by: np.ndarray, least: int, part: int, parts: int) -> np.ndarray:
    """Ids of the entries with at least ``least`` occurrences by frequency rank, 0 for the others."""
    ids = np.zeros(len(f), np.int64)
    keep = np.flatnonzero(f >= least)
    keep = keep[np.lexsort((order_by[keep], -f[keep]))]
    ids[keep] = np.arange(len(keep)) * parts + part + 1
    return ids


def _answers(table: pa.Table, codes: np.ndarray, ids: np.ndarray, width: int) -> pa.Table:
    """For each block that sent to this part, the codes whose id is not 0."""
    ends = np.cumsum(pk.lengths(table["counts"], width))
    out = {"block": [], "codes": [], "ids": []}
    for block, end, n in zip(table["block"].to_pylist(), ends, np.diff(ends, prepend=0)):
        c, i = codes[end - n:end], ids[end - n:end]
        if (i > 0).any():
            out["block"].append(block)
            out["codes"].append(pk.binary(c[i > 0]))
            out["ids"].append(pk.binary(i[i > 0]))
    return pk.rows(_ANSWER, **out)


def _count_words(parts: int, least: int):
    def count(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys = pa.concat_arrays([c.flatten() for c in table["keys"].chunks]).dictionary_encode()
        code, words = keys.indices.to_numpy(), keys.dictionary.to_pylist()
        f = np.bincount(code, weights=pk.joined(table["counts"], np.int64)).astype(np.int64)
        by_word = np.empty(len(words), np.int64)
        by_word[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        ids = _ranked(f, by_word, least, part, parts)
        if len(ids) and ids.max() >> WORD_BITS:
            raise OverflowError("more frequent words than ids")
        totals: dict[bytes, int] = {}
        for w, k in zip(words, f.tolist()):
            lang = w[:w.rindex(b" ")]
            totals[lang] = totals.get(lang, 0) + k
        kept = np.flatnonzero(ids)
        split = [words[i].rsplit(b" ", 1) for i in kept]
        return pa.concat_tables([
            _answers(table, pk.joined(table["at"], np.int32).astype(np.int64), ids[code], 8),
            pk.rows(_ANSWER, id=ids[kept], lang=[s[0].decode() for s in split], phrase=[s[1].decode() for s in split], f=f[kept]),
            pk.rows(_ANSWER, lang=[k.decode() for k in totals], n=list(totals.values()))])
    return count


def tile_counts(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes (left id << WORD_BITS | right id) and the sums of their weights, by tiles."""
    side, mask = 1 << TILE_BITS, (1 << WORD_BITS) - 1
    left, right = codes >> WORD_BITS, codes & mask
    row, col = left >> TILE_BITS, right >> TILE_BITS
    head = (row < HEAD_TILES) & (col < HEAD_TILES)
    tile = np.where(head, row * HEAD_TILES + col, HEAD_TILES ** 2)
    hits = np.bincount(tile, minlength=HEAD_TILES ** 2 + 1)[:-1]
    found, sums = [], []
    dense = np.append(hits >= side * side // DENSE, False)
    for t in np.flatnonzero(dense):
        own = tile == t
        at = (left[own] & (side - 1)) << TILE_BITS | right[own] & (side - 1)
        n = np.bincount(at, None if weights is None else weights[own], side * side).astype(np.int64)
        at = np.flatnonzero(n)
        found.append((t // HEAD_TILES << TILE_BITS | at >> TILE_BITS) << WORD_BITS | (t % HEAD_TILES << TILE_BITS | at & (side - 1)))
        sums.append(n[at])
    rest = ~dense[tile]
    if weights is None:
        coo, n = np.unique(codes[rest], return_counts=True)
    else:
        order = np.argsort(codes[rest])
        coo, first = np.unique(codes[rest][order], return_index=True)
        n = np.add.reduceat(weights[rest][order], first) if len(first) else first
    return np.concatenate([*found, coo]).astype(np.int64), np.concatenate([*sums, n]).astype(np.int64)


def piece_bits(n_blocks: int) -> int:
    """Bits of a pair's address in its tile that choose its piece: each block can send every cell of a tile once,
    so a tile is cut into pieces of which all blocks together send at most some PART_KEYS cells."""
    return min(2 * TILE_BITS, max(0, (n_blocks << 2 * TILE_BITS) // pk.PART_KEYS).bit_length())


def _tile_parts(codes: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Part of each code: that of its piece of its tile."""
    left, right, side = codes >> WORD_BITS, codes & ((1 << WORD_BITS) - 1), 1 << TILE_BITS
    tile = left >> TILE_BITS << (WORD_BITS - TILE_BITS) | right >> TILE_BITS
    at = (left & (side - 1)) << TILE_BITS | right & (side - 1)
    return pk.mixed(pk.mixed(tile, 1 << 62) ^ at >> (2 * TILE_BITS - bits), parts)


def _neighbours(words: np.ndarray, grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a phrase of ``length`` words may be frequent, and its codes there."""
    last = words[length - 1:]
    ok = (grams[:len(last)] > 0) & (last > 0)
    if length > 2:
        ok &= grams[1:len(last) + 1] > 0
    at = np.flatnonzero(ok)
    return at, grams[at] << WORD_BITS | last[at]


def _state(row) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(row["words"], np.int32).astype(np.int64)
    return words, np.frombuffer(row["grams"], np.int64) if row["grams"] is not None else words


def _send_pairs(parts: int, bits: int, length: int):
    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                codes, counts = tile_counts(_neighbours(*_state(row), length)[1])
                if not len(codes):
                    continue
                order, own, bounds = pk.dealt(_tile_parts(codes, parts, bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([row["block"]] * len(own), pa.int64()), pk.cut(codes[order], bounds),
                     pk.cut(counts[order].astype(np.int32), bounds)], names=["part", "block", "codes", "counts"])
    return send


def _count_pairs(parts: int, least: int):
    def count(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        sent = pk.joined(table["codes"], np.int64)
        codes, f = tile_counts(sent, pk.joined(table["counts"], np.int32).astype(np.int64))
        ids = _ranked(f, codes, least, part, parts)
        if len(ids) and ids.max() >> (63 - WORD_BITS):
            raise OverflowError("more frequent phrases than ids")
        kept = np.flatnonzero(ids)
        kept = kept[np.argsort(codes[kept])]
        ids_of_sent = np.zeros(len(sent), np.int64)
        if len(kept):
            at = np.minimum(np.searchsorted(codes[kept], sent), len(kept) - 1)
            ids_of_sent = np.where(codes[kept][at] == sent, ids[kept][at], 0)
        return pa.concat_tables([
            _answers(table, sent, ids_of_sent, 4),
            pk.rows(_ANSWER, id=ids[kept], left=codes[kept] >> WORD_BITS, right=codes[kept] & ((1 << WORD_BITS) - 1), f=f[kept])])
    return count


def _first_state(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Ids in place of local numbers."""
    row = blocks.to_pylist()[0]
    ids = np.zeros(row["n_keys"] + 1, np.int32)
    ids[pk.joined(answers["codes"], np.int64) + 1] = pk.joined(answers["ids"], np.int64)
    words = ids[np.frombuffer(row["tokens"], np.int32)]
    return pa.table([[row["block"]], pa.array([row["n_tokens"]], pa.int64()), pa.array([pk.binary(words)], pa.binary()),
                     pa.nulls(1, pa.binary())], names=["block", "n_tokens", "words", "grams"])


def _next_state(length: int):
    def step(state: pa.Table, answers: pa.Table) -> pa.Table:
        """Ids of the frequent phrases of ``length`` words at their first positions; words that no longer phrase can end with go."""
        row = state.to_pylist()[0]
        words, grams = _state(row)
        at, sent = _neighbours(words, grams, length)
        codes, ids = pk.joined(answers["codes"], np.int64), pk.joined(answers["ids"], np.int64)
        out = np.zeros(len(words), np.int64)
        if len(codes):
            order = np.argsort(codes)
            codes, ids = codes[order], ids[order]
            near = np.minimum(np.searchsorted(codes, sent), len(codes) - 1)
            out[at] = np.where(codes[near] == sent, ids[near], 0)
        words = words.astype(np.int32)
        words[length - 1:][out[:len(out) - length + 1] == 0] = 0
        words[:length - 1] = 0
        return pa.table([[row["block"]], pa.array([row["n_tokens"]], pa.int64()), pa.array([pk.binary(words)], pa.binary()),
                         pa.array([pk.binary(out)], pa.binary())], names=["block", "n_tokens", "words", "grams"])
    return step


def _per_block(spark: SparkSession, state: DataFrame, answers: DataFrame, step, parts: int) -> DataFrame:
    replies = answers.where("block is not null").select("block", "codes", "ids")
    state, replies = (pk.spread(spark, df, "block", parts).groupBy("block") for df in (state, replies))
    return pk.stored(spark, state.cogroup(replies).applyInArrow(step, STATE), "phrase-state")


def _per_part(spark: SparkSession, sent: DataFrame, count, parts: int, name: str) -> DataFrame:
    return pk.stored(spark, pk.spread(spark, sent, "part", parts).groupBy("part").applyInArrow(count, ANSWER), name)


def frequent_phrases(spark: SparkSession, docs: DataFrame, least: int = MIN_COUNT,
                     longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, length, f) of all phrases of one to ``longest`` words with f >= ``least``, (lang, n))."""
    ship(spark)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary")
    texts = docs.select(F.col("text").cast("string").cast("binary").alias("text"), lang.alias("lang"))
    blocks = pk.stored(spark, texts.mapInArrow(_blocks, BLOCK), "phrase-blocks")
    parts, n_blocks = pk.parts_for(blocks)
    bits = piece_bits(n_blocks)
    sent = blocks.mapInArrow(_send_words(parts), WORDS)
    answers = _per_part(spark, sent, _count_words(parts, least), parts, "phrase-words")
    totals = answers.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    words = answers.where("id is not null").select("id", "lang", "phrase", "f")
    found, shorter = words.select("lang", "phrase", F.lit(1).alias("length"), "f"), words
    local = blocks.select("block", "n_tokens", "tokens", F.size("keys").alias("n_keys"))
    state = _per_block(spark, local, answers, _first_state, parts)
    for length in range(2, longest + 1):
        sent = state.mapInArrow(_send_pairs(parts, bits, length), PAIRS)
        answers = _per_part(spark, sent, _count_pairs(parts, least), parts, "phrase-pairs")
        last = words.select(F.col("id").alias("right"), F.col("phrase").alias("word"))
        front = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("front"))
        grams = answers.where("id is not null").select("id", "left", "right", "f").join(front, "left").join(last, "right")
        shorter = pk.stored(spark, grams.select("id", "lang", F.concat_ws(" ", "front", "word").alias("phrase"), "f"), "phrase-grams")
        found = found.unionByName(shorter.select("lang", "phrase", F.lit(length).alias("length"), "f"))
        if length < longest:
            state = _per_block(spark, state, answers, _next_state(length), parts)
    return found, totals


def collocations(spark: SparkSession, docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST,
                 top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language."""
    found, totals = frequent_phrases(spark, docs, least, longest)
    phrases = found.where("length > 1").withColumnRenamed("f", "a")
    split = F.split("phrase", " ")
    # phrases that a longer one around them explains
    spans = [(i, k) for k in range(2, longest) for i in range(longest - k + 1)]
    inner = F.array(*[F.when((F.col("length") > k) & (F.col("length") >= i + k), F.array_join(F.slice(split, i + 1, k), " "))
                      for i, k in spans]) if spans else F.array(F.lit(None).cast("string"))
    around = (phrases.where("length > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
              .where("phrase is not null").groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    share, whole = INSIDE
    kept = phrases.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(whole) * F.col("longer") < F.lit(share) * F.col("a"))).drop("longer")
    # every cut, and the lowest-scoring one
    cuts = kept.select("lang", "phrase", "a", split.alias("w"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("front"),
                       F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("back"))
    cuts = (cuts.join(found.select("lang", F.col("phrase").alias("front"), F.col("f").alias("l")), ["lang", "front"])
                .join(found.select("lang", F.col("phrase").alias("back"), F.col("f").alias("r")), ["lang", "back"]))
    score = F.expr(f"cast({SCALE} as decimal(20, 0)) * cast(a as decimal(18, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("c"))
    best = best.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("c").alias("c"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = best.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
