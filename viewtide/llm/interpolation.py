"""Language-model scores by deleted interpolation.

Tokens are lower-cased words and one end per text. The model mixes maximum-likelihood estimates,

    P(w | v) = l2 * c(v, w) / c(v) + l1 * c(w) / N + l0 / (V + 1),

with weights that depend on the bucket of c(v), the power of two of the context's frequency. A text's
first word has the end of the text before as its context. All words that training texts lack share the one place beyond V, so
the probabilities of the V words and of an unknown one sum to 1 in every context.

The weights are learned by expectation-maximisation on held-out counts: a tenth of the training texts, by a hash of the
id, is deleted from the counts, and its tokens are predicted from what is left. Every deleted token counts; tokens whose
estimates lie in the same half octaves are one cell with their geometric means, so the driver's table is bounded (by the
squared number of half octaves of a 64-bit count, times the buckets) at any size. Scores use the counts of all training texts.

Counts come from the whole corpus: documents become blocks of numbered words (`packed`), words and then pairs are counted by
parts, and each block gets the counts of what it holds, so no table of the model is broadcast. Pairs are keyed by both
words' 32-bit numbers; beyond 2^32 distinct words keys of different pairs may meet, which is noise in scores only (words are counted by their bytes).

Defined cases: null and empty texts are the end alone; repeated rows count each time; a null doc_id is hashed as the empty
text; without training texts every token gets 1 / (V + 1) = 1; without deleted texts the weights stay as they start, equal; very
long texts are read whole (a block is as large as its longest text); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed as pk
from .common import LOWER_AZ, id_crc, ship

HELD_OUT = 2  # remainder modulo 7 of the texts that are not learned from
DELETED = 10  # one of so many training texts is deleted from the counts that the weights are learned from
BUCKETS = 24
ROUNDS = 60
TOLERANCE = 1e-9
_END = b""  # no word is empty

BLOCK = ("block long, n_tokens long, tokens binary, keys array<binary>, ids binary, starts binary, kinds binary")
WORDS = "part int, block long, at binary, keys array<binary>, learned binary, deleted binary"
PAIRS = "part int, block long, codes binary, learned binary, deleted binary, contexts binary, words binary"
ANSWER = "part int, block long, at binary, ids binary, learned binary, deleted binary, distinct long, total_learned long, total_deleted long"
PAIR_ANSWER = "part int, block long, learned binary, bucket int, high int, low int, n long, sum_high double, sum_low double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_ANSWER = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()),
                     ("learned", pa.binary()), ("deleted", pa.binary()), ("distinct", pa.int64()),
                     ("total_learned", pa.int64()), ("total_deleted", pa.int64())])
_PAIR_ANSWER = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("learned", pa.binary()), ("bucket", pa.int32()), ("high", pa.int32()),
                          ("low", pa.int32()), ("n", pa.int64()), ("sum_high", pa.float64()), ("sum_low", pa.float64())])
_NO_ID = np.iinfo(np.int64).min  # stands for a null doc_id beside the flag


def held_out(name: str = "doc_id") -> Column:
    return id_crc(name) % 7 == HELD_OUT


def deleted(name: str = "doc_id") -> Column:
    """Training texts that are left out of the counts while the weights are learned."""
    return ~held_out(name) & (F.pmod(F.xxhash64(F.lit("deleted"), F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(DELETED)) == 0)


def _blocks(batches):
    """Blocks of rows (doc_id, kind, text): kind 0 not learned from, 1 learned, 2 learned but deleted for the weights."""
    seq, size, docs, ids, kinds, book = 0, 0, [], [], [], pk.Numbers({_END: 0})

    def flush():
        nonlocal seq, size, docs, ids, kinds, book
        tokens = np.concatenate(docs)
        starts = np.cumsum([0] + [len(d) for d in docs[:-1]]).astype(np.int64)
        known = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        missing = np.array([i is None for i in ids], np.int8) << 2
        row = pa.table([[pk.block_id(seq)], pa.array([len(tokens)], pa.int64()), pa.array([pk.squeezed(tokens)], pa.binary()),
                        pa.array([list(book)], pa.list_(pa.binary())), pa.array([pk.binary(known)], pa.binary()),
                        pa.array([pk.binary(starts)], pa.binary()), pa.array([pk.binary(np.array(kinds, np.int8) | missing)], pa.binary())],
                       names=["block", "n_tokens", "tokens", "keys", "ids", "starts", "kinds"])
        seq, size, docs, ids, kinds, book = seq + 1, 0, [], [], [], pk.Numbers({_END: 0})
        return row.to_batches()

    for b in batches:
        for doc, kind, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "kind", "text"))):
            words = (text or b"").translate(LOWER_AZ).split()
            words.append(_END)
            docs.append(np.fromiter(map(book.__getitem__, words), np.int32, len(words)))
            ids.append(doc)
            kinds.append(kind)
            size += len(words)
            if size >= pk.BLOCK_TOKENS:
                yield from flush()
    if docs:
        yield from flush()


def _kinds(row) -> np.ndarray:
    """Kind of the text of each token."""
    starts = np.frombuffer(row["starts"], np.int64)
    return np.repeat(np.frombuffer(row["kinds"], np.int8) & 3, np.diff(np.append(starts, row["n_tokens"])))


def _send_words(parts: int):
    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                words, tokens, kind = row["keys"], pk.expanded(row["tokens"], np.int32), _kinds(row)
                learned = np.bincount(tokens[kind > 0], minlength=len(words))
                gone = np.bincount(tokens[kind == 2], minlength=len(words))
                order, own, bounds = pk.dealt(pk.mixed_words(words, parts))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words, pa.binary()).take(pa.array(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([row["block"]] * len(own), pa.int64()),
                     pk.cut_squeezed(order.astype(np.int32), bounds, rising=True), lists,
                     pk.cut_squeezed(learned[order].astype(np.int32), bounds), pk.cut_squeezed(gone[order].astype(np.int32), bounds)],
                    names=["part", "block", "at", "keys", "learned", "deleted"])
    return send


def _count_words(parts: int):
    def count(table: pa.Table) -> pa.Table:
        """Counts of the words of a part; a learned word gets a number by the rank of its count, 0 is no word."""
        part = table["part"][0].as_py()
        keys = pa.concat_arrays([c.flatten() for c in table["keys"].chunks]).dictionary_encode()
        code, words = keys.indices.to_numpy(), keys.dictionary.to_pylist()
        sent = [pk.expanded_all(table[c], np.int32) for c in ("learned", "deleted")]
        bounds = sent[0][1]
        sums = [np.bincount(code, weights=v).astype(np.int64) for v, _ in sent]
        by_word = np.empty(len(words), np.int64)
        by_word[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        known = np.flatnonzero(sums[0])
        ids = np.zeros(len(words), np.int64)
        ids[known[np.lexsort((by_word[known], -sums[0][known]))]] = np.arange(len(known)) * parts + part + 1
        replies = pk.rows(_ANSWER, part=table["part"].combine_chunks(), block=table["block"].combine_chunks(), at=table["at"].combine_chunks(),
                          **{name: pk.cut_squeezed(v[code], bounds) for name, v in zip(("ids", "learned", "deleted"), (ids, *sums))})
        return pa.concat_tables([replies, pk.rows(_ANSWER, distinct=[len(known)], total_learned=[int(sums[0].sum())],
                                                  total_deleted=[int(sums[1].sum())])])
    return count


def _count_pairs(total: int):
    """``total``: learned tokens that are not deleted."""
    def count(table: pa.Table) -> pa.Table:
        """Learned count of each pair for the blocks that sent it, and of the deleted tokens that are these pairs
        how many fall in each cell of (bucket, pair estimate, word estimate)."""
        codes, bounds = pk.expanded_all(table["codes"], np.uint64, rising=True)
        codes, back = np.unique(codes, return_inverse=True)
        sent = pk.expanded_all(table["deleted"], np.int32)[0]
        learned, gone = (np.bincount(back, weights=w, minlength=len(codes)).astype(np.int64)
                         for w in (pk.expanded_all(table["learned"], np.int32)[0], sent))
        replies = pk.rows(_PAIR_ANSWER, part=table["part"].combine_chunks(), block=table["block"].combine_chunks(),
                          learned=pk.cut_squeezed(learned[back], bounds))
        # the counts of context and word that are left come along with pairs that a block has deleted
        at, first = np.unique(back[sent > 0], return_index=True)
        context, word = (pk.expanded_all(table[c], np.int64)[0][first] for c in ("contexts", "words"))
        high, low = estimates((learned - gone)[at], context, word, total)
        (h, log_h), (w, log_w) = _half_octave(high), _half_octave(low)
        b, n = bucket(context), gone[at]
        key, own, cell = np.unique(b << 20 | (h + 1) << 10 | (w + 1), return_index=True, return_inverse=True)
        sums = [np.bincount(cell, weights=x, minlength=len(key)) for x in (n, n * log_h, n * log_w)]
        return pa.concat_tables([replies, pk.rows(_PAIR_ANSWER, bucket=b[own], high=h[own], low=w[own], n=sums[0].astype(np.int64),
                                                  sum_high=sums[1], sum_low=sums[2])])
    return count


def _numbered(blocks: pa.Table, answers: pa.Table) -> dict:
    """A block's row with the number and the counts of each local word."""
    row = blocks.to_pylist()[0]
    row["tokens"] = pk.expanded(row["tokens"], np.int32)
    words = answers.filter(pc.is_valid(answers["at"]))
    at = pk.expanded_all(words["at"], np.int32, rising=True)[0]
    for name in ("ids", "learned", "deleted"):
        if name in words.column_names:
            v = np.zeros(row["n_keys"], np.int64)
            v[at] = pk.expanded_all(words[name], np.int64)[0]
            row["numbers" if name == "ids" else name] = v
    return row


def _pairs(row):
    """(positions whose word and context are learned, their pairs' codes)."""
    numbers = row["numbers"]
    word = numbers[row["tokens"]]
    context = np.concatenate((numbers[:1], word[:-1]))  # number 0 of a block is the end
    at = np.flatnonzero((word > 0) & (context > 0))
    return at, context[at].astype(np.uint64) << np.uint64(32) ^ word[at].astype(np.uint64)


def _send_pairs(parts: int):
    def send(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = _numbered(blocks, answers)
        at, codes = _pairs(row)
        kind = _kinds(row)[at]
        codes, first, back = np.unique(codes, return_index=True, return_inverse=True)
        learned, gone = (np.bincount(back[kind >= k], minlength=len(codes)) for k in (1, 2))
        order, own, bounds = pk.dealt(pk.mixed(codes, parts))
        some = gone[order] > 0
        where = at[first[order][some]]
        left = [(a - b)[where] for a, b in zip(_counts(row, "learned"), _counts(row, "deleted"))]
        few = np.concatenate(([0], np.cumsum(some)))[bounds]
        return pa.table([pa.array(own, pa.int32()), pa.array([row["block"]] * len(own), pa.int64()), pk.cut_squeezed(codes[order], bounds, rising=True),
                         pk.cut_squeezed(learned[order].astype(np.int32), bounds), pk.cut_squeezed(gone[order].astype(np.int32), bounds),
                         pk.cut_squeezed(left[1], few), pk.cut_squeezed(left[0], few)],
                        names=["part", "block", "codes", "learned", "deleted", "contexts", "words"])
    return send


def _pair_counts(row, answers: pa.Table, parts: int) -> np.ndarray:
    """Learned count of the pair at each token; 0 where word or context is not learned."""
    at, codes = _pairs(row)
    out = np.zeros(row["n_tokens"], np.int64)
    if len(at):
        codes, back = np.unique(codes, return_inverse=True)
        order, own, bounds = pk.dealt(pk.mixed(codes, parts))
        pairs = answers.filter(pc.is_null(answers["at"]))
        sent = dict(zip(pairs["part"].to_pylist(), pairs["learned"].to_pylist()))
        v = np.empty(len(codes), np.int64)
        v[order] = np.concatenate([pk.expanded(sent[p], np.int64) for p in own.tolist()])
        out[at] = v[back]
    return out


def _counts(row, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Count of the word and of the context at each token."""
    word = row[name]
    here = word[row["tokens"]]
    return here, np.concatenate((word[:1], here[:-1]))


def bucket(count: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0 for none, else by powers of two."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def estimates(pair: np.ndarray, context: np.ndarray, word: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(context, 1), word / max(total, 1)


def _half_octave(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, log2) of a probability; cell -1 for 0."""
    log = np.log2(np.where(p > 0, p, 1.0))
    return np.where(p > 0, np.floor(-2 * log), -1).astype(np.int32), log


def learn_weights(cells: list, types: int) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform estimate by expectation-maximisation over cells
    (bucket, high, low, n, sum_high, sum_low). A bucket without a deleted token takes those of the next lower one."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 1 / 2, 1 / 2)  # a context that was not seen has no pair estimate
    for b in range(BUCKETS):
        own = [c for c in cells if c[0] == b]
        if not own:
            weights[b] = weights[b - 1] if b > 1 else weights[b]
            continue
        n = np.array([c[3] for c in own], np.float64)
        p = np.stack([np.where([c[1] < 0 for c in own], 0.0, np.exp2([c[4] / c[3] for c in own])),
                      np.where([c[2] < 0 for c in own], 0.0, np.exp2([c[5] / c[3] for c in own])),
                      np.full(len(own), 1 / (types + 1))], axis=1)
        for _ in range(ROUNDS):
            joint = p * weights[b]
            new = (n[:, None] * joint / joint.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            moved = np.abs(new - weights[b]).max()
            weights[b] = new
            if moved < TOLERANCE:
                break
        weights[b] = (weights[b] + 1e-6) / (1 + 3e-6) if b else (weights[b] + [0, 1e-6, 1e-6]) / (1 + 2e-6)  # no probability is 0
    return weights


def _score(parts: int, total: int, types: int, weights: np.ndarray):
    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = _numbered(blocks, answers)
        pair = _pair_counts(row, answers, parts)
        word, context = _counts(row, "learned")
        high, low = estimates(pair, context, word, total)
        w = weights[bucket(context)]
        p = w[:, 0] * high + w[:, 1] * low + w[:, 2] / (types + 1)
        starts, kinds, ids = (np.frombuffer(row[c], t) for c, t in (("starts", np.int64), ("kinds", np.int8), ("ids", np.int64)))
        base = np.log10((word + 1) / (total + types + 1))
        return pa.table([pa.array(ids, mask=kinds & 4 > 0), pa.array(kinds & 3 == 0), np.diff(np.append(starts, row["n_tokens"])),
                         np.add.reduceat((word > 0).astype(np.int64), starts), np.full(len(ids), total), np.add.reduceat(base, starts),
                         np.add.reduceat(np.log10(p), starts)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return score


def score_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(spark)
    kind = F.when(held_out(), 0).when(deleted(), 2).otherwise(1)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("kind"), F.col("text").cast("string").cast("binary").alias("text"))
    blocks = pk.stored(spark, texts.mapInArrow(_blocks, BLOCK), "lm-blocks")
    parts, _ = pk.parts_for(blocks)
    dealt = lambda df, by: pk.spread(spark, df, by, parts).groupBy(by)
    sent = blocks.mapInArrow(_send_words(parts), WORDS)
    words = pk.stored(spark, dealt(sent, "part").applyInArrow(_count_words(parts), ANSWER), "lm-words")
    types, total, gone = (v or 0 for v in words.agg(F.sum("distinct"), F.sum("total_learned"), F.sum("total_deleted")).first())
    local = blocks.select(*[c for c in blocks.columns if c != "keys"], F.size("keys").alias("n_keys"))
    words = words.where("block is not null")
    sent = dealt(local, "block").cogroup(dealt(words.select("block", "at", "ids", "learned", "deleted"), "block")).applyInArrow(_send_pairs(parts), PAIRS)
    pairs = pk.stored(spark, dealt(sent, "part").applyInArrow(_count_pairs(total - gone), PAIR_ANSWER), "lm-pairs")
    cells = pairs.where("n is not null").groupBy("bucket", "high", "low").agg(F.sum("n"), F.sum("sum_high"), F.sum("sum_low"))
    weights = learn_weights(sorted(tuple(r) for r in cells.collect()), types)
    replies = words.select("block", "part", "at", "ids", "learned").unionByName(
        pairs.where("block is not null").select("block", "part", "learned"), allowMissingColumns=True)
    return dealt(local, "block").cogroup(dealt(replies, "block")).applyInArrow(_score(parts, total, types, weights), SCORES)
