"""Toxicity: a factorization machine over hashed terms.

A text is the set of its lower-cased words and of their first four and five letters (for stems with
many endings), hashed to 2^20 buckets. The score is the logistic of
bias + linear weights + pairwise interactions, where a pair's weight is the inner product of the two
terms' factor vectors, so a pair (an insult and a mention of a group) can weigh more than its parts.
Buckets enter the model if they tell the classes apart in the training rows (chi-square), which keeps
it to a few thousand rows of weights. Training is AdaGrad on the logistic loss, in numpy.

The model is fitted on at most ``max_rows`` labelled documents, chosen by a hash of the id among
those not held out. Scoring is one map-only pass over whole texts.

Defined cases: null and empty texts have no terms and get the bias's score; rows with a null label
are not learned from; documents with several label rows count as toxic if one says so; without labels of
both classes every score is the base rate; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_crc, ship

BUCKETS = 1 << 20
TERMS = 4_000  # rows of weights, at most
CHI_SQUARE = 20.0  # a term tells the classes apart from here on
FACTORS = 4
MAX_ROWS = 16_000
EPOCHS = 30
L2 = 1e-4
TOXIC_WEIGHT = 3.0  # of a toxic row in training; they are the rarer class
THRESHOLD = 0.7
MAX_WORDS = 300_000  # distinct words a worker remembers
_TERM = re.compile(r"\w+")

SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                       T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % BUCKETS


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a word and its stems (marked, so that a stem and an equal word differ)."""
    return (_bucket(word), *(_bucket(f"{k}>{word[:k]}") for k in (4, 5) if len(word) > k))


def words_of(text: str | None) -> set[str]:
    return set(_TERM.findall(text.lower())) if text else set()


def term_buckets(text: str | None) -> set[int]:
    """Hash buckets of the terms of the whole text."""
    return {b for w in words_of(text) for b in word_buckets(w)}


@dataclass
class FactorizationMachine:
    index: dict[int, int]  # bucket -> row
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, known = [], {}
        for text in texts:
            hits: set[int] = set()
            for w in words_of(text):
                found = known.get(w)
                if found is None:
                    if len(known) > MAX_WORDS:
                        known.clear()
                    found = known[w] = tuple(self.index[b] for b in word_buckets(w) if b in self.index)
                hits.update(found)
            rows.append(hits)
        return _logistic(_margins(rows, self.bias, self.linear, self.factors)[0])


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _margins(rows: list[set[int]], bias: float, linear: np.ndarray, factors: np.ndarray):
    """Per row: bias + sum w_i + 1/2 (|sum v_i|^2 - sum |v_i|^2); also sum v_i and the flat terms."""
    flat = np.array([i for r in rows for i in sorted(r)], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    sums, squares, lin = np.zeros((len(rows), factors.shape[1])), np.zeros(len(rows)), np.zeros(len(rows))
    if len(flat):
        v = factors[flat]
        np.add.at(sums, owner, v)
        squares = np.bincount(owner, (v * v).sum(axis=1), len(rows))
        lin = np.bincount(owner, linear[flat], len(rows))
    return bias + lin + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, flat, owner


def select_terms(rows: list[np.ndarray], toxic: np.ndarray, most: int = TERMS) -> np.ndarray:
    """The buckets with the largest chi-square against the label, in three documents or more; sorted."""
    n, pos = len(rows), toxic.sum()
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    c = np.bincount(flat, minlength=BUCKETS).astype(float)
    p = np.bincount(flat, np.repeat(toxic, [len(r) for r in rows]), BUCKETS)
    expected = c * pos / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.where(c >= 3, (p - expected) ** 2 * (1 / expected + 1 / (c - expected)), 0)
    best = np.argsort(-chi, kind="stable")[:min(most, int((chi >= CHI_SQUARE).sum()))]
    return np.sort(best)


def fit(rows: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = 4) -> FactorizationMachine:
    """``rows``: the term buckets of each document, as arrays."""
    toxic = np.asarray(toxic, float)
    rate = (toxic.sum() + 1) / (len(toxic) + 2)
    chosen = select_terms(rows, toxic) if 0 < toxic.sum() < len(toxic) else np.zeros(0, np.int64)
    rng = np.random.default_rng(seed)
    model = FactorizationMachine({int(b): i for i, b in enumerate(chosen)}, float(np.log(rate / (1 - rate))),
                                 np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), FACTORS)))
    if not len(chosen):
        return model
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    terms = [set(k[k >= 0].tolist()) for k in (place[r] for r in rows)]
    g_lin, g_fac, g_bias = np.full(len(chosen), 1e-6), np.full((len(chosen), FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(terms))
        for s in range(0, len(order), 64):
            at = order[s:s + 64]
            margin, sums, flat, owner = _margins([terms[i] for i in at], model.bias, model.linear, model.factors)
            err = (_logistic(margin) - toxic[at]) * np.where(toxic[at] > 0, TOXIC_WEIGHT, 1.0)
            g = err.mean()
            g_bias += g * g
            model.bias -= 0.1 * g / g_bias ** 0.5
            if not len(flat):
                continue
            touched, pos = np.unique(flat, return_inverse=True)
            e = err[owner]
            lin = np.bincount(pos, e) + L2 * model.linear[touched]
            fac = np.zeros((len(touched), FACTORS))
            np.add.at(fac, pos, e[:, None] * (sums[owner] - model.factors[flat]))
            fac += L2 * model.factors[touched]
            g_lin[touched] += lin * lin
            g_fac[touched] += fac * fac
            model.linear[touched] -= 0.2 * lin / np.sqrt(g_lin[touched])
            model.factors[touched] -= 0.02 * fac / np.sqrt(g_fac[touched])
    return model


def held_out(name: str = "doc_id") -> Column:
    return id_crc(name) % 3 == 1


def _hash_terms(batches):
    for b in batches:
        terms = [np.array(sorted(term_buckets(t)), "<u4").tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(terms, pa.binary())],
                                         names=["doc_id", "toxic", "terms"])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> FactorizationMachine:
    """Fit on at most ``max_rows`` labelled documents that are not held out."""
    ship(spark)
    some = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    some = some.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # at most max_rows narrow rows
    some = some.select(F.col("doc_id").alias("l_id"), "toxic")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), F.col("doc_id") == F.col("l_id"))
    got = rows.select("doc_id", "toxic", "text").mapInArrow(_hash_terms, "doc_id bigint, toxic int, terms binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    return fit([np.frombuffer(t, "<u4") for t in got["terms"].to_pylist()], np.array(got["toxic"].to_pylist(), float))


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame,
                   model: FactorizationMachine | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score >= 0.7)."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model or train(spark, docs, labels))

    def score(batches):
        for b in batches:
            s = shared.value.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s),
                                              pa.array((s >= THRESHOLD).astype(np.int32))], names=SCORES.names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, SCORES)
