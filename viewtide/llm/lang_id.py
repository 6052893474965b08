"""Language identification: nearest centroid over TF-IDF character n-grams.

Letters are lower-cased, everything else becomes one blank, and 2- and 3-grams are hashed to a fixed
number of features with log-scaled counts, IDF weights and unit length. A text is cut into equal windows of
about WINDOW letters, because the vector of a long text has nearly every feature and so is like any
other. Each language has several centroids (spherical k-means over windows of its training texts);
a text gets the language whose best centroids have the largest cosine on average over all windows.
A text is rejected if it has no letter, or if that cosine is below what training texts of a similar
length reach while they are left out of the fit (short lengths: pieces of them).

The model is fitted on at most ``max_rows`` labelled texts, spread evenly over the languages and
chosen by a hash of the id, each with at most TRAIN_WINDOWS windows spread over it; it is a few hundred
kilobytes per language. Prediction is one map-only pass over whole texts.

Defined cases: null, empty and letterless texts get 'und', score 0 and are rejected; rows with a
null language are not learned from; ties go to the first language by name; without any training row
every text is 'und'; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, id_crc, mixing_constants, ship, written

FEATURES = 1 << 12
CENTROIDS = 3
MAX_ROWS = 2_400
ROUNDS = 12
WINDOW = 400  # letters and blanks
TRAIN_WINDOWS = 2  # of a training text
CHUNK = 256  # windows that are scored at a time
PIECES = (16, 50, 150)  # letters and blanks of the pieces that show what short texts reach
FOLDS = 4
BINS = (0, 20, 60, 200, 800, 3200, 1 << 40)  # letters, for the rejection thresholds
LOWEST = 0.005  # share of the left-out training texts of a bin that its floor may lie above, before the margin
MARGIN = 0.9
UND = "und"

PREDICTION = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])

_BLANK = np.uint32(32)
_BMP_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Lower-case code of each code point of the basic plane that is a letter, else a blank."""
    if not _BMP_LETTERS:
        table = np.full(1 << 16, _BLANK, np.uint32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _BMP_LETTERS.append(table)
    return _BMP_LETTERS[0]


def letters(text: str | None) -> np.ndarray:
    """Lower-cased letters with single blanks between and around words; empty if there is no letter."""
    if not text:
        return np.zeros(0, np.uint32)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = code >= 1 << 16
    out = _letter_table()[np.where(wide, 32, code)]
    if wide.any():
        out[wide] = [c if chr(c).isalpha() else 32 for c in code[wide].tolist()]
    blank = out == _BLANK
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    out = out[keep]
    if not len(out) or (len(out) == 1 and out[0] == _BLANK):
        return np.zeros(0, np.uint32)
    return np.concatenate(([_BLANK] if out[0] != _BLANK else [], out, [_BLANK] if out[-1] != _BLANK else [])).astype(np.uint32)


def windows(code: np.ndarray) -> list[np.ndarray]:
    """The letters of a text in equal windows of about WINDOW; none without letters."""
    n = max(1, round(len(code) / WINDOW))
    return np.array_split(code, n) if len(code) else []


def gram_places(code: np.ndarray, features: int = FEATURES) -> np.ndarray:
    """Feature of each n-gram of a window."""
    a, b, c = (np.uint32(m & 0xFFFFFFFF) for m in mixing_constants(3, seed=10))
    shift = np.uint32(32 - int(np.log2(features)))
    two = code[:-1] * a + code[1:] * b
    at = (two ^ (two >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift
    if len(code) > 2:
        three = two[:-1] + code[2:] * c
        at = np.concatenate((at, (three ^ (three >> np.uint32(15))) * np.uint32(0x297A2D39) >> shift))
    return at


def gram_counts(code: np.ndarray, features: int = FEATURES) -> np.ndarray:
    """Log-scaled n-gram counts of a window."""
    return np.log1p(np.bincount(gram_places(code, features), minlength=features)).astype(np.float32)


class WindowCounts:
    """n-gram counts of windows as the features that occur (16 bits) and their counts (a window's n-grams are fewer than
    2^16). Rows become dense a selection at a time, so the driver never holds all windows by all features."""

    def __init__(self, places: list[bytes], counts: list[bytes], features: int = FEATURES):
        self.features = features
        self.start = np.cumsum([0] + [len(p) // 2 for p in places])
        self.places = np.frombuffer(b"".join(places), np.uint16)
        self.counts = np.frombuffer(b"".join(counts), np.uint16)

    def __len__(self) -> int:
        return len(self.start) - 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        """Log-scaled counts of the windows ``rows``."""
        out = np.zeros((len(rows), self.features), np.float32)
        for line, r in zip(out, rows):
            own = slice(self.start[r], self.start[r + 1])
            line[self.places[own]] = np.log1p(self.counts[own].astype(np.float64))
        return out

    def windows_with(self, rows: np.ndarray) -> np.ndarray:
        """Of each feature, how many of the windows ``rows`` have it."""
        out = np.zeros(self.features, np.int64)
        for r in rows:
            out[self.places[self.start[r]:self.start[r + 1]]] += 1
        return out


@dataclass
class Centroids:
    langs: list[str]
    owner: np.ndarray  # language of each centroid
    idf: np.ndarray
    means: np.ndarray  # unit rows
    floors: np.ndarray  # least accepted cosine by BINS

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = counts * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def cosines(self, vectors: np.ndarray) -> np.ndarray:
        """Of each vector, the best cosine in each language."""
        sims = vectors @ self.means.T
        return np.stack([sims[:, self.owner == k].max(axis=1) for k in range(len(self.langs))], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        if not len(self.langs):
            return [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), int)
        cut = np.ones(len(texts), int)
        grams, owner = [], []

        def score():
            if grams:
                np.add.at(sums, owner, self.cosines(self.vectors(np.stack(grams))))
                grams.clear()
                owner.clear()

        for i, text in enumerate(texts):
            code = letters(text)
            n[i], parts = (code != _BLANK).sum(), windows(code)
            cut[i] = max(1, len(parts))
            for part in parts:
                grams.append(gram_counts(part, len(self.idf)))
                owner.append(i)
                if len(grams) == CHUNK:
                    score()
        score()
        mean = sums / cut[:, None]
        cosine = np.where(n > 0, np.clip(mean.max(axis=1), 0, 1), 0)
        lang = [self.langs[b] if k else UND for b, k in zip(mean.argmax(axis=1), n)]
        return lang, cosine, (n == 0) | (cosine < self.floors[np.searchsorted(BINS, n, side="right") - 1])


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from rows spread over the first principal order; deterministic."""
    k = min(k, len(x))
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    means = x[order[((np.arange(k) + 0.5) * len(x) / k).astype(int)]]
    for _ in range(ROUNDS):
        near = (x @ means.T).argmax(axis=1)
        means = np.stack([x[near == j].sum(axis=0) if (near == j).any() else means[j] for j in range(k)])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    return means


def _fit(counts: WindowCounts, rows: np.ndarray, langs: np.ndarray, k: int) -> Centroids:
    """A model of the windows ``rows``; one language's windows are dense at a time."""
    names = sorted(set(langs[rows].tolist()))
    idf = (np.log((1 + len(rows)) / (1 + counts.windows_with(rows))) + 1).astype(np.float32)
    model = Centroids(names, np.zeros(0, int), idf, np.zeros((0, counts.features), np.float32), np.zeros(len(BINS) - 1))
    if names:
        means = [_k_means(model.vectors(counts.dense(rows[langs[rows] == name])), k) for name in names]
        model.means = np.concatenate(means).astype(np.float32)
        model.owner = np.repeat(np.arange(len(names)), [len(m) for m in means])
    return model


def fit_centroids(counts: WindowCounts, text: np.ndarray, piece: np.ndarray, n_letters: np.ndarray, langs: list[str],
                  k: int = CENTROIDS) -> Centroids:
    """A model of windows: ``text`` is the number of the text of each and ``n_letters`` that text's letters.
    Where ``piece`` is set it is a short piece instead, which only tells what texts of its length reach."""
    of = np.array(langs, object)
    model = _fit(counts, np.flatnonzero(~piece), of, k)
    # floors: each text's cosine in a model that has not seen it
    fold = np.zeros(len(text), int)
    for name in model.langs:
        own = of == name
        fold[own] = np.unique(text[own], return_inverse=True)[1] % FOLDS
    top, size = [], []
    for f in range(FOLDS):
        out = fold == f
        seen = _fit(counts, np.flatnonzero(~out & ~piece), of, k)
        out &= np.isin(of, seen.langs)
        if not out.any():
            continue
        _, first, home, cut = np.unique(2 * text[out] + piece[out], return_index=True, return_inverse=True, return_counts=True)
        sums = np.zeros((len(first), len(seen.langs)))
        left = np.flatnonzero(out)
        for c in range(0, len(left), CHUNK):
            np.add.at(sums, home[c:c + CHUNK], seen.cosines(seen.vectors(counts.dense(left[c:c + CHUNK]))))
        top.append((sums / cut[:, None]).max(axis=1))
        size.append(n_letters[out][first])
    if top:
        top, bins = np.concatenate(top), np.searchsorted(BINS, np.concatenate(size), side="right") - 1
        for b in range(len(BINS) - 1):
            if (bins == b).sum() >= 20:
                model.floors[b] = MARGIN * np.quantile(top[bins == b], LOWEST)
            elif b:  # too few of this length: longer texts have larger cosines, so the floor of shorter ones holds
                model.floors[b] = model.floors[b - 1]
    return model


def held_out(name: str = "doc_id") -> Column:
    return id_crc(name) % 4 == 2


_WINDOW_NAMES = ["doc_id", "lang", "piece", "n", "places", "counts"]


def _sparse(code: np.ndarray) -> tuple[bytes, bytes]:
    places, counts = np.unique(gram_places(code), return_counts=True)
    return places.astype(np.uint16).tobytes(), counts.astype(np.uint16).tobytes()


def _count_grams(batches):
    """Of each training text TRAIN_WINDOWS windows spread over it, and from its middle a piece of one of the lengths PIECES."""
    for b in batches:
        rows = []
        for doc, lang, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
            code = letters(text)
            parts = windows(code)
            some = sorted({int((j + 0.5) * len(parts) / TRAIN_WINDOWS) for j in range(TRAIN_WINDOWS)}) if parts else []
            rows += [(doc, lang, False, int((code != _BLANK).sum()), *_sparse(parts[j])) for j in some]
            size = PIECES[doc % len(PIECES)]
            if len(code) > 2 * size:
                code = code[(len(code) - size) // 2:][:size]
                rows.append((doc, lang, True, int((code != _BLANK).sum()), *_sparse(code)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], names=_WINDOW_NAMES)


def training_ids(spark: SparkSession, docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """t_id of at most ``max_rows`` texts with a language, not held out: each language's first by hash."""
    ids = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = ids.select(F.col("doc_id").alias("t_id"), F.col("lang").alias("t_lang"))
    sizes = written(spark, ids.groupBy("t_lang").agg(F.count("*").alias("t_rows")), "language-sizes")
    share = max(1, max_rows // max(1, sizes.count()))
    # rows above a hash that some four times the share of their language lie below cannot be among its first;
    # they stay out of the window, which so sorts as few rows at any size
    at = F.xxhash64("t_id") / F.lit(2.0 ** 64) + F.lit(0.5)
    ids = ids.join(sizes, "t_lang").where(at * F.col("t_rows") <= F.lit(4.0 * share + 64))
    pick = F.row_number().over(W.partitionBy("t_lang").orderBy(F.xxhash64("t_id"), "t_id"))
    return ids.withColumn("r", pick).where(F.col("r") <= share).select("t_id")


def train(spark: SparkSession, docs: DataFrame, max_rows: int = MAX_ROWS) -> Centroids:
    """Fit on at most ``max_rows`` texts with a language whose id is not held out."""
    ship(spark)
    ids = training_ids(spark, docs, max_rows)
    rows = docs.join(F.broadcast(ids), docs.doc_id == ids.t_id, "left_semi").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").mapInArrow(
        _count_grams, "doc_id long, lang string, piece boolean, n bigint, places binary, counts binary")
    got = rows.toArrow()
    # the fit does not depend on the order of arrival
    got = got.sort_by([(c, "ascending") for c in ("lang", "doc_id", "piece", "n", "places", "counts")])
    counts = WindowCounts(got["places"].to_pylist(), got["counts"].to_pylist())
    meta = {c: got[c].to_pylist() for c in ("doc_id", "lang", "piece", "n")}
    del got
    text = np.unique(np.array(meta["doc_id"], np.int64), return_inverse=True)[1]
    return fit_centroids(counts, text, np.array(meta["piece"], bool), np.array(meta["n"], int), meta["lang"])


def identify(spark: SparkSession, docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (cosine), rejected."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model or train(spark, docs))

    def predict(batches):
        for b in batches:
            lang, cosine, rejected = shared.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()),
                                              pa.array(cosine), pa.array(rejected)], names=PREDICTION.names)
            give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, PREDICTION)


def drop_rejected(spark: SparkSession, docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """``docs`` without the rows the model rejects, all columns kept; one map-only pass."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model or train(spark, docs))

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(~shared.value.predict(b.column("text").to_pylist())[2]))
            give_back()

    return docs.mapInArrow(keep, docs.schema)
