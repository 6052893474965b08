"""Collocations, interpolated scores, centroid clustering."""
import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewtide.llm import centroids, collocations, interpolation
from viewtide.llm import packed as pk

from llm_helpers import LOWER, SPACE_WORD, same_as_sql

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- collocations

def brute_phrases(rows, least, longest=4):
    """{(lang, words): f} and {lang: n} by listing every phrase."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return {k: v for k, v in f.items() if v >= least}, n


def brute_collocations(rows, least, top):
    f, n = brute_phrases(rows, least)
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or any(100 * f[lang, x] >= 80 * a for l, x in f if l == lang and len(x) > len(w)
                             and any(x[i:i + len(w)] == w for i in range(len(x)))):
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def mined(df, **how):
    return sorted(map(tuple, collocations.collocations(df.sparkSession, df, **how).collect()))


def test_collocations_as_sql(spark, odd, none):
    same_as_sql(collocations.collocations(spark, spark.read.parquet(f"{SF}/documents.parquet")), "op11_collocations",
                documents=spark.read.parquet(f"{SF}/documents.parquet"))
    same_as_sql(collocations.collocations(spark, odd), "op11_collocations", documents=odd)
    assert collocations.collocations(spark, none).count() == 0


@pytest.mark.parametrize("least", [1, 2, 5])
def test_collocations_against_brute_force(spark, docs, odd, least, monkeypatch):
    """Small blocks, parts and tiles, so that every count meets others; dense and sparse tiles alike."""
    monkeypatch.setattr(pk, "PART_KEYS", 700)
    monkeypatch.setattr(pk, "BLOCK_TOKENS", 900)
    texts = [("a b a b a b, a a a a! B\ta b", "x"), (None, "x"), ("", None), ("a b . a b", None), ("a b", "und")] * 7
    small = spark.createDataFrame(texts, "text string, lang string")
    assert mined(small, least=least, top=5) == brute_collocations(texts, least, 5)
    some = docs.where("doc_id < 60").select("text", "lang").unionByName(odd.select("text", "lang").where("length(text) < 1000"))
    rows = [tuple(r) for r in some.collect()]
    if least > 1:
        assert mined(some.repartition(3), least=least, top=10 ** 6) == brute_collocations(rows, least, 10 ** 6)


@pytest.mark.parametrize("weighted", [False, True])
def test_tile_counts(weighted, monkeypatch):
    monkeypatch.setattr(collocations, "TILE_BITS", 3)
    r = np.random.default_rng(1)
    left = np.where(r.random(5000) < 0.5, r.integers(1, 8, 5000), r.integers(1, 1 << 30, 5000))
    right = np.where(r.random(5000) < 0.7, r.integers(1, 20, 5000), r.integers(1, 1 << 27, 5000))
    codes = left << collocations.WORD_BITS | right
    weights = r.integers(1, 100, 5000) if weighted else np.ones(5000, int)
    want = collections.Counter()
    for c, w in zip(codes.tolist(), weights.tolist()):
        want[c] += w
    got = collocations.tile_counts(codes, weights if weighted else None)
    assert dict(zip(got[0].tolist(), got[1].tolist())) == want and len(got[0]) == len(want)
    assert [len(x) for x in collocations.tile_counts(codes[:0], weights[:0] if weighted else None)] == [0, 0]


def test_tile_pieces_keep_a_part_bounded():
    for blocks in (1, 10, 1000, 10 ** 6, 10 ** 9):
        bits = collocations.piece_bits(blocks)
        cells = 1 << (2 * collocations.TILE_BITS - bits)
        assert cells * blocks <= 2 * pk.PART_KEYS or cells == 1
    code = (5 << collocations.WORD_BITS | 7) + np.zeros(3, np.int64)
    assert len(set(collocations._tile_parts(code, 97, 4).tolist())) == 1


# ---------------------------------------------------------------- interpolation

def tokens_of(text):
    return SPACE_WORD.findall((text or "").translate(LOWER)) + [""]


def crc(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode())


def brute_scores(rows, gone, weights=None):
    """Rows (doc_id, text) scored token by token; ``gone`` says which ids are deleted for the weights."""
    train = [(d, tokens_of(t)) for d, t in rows if crc(d) % 7 != 2]
    pairs = lambda ts: zip([""] + ts[:-1], ts)
    c1, c2 = collections.Counter(w for _, ts in train for w in ts), collections.Counter(p for _, ts in train for p in pairs(ts))
    left = [(d, ts) for d, ts in train if d not in gone]
    k1, k2 = collections.Counter(w for _, ts in left for w in ts), collections.Counter(p for _, ts in left for p in pairs(ts))
    total, types, kept = sum(c1.values()), len(c1), sum(k1.values())
    bucket = lambda n: min(n.bit_length(), interpolation.BUCKETS - 1)
    if weights is None:
        cells = {}
        for d, ts in train:
            for v, w in pairs(ts) if d in gone else ():
                p = (k2[v, w] / k1[v] if k1[v] else 0, k1[w] / kept if kept else 0)
                log = [math.log2(x) if x else 0.0 for x in p]
                key = (bucket(k1[v]), *[math.floor(-2 * g) if x else -1 for x, g in zip(p, log)])
                n, a, b = cells.get(key, (0, 0.0, 0.0))
                cells[key] = (n + 1, a + log[0], b + log[1])
        weights = interpolation.learn_weights(sorted((*k, *v) for k, v in cells.items()), types)
    out = []
    for d, t in rows:
        ts = tokens_of(t)
        base = sum(math.log10((c1[w] + 1) / (total + types + 1)) for w in ts)
        score = 0.0
        for v, w in pairs(ts):
            l2, l1, l0 = weights[bucket(c1[v])]
            score += math.log10(l2 * (c2[v, w] / c1[v] if c1[v] else 0) + l1 * (c1[w] / total if total else 0) + l0 / (types + 1))
        out.append((d, crc(d) % 7 == 2, len(ts), sum(c1[w] > 0 for w in ts), total, base, score))
    return out, weights


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_scores_against_brute_force(spark, table, request, monkeypatch):
    monkeypatch.setattr(pk, "PART_KEYS", 3000)
    monkeypatch.setattr(pk, "BLOCK_TOKENS", 5000)
    df = request.getfixturevalue(table)
    gone = {r[0] for r in df.where(interpolation.deleted()).select("doc_id").collect()}
    want, weights = brute_scores([tuple(r) for r in df.select("doc_id", "text").collect()], gone)
    out = interpolation.score_texts(spark, df.repartition(3))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close([tuple(r) for r in out.collect()], want)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[1:] > 0).all()


def test_scores_of_empty_and_unlearned_tables(spark, none, odd):
    assert interpolation.score_texts(spark, none).count() == 0
    held = spark.range(200).where(interpolation.held_out("id")).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    got = interpolation.score_texts(spark, held).collect()
    assert got and {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(3, 0, 0, 0.0)}


def test_model_beats_the_base_on_held_out_texts_and_sums_to_one(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = interpolation.score_texts(spark, df).where("held_out").collect()
    assert rows and sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)  # log probabilities: at least a tenth less surprise
    few = [(i, "a b a c") for i in range(40)]
    _, weights = brute_scores(few, {d for d, _ in few[:5]})
    text = {"a": 80, "b": 40, "c": 40, "": 40}
    after = {"a": {"b": 40, "c": 40}, "b": {"a": 40}, "c": {"": 40}, "": {"a": 40}}
    for v, n in text.items():
        l2, l1, l0 = weights[n.bit_length()]
        p = [l2 * after[v].get(w, 0) / n + l1 * m / 200 + l0 / 5 for w, m in text.items()]
        assert math.isclose(sum(p) + l0 / 5, 1)


def test_weights_are_the_most_likely_ones():
    cells = [(3, 1, 5, 40, -20.0, -100.0), (3, -1, 5, 10, 0.0, -50.0), (3, -1, -1, 5, 0.0, 0.0), (3, 4, 9, 20, -40.0, -90.0)]
    w = interpolation.learn_weights(cells, 50)

    def likelihood(l):
        return sum(n * math.log(l[0] * (2 ** (a / n) if h >= 0 else 0) + l[1] * (2 ** (b / n) if k >= 0 else 0) + l[2] / 51)
                   for _, h, k, n, a, b in cells)

    grid = [(a / 100, b / 100, 1 - (a + b) / 100) for a, b in itertools.product(range(1, 99), repeat=2) if a + b < 100]
    assert likelihood(w[3]) >= max(map(likelihood, grid)) - 1e-3
    assert np.allclose(w[4], w[3]) and np.allclose(w[1], 1 / 3)  # no deleted token: as the bucket below, or as at the start


# ---------------------------------------------------------------- centroids

def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{extra}")


def brute_clusters(rows, k=16, rounds=3):
    """All distances in Python integers."""
    kept = [(i, [math.floor(64 * x) if abs(x) < 2 ** 50 else int(x) * 64 for x in e]) for i, e in rows if e is not None and len(e) == 64
            and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        for j, vs in own.items():
            cents[j] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = collections.Counter()
    for _, d, j in out:
        per[j] += d
    fits = lambda v: v if v < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, j, fits(d), fits(per[j]), fits(sum(per.values())), digest[j]) for i, d, j in out]


def same_clusters(spark, rows, **how):
    key = lambda r: tuple((v is None, v or 0) for v in r[:3])
    got = [tuple(r) for r in centroids.cluster(spark, vectors(spark, rows).repartition(3), **how).collect()]
    assert sorted(got, key=key) == sorted(brute_clusters(rows, **how), key=key)


def test_clusters_as_sql(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    same_as_sql(centroids.cluster(spark, e), "op13_centroids", embeddings=e)


def test_clusters_against_brute_force(spark):
    r = np.random.default_rng(3)
    same_clusters(spark, [(i, v.tolist()) for i, v in enumerate(r.normal(size=(150, 64)))])
    # ties: few distinct points on a grid, repeated rows and ids
    grid = [(i % 40, (r.integers(0, 2, 64) / 64 * (np.arange(64) < 3)).tolist()) for i in range(120)]
    same_clusters(spark, grid + grid[:30])
    same_clusters(spark, [(i, v.tolist()) for i, v in enumerate(r.normal(size=(90, 64)))], k=40, rounds=2)


def test_clusters_of_odd_rows(spark):
    one = [0.5] * 64
    odd = [(1, None), (2, []), (3, one[:63]), (4, one + [1.0]), (5, one[:63] + [None]), (6, one[:63] + [float("nan")]),
           (7, one[:63] + [float("inf")]), (None, one), (8, one), (8, one), (9, [-0.01] * 64)]
    same_clusters(spark, odd)  # fewer vectors than centroids
    wide = [(10, [1e30] * 64), (11, [-3e9] + one[:63]), (12, [2.0 ** 21] * 64), (13, [-(2.0 ** 21)] * 64)]
    same_clusters(spark, odd + wide, k=3)
    assert centroids.cluster(spark, vectors(spark, odd[:7])).count() == 0
    assert centroids.cluster(spark, vectors(spark, []).withColumn("cluster", F.lit(1)).withColumn("c", F.lit("x"))).count() == 0
    clash = vectors(spark, [(1, one)]).selectExpr("*", "'x' cluster", "1 distance", "2 c", "3 inertia")
    assert [r.distance for r in centroids.cluster(spark, clash).collect()] == [0]


def test_tree_search_is_exact():
    r = np.random.default_rng(5)
    for n in (1, 2, 5, 16, 200):
        c = r.integers(-3, 4, (n, 64)) * (np.arange(64) < 4)
        x = r.integers(-4, 5, (500, 64)) * (np.arange(64) < 4)
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        who, best = centroids.search(centroids.build_tree(c.tolist()), x)
        assert (best == d.min(axis=1)).all() and (who == d.argmin(axis=1)).all()


def test_tree_prunes():
    r = np.random.default_rng(6)
    c = r.integers(-1000, 1000, (400, 64)) * (np.arange(64) < 2)
    tree = centroids.build_tree(c.tolist())
    met = []
    real = centroids._squared
    try:
        centroids._squared = lambda x, y: met.append(len(x)) or real(x, y)
        centroids.search(tree, r.integers(-1000, 1000, (300, 64)) * (np.arange(64) < 2))
    finally:
        centroids._squared = real
    assert sum(met) < 0.25 * 300 * 400
