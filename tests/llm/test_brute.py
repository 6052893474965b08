"""Models against term-by-term versions; the pipeline on empty tables."""
import collections
import math

import numpy as np

import corpus_pipeline
from viewtide.llm import lang_id, toxicity


def test_margins_are_sums_over_all_pairs():
    r = np.random.default_rng(1)
    linear, factors = r.normal(size=9), r.normal(size=(9, 4))
    rows = [set(), {3}, {0, 1}, {0, 2, 4, 5, 8}, set(range(9))]
    want = [0.3 + sum(linear[i] for i in t) + sum(float(factors[i] @ factors[j]) for i in t for j in t if i < j) for t in rows]
    got, sums, flat, owner = toxicity._margins(rows, 0.3, linear, factors)
    assert np.allclose(got, want)
    # the derivative by a factor that training uses: the sum of the row's other factors
    e = 1e-6
    for row, term, k in ((3, 4, 1), (4, 0, 3), (2, 1, 0)):
        up = factors.copy()
        up[term, k] += e
        slope = (toxicity._margins(rows, 0.3, linear, up)[0][row] - got[row]) / e
        assert math.isclose(slope, sums[row, k] - factors[term, k], rel_tol=1e-4, abs_tol=1e-6)


def test_scores_are_logistic_margins_of_known_terms():
    model = toxicity.fit([np.array(sorted(toxicity.term_buckets(t)), "<u4") for t in ["bad them"] * 40 + ["bad day", "nice them", "nice day"] * 20],
                         np.array([1] * 40 + [0] * 60))
    texts = ["bad them", "Bad? nice!", "", None, "unknown words", "bad them bad them"]
    for text, score in zip(texts, model.score(texts)):
        own = sorted({model.index[b] for b in toxicity.term_buckets(text) if b in model.index})
        margin = model.bias + sum(model.linear[i] for i in own) + sum(
            float(model.factors[i] @ model.factors[j]) for n, i in enumerate(own) for j in own[n + 1:])
        assert math.isclose(score, 1 / (1 + math.exp(-margin)), rel_tol=1e-9)
    both, one = model.score(["bad them", "bad day"])
    assert both > 0.5 > one  # told apart by the pair alone: either word stands in clean texts too


def plain_cosines(model, text):
    """Per language the best centroid's cosine on average over the windows, with dictionaries and loops."""
    parts = lang_id.windows(lang_id.letters(text))
    out = collections.defaultdict(float)
    for part in parts:
        weight = {f: math.log1p(n) * float(model.idf[f]) for f, n in collections.Counter(lang_id.gram_places(part).tolist()).items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        for k, lang in enumerate(model.langs):
            out[lang] += max(sum(w * float(m[f]) for f, w in weight.items()) / norm for m, o in zip(model.means, model.owner) if o == k) / len(parts)
    return out


def test_language_scores_against_plain_cosines(spark, docs):
    model = lang_id.train(spark, docs)
    texts = [r.text for r in docs.where("length(text) < 3000").limit(12).collect()] + ["Kurz", "ein Wort mehr", "été"]
    langs, scores, _ = model.predict(texts)
    for text, lang, score in zip(texts, langs, scores):
        want = plain_cosines(model, text)
        assert lang == max(sorted(want), key=want.get) and math.isclose(score, max(want.values()), abs_tol=1e-4)


def test_training_windows_dense_and_sparse_agree():
    parts = [lang_id.letters(t) for t in ("abc abc ein zwei", "x", "drei vier fünf " * 30)]
    counts = lang_id.WindowCounts(*zip(*(lang_id._sparse(p) for p in parts)))
    assert len(counts) == 3
    assert np.array_equal(counts.dense(np.arange(3)), np.stack([lang_id.gram_counts(p) for p in parts]))
    assert np.array_equal(counts.windows_with(np.array([0, 2])), (counts.dense(np.array([0, 2])) > 0).sum(axis=0))


def test_pipeline_of_empty_tables(spark, docs, tmp_dir):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs.limit(0).write.parquet(f"{tmp_dir}/documents.parquet")
    bench.limit(0).write.parquet(f"{tmp_dir}/benchmark.parquet")
    out = corpus_pipeline.run(spark, tmp_dir)
    assert out.count() == 0 and {"doc_id", "start", "n_tokens", "ids_crc32"} == set(out.columns)
