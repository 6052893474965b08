import random

import pytest
from pyspark.sql import functions as F

from viewtide.llm import components, exact_dedup, jaccard_join, line_dedup
from viewtide.llm.queries import LINE_MIN_SITES

from llm_helpers import brute_components, same_as_sql, shingles


def test_exact_dedup_odd_rows(odd, none):
    same_as_sql(exact_dedup.exact_dedup(odd), "op8_exact_dedup", documents=odd)
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 4, 5, 6, 7, 10, 11, 12}


@pytest.mark.parametrize("hash_of", [lambda t: F.lit(b"\x00"), lambda t: F.substring(F.unhex(F.md5(t)), 1, 1)])
def test_exact_dedup_excludes_collisions(docs, odd, hash_of):
    for rows in (docs, odd):
        same_as_sql(exact_dedup.exact_dedup(rows, hash_of), "op8_exact_dedup", documents=rows)


def test_drop_copies_goes_by_class(spark):
    rows = [(3, "T"), (7, "T"), (7, "own"), (None, "unique"), (None, "T"), (9, "a  b"), (8, "a b"), (8, "a b")]
    kept = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, "T"), (7, "own"), (None, "unique"), (8, "a b"), (8, "a b")], key=str)


def test_long_documents_of_boilerplate_lines(spark):
    """Some 20,000 boilerplate lines in a document; a search of each line among them took minutes."""
    lines = [f"line {i}" for i in range(20_000)]
    rows = [(k, "\n".join(lines + [f"own {k}"]), f"s{k}") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup.remove_boilerplate_lines(spark, docs, LINE_MIN_SITES).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == [(k, 20_001, 20_000, f"own {k}") for k in range(4)]


def test_line_dedup_odd_rows(spark, odd, none):
    same_as_sql(line_dedup.remove_boilerplate_lines(spark, odd, LINE_MIN_SITES), "op2_line_dedup", documents=odd)
    assert line_dedup.remove_boilerplate_lines(spark, none).count() == 0


@pytest.mark.parametrize("sites", [2, 3, 4, 5, 40])
def test_line_dedup_near_the_threshold(spark, sites):
    rows = [(100 * k + s, f"line {k}\nown {k} {s}\n \n  line {k} ", "en", f"s{s}", 0)
            for k in range(1, 7) for s in range(k if sites < 40 else sites + k - 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in line_dedup.remove_boilerplate_lines(spark, docs, sites).collect()}
    for d, *_ in rows:
        k = d // 100
        gone = (k if sites < 40 else sites + k - 4) >= sites
        assert out[d].n_lines == 3 and out[d].n_removed == (2 if gone else 0)
        assert out[d].text == (f"own {k} {d % 100}\n " if gone else f"line {k}\nown {k} {d % 100}\n \n  line {k} ")


def near_copies(seed, groups=12, n=9):
    """Texts at every distance around the limit, small and large, with a shared passage."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(r.choice([1, 3, 5, 6, 8, 12, 25, 90, 300]))] + (passage if g % 3 == 0 else [])
        for k in range(n):
            t = list(base)
            for _ in range(r.randrange(0, 1 + len(t) // 25 + (k % 3))):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.3:
                t = t + [word() for _ in range(r.randrange(1 + len(t) // 6))]
            rows.append(" ".join(t).upper() if r.random() < 0.2 else "  ".join(t))
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_is_exact(spark, seed):
    rows = near_copies(seed)
    out = jaccard_join.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_components(rows)


@pytest.mark.parametrize("boundary", [0, 10, 10_000])
def test_jaccard_join_at_any_boundary(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "boundary_by_cost", lambda parts: boundary)
    monkeypatch.setattr(jaccard_join, "BATCH_DOCS", 7)
    rows = near_copies(5, groups=8)
    out = jaccard_join.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_components(rows)


def test_jaccard_join_odd_rows(spark, odd, none):
    out = [tuple(r) for r in jaccard_join.jaccard_components(spark, odd).collect()]
    assert sorted(r[1:] for r in out if r[0] is None) == [(0, None), (1, None)]  # a row per document, without a component
    out = sorted(r for r in out if r[0] is not None)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect() if r.doc_id]
    want = brute_components(rows)
    assert out == sorted((d, *want[d]) for d, _ in rows)
    assert want[8] == want[9] == (1, 7) and want[12] == (6, 1) and want[2] == (0, 2) and want[6][1] == 5
    assert jaccard_join.jaccard_components(spark, none).count() == 0
    kept = jaccard_join.one_per_group(spark, odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 7, 10, 11]
    assert kept.where("doc_id is null").count() == 2


def test_jaccard_join_of_repeated_ids(spark):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:58], "x", "y"])
    rows = [(3, " ".join(base), "a"), (7, near, "b"), (7, "a text of its own that is like no other one", "c"), (8, near, "d"),
            (20, "two equal rows with one id here", "e"), (20, "two equal rows with one id here", "e"),
            (30, " ".join(base[::-1]), "f"), (30, " ".join([*base[:1:-1], "x", "y"]), "g"), (None, " ".join(base), "h"), (40, None, "i"), (40, None, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark, docs).collect()]
    assert [r for r in out if r[0] is None] == [(None, 56, None)]
    out = sorted(r for r in out if r[0] is not None)
    want = brute_components([(k, t) for k, (_, t, _) in enumerate(rows)])  # by row
    ids = [d for d, *_ in rows]
    assert out == sorted((d, want[k][0], ids[want[k][1]]) for k, d in enumerate(ids) if d is not None)
    kept = jaccard_join.one_per_group(spark, docs)
    assert sorted(r.source for r in kept.collect()) in (list("acefhii"), list("aceghii")) and kept.columns == docs.columns


def test_repeated_rows_are_verified_once(spark, monkeypatch):
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base))] * 1000 + [(2, " ".join([*base[:58], "x", "y"]))] * 1000 + [(3, "a text of its own")] * 50
    links, real = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda *a: links.append(real(*a)) or links[-1])
    out = jaccard_join.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id", "component_id").count()
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1000), (2, 1, 1000), (3, 3, 50)]
    assert sum(x.count() for x in links) <= 2


def test_jaccard_join_on_the_table(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = jaccard_join.jaccard_components(spark, docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_components(rows)


def test_odd_sketch_is_a_lower_bound():
    import numpy as np
    r = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(r.integers(0, 1 << 62, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.9], r.integers(0, 1 << 62, 20).astype(np.uint64)]))
        bits = sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(jaccard_join.odd_sketch(a), jaccard_join.odd_sketch(b)))
        assert bits <= len(np.setxor1d(a, b))


def test_shingler_matches_sets():
    texts = [None, "", " \n", "a", "a b c d", "A b c d e", "x " * 50, "é É è one two three four five"]
    assert [len(s) for s in jaccard_join.Shingler().sets(texts)] == [len(shingles(t)) for t in texts]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 70), (7, 7), (200, 201), (201, 200)]
    out = {r.node: r.component for r in components.connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 70: 50, 200: 200, 201: 200}
    assert components.connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_packed_shingles_stay_small_in_many_ranges(spark):
    """Packed for far more hash ranges than a set has shingles, a shingle takes about as much as in few ranges."""
    r = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(304))) for i in range(400)], "doc_id long, text string").coalesce(1)
    packed = jaccard_join._keyed(docs).mapInArrow(jaccard_join._pack_documents(700), jaccard_join.PACKED).where("range >= 0")
    size = "sum(octet_length(keys) + octet_length(owners) + octet_length(many))"
    n, size = packed.selectExpr("sum(octet_length(keys)) / 3", size).first()
    assert n > 119_000 and size < 5 * n


@pytest.mark.parametrize("ranges", [1, 3, 24, 133, 255, 256])
def test_offsets_tell_keys_of_a_range_apart(ranges):
    import numpy as np
    keys = np.unique(np.random.default_rng(ranges).integers(0, 1 << 64, 50_000, dtype=np.uint64))
    keys = np.concatenate([[np.uint64(0)], keys, [np.uint64((1 << 64) - 1)]])
    part = np.searchsorted(jaccard_join._starts(ranges), keys, "right") - 1
    assert [(p, part[s].min(), part[s].max()) for p, s in jaccard_join._pieces(keys, ranges)] == [(p, p, p) for p in range(ranges)]
    offsets, each = jaccard_join._read_offsets([jaccard_join._offsets(keys, part, ranges).tobytes()])
    assert each.tolist() == [len(keys)] and (np.diff(part * (1 << 24) + offsets) >= 0).all()
    assert len(np.unique(part * (1 << 24) + offsets)) > 0.99 * len(keys)


def test_shared_shingles_are_counted_across_batches(spark):
    rows = near_copies(4, groups=10)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lists = {}
    for d, t in rows:
        for k in shingles(t):
            lists.setdefault(k, set()).add(d)
    want = {d: sum(len(lists[k]) > 1 for k in shingles(t)) for d, t in rows}
    out = {r.doc_id: (r.n, r.shared) for r in jaccard_join.shingle_sets(spark, docs).collect()}
    assert {d: (len(shingles(t)), want[d]) for d, t in rows} == out  # too few shingles for two to fall together


def test_batch_read_in_pieces_is_counted_whole():
    import numpy as np
    import pyarrow as pa
    sets = [np.array(x, np.uint64) for x in ([1, 5, 1 << 63], [5, 9], [5], [1 << 63, (1 << 63) + 1])]
    rows = pa.record_batch([pa.array([7, 7, 8, 7]), pa.array([s.tobytes() for s in sets])], names=["batch", "keys"])
    table = pa.Table.from_batches([*jaccard_join._count_batches(2)([rows])])
    assert sorted(zip(table["range"].to_pylist(), table["batch"].to_pylist())) == [(0, 7), (0, 8), (1, 7), (1, 7)]
    found = {}
    for part in (0, 1):
        t = jaccard_join._frequencies(table.filter(pa.array([x == part for x in table["range"].to_pylist()])))
        for b, k, c in zip(*(t[x].to_pylist() for x in ("batch", "keys", "counts"))):
            found.update({(b, int(x)): int(y) for x, y in zip(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64))})
    assert found == {(7, 5): 3, (8, 5): 3, (7, 1 << 63): 2}


def test_texts_are_not_shuffled_to_be_filtered(spark, monkeypatch):
    """Dropped keys go to the texts, whatever size Spark broadcasts of itself."""
    rows = near_copies(6, groups=12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard_join.one_per_group(spark, docs)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute_components(rows).values()})
        monkeypatch.setattr(jaccard_join, "small_enough", lambda *a: False)  # beyond that they meet in a shuffle
        kept = jaccard_join.one_per_group(spark, docs)
        assert "SortMergeJoin" in kept._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute_components(rows).values()})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
