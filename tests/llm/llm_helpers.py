"""Brute-force versions that the tests compare with."""
import collections
import re

import duckdb
from tools.oracle_check import digest
from viewtide.llm.queries import ORACLE_SQL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names clash with those the operators make
CLASH = ("norm string, keep_id string, text_sha256 string, size string, key string, range string, n string, hits string, "
         "component_id string, fp string, base string, held_out string, score string, part string, host string, gone string")


def run_sql(name, **tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df.toArrow())
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    return digest(res.fetchall(), cols)[1], cols


def same_as_sql(df, name, **tables):
    want, cols = run_sql(name, **tables)
    assert sorted(cols) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns)[1] == want


SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    """{doc_id: (n_shingles, smallest id reachable)} by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    lists = collections.defaultdict(list)
    for d, s in sets.items():
        for k in s:
            lists[k].append(d)
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, s in sets.items():
        for b in {d for k in s for d in lists[k] if d > a}:
            both = len(s & sets[b])
            if 100 * both >= 80 * (len(s) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items, window=13):
    """(n_words, n_hit, items that occur) by comparing every window with every position."""
    words = BENCH_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), []
    for item, body in items:
        iw = BENCH_WORD.findall((body or "").translate(LOWER))
        n = min(window, len(iw))
        grams = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        at = [i for i in range(len(words) - n + 1) if tuple(words[i:i + n]) in grams] if grams else []
        for i in at:
            hit.update(range(i, i + n))
        if at:
            found.append(str(item))
    return len(words), len(hit), sorted(found)
