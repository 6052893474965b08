"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import (centroids, collocations, decontam, exact_dedup, html_main, interpolation, jaccard_join, lang_id, line_dedup,
               mixing, pii, token_files, toxicity)

LINE_MIN_SITES = 4


def q_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_personal_data(spark, read_table(spark, sf, "documents"))


def q_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.remove_boilerplate_lines(spark, read_table(spark, sf, "documents"), LINE_MIN_SITES)


def q_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_main.extract_main_text(spark, read_table(spark, sf, "pages"))


def q_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_toxicity(spark, read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def q_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(spark, read_table(spark, sf, "documents"))


def q_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_output(spark, read_table(spark, sf, "documents"))


def q_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.contamination(spark, read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return found.drop("hits")


def q_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf, "documents"))


def q_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def q_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return lang_id.identify(spark, read_table(spark, sf, "documents"))


def q_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(spark, read_table(spark, sf, "documents"))


def q_interpolation(spark: SparkSession, sf: str) -> DataFrame:
    return interpolation.score_texts(spark, read_table(spark, sf, "documents"))


def q_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(spark, read_table(spark, sf, "embeddings"))


def q_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": q_personal_data,
    "op2_line_dedup": q_line_dedup,
    "op3_main_text": q_main_text,
    "op4_toxicity": q_toxicity,
    "op5_jaccard_join": q_jaccard_join,
    "op6_token_files": q_token_files,
    "op7_decontaminate": q_decontaminate,
    "op8_exact_dedup": q_exact_dedup,
    "op9_mix": q_mix,
    "op10_language_id": q_language_id,
    "op11_collocations": q_collocations,
    "op12_interpolation": q_interpolation,
    "op13_centroids": q_centroids,
    "pipeline": q_pipeline,
}



def _centroids_sql(k: int, rounds: int) -> str:
    """k-means unrolled: c0 the first centroids, a<i> the assignment to them, c<i> the centroids after round i."""
    parts = [f"""
        WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x))::INTEGER - 1 AS c, x FROM v
               QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
        a{i} AS (SELECT rid, vec_id, x, unnest((SELECT list((c, cx)) FROM (SELECT c, x AS cx FROM c{i}))) AS p FROM v),
        d{i} AS (SELECT rid, vec_id, x, p[1] AS c, list_sum(list_transform(list_zip(x, p[2]), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT AS d FROM a{i}),
        n{i} AS (SELECT rid, vec_id, x, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if i < rounds:
            parts.append(f"""
        s{i} AS (SELECT c, j, sum(e) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM n{i}) GROUP BY c, j),
        m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM s{i} GROUP BY c),
        c{i + 1} AS (SELECT c{i}.c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} ON c{i}.c = m{i}.c)""")
    return ",".join(parts) + f"""
        SELECT vec_id, n{rounds}.c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY n{rounds}.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
        FROM n{rounds} JOIN c{rounds} ON n{rounds}.c = c{rounds}.c"""


_SPACES = r"[\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": rf"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(0)) AS site, coalesce(text, '') AS text
                   FROM documents),
        parts AS (SELECT rid, site, unnest(string_split(text, chr(10))) AS raw,
                         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
        l AS (SELECT rid, site, pos, raw, regexp_replace(raw, '^{_SPACES}|{_SPACES}$', '', 'g') AS line FROM parts),
        bad AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {LINE_MIN_SITES}),
        marked AS (SELECT rid, pos, raw, line, line <> '' AND line IN (SELECT line FROM bad) AS gone FROM l),
        per AS (SELECT rid, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
                       string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone) AS text FROM marked GROUP BY rid)
        SELECT d.doc_id, per.n_lines, per.n_removed, coalesce(per.text, '') AS text FROM d JOIN per USING (rid)""",
    "op8_exact_dedup": rf"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') AS norm FROM documents),
        g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, false) AS kept,
               sha256(d.norm) AS text_sha256 FROM d JOIN g USING (norm)""",
    "op9_mix": rf"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                          md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
        s0 AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
        s1 AS (SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
               FROM s0),
        s2 AS (SELECT *, source_size * 3 / weight AS dry FROM s1),
        s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER w, 0)) /
                         (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS candidate FROM s2
               WINDOW w AS (ORDER BY dry, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        lvl AS (SELECT candidate AS level FROM s3 WHERE candidate <= dry ORDER BY dry, candidate LIMIT 1),
        s AS (SELECT s3.*, least(source_size * 3, coalesce(level, 0) * weight)::DOUBLE AS target FROM s3 LEFT JOIN lvl ON true),
        q AS (SELECT d.*, s.source_size, s.weight, s.target,
                     sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
              FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
        c AS (SELECT q.*, copy, ((copy - 1) * source_size + run) / weight AS vft FROM q, unnest([1, 2, 3]) AS t(copy)
              WHERE size > 0),
        o AS (SELECT *, sum(size) OVER (ORDER BY vft, key, doc_id, size, copy
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM c),
        t AS (SELECT doc_id, key, size, run, sum(size) AS taken FROM o
              WHERE upto <= (SELECT sum(size) FROM d) GROUP BY ALL)
        SELECT q.doc_id, q.size::BIGINT AS size, q.source_size::BIGINT AS source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
        FROM q LEFT JOIN t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.key = t.key AND q.size = t.size AND q.run = t.run""",
    "op11_collocations": rf"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS words
              FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
        w AS (SELECT lang, pid, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM p),
        g AS (SELECT lang, w AS a, lead(w, 1) OVER x AS b, lead(w, 2) OVER x AS c, lead(w, 3) OVER x AS d FROM w
              WINDOW x AS (PARTITION BY pid ORDER BY pos)),
        n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
        f AS (SELECT lang, [a] AS ws, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, [a, b], count(*) FROM g WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, [a, b, c], count(*) FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, [a, b, c, d], count(*) FROM g WHERE d IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
        inner_ AS (SELECT lang, ws[i:i + k - 1] AS ws, max(f) AS longer FROM f, unnest([1, 2, 3]) AS t(i), unnest([2, 3]) AS u(k)
                   WHERE k < len(ws) AND i + k - 1 <= len(ws) GROUP BY ALL),
        kept AS (SELECT f.lang, f.ws, f.f AS a FROM f LEFT JOIN inner_ USING (lang, ws)
                 WHERE len(f.ws) > 1 AND (longer IS NULL OR 100 * longer < 80 * f.f)),
        cuts AS (SELECT k.lang, k.ws, a, l.f AS l, r.f AS r, cut, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
                 FROM (SELECT *, unnest(range(1, len(ws))) AS cut FROM kept) k
                 JOIN f l ON l.lang = k.lang AND l.ws = k.ws[1:cut] JOIN f r ON r.lang = k.lang AND r.ws = k.ws[cut + 1:]),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) = 1),
        ranked AS (SELECT *, array_to_string(ws, ' ') AS phrase,
                          row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_centroids": _centroids_sql(centroids.CLUSTERS, centroids.ROUNDS),
}
