"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import ann, collocations, exact_topk, langid, licenses, mixing, packing, passages, pieces, prefix_trie, quality, simhash, suffix_dedup
from tessera.llm.common import read_table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(read_table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_documents(read_table(spark, sf_dir, "documents"))


def op5_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(read_table(spark, sf_dir, "documents"))


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read_table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_array_dedup, op2_exact_topk, op3_language_id, op4_simhash, op5_ann_forest, op6_license_scan, op7_compact_windows,
                              op8_compression_quality, op9_mix_sources, op10_pack,
                              op11_prefix_trie, op12_sentencepiece, op13_collocations)}

#: Vectors are cut into integer components and every query meets every other row.
_OP2 = """
WITH one AS (SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
             WHERE vec_id IS NOT NULL AND len(embedding) > 0
               AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
             GROUP BY vec_id),
     part AS (SELECT vec_id, len(v) AS n, unnest(range(len(v))) AS i,
                     unnest([CAST(floor(1024 * x) AS BIGINT) for x in v]) AS c FROM one),
     score AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.c * d.c) AS BIGINT) AS score
               FROM part q JOIN part d ON q.i = d.i AND q.n = d.n AND q.vec_id <> d.vec_id
               WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM score QUALIFY rank <= 10
"""

_OP9 = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
     r AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::BIGINT AS w,
                  row_number() OVER (ORDER BY encode(source) NULLS LAST) AS r, 2 * source_size AS cap FROM s),
     l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
                      - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                     / (sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM r),
     best AS (SELECT arg_min(level, (cap / w, r)) AS level FROM l WHERE level * w <= cap),
     t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(best.level * w, cap::DOUBLE)) AS target
           FROM l LEFT JOIN best ON true),
     f AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * source_size) AS flow FROM t),
     o AS (SELECT d.doc_id, d.size, f.source_size, f.target, f.flow,
                  CASE WHEN f.source_size > 0 THEN f.flow // f.source_size ELSE 0 END AS whole,
                  CASE WHEN f.source_size > 0 THEN f.flow % f.source_size ELSE 0 END AS rest,
                  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
           FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken,
       (whole + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END)::INTEGER AS times
FROM o
"""

#: Conversations are whole lists of turns here, and a node is the list of its first ones.
_OP11 = """
WITH t AS (SELECT conv_id AS c, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS m,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
     s AS (SELECT c, list(m ORDER BY p) AS v FROM t GROUP BY c),
     k AS (SELECT *, xor(list_reduce(string_split(CAST(c AS VARCHAR), ''),
                  lambda crc, ch: list_reduce(range(8), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END,
                                              xor(crc, ascii(ch)::BIGINT)), 4294967295), 4294967295) % 9 AS h
           FROM (SELECT c, v FROM s)),
     q AS (SELECT k.c, list_concat(coalesce(b.v[1:k.h], []), k.v[k.h + 1:]) AS v FROM k LEFT JOIN s b ON b.c = k.c - k.c % 5),
     e AS (SELECT c, len(v) AS n, v, unnest(range(len(v) + 1)) AS d FROM q),
     n AS (SELECT d, v[1:d] AS k, min(c) AS conv_id, count(*) AS n_convs, count(DISTINCT CASE WHEN n > d THEN v[1:d + 1] END) AS n_children,
                  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
           FROM e GROUP BY ALL),
     below AS (SELECT x.d, x.k, count(*) FILTER (y.n_children = 0) AS n_leaves,
                      sum((y.n_convs - 1) * CASE WHEN y.d = 0 THEN 0 ELSE strlen(y.k[y.d].x) END)::BIGINT AS saved_tokens
               FROM n x JOIN n y ON y.d >= x.d AND y.k[1:x.d] = x.k GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, below.n_leaves, below.saved_tokens, n.ends_sha256
FROM n JOIN below ON below.d = n.d AND below.k = n.k LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
"""

#: All phrases of all lengths are counted at once here.
_OP13 = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
     m AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM w),
     g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM m),
     f AS (SELECT lang, m, phrase, count(*) AS c FROM g GROUP BY ALL),
     t AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
     a AS (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND c >= 30),
     inner_m AS (SELECT lang, a, w, m, unnest(range(2, m)) AS s FROM a),
     inside AS (SELECT lang, phrase, max(a) AS above
                FROM (SELECT lang, a, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase FROM inner_m)
                GROUP BY ALL),
     k AS (SELECT a.*, unnest(range(1, a.m)) AS k FROM a LEFT JOIN inside USING (lang, phrase)
           WHERE above IS NULL OR 100::HUGEINT * above < 80::HUGEINT * a.a),
     cut AS (SELECT k.lang, k.phrase, k.a, k.k, l.c AS l, r.c AS r, (2000000::HUGEINT * k.a) // (l.c + r.c) AS score
             FROM k JOIN f l ON l.lang = k.lang AND l.m = k.k AND l.phrase = array_to_string(k.w[1:k.k], ' ')
                    JOIN f r ON r.lang = k.lang AND r.m = k.m - k.k AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')),
     weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score::BIGINT AS score
FROM weakest JOIN t USING (lang) QUALIFY rank <= 2000
"""

SQL: dict[str, str] = {"op2_exact_topk": _OP2, "op9_mix_sources": _OP9, "op11_prefix_trie": _OP11, "op13_collocations": _OP13}
