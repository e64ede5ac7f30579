"""The registered queries of the operators, each over its whole tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tunnelscan.llm.common import table
from tunnelscan.llm.decontaminate import op3_decontaminate
from tunnelscan.llm.hard_negatives import op12_hard_negatives
from tunnelscan.llm.licenses import op8_licenses
from tunnelscan.llm.line_dedup import op11_line_dedup
from tunnelscan.llm.minhash import op4_minhash
from tunnelscan.llm.mixing import op10_mixing
from tunnelscan.llm.mtree import op5_mtree
from tunnelscan.llm.pieces import op1_sentencepiece
from tunnelscan.llm.pii import op7_pii
from tunnelscan.llm.substrings import op2_substrings
from tunnelscan.llm.token_counts import default_cache, op6_token_counts
from tunnelscan.llm.toxicity import op9_toxicity
from tunnelscan.llm.whitening import op13_whitening

PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_sentencepiece(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_substrings(table(spark, sf_dir, "documents"))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_minhash(table(spark, sf_dir, "documents"))


def mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_mtree(table(spark, sf_dir, "embeddings"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE),
                            default_cache(spark, sf_dir))


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_pii(table(spark, sf_dir, "documents"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_licenses(table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_mixing(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_line_dedup(table(spark, sf_dir, "documents"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_hard_negatives(table(spark, sf_dir, "embeddings"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_whitening(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": sentencepiece,
    "op2_substrings": substrings,
    "op3_decontaminate": decontaminate,
    "op4_minhash": minhash,
    "op5_mtree": mtree,
    "op6_token_counts": token_counts,
    "op7_pii": pii,
    "op8_licenses": licenses,
    "op9_toxicity": toxicity,
    "op10_mixing": mixing,
    "op11_line_dedup": line_dedup,
    "op12_hard_negatives": hard_negatives,
    "op13_whitening": whitening,
}

# Words by the contracts: only A-Z are lower-cased.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x20\x09-\x0D]+')"

_OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce({_WORDS}, []) AS w FROM benchmark),
bw AS (SELECT DISTINCT item, CASE WHEN len(w) < 13 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[k:k + 12], ' ') END AS g, least(len(w), 13) AS n
       FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM d, sizes, LATERAL (SELECT unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS k)),
hits AS (SELECT rid, k, dw.n, item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM hits, LATERAL (SELECT unnest(range(k, k + n)) AS p) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS l
          FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN items USING (rid)
"""

_OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_TOKENS}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[k:k + 4], ' ') END AS g
      FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.r = e.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_OP5 = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rid, doc_id, l[k] AS line, k,
        {_LOWER.format("trim(l[k], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
      FROM d, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS k)),
f AS (SELECT key, min(doc_id) AS first FROM x WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT rid, x.doc_id, k, line, coalesce(x.doc_id > first, false) AS gone FROM x LEFT JOIN f ON x.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""

_OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.r <= 5 AND s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op3_decontaminate": _OP3, "op4_minhash": _OP4, "op5_mtree": _OP5,
                              "op11_line_dedup": _OP11, "op12_hard_negatives": _OP12}
