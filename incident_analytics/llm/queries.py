"""The registered queries of this subpackage: thin calls of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.llm import (
    blob_secrets, byte_bpe, cover_codes, importance_resampling, kd_search, language_fusion, nnls_packing, pairwise_quality, partenum_join,
    pq_neardup, tag_paths, toxicity, url_markov,
)
from incident_analytics.llm.common import new_folder, read

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnls_packing.pieces(read(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op4_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum_join.join(read(spark, sf_dir, "documents"), 3, Fraction(9, 10))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_markov.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return kd_search.search(vectors, vectors.where("vec_id % 50 = 0"))


def op7_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(read(spark, sf_dir, "pages"))


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lexicon_of(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learned from the labelled documents that aren't held out."""
    labels = read(spark, sf_dir, "labels").where(~held_out())
    return toxicity.learn(read(spark, sf_dir, "documents"), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, lexicon_of(spark, sf_dir)).drop("text")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.CUT_SCORE).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = language_fusion.identify(documents, "text", "lang", "source")
    return found.select("doc_id", F.col("lang").alias("declared"), "language", "posterior", "accepted")


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on web pages: the html element's language, the address's suffix and its host."""
    pages = tag_paths.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("host", url_markov.host_of("url"))
    declared = read(spark, sf_dir, "pages").select("page_id", language_fusion.declared_language("html").alias("declared"))
    found = language_fusion.identify(pages.join(declared, "page_id", "left"), "text", "declared", "host")
    return found.select("page_id", "host", "declared", "language", "posterior", "accepted")


def op10_blob_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_secrets.report(read(spark, sf_dir, "documents"), f"{new_folder(spark, 'ledger')}/ledger")


def op11_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_codes.report(read(spark, sf_dir, "embeddings"))


def quality_held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(~quality_held_out())
    scored = pairwise_quality.score(read(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", quality_held_out().alias("held_out"), "score",
                         (F.col("score") >= pairwise_quality.CUT_SCORE).cast("int").alias("predicted"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pq_neardup, op2_nnls_packing, op3_byte_bpe, op4_partenum_join, op5_url_filter, op6_kd_topk, op7_tag_path_text,
        op8_toxicity, op9_language_id, page_language_id, op10_blob_secrets, op11_cover_codes,
        op12_pairwise_quality, op13_importance_resampling)
}

#: The least id reachable over the symmetric links (a, b).
_REACHED = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
"""

_VECTORS = """
usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)
"""



def _lloyd_sql(rounds: int = 6) -> str:
    """Parts as lists of doubles, which hold all integers that occur here exactly."""
    ctes = [f"""RECURSIVE {_VECTORS}""", """
placed AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS n, list_transform(x, lambda c: floor(4096 * c)) AS v FROM usable
), parts AS MATERIALIZED (
  SELECT vec_id, label, n, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS v FROM placed, range(8) AS t(p)
), books0 AS MATERIALIZED (SELECT p, n - 1 AS e, v FROM parts WHERE n <= 16)"""]
    for k in range(rounds + 1):
        ctes.append(f"""
near{k} AS MATERIALIZED (
  SELECT q.vec_id, q.label, q.n, q.p, q.v, min((list_inner_product(q.v, q.v) - 2 * list_inner_product(q.v, b.v)
    + list_inner_product(b.v, b.v))::BIGINT * 16 + b.e) AS d FROM parts q JOIN books{k} b ON q.p = b.p GROUP BY ALL
)""")
        if k < rounds:
            ctes.append(f"""
mean{k} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT p, e, i, floor(sum(c) / count(*)) AS m FROM (
      SELECT p, d % 16 AS e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM near{k}) GROUP BY p, e, i) GROUP BY p, e
), books{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM books{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e
)""")
    return f"""
WITH {','.join(ctes)}, coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', d % 16), '' ORDER BY p) AS code, sum(d // 16)::BIGINT AS error FROM near{rounds} GROUP BY n, vec_id, label
), listed AS (
  SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS digest FROM (
    SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM books{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256 FROM coded, listed
"""


ORACLES = {
    "op11_cover_codes": _lloyd_sql(),
    "op1_pq_neardup": f"""
WITH RECURSIVE {_VECTORS},
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.label = q.label AND p.vec_id <> q.vec_id
  WHERE list_inner_product(p.x, p.x) > 0 AND list_inner_product(q.x, q.x) > 0
    AND list_inner_product(p.x, q.x) / (sqrt(list_inner_product(p.x, p.x)) * sqrt(list_inner_product(q.x, q.x))) >= 0.98
), {_REACHED}
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(l.root, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.root, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
""",
    "op4_partenum_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS s FROM words
), features AS (SELECT doc_id, len(s) AS n, unnest(s) AS f FROM sets
), links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM features p JOIN features q ON p.f = q.f AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
), {_REACHED}
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(l.root, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least l ON l.a = s.doc_id
""",
    "op6_kd_topk": f"""
WITH {_VECTORS},
whole AS (SELECT vec_id, list_transform(x, lambda c: floor(256 * c)) AS v FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored) WHERE rank <= 5
""",
}
