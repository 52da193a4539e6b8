"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envstats.llm import (bpe, decontam, divergence, fingerprint, hardneg, html, langcrf, neardup, pii,
                          resample, suffixdedup, toxicity, warc)
from envstats.llm.common import read

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.fit(docs)))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(suffixdedup.remove(read(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(decontam.find(read(spark, sf_dir, "documents"),
                                          read(spark, sf_dir, "benchmark")))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.with_lengths(html.extract(read(spark, sf_dir, "pages")))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(bpe.encode(read(spark, sf_dir, "documents"), tokens,
                                  public_tokenizers.PATTERN))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.members(neardup.group(read(spark, sf_dir, "documents")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.digests(fingerprint.with_next(read(spark, sf_dir, "documents")))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langcrf.predictions(langcrf.tag(docs, langcrf.fit(docs), runs=False))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hardneg.mine(vectors, "id % 100 = 0")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_html": op5_html,
    "op6_bpe": op6_bpe,
    "op7_neardup": op7_neardup,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_fingerprint": op10_fingerprint,
    "op11_language": op11_language,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_divergence": op13_divergence,
}

ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH p AS (SELECT page_id, url, sha1(coalesce(html, '')) AS digest,
                          CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
             m AS (SELECT digest, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < kept THEN kept END AS refers_to, url
        FROM p LEFT JOIN m ON p.digest = m.digest""",
    "op12_hard_negatives": """
        WITH r AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (
                SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
                       CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)
                            AS BIGINT) AS score
                FROM r AS a JOIN r AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
             p AS (SELECT a, b, score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
             n AS (SELECT p.a, p.b, s.b AS c, p.score AS ps, s.score AS ns,
                          row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k
                   FROM p JOIN s ON p.a = s.a AND NOT s.same
                   WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT a AS anchor_id, b AS positive_id, CAST(k AS INTEGER) AS "rank", c AS negative_id,
               ps AS positive_score, ns AS negative_score
        FROM n WHERE k <= 10""",
    "op13_divergence": """
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             w AS (SELECT i, lang, source,
                          unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
             k AS (SELECT lang, term, count(*) AS of_lang FROM w GROUP BY lang, term
                   HAVING count(DISTINCT i) >= 10),
             v AS (SELECT lang, count(*) AS v, sum(of_lang) AS total FROM k GROUP BY lang),
             g AS (SELECT DISTINCT lang, source FROM d),
             c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term)
                   GROUP BY lang, source, term),
             u AS (SELECT g.lang, g.source, k.term, k.of_lang, coalesce(c.n, 0) AS n
                   FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
             p AS (SELECT lang, source, term, n,
                          1 + (CAST(1000000000 AS HUGEINT) * (n + 2))
                              // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
                          1 + (CAST(1000000000 AS HUGEINT) * (of_lang + 2)) // (total + 2 * v) AS q
                   FROM u JOIN v USING (lang)),
             f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                   FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
                   GROUP BY a.lang, a.source, b.source),
             e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
                   FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
                   LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
                   UNION ALL
                   SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
             o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM e)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS "rank"
        FROM o WHERE part = 'pair' OR k <= 10""",
}
