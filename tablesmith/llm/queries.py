"""The operators of this package bound to the driver tables, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesmith.llm import (
    byte_bpe, collocations, decontaminate, edit_counts, fill_middle, ftrl_toxicity, jaccard_rtree, license_dice, multiprobe_lsh,
    ppm_language, pq_dedup, token_files, zstd_quality)
from tablesmith.sources.files import read_table

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
ENGLISH_RANKS = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
END_ID = 2


def op1_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return pq_dedup.link(read_table(spark, sf, "embeddings"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return ppm_language.identify(read_table(spark, sf, "documents"))


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    spec = byte_bpe.specification(public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)
    return byte_bpe.round_trip(read_table(spark, sf, "documents"), spec)


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.overlaps(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of all documents before and after the redaction of personal data and secrets."""
    spec = byte_bpe.specification(public_tokenizers.path(ENGLISH_RANKS), public_tokenizers.PATTERN)
    trees = edit_counts.build(read_table(spark, sf, "documents").select("doc_id", "text"), spec)
    return edit_counts.apply_edits(edit_counts.redactions(trees), spec).select(
        "doc_id", "n_before", "n_tokens", "n_edits", "chars", "chars_encoded", F.size("leaves").alias("n_leaves"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return zstd_quality.classify(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    with open(public_tokenizers.path(WORD_VOCABULARY), encoding="utf-8") as file:
        vocabulary = file.read()
    return token_files.read_digests(token_files.write_files(read_table(spark, sf, "documents"), vocabulary, END_ID))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_dice.scan(read_table(spark, sf, "documents")).withColumn("dice", F.round("dice", 6))


def op9_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_rtree.join(read_table(spark, sf, "documents"), 0.9)


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return ftrl_toxicity.classify(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(read_table(spark, sf, "documents")))


def op12_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return multiprobe_lsh.search(read_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_language_id, op3_byte_bpe, op4_decontamination, op5_token_counts, op6_quality,
    op7_token_files, op8_license_scan, op9_ngram_jaccard, op10_toxicity, op11_fill_middle, op12_nearest_neighbours,
    op13_collocations)}

ORACLES = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op8_license_scan": f"SELECT doc_id, license, n_units, round(dice, 6) AS dice FROM ({license_dice.scan_sql()})",
    "op9_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c WHERE 100 * k >= 90 * (na + nb - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id
FROM s LEFT JOIN low ON low.a = doc_id""",
    "op11_fill_middle": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
  CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (SELECT *, substr(x, 1, a) AS p, substr(x, a + 1, b - a) AS m, substr(x, b + 1) AS s FROM v)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(x) AS restored_sha256 FROM w""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 6) AS t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 100),
s AS (SELECT c.lang, c.phrase, a, j, x.f AS l, y.f AS r, n, CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM c JOIN range(1, 5) AS t(j) ON j < c.k JOIN n USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
d AS (SELECT DISTINCT o.lang, o.phrase FROM c o JOIN c v ON o.lang = v.lang AND v.k > o.k AND v.a >= o.a
  AND contains(' ' || v.phrase || ' ', ' ' || o.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM b ANTI JOIN d USING (lang, phrase) QUALIFY rank <= 2000""",
}
