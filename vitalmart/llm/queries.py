"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.llm import (block_whitening, cap_filters, content_sort, exact_topk, language_id, minmax_dedup, mixing,
                           packing, spelling_trie, substring_dedup, suffix_dedup, token_output, url_graph)
from vitalmart.llm.common import only_result, saved, scratch, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
        (F.coalesce(F.length("text"), F.lit(0)) - F.coalesce(F.length("kept_text"), F.lit(0))).cast("bigint").alias("n_removed"),
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"), "starts", "ends")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark) as path:
        token_output.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(), 2)
        return saved(token_output.read_tokens(spark, path))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judged(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mixed(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "source", "copies"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.linked(table(spark, sf_dir, "embeddings"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_trie.variants(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (content_sort.exact_copies(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


QUERIES = {
    "op1_substring_dedup": op1, "op2_token_output": op2, "op3_url_graph": op3, "op4_language_id": op4,
    "op5_source_mix": op5, "op6_suffix_dedup": op6, "op7_exact_topk": op7, "op8_packing": op8,
    "op9_embedding_near_dedup": op9, "op10_minmax_near_dedup": op10,
    "op11_block_whitening": op11, "op12_spelling_trie": op12, "op13_content_sort": op13,
}
QUERIES = {name: only_result(query) for name, query in QUERIES.items()}

SQL = {
    "op7_exact_topk": """
WITH sound AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5""",
    "op9_embedding_near_dedup": """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON e.vec_id = low.a LEFT JOIN n ON e.vec_id = n.a""",
    "op10_minmax_near_dedup": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d JOIN low ON d.doc_id = low.a LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    "op13_content_sort": """
WITH bare AS (
  SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t
  FROM documents
), judged AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size, t
  FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM judged""",
}
