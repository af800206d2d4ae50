"""The operators with production parameters on their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyflow.llm import align_tokens, decontaminate, embedding_dedup, huffman, language_id, licenses, minhash, pii, piece_bpe, prefix_trie, suffix_dedup, token_counts, toxicity
from tallyflow.llm.frames import table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.encode_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


#: A production run sets the key; where it is unset, one is drawn for the session.
PII_KEY = "spark.llm.pii.key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymized(table(spark, sf_dir, "documents"), pii.key_of(spark, PII_KEY))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a tree: source / language / thousand / hundred; ids that are round numbers lie in the folders above."""
    i = F.col("doc_id")
    folder = F.concat_ws("/", "source", "lang", F.when(i % 1000 != 0, F.floor(i / 1000).cast("string")), F.when(i % 100 != 0, (F.floor(i / 100) % 10).cast("string")))
    docs = table(spark, sf_dir, "documents").select(i, F.concat_ws("/", folder, i.cast("string")).alias("path"), "text")
    return licenses.scan(docs, id_col="doc_id").withColumnRenamed("id", "doc_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_huffman_ids": op2_huffman_ids,
    "op3_piece_bpe": op3_piece_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_minhash": op8_minhash,
    "op9_licenses": op9_licenses,
    "op10_decontaminate": op10_decontaminate,
    "op11_language_id": op11_language_id,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_align_tokens": op13_align_tokens,
}

#: Words, shingles and exact containment without any search structure.
OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents WHERE doc_id IS NOT NULL),
     b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
     i AS (SELECT item_id, least(len(w), 5) AS k, list_distinct(list_transform(range(len(w) - least(len(w), 5) + 1), lambda p: w[p + 1:p + least(len(w), 5)])) AS s FROM b WHERE len(w) > 0),
     e AS (SELECT item_id, k, len(s) AS n, unnest(s) AS h FROM i),
     h AS (SELECT DISTINCT doc_id, unnest(list_transform(range(len(w) - k + 1), lambda p: w[p + 1:p + k])) AS h FROM d, (SELECT DISTINCT k FROM e) WHERE len(w) >= k)
SELECT doc_id, item_id, n AS n_item, count(*) AS n_shared, count(*) / n AS containment
FROM e JOIN h USING (h) GROUP BY doc_id, item_id, n HAVING count(*) / n >= 0.75
"""

#: All pairs of vectors, and components by recursion over their links.
OP1 = """
WITH RECURSIVE e AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v,
           embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.ok AND y.ok AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
      AND list_cosine_similarity(x.v, y.v) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM e JOIN c ON c.a = e.vec_id
"""

ORACLES: dict[str, str] = {"op1_embedding_dedup": OP1, "op10_decontaminate": OP10}
