"""Named queries of the operators: thin views with the contract's columns.

Each callable takes (spark, folder of tables) and applies its operator with
production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sentencepiece_codec
    from .common import table

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), f.read())


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_array
    from .common import table

    return suffix_array.digests(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import exact_topk
    from .common import table

    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language_id
    from .common import table

    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import minhash_hamming
    from .common import table

    return minhash_hamming.components(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import order_minhash
    from .common import table

    return order_minhash.edited(table(spark, sf_dir, "documents"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_templates
    from .common import table

    return line_templates.digests(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import best_fit_packing
    from .common import table

    with open(tokenizer_file("byte_bpe_50k.json"), "rb") as f:
        return best_fit_packing.packed(table(spark, sf_dir, "documents"), f.read())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_wrapper
    from .common import table

    return html_wrapper.extract(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc
    from .common import table

    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op11_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import disclosure
    from .common import table

    return disclosure.digests(table(spark, sf_dir, "documents"))


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vector_file
    from .common import table

    return vector_file.cluster(table(spark, sf_dir, "embeddings"))


def op13_wavelet_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fill_in_middle
    from .common import table

    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


# Exact integer scores of every pair, for the small tables of the SQL check.
TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""

WARC_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (
  SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keeper IS DISTINCT FROM p.page_id AND k.keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keeper IS DISTINCT FROM p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_suffix_array, op3_exact_topk, op4_language_id, op5_minhash_hamming, op6_order_minhash, op7_line_templates, op8_best_fit_packing, op9_html_extraction, op10_warc, op11_disclosure, op12_va_clusters, op13_wavelet_fim, pipeline)}


def oracle_sql() -> dict[str, str]:
    from . import fill_in_middle, line_templates, vector_file

    return {
        "op3_exact_topk": TOPK_SQL,
        "op7_line_templates": line_templates.SQL,
        "op10_warc": WARC_SQL,
        "op12_va_clusters": vector_file.sql(),
        "op13_wavelet_fim": fill_in_middle.SQL,
    }
