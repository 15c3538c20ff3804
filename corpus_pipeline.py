"""Corpus cleaning pipeline: five stages over the documents table.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept and applies one operator of ``reclaim.llm`` to them.  All but
the last return the columns of documents (n_chars follows the text where a
stage changes it).

1. language: documents without a letter go, and those whose language is less
   likely than ``LEAST_SCORE``, or with many labels than ``LEAST_LIFT`` times a
   guess among them.  Where nothing could be learned, only letters count.
2. lines: lines of recurring templates go, but for their first occurrence; a
   document all of whose text went with them goes.  Long lines that repeat
   without a template are left to stages 3 and 4, which see whole documents and
   cut every repeated 100 bytes: dropped here, they would leave fragments of
   near copies that stage 3 could no longer tell.
3. near_duplicates: of each component of near-duplicates the row with the
   smallest doc_id stays (nulls last; of one doc_id, one text).
4. repeats: byte strings that start earlier elsewhere are cut out, to whole
   characters; a document of which nothing is left goes.
5. packing: the rest is tokenized and packed into sequences.

Cases: a null text has no letter, so it goes in stage 1; an empty table gives
no rows in every stage; rows with one doc_id and different texts are judged one
by one; rows with equal doc_id and text are one document and stay or go
together.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclaim.llm import best_fit_packing, language_id, line_templates, minhash_hamming, suffix_array
from reclaim.llm.common import prepare, table, written
from reclaim.llm.queries import tokenizer_file

LEAST_SCORE, LEAST_LIFT = 0.3, 1.2  # short clean texts score low; under this hardly any label is likelier than the rest


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = language_id.scored(docs)
    sure = F.col("lang_score") >= F.least(F.lit(LEAST_SCORE), F.lit(LEAST_LIFT) / F.greatest(F.lit(1), F.col("lang_labels")))
    return found.where(F.col("lang_letters") & (sure | (F.col("lang_labels") == 0))).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    left = line_templates.drop_recurring(docs, long=None)
    return sized(left.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    gone = minhash_hamming.rows_of(docs).where(~F.col("first")).select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("gone_id")) & (minhash_hamming.text_hash() == F.col("gone_row"))
    return docs.join(written(gone, "near-duplicates"), same, "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    left = suffix_array.cut_texts(docs)
    return sized(left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    with open(tokenizer_file("byte_bpe_50k.json"), "rb") as f:
        return best_fit_packing.packed(docs, f.read())


def sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, n_chars (if there is one) recounted."""
    return docs.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in columns])


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("packing", packing),
]

# Training, signatures and suffix arrays have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
