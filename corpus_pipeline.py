"""Documents to tokens: language ID, near duplicates, secrets, source weights, SentencePiece.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last
return the columns of documents; the last returns a row for each drawn document with its tokens.

docs needs doc_id, text, lang and source; further columns, whatever their names, go along. Rows are
what a stage counts: repeated rows and rows with a null doc_id are kept like others unless a stage
says otherwise, and an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewell.llm import langid, mixing, ngram_join, pieces, secrets
from ridewell.llm.common import small_batches, spill

#: A document whose best language has less than this posterior is in none of them.
LEAST_SCORE = 0.4


def _whole(docs: DataFrame) -> Column:
    """All columns in one struct `row`, out of the way of a stage's own names."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty texts, too), and those of no language that the labelled ones teach.

    Equal texts get equal answers. Without any labelled document all are rejected.
    """
    docs = small_batches(docs)
    predict = langid.predictor(docs, langid.train(docs))
    told = docs.select(_whole(docs), predict("text").alias("told"))
    return told.filter((F.col("told.lang_pred") != "und") & (F.col("told.score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group whose sets of five-word shingles are linked at 0.8 or more.

    Of rows that repeat both doc_id and text one stays; a doc_id with two texts stands for either's
    group. Null and empty texts are alone in their group. Rows with a null doc_id stay.
    """
    return ngram_join.keep_one(small_batches(docs)).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts, whatever their length; null stays null. No row goes."""
    clean = F.pandas_udf(secrets.redact, "string")
    return small_batches(docs).withColumn("text", clean("text")).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents until the sources have their weights; a document may come twice. A null source is a source.

    Documents without words come with the blocks that are drawn whole; rows with equal doc_id, source
    and size are drawn alike.
    """
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and digests of each drawn document, a row for each draw; null counts as empty and has no ids."""
    import public_tokenizers

    return pieces.digests(small_batches(docs), public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_weights),
    ("sentencepiece", sentencepiece),
]
#: SQL can express neither the learnt languages nor the segmentation; tests check invariants of the stages, not brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else spill(docs)
    return docs
