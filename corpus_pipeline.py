"""The corpus pipeline: from raw documents to a mixed, tokenised corpus.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``. All but the last
return the columns of ``documents``; ``n_chars`` follows the text. A stage works
on all rows that its predecessor kept, and its decisions take effect:

1. toxicity: documents whose score is 0.5 or more go. The classifier learns from
   the labelled documents among the stage's input.
2. line dedup: lines covered by a later occurrence of a three-line window are cut
   out; every document stays, if need be with an empty text.
3. near duplicates: sets of five-word shingles with a similarity of 0.8 or more
   link; of each connected group the document with the smallest id stays.
4. mixing: documents as the mix takes them, once for each time; a source's last
   document is cut to the words taken, documents that are not taken go.
5. SentencePiece: the ids of each text, and whether they decode to it.

The first and the last stage need a trained model and a tokenizer's file, which
SQL cannot express, so ``ORACLE_SQL`` is None; tests run the whole pipeline
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import jaccard, line_dedup, mixing, pieces, toxicity
from hirelake.llm.common import read, stored


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.line_dedup(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed_documents(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pieces.encode_decode(docs)
    return rows.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn(
        "round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("sentencepiece", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
