"""The corpus pipeline: each stage works on what the one before kept.

Toxic documents go, recurring lines go, one document of each group of near-duplicates stays, documents that hold a
benchmark item go, and what is left is encoded. Between stages rows are written and read again, so that a lost executor
costs part of a stage and plans stay short. All stages but the last return the columns of documents.

Rows that share a doc_id are one document and stay or go together. Rows without one are named after their text for the
stages that give verdicts by name, behind all that have one, so that they go as copies or leaks like others. Null and
empty texts are no one's copy and hold nothing. Very long texts are worked on whole. An empty table stays empty. Columns
that documents has besides are passed on, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import cminhash, decontaminate, line_templates, sentencepiece_codec, toxicity
from terrace.llm._spark import fresh, id_filter, scope, scratch, table, written

#: Hundredths of Jaccard similarity on five-word shingles from which documents are near-duplicates.
NEAR_PERCENT = 80


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that is never null: doc_id, or for rows without it a number from their text above 2^62."""
    name = fresh(docs, "stage_id")[0]
    own = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 62))
    return docs.withColumn(name, F.coalesce(F.col("doc_id"), own)), name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows whose score is under the threshold; without labels all rows stay. Repeated rows stay or go together."""
    return toxicity.cleaned(docs, table(spark, sf_dir, "labels"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without recurring lines. Rows that agree in doc_id and text count once."""
    return line_templates.deduplicated(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the least doc_id of each group of near-duplicates; rows without words stay."""
    rows, name = _named(docs)
    verdicts = cminhash.near_duplicates(rows, percent=NEAR_PERCENT, doc_id=name)
    gone = written(verdicts.where("NOT kept").select(F.col("doc_id").alias(name)).distinct(), "copies")
    return id_filter(rows, gone, name, "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose texts hold no benchmark item; all of them with an empty benchmark."""
    rows, name = _named(docs)
    gone = written(decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), doc_id=name).select(F.col("doc_id").alias(name)).distinct(), "leaks")
    return id_filter(rows, gone, name, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the checks of the round trip of every row; a null text has no ids."""
    return sentencepiece_codec.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_recurring_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: Scores of trained dictionaries can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
