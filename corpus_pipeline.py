"""Five stages that clean a corpus of documents and turn it into tokens.

Each stage reads all that the one before kept. Rules for odd input are those of the operators:
null and wordless texts leave in the first stage, repeated rows are copies of which the second
keeps one per class, an empty table stays empty, and all columns are kept up to the last stage.
SQL expresses neither language models nor byte-pair merges, so there is no SQL for the whole;
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import bpe, decontaminate, jaccard_join, language_id, pii
from tagloom.llm.common import table
from tagloom.session import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", hide_personal_data),
    ("tokens", to_tokens),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
