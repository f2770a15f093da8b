"""The training-data pipeline: quality, near copies, contamination, mix, token records.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir), where ``docs`` has
the columns of ``documents``, and returns those columns (the last: the records' index).
``run`` writes every stage's result to the shared folder and reads it back as the next
one's input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import decontamination, jaccard_join, line_quality, mixing, token_records
from riskframe.llm.common import staged
from riskframe.llm.queries import table, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules."""
    return line_quality.keep_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near copies."""
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    scanned = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.remove_documents(scanned).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to meet the sources' targets."""
    return mixing.emit(mixing.allocate(docs)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token records that were written."""
    path = token_records.write_records(docs, tokenizer_file())
    index = token_records.with_starts(token_records.build_index(spark, path))
    return index.selectExpr("id as doc_id", "path", "offset", "length", "start", "n_tokens", "ids_crc32")


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminate),
          ("mixing sources", mix), ("token records", tokenize)]

#: The tokenizer and the paths of the records are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
