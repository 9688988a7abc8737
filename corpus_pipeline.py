"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes what its predecessor kept. All but the last return documents with their columns; the last returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwise.llm.common import Scratch
from panelwise.llm.decontaminate import decontaminate
from panelwise.llm.exact_dedup import exact_dedup
from panelwise.llm.near_dedup import near_dedup
from panelwise.llm.packing import pack_documents
from panelwise.llm.queries import table, tokenizer_path
from panelwise.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Signatures, models and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
