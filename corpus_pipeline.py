"""The pipeline: documents to packed sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlake.llm import decontaminate, packing, quality, simhash, toxicity
from basketlake.llm.common import stored, table


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"), spark)


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies (five-word shingles, similarity 0.8 or more)."""
    return simhash.deduplicated(docs)


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark covers less than 5 %."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of a power of two tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: Trained models, hash functions and a tokenizer cannot be written in SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
