"""Corpus pipeline over ``documents``: each stage calls one operator of ``tableprep.llm``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tableprep.llm import decontaminate, packing, quality, secret_scan, simhash
from tableprep.llm.common import table
from tableprep.session import ensure_checkpoint_dir


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by position, as input columns may be called like those a stage adds; new name by old."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*inner), dict(zip(docs.columns, inner))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the cascade rejects go."""
    inner, named = numbered(docs)
    return quality.cascade(inner, named["text"]).where("rejected_by IS NULL").select(*inner.columns).toDF(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    inner, named = numbered(docs)
    found = decontaminate.contamination(inner, table(spark, sf_dir, "benchmark"), named["doc_id"], named["text"],
                                        keep=inner.columns)
    return found.where("size(spans) = 0").select(*inner.columns).toDF(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return secret_scan.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: packing needs a tokenizer and the near-duplicate stage XXH64 and components, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of all but the last are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    root = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = os.path.join(root, str(k))
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
