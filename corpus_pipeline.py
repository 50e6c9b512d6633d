"""A corpus from raw documents: good texts, one of each group of near-duplicates by SimHash, no benchmark items, no
personal data, encoded.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and all but the last return the columns of
documents. Null and empty texts, repeated rows and rows without doc_id pass as each operator defines; none fails.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adsettle.llm import bayes, bpe, decontamination, near_duplicates, pii
from adsettle.llm.base import table
from adsettle.session import staging_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return bayes.good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of op10, 3-word fingerprints linked at 3 bits or fewer, the document with the smallest doc_id."""
    return near_duplicates.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token ids, their number, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, bpe.share(spark, path, public_tokenizers.PATTERN), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark),
    ("personal data", personal_data),
    ("byte-level BPE", encode),
]

#: The stages learn from labels, hash with XXH64 and match fingerprints; SQL can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
