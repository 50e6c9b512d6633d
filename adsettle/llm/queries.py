"""The registered queries of this folder, and the pipeline's."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from adsettle.llm.base import QUERIES, SQL, Query

for _name in (
    "anomaly templates bpe warc bayes licenses pii decontamination languages near_duplicates periodic divergence shards".split()
):
    importlib.import_module(f"adsettle.llm.{_name}")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    ordered = sorted(QUERIES, key=lambda name: int(name[2:].split("_")[0]))
    return {**{name: QUERIES[name] for name in ordered}, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    whole = corpus_pipeline.ORACLE_SQL
    return {**SQL, **({"pipeline": whole} if whole else {})}
