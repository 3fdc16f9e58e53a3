"""A training corpus in five stages over the ``documents`` table.

Each stage is ``(name, function)`` with ``function(spark, docs, sf_dir)``; its
result is written as Parquet and read again as the next one's ``docs``.  All but
the last return the columns of ``documents``.  Rows with null columns, empty or
very long texts, repeated rows and extra columns pass through every stage as the
operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import docs_of, keep_table, ship_package
from strata.llm.mixing import apply_rates, labelled_domains
from strata.llm.near_dup import drop_near_duplicates
from strata.llm.secret_scan import redact
from strata.llm.sentencepieces import round_trip
from strata.llm.toxicity import drop_toxic


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more go."""
    ship_package(spark)
    return drop_toxic(docs, _labels(spark, sf_dir), threshold=0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    ship_package(spark)
    return drop_near_duplicates(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    ship_package(spark)
    return redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents occur as often as their fitted rate says."""
    return apply_rates(docs, labelled_domains(docs, _labels(spark, sf_dir)))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, with the check of the round trip."""
    ship_package(spark)
    return round_trip(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("source_mixing", source_mixing), ("sentencepiece", sentencepiece)]

#: No SQL expresses the classifier of the first stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs = docs_of(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
