"""The corpus pipeline: stages that clean `documents`, one after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orgcurate.llm import bpe, decontaminate, near_dedup, quality, suffix_dedup
from orgcurate.llm._spark import table, written
from orgcurate.llm.queries import word_bpe

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Each stage takes documents (doc_id, text, lang, source, n_chars, and any further columns), works on all of
# them and, but for the last, returns rows with the same columns. Null and empty texts, repeated rows and ids,
# null ids and empty tables are defined by the operator that a stage calls.


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio; null, empty and short texts fail the rules."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class; null and empty texts and null ids are classes of their own."""
    return near_dedup.first_of_each(docs)


def uncopied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that stand earlier too, n_chars set anew; those of which nothing is left go."""
    return suffix_dedup.clean(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; a text without words has none."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and digests; null and empty texts have no ids."""
    return bpe.tokens(docs, word_bpe())


STAGES: list[tuple[str, Stage]] = [("quality", good), ("near_dedup", distinct), ("suffix_dedup", uncopied), ("decontaminate", decontaminated), ("bpe", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
