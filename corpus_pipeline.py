"""The corpus pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenderlake.llm import line_dedup, packing, quality_model, quality_rules, simhash
from tenderlake.llm.common import materialize, ready, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; null and empty texts have no words and go."""
    ready(spark)
    return quality_rules.apply_rules(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least one half.

    It learns from all labelled rows of ``documents``, those that the rules have rejected
    included: among the kept ones hardly any bad example is left. Statistics, not texts, are
    joined with the labels.
    """
    _, model = quality_model.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one.

    Null texts stay null, a text may be left empty; rows with one id and text are one document.
    """
    ready(spark)
    return line_dedup.drop_repeated_lines(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of 3-word shingles link at 2 or fewer differing bits.

    The first one in the order of id and text stays. Null and empty texts have the fingerprint
    zero and link like any other; rows that share an id or have none are documents of their own.
    """
    ready(spark)
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece with its sequence and place; a null or empty text is its end id alone."""
    ready(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("line_dedup", drop_lines),
    ("simhash", keep_one_copy),
    ("best_fit", pack),
]

#: The classifier's floating-point fit and the token ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        docs = made if name == STAGES[-1][0] else materialize(made)
    return docs
