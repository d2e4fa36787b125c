"""The corpus pipeline: stages over ``documents``, each one of the operators of ``lauter.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lauter.llm.common import table, written
from lauter.llm.decontaminate import drop_contaminated
from lauter.llm.exact_dedup import keep_first_copies
from lauter.llm.mixing import take_mix
from lauter.llm.near_dedup import keep_one_of_each
from lauter.llm.toxicity import drop_toxic, learnable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return drop_toxic(docs, learnable(table(spark, folder, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, one document stays."""
    return keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates, one document stays."""
    return keep_one_of_each(docs)


def contaminated_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return drop_contaminated(docs, table(spark, folder, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    return take_mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_documents),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("decontamination", contaminated_documents),
    ("mixing", source_mix),
]

# nearest neighbours, sketches and sums over budgets have no SQL form
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, each reading what the one before has written."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
