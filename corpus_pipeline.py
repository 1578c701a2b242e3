"""A corpus pipeline of five stages: quality rules, near copies, benchmark decontamination, personal data, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's
documents. All but the last return the columns of documents. ``run`` applies them to the documents of sf_dir.

Texts that are null, empty or too short are rejected by the quality rules. Very long texts go through whole. Documents
with a null id stay, each for itself; of rows with equal id and text one stays, of near copies the one with the smallest
id. An empty table gives an empty result, and a benchmark without items takes nothing away. The order of the rows has no
part in any decision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stackgrain.llm import decontaminate, jaccard_join, packing, pii, quality
from stackgrain.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_copy),
    ("benchmark decontamination", drop_benchmark),
    ("personal data", hide_personal_data),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs


#: SQL cannot express the stages (expectation-maximisation, a trained network, bin completion): brute force tests do.
ORACLE_SQL = None
