"""The training-data pipeline: quality rules, near-dedup, decontamination, personal data, packing.

Each stage takes (session, documents, folder of the tables) and returns a
DataFrame. ``run`` writes every stage's rows as Parquet to the shared folder
and reads them again as the next one's documents, so a lost executor repeats
tasks of one stage only. All stages but the last keep the columns of the table:

* ``quality``: boilerplate lines go, documents that fail the rules go;
* ``near_duplicates``: one document of each component of 5-word Jaccard 0.8 or more stays, the smallest doc_id;
* ``decontamination``: documents that hold a benchmark item go;
* ``personal_data``: personal data is masked in the text;
* ``packing``: the pieces of all that is left, in sequences of equal cost.

Nulls, empty texts, ties, repeated rows and empty tables: as each operator
says. Extra columns pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import decontamination, jaccard, packing, pii, quality
from demandloom.llm.common import prepare, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.clean(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_balanced(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
