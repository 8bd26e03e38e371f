"""From raw documents to shards: quality, near duplicates, contamination, mixture, order.

Each stage takes (spark, docs, folder of the tables) and works on all that the
one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.contamination import decontaminated
from strata.llm.mixing import Goal, mixed
from strata.llm.near_dups import without_near_duplicates
from strata.llm.quality import quality_kept
from strata.llm.sharding import sharded
from strata.llm.shared import table
from strata.session import settled

SHARDS = 24


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the quality rules; rejected ones go."""
    return quality_kept(docs, table(spark, folder, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8), with the smallest id."""
    return without_near_duplicates(docs, size=5, percent=80)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    return decontaminated(docs, table(spark, folder, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document at least once, those of small sources repeated to the mixture's weights."""
    return mixed(docs, Goal(entropy=0.95, passes=4.0))


def into_shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows with shard and slot, in Hilbert-curve order."""
    return sharded(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near duplicates", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("mixing", to_target_weights),
    ("sharding", into_shards),
]

#: The token hashes and the random draws of the stages have no counterpart in DuckDB; tests/llm hold them against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next one."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, folder)
        if name != STAGES[-1][0]:
            docs = settled(docs, f"stage-{name.replace(' ', '-')}")
    return docs
