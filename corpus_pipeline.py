"""From raw documents to a training mixture: five stages over a folder of tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
below the shared folder and hands the reread table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import staged, table
from fleetpulse.llm.decontaminate import decontaminated
from fleetpulse.llm.mixing import take
from fleetpulse.llm.quality import quality_filter
from fleetpulse.llm.simhash import distinct_documents
from fleetpulse.llm.suffixes import deduplicated_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, the one with the smallest id.

    Three-word shingles and at most three differing bits, as in the operator's contract.
    """
    return distinct_documents(docs, size=3, threshold=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without what earlier ones hold; a document of which nothing is left goes."""
    return deduplicated_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each copy of each document taken."""
    return take(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_weights", mixing_to_weights),
]
# Fingerprints, suffix arrays, alignment and random flights have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
