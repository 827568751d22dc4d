"""Helpers the operators share: words, staged tables, connected components."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.sources.storage import scratch

# A word is a run of bytes other than space and the five control characters after tab.
SPACES = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def byte_words(text: bytes | None) -> list[bytes]:
    """As ``words`` for UTF-8 bytes, with A-Z in lower case (both rules are ASCII rules)."""
    return text.lower().split() if text else []


def row_key(docs: DataFrame) -> Column:
    """A 64-bit name of a row, from all its columns; equal rows share it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """Remainder that splits documents into folds; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


# Removes the shuffle files of a query when it ends; without it they stay until the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once and kept as a table in the shared folder.

    Nothing reads its shuffles again, so their files go as soon as the table is there.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREED, before) if before is not None else spark.conf.unset(FREED)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (u, v), as rows (u, root), root < u.

    Alternates two steps that turn every component into a star around its smallest node.
    Each step is a minimum per node and a join, so a node with very many neighbours is
    never gathered in one place, and a chain of n nodes needs about log n rounds. Nodes
    without an edge, and the roots themselves, have no row. Equal and looped edges are
    allowed; edges with a null end are ignored.
    """
    current = staged(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if mark[0] == 0 or mark == before:
            return current.select("u", F.col("v").alias("root"))
        before = mark
        both = current.select("u", "v").union(current.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = staged(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
