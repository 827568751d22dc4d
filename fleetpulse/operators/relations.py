"""Small relational helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing from one of them is NULL there."""
    if not dfs:
        raise ValueError("union_by_name needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus column ``name``, computed exactly once per row.

    A filter on a projected column is pushed below the projection, which then computes the
    column's expression twice. For parsing JSON that doubles the work of the whole scan.
    A one-element explode is a boundary that predicates do not cross; it adds no shuffle
    and keeps the row count.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
