"""Partition routing and ordering helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_by_index(df: DataFrame, index: Column, k: int) -> DataFrame:
    """Each row with its route ``part`` = ``index mod k`` (unknown/NULL ->
    0), a column computed in place; ``sinks.write_routed`` writes by it."""
    part = F.coalesce(F.pmod(index, F.lit(k)), F.lit(0)) if k > 0 else F.lit(0)
    return df.withColumn("part", part.cast("int"))


def cluster_sorted(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Hash-cluster on ``keys``, order rows by ``keys + order`` inside
    each partition (the shuffle-sort of a reduce-side join)."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def sorted_within(df: DataFrame, *cols: str) -> DataFrame:
    """Key order inside each partition (UTF-8 byte order for strings)."""
    return df.sortWithinPartitions(*cols)


def single_partition(df: DataFrame) -> DataFrame:
    """One output partition, for single-row or tiny results only."""
    return df.coalesce(1)
