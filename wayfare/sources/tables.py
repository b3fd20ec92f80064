"""Driver parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.session import table_path


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None
) -> DataFrame:
    """Scan one table; naming ``columns`` keeps the Parquet ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
