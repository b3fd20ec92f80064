"""Line-oriented text scans (S1) and re-reading tab-separated part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``); LF, CR and CRLF all end a line."""
    return spark.read.text(path)


def document_lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Split multi-line documents into (doc_id, line) rows, like a line scan."""
    return documents.select(
        "doc_id", F.explode(F.split(F.col(text_col), "\r\n|\r|\n")).alias("value")
    )


def read_tab_parts(spark: SparkSession, directory: str, schema: StructType | str) -> DataFrame:
    """Read a previous job's ``part*`` files as tab-separated typed columns."""
    return (
        spark.read.option("sep", "\t")
        .option("header", "false")
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(directory.rstrip("/") + "/part*")
    )
