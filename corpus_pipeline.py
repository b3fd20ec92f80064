"""From raw documents to padded training batches, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and is written as Parquet and read again. All stages but the last return
the columns of ``documents``; ``n_chars`` follows the text where it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import lines, mixing, packing, quality, simhash
from wayfare.llm.common import materialise, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null, empty and very long texts are scored like any other (the first two
    as one passage of zeros), rows with equal texts alike; a row without a
    label or an id is scored too. Without any label all score 0.5 and stay.
    An empty table stays empty; further columns of any name pass through."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that ten or more of them share.

    A null or empty text is one empty line and stays as an empty text; a
    document that loses all its lines stays, empty. Rows repeated whole, and
    rows without an id, count as the line operator says. Texts of any length
    are split whole; an empty table stays empty; further columns pass."""
    kept = lines.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id.

    Null, empty and blank texts share fingerprint zero, hence one group. Of
    equal ids the smaller hash of the row decides, of rows repeated whole one
    stays; null ids come last. An empty table stays empty; further columns of
    any name pass through."""
    return simhash.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken twice is there twice.

    Null and empty texts take no words; they are there as often as their
    source takes all its documents. A null source is a source of its own, the
    last. Among equal sizes a seeded hash chooses, rows repeated whole are
    chosen one by one. An empty table stays empty; further columns pass."""
    return mixing.repeated(mixing.mix(docs), docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of text in the padded batches.

    A text longer than the longest bucket becomes several pieces, a null or
    empty one a piece without words; repeated rows are placed one by one. Other
    columns are not kept; an empty table gives no batches."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", one_of_each),
    ("mix_sources", mix_sources),
    ("pack", pack_batches),
]

#: Trained models and XXH64 are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
