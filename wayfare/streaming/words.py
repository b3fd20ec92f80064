"""Incremental word counts over a directory that receives text files.

State is one row per distinct word (bounded by the vocabulary, not by the
input), kept in the state store under a checkpoint in the shared folder,
so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions.predicates import DEFAULT_LETTERS
from wayfare.operators.words import letter_tokens, word_count
from wayfare.session import shared_dir


def word_count_stream(spark: SparkSession, input_dir: str, letters: str = DEFAULT_LETTERS,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (word, n) over every line of every file in ``input_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(input_dir)
    return word_count(letter_tokens(lines, text_col="value", letters=letters))


def start_word_count(spark: SparkSession, input_dir: str, name: str = "word_count",
                     sink: str = "memory", output_mode: str = "complete",
                     checkpoint: str | None = None, available_now: bool = True,
                     **sink_options: str) -> StreamingQuery:
    """Start the stream; ``complete`` re-emits all counts, ``update`` only
    the changed ones. With ``available_now`` it processes what is there and
    stops. The default checkpoint is fixed per (name, input_dir), so starting
    the same query again resumes from its committed offsets and state."""
    tag = hashlib.sha1(input_dir.encode()).hexdigest()[:12]
    ckpt = checkpoint or shared_dir(spark, "streams", f"{name}_{tag}")
    writer = (word_count_stream(spark, input_dir).writeStream.format(sink)
              .outputMode(output_mode).option("checkpointLocation", ckpt))
    if sink == "memory":
        writer = writer.queryName(name)
    for k, v in sink_options.items():
        writer = writer.option(k, v)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
