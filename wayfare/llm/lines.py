"""Line deduplication over the whole corpus.

Lines are exploded under a normalised key, keys are hashed, the documents of
each hash are counted, lines whose key is too frequent go, and the rest are
put together again by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import boxed, content_key, materialise, row_slices, texts_as_bytes, unboxed, without

MIN_DOCUMENTS = 10
MIN_CHARS = 1

LINE_SCHEMA = "_doc1 bigint, _doc2 bigint, _place int, k1 bigint, k2 bigint, first boolean"


def line_keys(text: bytes) -> list[bytes]:
    """The normalised lines of a UTF-8 text. On bytes, Python lower-cases A-Z
    only and strips exactly space and \\x09-\\x0D."""
    return [line.strip() for line in text.lower().split(b"\n")]


def explode_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line with a key: its document (two hashes), position,
    128-bit key and whether the key is new in its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole):
                counts, places, digests, firsts = [], [], [], []
                for body in texts_as_bytes(batch.column(2)):
                    seen: set[bytes] = set()
                    n = 0
                    for place, key in enumerate(line_keys(body)):
                        if len(key) < min_chars or min_chars > 1 and len(key.decode()) < min_chars:
                            continue
                        n += 1
                        digest = xxhash.xxh3_128_digest(key)
                        places.append(place)
                        digests.append(digest)
                        firsts.append(digest not in seen)
                        seen.add(digest)
                    counts.append(n)
                hashes = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                owner = np.repeat(np.arange(batch.num_rows), counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                     pa.array(places, pa.int32()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]),
                     pa.array(firsts, pa.bool_())],
                    names=["_doc1", "_doc2", "_place", "k1", "k2", "first"])

    return docs.select("_doc1", "_doc2", "_text").mapInArrow(run, LINE_SCHEMA)


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` without the lines found in ``min_documents`` documents or more.

    Every row counts as one document. A key shorter than ``min_chars`` code
    points is never dropped. ``text`` is replaced by the lines that stay,
    joined by ``\\n``; ``n_lines`` (before dropping) and ``n_dropped`` are
    added, and columns of the input with these names give way; any other name
    is safe. Null and empty
    texts are one empty line, which stays. Repeated rows and null ids are
    documents like others; an empty table gives an empty table.

    The hashed lines are written once to the shared checkpoint folder. A line
    in a third of all documents is counted in each task before the shuffle;
    its rows meet the frequent keys in a join that Spark splits when skewed.
    Texts cross the network once, to meet their dropped positions.
    """
    base = without(docs, "n_lines", "n_dropped")
    first, second = content_key(doc_id, text)
    rows = docs.select(boxed([c for c in base.columns if c != text]), first.alias("_doc1"), second.alias("_doc2"),
                       F.col(text).alias("_text"))
    lines = materialise(explode_keys(rows, min_chars), "line_keys")

    frequent = (lines.where("first").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_documents"))
                .where(F.col("n_documents") >= min_documents).select("k1", "k2"))
    dropped = (lines.select("_doc1", "_doc2", "_place", "k1", "k2").join(frequent, ["k1", "k2"])
               .groupBy("_doc1", "_doc2").agg(F.collect_set("_place").alias("_dropped")))

    split = (rows.join(dropped, ["_doc1", "_doc2"], "left")
             .withColumn("_lines", F.split(F.coalesce("_text", F.lit("")), "\n", -1)))
    # array_except works by hashing and keeps the order of the positions
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(stay, lambda p: F.get(F.col("_lines"), p)), "\n")
    new_text = F.when(F.col("_dropped").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept)
    out = unboxed(split, {text: new_text, "n_lines": F.size("_lines").cast("bigint"),
                          "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint")})
    return out.select(*[F.col(f"`{c}`") for c in base.columns], "n_lines", "n_dropped")
