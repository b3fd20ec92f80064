"""Packing documents into padded batches with optimal length buckets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import content_key, materialise, row_slices, texts_as_bytes, with_rank

MAX_TOKENS = 2048
BATCH_TOKENS = 16384
BUCKETS = 12
SEED = 42

# A word with the spaces after it; the first word also has those before it.
UNIT = re.compile(rb"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def cut(text: bytes, max_tokens: int) -> list[tuple[int, bytes]]:
    """(words, piece) pairs that joined give back the text; every piece but
    the last has ``max_tokens`` words."""
    words = len(text.split())
    if words <= max_tokens:
        return [(words, text)]
    starts = [m.start() for m in UNIT.finditer(text)][::max_tokens]
    return [(min(max_tokens, words - i * max_tokens), text[s:e])
            for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(text)]))]


def pieces(docs: DataFrame, text: str, doc_id: str, max_tokens: int, keep_text: bool) -> DataFrame:
    """(doc_id, _doc1, _doc2, piece, n_tokens[, text]); a token is a word."""
    first, second = content_key(doc_id, text)
    rows = docs.select(F.col(doc_id), first.alias("_doc1"), second.alias("_doc2"), F.col(text).alias("_text"))
    names = [doc_id, "_doc1", "_doc2", "piece", "n_tokens", *[text] * keep_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole):
                parts = [cut(t, max_tokens) for t in texts_as_bytes(batch.column(3))]
                owner = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
                columns = [batch.column(i).take(owner) for i in range(3)]
                columns.append(pa.array([i for p in parts for i in range(len(p))], pa.int32()))
                columns.append(pa.array([n for p in parts for n, _ in p], pa.int32()))
                if keep_text:
                    columns.append(pa.array([t for p in parts for _, t in p], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = docs.select(doc_id).schema[0].dataType.simpleString()
    schema = f"`{doc_id}` {id_type}, _doc1 bigint, _doc2 bigint, piece int, n_tokens int"
    return rows.mapInArrow(run, schema + f", `{text}` string" * keep_text)


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``lengths`` ascend. With C and S the running counts and tokens, a bucket
    over lengths i+1..j pads lengths[j] * (C[j] - C[i]) - (S[j] - S[i]); best[j]
    is the least padding of the lengths up to j with the buckets so far.
    """
    n = len(lengths)
    if not n:
        return []
    below = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        now, cut_at = best.copy(), np.arange(n + 1)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (below[j] - below[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(cost))
            if cost[i] < now[j]:
                now[j], cut_at[j] = cost[i], i
        best = now
        cuts.append(cut_at)
    bounds, j = [], n
    for cut_at in reversed(cuts):
        if cut_at[j] != j:
            bounds.append(int(lengths[j - 1]))
            j = int(cut_at[j])
    return bounds[::-1]


def bucket_of(length: Column, bounds: list[int]) -> Column:
    chain = F.lit(bounds[-1])
    for bound in reversed(bounds[:-1]):
        chain = F.when(length <= bound, F.lit(bound)).otherwise(chain)
    return chain.cast("int")


def pack(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    max_tokens: int = MAX_TOKENS,
    batch_tokens: int = BATCH_TOKENS,
    buckets: int = BUCKETS,
    keep_text: bool = True,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, piece, n_tokens, bucket_len, batch, slot[, text]): where each
    piece of each document lies in the padded batches.

    Texts longer than ``max_tokens`` words are cut into consecutive pieces, so
    nothing is lost and the histogram has at most ``max_tokens`` + 1 rows; it
    is all that reaches the driver, which chooses the bucket bounds. A batch
    of a bucket holds ``batch_tokens`` // bucket_len pieces (one at least) in
    seeded order. Null and empty texts are one piece without words in the
    smallest bucket. Equal rows are packed each. Other columns are not kept.
    An empty table gives an empty table.
    """
    cut_up = materialise(pieces(docs, text, doc_id, max_tokens, keep_text), "pieces")
    histogram = cut_up.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("count")).orderBy("n_tokens").toPandas()
    lengths = histogram["n_tokens"].to_numpy(np.int64)
    bounds = bucket_bounds(lengths, histogram["count"].to_numpy(np.int64), buckets) or [max_tokens]
    placed = cut_up.withColumn("bucket_len", bucket_of(F.col("n_tokens"), bounds))
    order = F.xxhash64(F.lit(seed), "_doc1", "_doc2", "piece")
    ranked = with_rank(placed, ["bucket_len"], order, [F.col("_doc1"), F.col("_doc2"), F.col("piece")])
    room = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    place = F.col("rank") - 1
    return ranked.select(
        doc_id, "piece", "n_tokens", "bucket_len",
        F.floor(place / room).cast("long").alias("batch"), (place % room).cast("int").alias("slot"),
        *[text] * keep_text)
