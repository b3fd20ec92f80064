"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The windows of all benchmark items are the patterns and words are their
symbols. A shift table over blocks of words says how far the search may jump
without missing a window's end; where it may not jump, the block's suffix
bucket names the windows to test, and direct comparison of all their words
decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import boxed, content_key, materialise, row_slices, texts_as_bytes, unboxed, without

WINDOW_WORDS = 10
# Words of a block: two are rare enough together for long jumps.
BLOCK_WORDS = 2
# Items are cut into overlapping pieces of so many words; a search holds the
# pieces of one shard, of about so many bytes, and a broadcast is no more.
PIECE_WORDS, SHARD_BYTES = 4096, 2 << 20
# Bytes of a text that are split into words at once.
SLICE_BYTES = 1 << 20

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, some at a time: runs of digits, letters A-Z
    (lower-cased) and characters beyond ASCII."""
    body = text.translate(_TABLE)
    at = 0
    while at < len(body):
        stop = body.find(b" ", at + SLICE_BYTES)
        stop = len(body) if stop < 0 else stop
        yield body[at:stop].split()
        at = stop


def cut_pieces(words: Iterable[list[bytes]], window: int = WINDOW_WORDS) -> Iterator[bytes]:
    """Pieces that together have all windows of a text and no other ones; a
    text of fewer words than a window is one piece, one without words none."""
    held: list[bytes] = []
    for part in words:
        held += part
        while len(held) > PIECE_WORDS:
            yield b" ".join(held[:PIECE_WORDS])
            held = held[PIECE_WORDS - window + 1:]
    if held:
        yield b" ".join(held)


class _Length:
    """Tables of the windows of one length. A window is kept as its piece and
    its place there, some 400 bytes with its share of the tables."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[int]] = {}  # by the last block, then the first
        self.windows: list[tuple[list[bytes], int]] = []
        self.owners: list[list[int]] = []

    def same(self, number: int, words: list[bytes], start: int) -> bool:
        piece, at = self.windows[number]
        return piece[at:at + self.length] == words[start:start + self.length]

    def add(self, piece: list[bytes], start: int, owner: int) -> None:
        end = start + self.length
        bucket = self.bucket.setdefault((*piece[end - self.block:end], *piece[start:start + self.block]), [])
        for number in bucket:
            if self.same(number, piece, start):
                if self.owners[number][-1] != owner:
                    self.owners[number].append(owner)
                return
        bucket.append(len(self.windows))
        self.windows.append((piece, start))
        self.owners.append([owner])
        for stop in range(start + self.block, end + 1):
            block = tuple(piece[stop - self.block:stop])
            if end - stop < self.shift.get(block, self.jump):
                self.shift[block] = end - stop

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, owners) of every window in ``words``, in order."""
        length, block, jump, shift, bucket = self.length, self.block, self.jump, self.shift.get, self.bucket.get
        end, n = length, len(words)
        while end <= n:
            last = tuple(words[end - block:end])
            step = shift(last, jump)
            if step:
                end += step
                continue
            start = end - length
            for number in bucket((*last, *words[start:start + block]), ()):
                if self.same(number, words, start):
                    yield start, self.owners[number]
            end += 1


class Patterns:
    """The windows of the pieces of one shard, by length: all have
    ``window`` words but those of shorter pieces."""

    def __init__(self, pieces: list[bytes], window: int = WINDOW_WORDS):
        by_length: dict[int, _Length] = {}
        known: dict[bytes, bytes] = {}
        for owner, piece in enumerate(pieces):
            words = [known.setdefault(w, w) for w in piece.split(b" ")]
            length = min(window, len(words))
            tables = by_length.setdefault(length, _Length(length))
            for i in range(len(words) - length + 1):
                tables.add(words, i, owner)
        self.lengths = [by_length[k] for k in sorted(by_length)]
        self.overlap = max(by_length, default=1) - 1

    def search(self, text: bytes) -> tuple[int, list[int], set[int]]:
        """How many words the text has, the spans of words inside windows
        (start, end, start, end, ... in order, disjoint), and the owners of
        the windows found. Slices overlap by a window less one word."""
        total, tail = 0, []
        starts: list[int] = []
        ends: list[int] = []
        owners: set[int] = set()
        for part in word_slices(text):
            words = tail + part
            base = total - len(tail)
            for tables in self.lengths:
                for start, who in tables.find(words):
                    starts.append(base + start)
                    ends.append(base + start + tables.length)
                    owners.update(who)
            total += len(part)
            tail = words[-self.overlap:] if self.overlap else []
        return total, merge_spans(starts, ends), owners


def merge_spans(starts: list[int], ends: list[int]) -> list[int]:
    """The union of spans, flat and in order; touching spans become one."""
    out: list[int] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += (s, e)
    return out


def pieces_of(benchmark: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """(item, piece, words): the pieces of every item under 128-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole):
                for item, body in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                    pieces = list(cut_pieces(word_slices(body), window))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(pieces), pa.string()),
                         pa.array([xxhash.xxh3_128_digest(p) for p in pieces], pa.binary()),
                         pa.array(pieces, pa.binary())], names=["item", "piece", "words"])

    items = benchmark.select(F.col(item_id).cast("string"), F.col(text))
    return items.mapInArrow(run, "item string, piece binary, words binary")


FOUND = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
         T.StructField("pieces", T.ArrayType(T.BinaryType()))]


def search(rows: DataFrame, names: list[bytes], pieces: list[bytes], window: int, only_hit: bool = False) -> DataFrame:
    """``rows`` with, in place of their last column (the text), its n_words,
    the spans of words inside windows of ``pieces``, and the ``names`` of the
    pieces found; ``only_hit`` leaves the other rows out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(pieces, window)
        for whole in batches:
            for batch in row_slices(whole):
                found = [patterns.search(t) for t in texts_as_bytes(batch.column(batch.num_columns - 1))]
                out = pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([n for n, _, _ in found], pa.int64()),
                     pa.array([spans for _, spans, _ in found], pa.list_(pa.int64())),
                     pa.array([[names[i] for i in sorted(who)] for _, _, who in found], pa.list_(pa.binary()))],
                    names=[*batch.schema.names[:-1], *(f.name for f in FOUND)])
                yield out.filter(pa.array([bool(who) for _, _, who in found], pa.bool_())) if only_hit else out

    return rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1] + FOUND))


def _with_more(base: DataFrame, more: DataFrame) -> DataFrame:
    """``base`` with the spans and pieces that further shards found."""
    key = ["_doc1", "_doc2"]
    # equal rows find the same, so sets hold no more than one row's finds
    added = more.groupBy(*key).agg(F.flatten(F.collect_set("spans")).alias("_spans"),
                                   F.flatten(F.collect_set("pieces")).alias("_pieces"))
    both = lambda c: F.concat(c, F.coalesce(f"_{c}", F.array().cast(base.schema[c].dataType))).alias(c)
    rows = base.join(added, key, "left").select("_row", *key, "n_words", both("spans"), both("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("spans")
            spans = [merge_spans(s[::2], s[1::2]) for s in batch.column(at).to_pylist()]
            yield batch.set_column(at, "spans", pa.array(spans, pa.list_(pa.int64())))

    return rows.mapInArrow(run, rows.schema)


def find_benchmark_words(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    keep: list[str] | None = None,
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and n_words, n_hit,
    spans, items and contaminated, one row for each row of ``docs``.

    A window is ``window`` consecutive words of an item, or all words of an
    item with fewer. A word of a document is hit if it is inside any
    occurrence of a window. ``spans`` has the runs of hit words as (first,
    end) word numbers from 0, ``items`` the ids, as text and sorted, of the
    items with occurring windows. Null and empty texts and texts without words
    have no words; such items have no windows. Windows of an item with a null
    id hit words, but there is no id to list. Repeated rows and repeated items
    count like one each; an empty benchmark hits nothing, an empty table gives
    an empty table. Very long texts are searched a slice at a time, very long
    items in overlapping pieces. Columns of the input with the names of the
    added ones give way; any other name is safe.

    Documents are searched where they are read, against one broadcast shard
    of the windows, of about ``SHARD_BYTES``; a larger benchmark is more
    shards and a pass over the documents for each. No text is shuffled.
    """
    added = ["n_words", "n_hit", "spans", "items", "contaminated"]
    spark = docs.sparkSession
    pieces = materialise(pieces_of(benchmark, item_text, item_id, window), "benchmark_pieces")
    # equal pieces have equal words
    words = materialise(pieces.groupBy("piece").agg(F.first("words").alias("words")), "benchmark_windows")
    n_bytes = words.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    n_shards = max(1, -(-n_bytes // SHARD_BYTES))
    number = F.pmod(F.xxhash64("piece"), F.lit(n_shards))
    clean = without(docs, *added)
    keep = [c for c in (keep or clean.columns) if c in clean.columns]
    first, second = content_key(doc_id, text)
    rows = docs.select(boxed(keep), first.alias("_doc1"), second.alias("_doc2"), F.col(text).alias("_text"))
    base, more = None, []
    for k in range(n_shards):
        shard = words.where(number == k).toArrow()
        names, bodies = shard["piece"].to_pylist(), shard["words"].to_pylist()
        if base is None:
            base = materialise(search(rows, names, bodies, window), "searched")
        else:
            found = search(rows.drop("_row"), names, bodies, window, only_hit=True)
            more.append(materialise(found, "searched"))
    if more:
        paths = [p for m in more for p in m.inputFiles()]
        base = _with_more(base, spark.read.schema(more[0].schema).parquet(*paths) if paths else more[0])
    owners = pieces.where(F.col("item").isNotNull()).select("piece", "item").distinct()
    small = owners.agg(F.coalesce(F.sum(F.octet_length("item") + 16), F.lit(0))).first()[0] <= SHARD_BYTES
    hits = base.where(F.size("pieces") > 0).select("_doc1", "_doc2", F.explode("pieces").alias("piece")).distinct()
    # a passage in very many documents is a hot piece: met by broadcast, or in a join that Spark splits
    items = (hits.join(F.broadcast(owners) if small else owners, "piece")
             .groupBy("_doc1", "_doc2").agg(F.array_sort(F.collect_set("item")).alias("items")))
    out = base.join(items, ["_doc1", "_doc2"], "left")
    last = (F.size("spans") / 2).cast("int") - 1
    pairs = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.get("spans", 2 * i).alias("first"), F.get("spans", 2 * i + 1).alias("end")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    # end - start + end - start ... : each step takes what is summed so far from the next bound
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: x - n)
    return unboxed(out, {
        "n_words": F.col("n_words"), "n_hit": n_hit,
        "spans": F.when(F.size("spans") > 0, pairs).otherwise(none),
        "items": F.coalesce("items", F.array().cast("array<string>")), "contaminated": n_hit > 0})
