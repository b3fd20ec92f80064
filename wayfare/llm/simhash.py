"""SimHash fingerprints and near-duplicate groups.

Distinct fingerprints are dealt to blocks by ranges of their Gray rank. The
blocks' shared bits form the top of the hierarchical index; it names the
blocks a fingerprint may have a partner in. Inside a block the lower levels of
the index find the partners.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import append_columns, boxed, content_key, materialise, texts_as_bytes, unboxed
from wayfare.llm.components import connected_components
from wayfare.llm.gray import GrayIndex, gray_rank

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42

# Blocks of the index, and how many fingerprints a block should hold before
# more are made. A fingerprint visits the blocks whose shared bits are within
# reach, a number that grows with the square of the bits that tell blocks
# apart, so there are as few blocks as memory allows. The top of the index,
# which every task gets, is 16 bytes a block: at most 64 KB.
BLOCKS, MAX_BLOCKS = 256, 4096
BLOCK_ROWS = 1 << 17
# Shingles whose bits are counted at once, and queries searched at once.
BITS_AT_ONCE = 1 << 16
QUERIES_AT_ONCE = 2048
# Bytes of a text whose words are held at once.
SLICE_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of ``text``, lower-cased, slice by slice of about ``size``
    bytes. On bytes, Python lower-cases A-Z only and splits at space and
    \\x09-\\x0D."""
    at = 0
    while at < len(text):
        gap = SPACE.search(text, at + size)
        stop = gap.start() if gap else len(text)
        yield text[at:stop].lower().split()
        at = stop


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, size: int = SLICE_BYTES) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text (0 without words).

    A long text is read slice by slice; the last words of a slice begin the
    shingles that reach into the next one.
    """
    ones, total, words = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for part in word_slices(text, size):
        words = words + part
        if len(words) < shingle_words:
            continue
        joined = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        ends = (stops[shingle_words - 1:] - 1).tolist()
        starts = [0, *stops[:len(ends) - 1].tolist()]
        for at in range(0, len(ends), BITS_AT_ONCE):
            spans = zip(starts[at:at + BITS_AT_ONCE], ends[at:at + BITS_AT_ONCE])
            hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
            ones += _bits(hashes)
        total += len(ends)
        words = words[len(ends):]
    if not total:
        if not words:
            return 0
        ones, total = _bits(np.array([digest(b" ".join(words), SEED)], "<u8")), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def with_fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the long column ``fingerprint`` (the 64 bits, signed)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            codes = np.array([fingerprint(t, shingle_words) for t in texts_as_bytes(column)], np.uint64)
            yield [pa.array(codes.view(np.int64))]

    return append_columns(docs, T.StructType([T.StructField("fingerprint", T.LongType())]), make)


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def _gray_order(code: Column) -> Column:
    """The Gray rank as a signed long that sorts like the unsigned rank."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _blocks(codes: DataFrame) -> DataFrame:
    """Distinct ``code`` with its ``block``: a range of Gray ranks between
    quantiles of all ranks."""
    n_blocks = min(MAX_BLOCKS, max(BLOCKS, -(-codes.count() // BLOCK_ROWS)))
    shares = [i / n_blocks for i in range(1, n_blocks)]
    cuts = codes.agg(F.percentile_approx(_gray_order(F.col("code")), shares, 20 * n_blocks)).first()[0]
    bounds = np.array(sorted(set(cuts or [])), np.int64)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = gray_rank(batch.column(0).to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
            block = np.searchsorted(bounds, rank.view(np.int64), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(block)], names=["code", "block"])

    return codes.select("code").mapInArrow(number, "code bigint, block int")


def _route(blocks: DataFrame, limit: int) -> DataFrame:
    """Every code once for each block at or after its own that may hold a
    partner: the blocks' shared bits are the index's top levels."""
    top = (blocks.groupBy("block").agg(F.bit_and("code").alias("ones"), F.bit_or("code").alias("any"))
           .orderBy("block").toPandas())
    ids = top["block"].to_numpy(np.int32)
    ones, some = (top[c].to_numpy(np.int64).view(np.uint64) for c in ("ones", "any"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GrayIndex(~(ones ^ some), ones)
        for batch in batches:
            codes = batch.column(0).to_numpy().view(np.uint64)
            own = batch.column(1).to_numpy()
            for at in range(0, len(codes), QUERIES_AT_ONCE):
                part, mine = codes[at:at + QUERIES_AT_ONCE], own[at:at + QUERIES_AT_ONCE]
                who, entry = index.search(part, limit)
                later = ids[entry] >= mine[who]
                who, entry = who[later], entry[later]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[entry]), pa.array(part[who].view(np.int64)),
                     pa.array(mine[who] != ids[entry])], names=["block", "code", "guest"])

    if not len(ids):
        return blocks.select("block", "code", F.lit(False).alias("guest"))
    return blocks.select("code", "block").mapInArrow(run, "block int, code bigint, guest boolean")


class _Block:
    """Members of one block, then its guests; finds links and merges members
    that share a partner, so that what leaves the block grows with the rows
    that came in and not with the pairs among them."""

    def __init__(self, limit: int):
        self.limit = limit
        self.parts: list[np.ndarray] = []
        self.index: GrayIndex | None = None

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def build(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        codes = np.concatenate(self.parts)
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.parent = list(range(len(codes)))
        self.index = GrayIndex(np.full(len(codes), ~np.uint64(0)), self.codes)
        for at in range(0, len(codes), QUERIES_AT_ONCE):
            who, entry = self.index.search(self.codes[at:at + QUERIES_AT_ONCE], self.limit)
            for a, b in zip((who + at).tolist(), entry.tolist()):
                if a < b and (ra := self.root(a)) != (rb := self.root(b)):
                    self.parent[rb] = ra
        yield from ()

    def guests(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Link each guest to one partner and merge all its partners."""
        left, right = [], []
        for at in range(0, len(codes), QUERIES_AT_ONCE):
            part = codes[at:at + QUERIES_AT_ONCE]
            who, entry = self.index.search(part, self.limit)
            order = np.argsort(who, kind="stable")
            last, first = -1, 0
            for w, e in zip(who[order].tolist(), entry[order].tolist()):
                if w != last:
                    last, first = w, e
                    left.append(part[w])
                    right.append(self.codes[e])
                elif (ra := self.root(first)) != (rb := self.root(e)):
                    self.parent[rb] = ra
        return np.array(left, np.uint64), np.array(right, np.uint64)

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        roots = np.array([self.root(i) for i in range(len(self.parent))], np.int64)
        moved = np.nonzero(roots != np.arange(len(roots)))[0]
        return self.codes[moved], self.codes[roots[moved]]


def links(codes: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """Links (u, v) that connect all distinct ``code`` values at most
    ``limit`` bits apart: not all pairs, but the same components."""
    blocks = _blocks(codes)
    routed = _route(blocks, limit)

    def batch_of(pair: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            codes_ = batch.column(1).to_numpy().view(np.uint64)
            guest = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.nonzero((ids[1:] != ids[:-1]) | (guest[1:] != guest[:-1]))[0] + 1
            for s, e in zip([0, *cuts], [*cuts, len(ids)]):
                if s == e:
                    continue
                if ids[s] != current:
                    if block is not None:
                        if block.index is None:
                            list(block.build())
                        yield batch_of(block.stars())
                    current, block = ids[s], _Block(limit)
                if not guest[s]:
                    block.parts.append(codes_[s:e])
                else:
                    if block.index is None:
                        list(block.build())
                    yield batch_of(block.guests(codes_[s:e]))
        if block is not None:
            if block.index is None:
                list(block.build())
            yield batch_of(block.stars())

    # members come before guests; guests stream, so a block that many codes
    # visit takes time but no memory
    dealt = routed.repartition("block").sortWithinPartitions("block", "guest")
    return dealt.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    limit: int = MAX_DISTANCE,
) -> DataFrame:
    """(``doc_id``, two hashes of the row, ``fingerprint``, ``component_id``)
    for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints
    that differ in at most ``limit`` bits, itself included. Null and empty
    texts and texts without words have fingerprint zero and are linked like
    any other. Equal fingerprints are one node, however many rows share them.
    Null ids get a component like others; it is null only if all its ids are.
    An empty table gives an empty table.
    """
    first, second = content_key(doc_id, text)
    rows = docs.select(F.col(doc_id), first.alias("_doc1"), second.alias("_doc2"), F.col(text).alias("_text"))
    marked = materialise(with_fingerprints(rows, "_text", shingle_words).drop("_text"), "fingerprints")
    codes = materialise(marked.groupBy("fingerprint").agg(F.min(doc_id).alias("_least")), "codes")
    found = connected_components(links(codes.select(F.col("fingerprint").alias("code")), limit))
    placed = (codes.join(found, codes["fingerprint"] == found["node"], "left")
              .select("fingerprint", "_least", F.coalesce("component", "fingerprint").alias("_component")))
    least = placed.groupBy("_component").agg(F.min("_least").alias("component_id"))
    home = materialise(placed.join(least, "_component").select("fingerprint", "component_id"), "code_components")
    return marked.join(home, "fingerprint")


def one_of_each_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      shingle_words: int = SHINGLE_WORDS, limit: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, then the smallest
    hash of the row; null ids come last. Of equal rows one stays. Any column
    names are safe."""
    order = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), "_doc1", "_doc2")
    groups = near_duplicates(docs, text, doc_id, shingle_words, limit)
    # a component is named by its smallest id, and rows without one by their code
    name = F.coalesce(F.col("component_id").cast("string"), hex_code(F.col("fingerprint")))
    kept = groups.groupBy(name).agg(F.min(order).alias("k")).select("k._doc1", "k._doc2")
    first, second = content_key(doc_id, text)
    rows = docs.select(boxed(docs.columns), first.alias("_doc1"), second.alias("_doc2"))
    stay = rows.join(kept, ["_doc1", "_doc2"], "left_semi")
    return unboxed(stay.dropDuplicates(["_doc1", "_doc2"]), {})
