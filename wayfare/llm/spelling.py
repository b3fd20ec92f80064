"""Spelling variant grouping by Bloom-guided neighbourhoods.

All single edits of every word are hashed and probed against blocked Bloom
filters of the vocabulary, one for each word length, which are broadcast. Only
edits that the filters know are made as strings and shuffled; a join with the
vocabulary removes the false positives.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import materialise, row_slices

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
DROP_ONE_IN = 97
# Words that a task counts before it spills them; characters split at once.
COUNTED, SLICE_CHARS = 300_000, 1 << 20
# Bits of a filter per word; a filter is made of 64-bit blocks, a word sets
# BLOCK_BITS bits in each of two. Blocks of a filter built in one group, and
# the blocks (8 bytes each) of all filters that are broadcast at once.
BITS_PER_WORD, BLOCK_BITS, CHUNK_BLOCKS, BROADCAST_BLOCKS = 40, 4, 1 << 12, 1 << 22
# Blocks of the smallest filter: with few words of a length (as there are of
# very long words) hardly an edit passes by mistake.
LEAST_BLOCKS = 64
# Edits hashed at once, words whose edits are a task's work, and characters of
# edited words made at once.
EDITS, TASK_WORDS, EDITED_CHARS = 1 << 17, 20_000, 1 << 22

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_DRAW = np.random.default_rng(97)
_CODE = _DRAW.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = np.uint64(pow(_BASE, -1, 1 << 64))  # _BASE * _UNBASE = 1 modulo 2**64


# ------------------------------------------------------------------ vocabulary
def run_counts(text: str, doc_id: str) -> Counter:
    """The words of a text, in Latin-1: maximal runs of letters, A-Z in lower
    case; a run for which DROP_ONE_IN divides the CRC of ``doc_id:run`` loses
    one code point."""
    runs: Counter = Counter()
    at = 0
    while at < len(text):
        stop = at + SLICE_CHARS
        part = text[at:stop].encode("latin-1", "replace").translate(_TABLE)
        if stop < len(text):  # up to the last run that surely ends here
            cut = part.rfind(b" ") + 1
            if not cut:  # one run goes on: find its end
                part = text[at:].encode("latin-1", "replace").translate(_TABLE)
                cut = part.find(b" ") + 1 or len(part)
            part = part[:cut]
        runs.update(part.split(b" "))
        at += len(part)
    runs.pop(b"", None)
    start = zlib.crc32(f"{doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        crc = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if crc % DROP_ONE_IN == 0:
            i = crc % len(run)
            run = run[:i] + run[i + 1:]
        words[run] += n
    return words


def vocabulary(docs: DataFrame, text: str, doc_id: str, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of all words long and frequent enough; tasks count first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def spill() -> Iterator[pa.RecordBatch]:
            words = [w.decode("latin-1") for w in counts]
            totals = list(counts.values())
            counts.clear()
            for s in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[s:s + 50_000], pa.string()),
                                                  pa.array(totals[s:s + 50_000], pa.int64())], names=["word", "n"])

        get = counts.get
        for whole in batches:
            for batch in row_slices(whole):
                for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for word, n in run_counts(body or "", key).items():
                        if len(word) >= min_length:
                            counts[word] = get(word, 0) + n
                    if len(counts) > COUNTED:
                        yield from spill()
        yield from spill()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text))
    words = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= min_count).select("word", "n", F.length("word").alias("length"))


# --------------------------------------------------------------- Bloom filters
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def hashes(letters: np.ndarray) -> np.ndarray:
    """The hash of each row of ``letters`` (words of one length, a byte for
    each Latin-1 letter): the sum of the codes of its letters times powers of
    a base, modulo 2**64, so that the hash of an edit follows from the word's."""
    return (_CODE[letters] * _powers(letters.shape[1])).sum(1, dtype=np.uint64)


def spots(h: np.ndarray, n_blocks: int, second: bool) -> tuple[np.ndarray, np.ndarray]:
    """The block and the bits there of each hash: one of two places."""
    h = _mix(h + np.uint64(0x632BE59BD9B4E019)) if second else _mix(h)
    block = ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    bits = np.zeros(len(h), np.uint64)
    for k in range(BLOCK_BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block, bits


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters) of the words of each length."""
    sizes = np.array([len(w) for w in words], np.int64)
    for n in np.unique(sizes):
        rows = np.nonzero(sizes == n)[0]
        yield rows, np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), n)


class Shard:
    """Where the filter of the words of one length is: ``n_blocks`` blocks in
    all, of which this part, ``start`` to ``stop``, is in the array that is
    broadcast now, from ``at`` on."""

    def __init__(self, n_blocks: int, start: int, stop: int, at: int):
        self.n_blocks, self.start, self.stop, self.at = n_blocks, start, stop, at


def filter_sizes(words: DataFrame) -> dict[int, int]:
    """Blocks of the filter of each word length: one row a length."""
    rows = words.groupBy("length").count().collect()
    return {r["length"]: max(LEAST_BLOCKS, -(-r["count"] * BITS_PER_WORD // 64)) for r in rows}


def rounds(sizes: dict[int, int]) -> list[dict[int, Shard]]:
    """The filters dealt to rounds of at most BROADCAST_BLOCKS blocks; a large
    one is divided into parts by ranges of its first block."""
    out: list[dict[int, Shard]] = [{}]
    used = 0
    for length in sorted(sizes):
        start = 0
        while start < sizes[length]:
            if used >= BROADCAST_BLOCKS:
                out.append({})
                used = 0
            stop = min(sizes[length], start + BROADCAST_BLOCKS - used)
            out[-1][length] = Shard(sizes[length], start, stop, used)
            used += stop - start
            start = stop
    return out


def build_filters(words: DataFrame, shards: dict[int, Shard]) -> np.ndarray:
    """The blocks of this round's shards. Words go to chunks of blocks by
    their hash, a chunk is built in one group, and whole chunks, 8 bytes a
    block, come to the driver: at most 8 * BROADCAST_BLOCKS bytes."""
    known = dict(shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in by_length([w.encode("latin-1") for w in batch.column(0).to_pylist()]):
                shard = known.get(letters.shape[1])
                if shard is None:
                    continue
                h = hashes(letters)
                for second in (False, True):
                    at, bits = spots_in(shard, h, second)
                    here = at >= 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at[here] // CHUNK_BLOCKS), pa.array(at[here] % CHUNK_BLOCKS),
                         pa.array(bits[here].view(np.int64))], names=["chunk", "block", "bits"])

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        blocks = np.zeros(CHUNK_BLOCKS, np.uint64)
        np.bitwise_or.at(blocks, rows["block"].to_numpy(), rows["bits"].to_numpy().view(np.uint64))
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "blocks": pa.array([blocks.tobytes()], pa.binary())})

    placed = words.select("word").mapInArrow(place, "chunk bigint, block bigint, bits bigint")
    built = placed.groupBy("chunk").applyInArrow(build, "chunk bigint, blocks binary").toArrow()
    total = max((s.at + s.stop - s.start for s in shards.values()), default=0)
    out = np.zeros((-(-total // CHUNK_BLOCKS), CHUNK_BLOCKS), np.uint64)
    for chunk, blocks in zip(built["chunk"].to_pylist(), built["blocks"].to_pylist()):
        out[chunk] = np.frombuffer(blocks, np.uint64)
    return out.ravel()


def spots_in(shard: Shard, h: np.ndarray, second: bool) -> tuple[np.ndarray, np.ndarray]:
    """The place in the broadcast array (-1: not of this part) and the bits.
    Both places of a word are in the part that its first place falls into."""
    first = spots(h, shard.n_blocks, False)[0].astype(np.int64)
    here = (first >= shard.start) & (first < shard.stop)
    block, bits = spots(h, shard.stop - shard.start if second else shard.n_blocks, second)
    at = shard.at + block.astype(np.int64) - (0 if second else shard.start)
    return np.where(here, at, -1), bits


def probe(filters: np.ndarray, shard: Shard, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter knows, as positions."""
    at, bits = spots_in(shard, h, False)
    hit = np.nonzero((at >= 0) & (filters[at] & bits == bits))[0]
    at, bits = spots_in(shard, h[hit], True)
    return hit[filters[at] & bits == bits]


# ----------------------------------------------------------------------- edits
def known_edits(letters: np.ndarray, alphabet: np.ndarray, filters: np.ndarray,
                shards: dict[int, Shard]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row, edited word) for the edits of words of one length that the
    filters know: deletions, and replacements by a larger letter. An insertion
    is the deletion of the longer word and a replacement by a smaller letter
    that of the other word, so every two near words come up once."""
    n = letters.shape[1]
    powers, codes = _powers(n), _CODE[letters]
    sums = np.cumsum(codes * powers, axis=1, dtype=np.uint64)  # hashes of the first 1, 2, ... letters
    shorter, equal = shards.get(n - 1), shards.get(n)
    if shorter is not None:
        last = np.ones(letters.shape, bool)  # of equal letters in a row only the last one goes
        last[:, :-1] = letters[:, :-1] != letters[:, 1:]
        gone = sums - codes * powers + (sums[:, -1:] - sums) * _UNBASE
        row, at = np.nonzero(last)
        for s in range(0, len(row), EDITS):
            hit = s + probe(filters, shorter, gone[row[s:s + EDITS], at[s:s + EDITS]])
            yield from _made(letters, row[hit], at[hit], None)
    if equal is not None:
        wide = max(1, EDITS // (len(letters) * len(alphabet)))
        for s in range(0, n, wide):
            change = (_CODE[alphabet] - codes[:, s:s + wide, None]) * powers[s:s + wide, None]
            row, at, new = np.nonzero(alphabet > letters[:, s:s + wide, None])
            hit = probe(filters, equal, sums[row, -1] + change[row, at, new])
            yield from _made(letters, row[hit], at[hit] + s, alphabet[new[hit]])


def _made(letters: np.ndarray, row: np.ndarray, at: np.ndarray, new: np.ndarray | None) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The edited words as strings, a bounded number of characters at once."""
    n = letters.shape[1]
    step = max(1, EDITED_CHARS // n)
    for s in range(0, len(row), step):
        rows, places = row[s:s + step], at[s:s + step]
        body = letters[rows]
        if new is None:
            body, size = body[np.arange(n) != places[:, None]], n - 1
        else:
            body[np.arange(len(rows)), places], size = new[s:s + step], n
        whole = body.tobytes().decode("latin-1")
        yield rows, [whole[k:k + size] for k in range(0, len(whole), size)]


def candidates(words: DataFrame, alphabet: np.ndarray, filters: np.ndarray, shards: dict[int, Shard]) -> DataFrame:
    """(word, n, edit): the edits of all words that the filters know."""
    lengths = sorted({k for length in shards for k in (length, length + 1)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole):
                body = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
                for rows, letters in by_length(body):
                    step = max(1, EDITS // (letters.shape[1] * len(alphabet)))
                    for s in range(0, len(rows), step):
                        for own, edited in known_edits(letters[s:s + step], alphabet, filters, shards):
                            part = batch.select([0, 1]).take(pa.array(rows[s:s + step][own]))
                            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(edited, pa.string())],
                                                             names=["word", "n", "edit"])

    return words.where(F.col("length").isin(lengths)).select("word", "n").mapInArrow(run, "word string, n bigint, edit string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), once for every two words that differ by one
    inserted, deleted or replaced letter."""
    n_words = words.count()
    dealt = words.repartition(max(1, -(-n_words // TASK_WORDS)), "word")
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()  # at most 90
    alphabet = np.array(sorted(r["letter"].encode("latin-1")[0] for r in letters if r["letter"]), np.uint8)
    found = None
    for shards in rounds(filter_sizes(words)):
        part = candidates(dealt, alphabet, build_filters(words, shards), shards)
        found = part if found is None else found.unionByName(part)
    vocabulary_side = words.select(F.col("word").alias("edit"), F.col("n").alias("other_n"))
    return found.join(vocabulary_side, "edit").select("word", "n", F.col("edit").alias("other"), "other_n")


# ---------------------------------------------------------------------- groups
def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a ``form``: where following forms ends. A
    round doubles the way behind every word; a form is more frequent than
    its word, so there are no circles and few rounds."""
    ways = materialise(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = materialise(ways.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return ways


def variant_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each word of ``docs``.

    Words are runs of letters A-Z (in lower case), a-z and U+00C0 to U+00FF,
    some of them less one letter (see ``run_counts``), of at least
    ``min_length`` letters and ``min_count`` occurrences ``n``. ``n_near``: how
    many other words differ by one inserted, deleted or replaced letter.
    ``form``: the most frequent of these (ties: the first in code-point order)
    if it occurs at least ``ratio`` times as often, else null; ``form_n`` its
    occurrences. ``root``: where following forms ends, the word itself without
    a form.

    Null and empty texts have no words; a null id counts as an empty one.
    Repeated rows count like others. Very long texts are split a slice at a
    time, very long words edited a stretch at a time. An empty table gives an
    empty table; only the two columns are read, so names of others do no harm.

    A task counts its words before they are shuffled, so a frequent word is no
    hot key. Filters of at most ``BROADCAST_BLOCKS`` blocks of 8 bytes are
    broadcast at once; a larger vocabulary takes further rounds.
    """
    words = materialise(vocabulary(docs, text, doc_id, min_length, min_count), "vocabulary")
    near = near_words(words)
    ways = F.explode(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                 F.col("n").alias("other_n")))).alias("way")
    best = F.min(F.struct((-F.col("way.other_n")).alias("order"), F.col("way.other").alias("other"))).alias("best")
    around = near.select(ways).groupBy("way.word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(around, "word", "left")
    form = -F.col("best.order") >= ratio * F.col("n")
    chosen = materialise(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(form, F.col("best.other")).alias("form"), F.when(form, -F.col("best.order")).alias("form_n")), "forms")
    ends = roots(chosen.where(F.col("form").isNotNull()))
    return chosen.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
