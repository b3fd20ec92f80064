"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import shared_dir, table_path

# Fixed character classes of the operators' contracts.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"

# Rows of a group that is ranked in one task, and the ranges of a larger one.
RANK_ROWS, RANK_SPLITS = 50_000, 4096


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read
    it back: later steps neither recompute it nor depend on an executor."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` minus the columns whose names an operator is about to add
    (compared as Spark resolves them, without regard to case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def boxed(columns: list[str]) -> Column:
    """The caller's columns as one struct ``_row``, beside which an operator
    may name its own columns as it likes."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")


def unboxed(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """The caller's columns out of ``_row`` again, and the ``added`` ones. The
    latter are made in a step of their own, where no name of the caller can
    stand for one of theirs."""
    own = [F.col("_row").getField(f.name).alias(f.name) for f in df.schema["_row"].dataType.fields]
    if not added:
        return df.select(*own)
    both = df.select("_row", F.struct(*[c.alias(name) for name, c in added.items()]).alias("_added"))
    return both.select(*own, *[F.col("_added").getField(name).alias(name) for name in added])


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; null ids: false."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(remainder), F.lit(False))


def content_key(*columns: str) -> list[Column]:
    """Two independent 64-bit hashes of the columns (nulls are told apart from
    empty strings), which together stand for their values in joins."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def append_columns(
    df: DataFrame,
    added: T.StructType,
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[list]],
    limit: int = 4 << 20,
) -> DataFrame:
    """``df`` with the columns ``added``. ``make`` maps an iterator of Arrow
    batches to one list of columns per batch; it runs inside tasks. Columns
    of ``df`` with the same names give way to the added ones."""
    base = without(df, *added.names)
    names = base.columns + added.names
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
             "string": pa.string(), "array<float>": pa.list_(pa.float32())}
    arrow = [kinds[f.dataType.simpleString()] for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def kept() -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in row_slices(whole, limit):
                    held.append(batch)
                    yield batch

        for columns in make(kept()):
            batch = held.pop(0)
            new = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t)
                   for c, t in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return base.mapInArrow(run, T.StructType(base.schema.fields + added.fields))


def row_slices(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes (a single row may be more),
    which bounds what a task holds in Python besides its longest row."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_rank(df: DataFrame, group: list[str], order: Column, ties: list[Column], rank: str = "rank",
              size: str | None = None) -> DataFrame:
    """Number the rows of each group 1, 2, ... in the order of the long
    ``order`` (a hash, so that values spread evenly), then ``ties``. The
    columns ``group`` hold no nulls.

    A group may hold a third of all rows, so it is split into ``RANK_SPLITS``
    ranges of ``order``; rows are numbered inside a range and the counts of
    the lower ranges are added. Where a column ``size`` says how many rows a
    group has, only one of more than ``RANK_ROWS`` is split; the others are
    ranked as they are, in one shuffle."""
    large = F.lit(True) if size is None else F.col(size) > RANK_ROWS
    split = F.shiftrightunsigned(order, 64 - (RANK_SPLITS.bit_length() - 1)).cast("int")
    rows = df.withColumns({"_order": order, "_split": F.when(large, split).otherwise(F.lit(0))})
    counts = rows.where(large).groupBy(*group, "_split").agg(F.count(F.lit(1)).alias("_count"))
    lower = Window.partitionBy(*group).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select(*group, "_split", F.coalesce(F.sum("_count").over(lower), F.lit(0)).alias("_below"))
    inside = Window.partitionBy(*group, "_split").orderBy("_order", *ties)
    joined = rows.withColumn("_inside", F.row_number().over(inside)).join(below, [*group, "_split"], "left")
    kept = [F.col(f"`{c}`") for c in df.columns if c != rank]
    return joined.select(*kept, (F.coalesce("_below", F.lit(0)) + F.col("_inside")).alias(rank))


def labelled_ids(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of the ids to learn from: labelled, and crc32 modulo 5
    not 0. An id labelled twice has the larger label."""
    return (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
            .where(~held_out(doc_id, 5, 0)).groupBy(doc_id).agg(F.max(label).alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id",
                    per_class: bool = False, text: str = "text") -> DataFrame:
    """(doc_id, text, label) for at most ``rows`` labelled documents whose
    crc32 modulo 5 is not 0, chosen by a hash of the id, whatever their
    length; with ``per_class`` half of them from either class. The ids are few
    by that bound, so the join with the documents is a broadcast."""
    ids = labelled_ids(labels, label, doc_id)
    chance = F.xxhash64(F.lit("sample"), doc_id)
    pick = lambda df, n: df.orderBy(chance, doc_id).limit(n)
    if per_class:
        chosen = pick(ids.where("label = 0"), rows // 2).unionByName(pick(ids.where("label = 1"), rows // 2))
    else:
        chosen = pick(ids, rows)
    return docs.select(doc_id, text).join(F.broadcast(chosen), doc_id)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


class Adam:
    """Adam steps over a dict of numpy arrays, in place."""

    def __init__(self, weights: dict, rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, grads: dict) -> None:
        self.step += 1
        rate = self.rate * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
        for k, g in grads.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.weights[k] -= rate * self.mean[k] / (self.square[k] ** 0.5 + 1e-8)


def ngrams(words: list[bytes], n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams of 3 and 4 bytes of all words, edges marked, one
    word after the other; and how many each word has."""
    body = np.frombuffer(b"".join(b"^" + w + b"$\0\0" for w in words), np.uint8).astype(np.uint32)
    sizes = np.array([len(w) for w in words], np.int64) + 4
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    left = (begins + sizes)[owner] - np.arange(len(body)) - 2  # bytes from here to the end mark
    three = body[:-2] * 40503 + body[1:-1] * 10007 + body[2:] * 31
    four = three[:-1] + body[3:] * 65599 + 17
    rows = np.zeros((len(body), 2), np.int64)
    rows[:-2, 0] = (three * np.uint32(2654435761) >> 16) % n_rows
    rows[:-3, 1] = (four * np.uint32(2654435761) >> 16) % n_rows
    real = np.stack([(left >= 3) | (np.arange(len(body)) == begins[owner]), left >= 4], axis=1)
    return rows[real], np.bincount(owner, real.sum(1), len(words)).astype(np.int64)


class WordIds(dict):
    """Numbers words 0, 1, ... as they are met; ``new`` has those met since it
    was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))
