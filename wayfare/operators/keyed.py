"""The keyed flights table: ingest encoding, last-write-wins upsert,
clustered partitioned write, and predicate / key-range scans.

Layout: Parquet partitioned by (year, cancelled), rows sorted inside each
file by an order-preserving binary ``rowkey`` =
year (2 bytes) | cancelled (1) | month (1) | carrier index (1) |
order key (7) | line number (1).
A predicate on year/cancelled prunes directories; a key range also gets
row-group skipping from the sorted ``rowkey`` column, and when both ends of
the range share the year/cancelled prefix, that prefix is added as a
partition predicate too. Values that do not fit their key bytes raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.scalar import (
    binary_key,
    key_byte,
    key_hex,
    pack_bits,
    trunc_int,
    unpack_high,
    unpack_low,
)
from wayfare.session import path_exists

# Carrier dictionary, code at index 0..19.
CARRIER_CODES = [
    "9E", "AA", "AQ", "AS", "B6", "CO", "DL", "EV", "F9", "FL",
    "HA", "MQ", "NW", "OH", "OO", "UA", "US", "WN", "XE", "YV",
]
BASE_YEAR = 2007
# Bumped whenever the stored layout or key encoding changes.
LAYOUT_VERSION = "keyed-v3"

# (column, bytes) of the row key, in key order.
KEY_PARTS = [
    ("year", 2), ("cancelled", 1), ("month", 1), ("carrier_idx", 1),
    ("l_orderkey", 7), ("l_linenumber", 1),
]
PARTITION_COLS = ["year", "cancelled"]


def carrier_dictionary(spark: SparkSession) -> DataFrame:
    """J6 dimension: 20 rows, a fixed bound, so it is always broadcast."""
    return spark.createDataFrame(
        [(c, i) for i, c in enumerate(CARRIER_CODES)], "carrier string, carrier_idx int")


def carrier_to_index(df: DataFrame, spark: SparkSession, strict: bool = True) -> DataFrame:
    """J6 code -> index by broadcast lookup; an unknown code raises when
    ``strict`` (the ingest rejects it), else gets NULL."""
    dim = F.broadcast(carrier_dictionary(spark))
    out = df.join(dim, on="carrier", how="left")
    if strict:
        idx = F.when(F.col("carrier_idx").isNull(),
                     F.raise_error(F.concat(F.lit("unknown carrier: "), F.col("carrier"))))
        out = out.withColumn("carrier_idx", F.coalesce(F.col("carrier_idx"), idx.cast("int")))
    return out


def index_to_carrier(df: DataFrame, spark: SparkSession, idx: str = "carrier_idx") -> DataFrame:
    """J6 index -> code by broadcast lookup; an unknown index raises."""
    dim = F.broadcast(carrier_dictionary(spark).withColumnRenamed("carrier_idx", idx))
    unknown = F.raise_error(F.concat(F.lit("unknown carrier index: "), F.col(idx).cast("string")))
    return df.join(dim, on=idx, how="left").withColumn(
        "carrier", F.coalesce(F.col("carrier"), F.when(F.col("carrier").isNull(), unknown.cast("string"))))


def row_key(parts: list[tuple[str, int]] = KEY_PARTS) -> Column:
    return binary_key([(F.col(c), w) for c, w in parts])


def row_key_hex(parts: list[tuple[str, int]] = KEY_PARTS) -> Column:
    return key_hex([(F.col(c), w) for c, w in parts])


def literal_key(values: dict[str, int], parts: list[tuple[str, int]] = KEY_PARTS) -> bytes:
    """Key bytes for a scan bound; unnamed trailing parts are 0."""
    out = b""
    for c, w in parts:
        v = int(values.get(c, 0))
        if not 0 <= v < (1 << (8 * w)):
            raise ValueError(f"{c}={v} does not fit in {w} bytes")
        out += v.to_bytes(w, "big")
    return out


def keyed_rows(flights: DataFrame, spark: SparkSession, extra: list[str] | None = None) -> DataFrame:
    """Ingest encoding (J6, F4/A9, F11, F13): one typed row per flight with
    its row key.

    ``cancelled`` is stored as the reject rule reads it (1 only for a flag
    of exactly 1), so the (year, cancelled = 0) partition holds exactly the
    rows the flat monthly job keeps. ``cond`` packs (year - 2007) with that
    flag and ``cell`` packs delay << 8 | carrier index, the single-column
    forms of the compact layout (BIGINT, so a large delay cannot wrap)."""
    extra = extra or []
    rows = carrier_to_index(flights.select(
        "l_orderkey", "l_linenumber", "year", "month", "carrier",
        F.when(F.col("cancelled") == 1, F.lit(1)).otherwise(F.lit(0)).alias("cancelled"),
        trunc_int("arr_delay_min").alias("delay"), *extra), spark)
    return rows.select(
        row_key().alias("rowkey"),
        "l_orderkey", "l_linenumber", "year", "cancelled", "month", "carrier", "carrier_idx",
        "delay",
        pack_bits(F.col("year") - BASE_YEAR, F.col("cancelled"), 1).alias("cond"),
        pack_bits(F.col("delay").cast("long"), F.col("carrier_idx"), 8).alias("cell"),
        *extra,
    )


def derived_columns() -> dict[str, Column]:
    """The columns of ``keyed_rows`` that follow from its other ones."""
    return {
        "rowkey": row_key(),
        "carrier": F.element_at(F.array(*map(F.lit, CARRIER_CODES)), F.col("carrier_idx") + 1),
        "cond": pack_bits(F.col("year") - BASE_YEAR, F.col("cancelled"), 1),
        "cell": pack_bits(F.col("delay").cast("long"), F.col("carrier_idx"), 8),
    }


def upsert_last(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """K7: one row per ``key``, the last by the total ``order`` wins.

    A max over a struct led by the order columns is an ordinary aggregate
    with a map-side partial step, so a key repeated a billion times is
    reduced inside each task instead of being gathered into one window.
    """
    payload = [c for c in rows.columns if c not in key]
    winner = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                            *[F.col(c) for c in payload])).alias("w")
    return rows.groupBy(*key).agg(winner).select(*key, *[F.col(f"w.{c}") for c in payload])


def write_keyed_table(rows: DataFrame, path: str, mode: str = "overwrite",
                      layout: str = "rebalance", n_ranges: int | None = None) -> None:
    """Write the table partitioned by (year, cancelled), rows
    sorted by ``rowkey`` inside every file (row-group min/max skipping).

    ``rebalance`` (default) hashes on (year, cancelled, month) and lets AQE
    split any skewed partition, even one made of copies of a single key, so
    no writer task receives a hot key whole. ``range`` is the pre-split
    layout: ``n_ranges`` contiguous key ranges (sampled bounds), for tables
    whose keys are known to be spread.
    """
    if layout == "rebalance":
        shaped = sorted_for_table(rows)
    elif layout == "range":
        ranged = (rows.repartitionByRange(n_ranges, "rowkey") if n_ranges
                  else rows.repartitionByRange("rowkey"))
        shaped = ranged.sortWithinPartitions(*PARTITION_COLS, "rowkey")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    shaped.write.mode(mode).partitionBy(*PARTITION_COLS).parquet(path)


def sorted_for_table(rows: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """Rows as the table's files have them: dealt by partition and month, a
    hot one split by AQE, and sorted. The writer needs rows by partition; a
    sort that starts with it is kept as it is. ``derived`` columns are made,
    in their order, after the rows are dealt, so they are not shuffled."""
    dealt = rows.hint("rebalance", "year", "cancelled", "month")
    for name, made in (derived or {}).items():
        dealt = dealt.withColumn(name, made)
    return dealt.sortWithinPartitions(*PARTITION_COLS, "rowkey")


# K9: the key of the split table has the month first, which spreads a load
# over the ranges.
SPLIT_KEY_PARTS = [("month", 1), ("year", 2), ("cancelled", 1), ("carrier_idx", 1), ("l_orderkey", 7), ("l_linenumber", 1)]


def even_splits(start: bytes, stop: bytes, n_ranges: int) -> list[bytes]:
    """The ``n_ranges - 1`` split points of a table of ``n_ranges`` ranges:
    ``start``, ``stop`` and evenly spaced keys between them. The first range
    has the keys below ``start`` and the last one those from ``stop`` on."""
    if n_ranges < 3 or len(start) != len(stop) or start >= stop:
        raise ValueError("splits need three ranges or more and two keys of one length in order")
    low, high = int.from_bytes(start, "big"), int.from_bytes(stop, "big")
    return [(low + (high - low) * i // (n_ranges - 2)).to_bytes(len(start), "big") for i in range(n_ranges - 1)]


def range_number(key: str, splits: list[bytes]) -> Column:
    """0 for keys below the first split point, ..., len(splits) for the last range."""
    return F.size(F.filter(F.array(*map(F.lit, splits)), lambda point: point <= F.col(key)))


def file_bounds(table: DataFrame, key: str) -> DataFrame:
    """(file, low, high, n) of every file of ``table``, whose files are sorted
    by ``key``, NULLs first: the first and the last known key, or NULLs.

    Only counts are aggregated over all rows. A minimum of binary keys would
    have every task sort its rows by the file's name, so the keys are picked by their
    place in the file; the counts are broadcast, one row a file."""
    at = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col(key).alias("_key"))
    counts = at.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count("_key").alias("known"))
    ends = at.join(F.broadcast(counts), "file").where((F.col("row") == F.col("n") - F.col("known")) | (F.col("row") == F.col("n") - 1))
    return ends.groupBy("file").agg(F.min("_key").alias("low"), F.max("_key").alias("high"), F.first("n").alias("n"))


def write_split_table(rows: DataFrame, path: str, splits: list[bytes], key: str = "rowkey") -> None:
    """K9: the table in the ranges that the caller's split points make, each
    a folder of files sorted by key; AQE splits a hot range into several. The
    key bounds of every file go to ``_bounds`` in the same folder (one row a
    file), which ``scan_split_range`` reads first."""
    placed = rows.withColumn("range", range_number(key, splits))
    (placed.hint("rebalance", "range").sortWithinPartitions("range", key)
     .write.partitionBy("range").parquet(path))
    made = rows.sparkSession.read.schema(placed.schema).parquet(path)
    bounds = file_bounds(made, key)
    bounds.write.parquet(f"{path.rstrip('/')}/_bounds")


def scan_split_range(spark: SparkSession, path: str, start: bytes, stop: bytes, key: str = "rowkey") -> DataFrame:
    """S6 over a split table: rows with start <= key < stop, out of the files
    whose bounds say that they may have some; no other file is opened."""
    bounds = spark.read.parquet(f"{path.rstrip('/')}/_bounds")
    files = [r["file"] for r in bounds.where((F.col("low") < F.lit(stop)) & (F.col("high") >= F.lit(start)))
             .select("file").collect()]
    whole = spark.read.parquet(path)
    some = spark.read.schema(whole.schema).option("basePath", path).parquet(*files) if files else whole.limit(0)
    return some.where((F.col(key) >= F.lit(start)) & (F.col(key) < F.lit(stop)))


def create_table_if_absent(spark: SparkSession, name: str, path: str, schema: str) -> bool:
    """K8: register an external partitioned table unless it exists.

    Returns False (and leaves the table and its rows alone) when it already
    exists; it is an error if its columns are others than those asked for."""
    if spark.catalog.tableExists(name):
        there = {f.name.lower(): f.dataType for f in spark.table(name).schema}
        wanted = {f.name.lower(): f.dataType for f in T.StructType.fromDDL(schema)}
        if there != wanted:
            raise ValueError(f"{name} exists with other columns: {spark.table(name).schema.simpleString()}")
        return False
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLS)}) LOCATION '{path}'")
    if path_exists(spark, path):  # else there are no partitions yet to recover
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return True


def append_by_name(rows: DataFrame, name: str) -> None:
    """Append to a catalog table; columns go by name. Another set of columns
    is an error, raised before anything is written."""
    there = [f.name for f in rows.sparkSession.table(name).schema]
    if sorted(map(str.lower, there)) != sorted(map(str.lower, rows.columns)):
        raise ValueError(f"{name} has the columns {there}, the rows {rows.columns}")
    (rows.select(*there).hint("rebalance", *PARTITION_COLS[:1]).sortWithinPartitions(*PARTITION_COLS)
     .write.mode("append").insertInto(name))


def opened(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A keyed table by its path, or one that is read already."""
    return spark.read.parquet(table) if isinstance(table, str) else table


def scan_predicate(spark: SparkSession, table: str | DataFrame, year: int, cancelled: int = 0) -> DataFrame:
    """Partition-pruned scan (year, cancelled)."""
    t = opened(spark, table)
    return t.where((F.col("year") == year) & (F.col("cancelled") == cancelled))


def scan_key_range(spark: SparkSession, table: str | DataFrame, start: dict[str, int],
                   stop: dict[str, int]) -> DataFrame:
    """Rows with start <= rowkey < stop (unsigned byte order)."""
    lo, hi = literal_key(start), literal_key(stop)
    t = opened(spark, table)
    cond = (F.col("rowkey") >= F.lit(lo)) & (F.col("rowkey") < F.lit(hi))
    for c in PARTITION_COLS:  # a shared prefix becomes a partition filter
        if c in start and start.get(c) == stop.get(c):
            cond = cond & (F.col(c) == start[c])
        else:
            break
    return t.where(cond)


def decode_key(df: DataFrame) -> DataFrame:
    """F12-style decode of month and carrier index from the row key bytes."""
    offs = {}
    pos = 0
    for c, w in KEY_PARTS:
        offs[c] = (pos, w)
        pos += w
    return df.select(
        "*",
        key_byte("rowkey", *offs["month"]).cast("int").alias("key_month"),
        key_byte("rowkey", *offs["carrier_idx"]).cast("int").alias("key_carrier_idx"),
    )


def scan_packed(spark: SparkSession, path: str, cond: int) -> DataFrame:
    """S5 / P13 in the compact form: a value predicate on the packed
    ``cond`` column (pushed to Parquet) and on the partition it names, so no
    other file is opened, with delay and carrier index
    decoded from ``cell`` (F12)."""
    t = spark.read.parquet(path).where(
        (F.col("cond") == cond) & (F.col("year") == BASE_YEAR + (cond >> 1)) & (F.col("cancelled") == (cond & 1)))
    return t.select(
        "month",
        unpack_high("cell", 8).cast("int").alias("delay"),
        unpack_low("cell", 8).cast("int").alias("carrier_idx"),
    )
