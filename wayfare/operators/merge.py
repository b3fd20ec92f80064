"""K7: loads into an existing keyed table, the last write of a record wins.

A record is known by its identifying columns, or a hash of them, and its occurrence
number among the records of a load with the same ones, so loading a file again
changes nothing and the k-th of several equal records stays the k-th.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.keyed import PARTITION_COLS, sorted_for_table
from wayfare.session import written
from wayfare.sinks import versions

# Rows of one identity that are numbered in one task; more are numbered in
# SPLITS ranges of their hash.
HOT_ROWS, SPLITS = 100_000, 1024
# Slots of a hash by which identities are counted first.
SLOTS = 1 << 16
ATTEMPTS = 3


def _hot_identities(rows: DataFrame, identity: list[str]) -> DataFrame | None:
    """The identities (``_who``) with more than ``HOT_ROWS`` rows, or None.

    All rows are counted by ``SLOTS`` slots of a hash, which each task does
    for itself; identities are counted only in slots that have so many rows."""
    slot = F.pmod(F.xxhash64(*identity), F.lit(SLOTS))
    slots = rows.groupBy(slot.alias("_slot")).count().where(F.col("count") > HOT_ROWS)
    full = [r["_slot"] for r in slots.collect()]
    if not full:
        return None
    counts = rows.where(slot.isin(full)).groupBy(F.struct(*identity).alias("_who")).count()
    hot = written(counts.where(F.col("count") > HOT_ROWS).select("_who", F.lit(True).alias("_hot")), "hot_identities")
    return None if hot.isEmpty() else hot


def with_occurrence(rows: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``occurrence`` (bigint): 1, 2, ... among the rows of equal
    ``identity`` (NULLs are equal), in the order of a hash of the ``order``
    columns and then these; they have to tell apart all rows that are not
    interchangeable. The hash is made after the shuffle.

    An identity with more than ``HOT_ROWS`` rows is numbered in ranges of the
    hash, in each from the count of the lower ranges on, which gives the same
    numbers. There are few such identities, so they and their counts are small."""
    chance = F.xxhash64(*order)
    range_of = lambda number: F.shiftrightunsigned(number, 64 - (SPLITS.bit_length() - 1))
    hot = _hot_identities(rows, identity)
    if hot is None:
        own = Window.partitionBy(*identity).orderBy(range_of("_chance"), "_chance", *order)
        dealt = rows.repartition(*identity).withColumn("_chance", chance)
        return dealt.select(*rows.columns, F.row_number().over(own).cast("bigint").alias("occurrence"))
    who = F.struct(*identity).alias("_who")
    split = range_of(chance)
    marked = rows.select("*", who).join(hot, "_who", "left").withColumn(
        "_split", F.when(F.col("_hot"), split).otherwise(F.lit(0).cast("bigint")))
    inside = F.row_number().over(Window.partitionBy("_who", "_split").orderBy(split, chance, *order))
    lower = Window.partitionBy("_who").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    below = (marked.where("_hot").groupBy("_who", "_split").agg(F.count(F.lit(1)).alias("_n"))
             .select("_who", "_split", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below")))
    joined = marked.withColumn("_inside", inside).join(below, ["_who", "_split"], "left")
    return joined.select(*rows.columns, (F.col("_inside") + F.coalesce("_below", F.lit(0))).cast("bigint").alias("occurrence"))


def record_key(identity: list[str]) -> Column:
    """20 bytes: two 64-bit hashes of the identity (a NULL is told from any
    value), then the occurrence number."""
    parts = [x for c in identity for x in (F.col(c).isNull(), F.col(c))]
    number = F.lpad(F.hex(F.col("occurrence")), 8, "0")
    text = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in ("first", "second")], number)
    return F.unhex(text)


def with_record(rows: DataFrame, identity: list[str], order: list[str], exact: bool = False) -> DataFrame:
    """``rows`` with the ``record`` that names each of them across loads: the
    binary ``record_key``, or with ``exact`` the identity itself and the
    occurrence as a struct, which for a narrow identity is less to shuffle and
    to store. All loads of a table have the same kind."""
    record = F.struct(*identity, "occurrence") if exact else record_key(identity)
    return with_occurrence(rows, identity, order).withColumn("record", record).drop("occurrence")


def merge_load(spark: SparkSession, root: str, load: DataFrame, fresh: bool = False,
               derived: dict[str, Column] | None = None) -> int:
    """Merge ``load`` (keyed rows with their ``record``, one row a record) into
    the table at ``root`` and return the new version; ``fresh`` replaces the
    table by the load.

    Records that are there are replaced, also where a change moves them to
    another (year, cancelled); the others are added. Only partitions that the
    load or one of its records touches are read whole and written anew; the
    rest stay as they are. A load that meets another writer's commit starts
    again from what that one made. ``derived`` columns follow from others of
    the row; they are made where rows are written, and not shuffled."""
    derived = derived or {}
    schema = load.schema
    load = load.drop(*derived)
    kept = False
    for attempt in range(ATTEMPTS):
        before = versions.latest(spark, root)
        if not kept and (attempt or (before and not fresh)):  # it is read more than once
            load, kept = written(load, "load"), True
        try:
            return _merge_once(spark, root, before, load, fresh, derived, schema)
        except versions.ConcurrentWrite:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def _merge_once(spark: SparkSession, root: str, before: int, load: DataFrame, fresh: bool,
                derived: dict[str, Column], schema: T.StructType) -> int:
    live = [] if fresh else versions.contents(spark, root, before)[1]
    home = lambda df: {"/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, r))  # noqa: E731  (few partitions)
                       for r in df.select(*PARTITION_COLS).distinct().collect()}
    inside = lambda names: [f for f in live if f.split("/", 1)[1] in names]
    affected = []
    if live:
        touched = home(load)
        others = [f for f in live if f not in inside(touched)]
        if others:  # partitions that only lose records
            old = versions.read(spark, root, others)
            touched |= home(old.select("record", *PARTITION_COLS).join(load.select("record"), "record", "left_semi"))
        affected = inside(touched)
    rows = load
    if affected:
        stay = versions.read(spark, root, affected).drop(*derived)
        rows = stay.join(load.select("record"), "record", "left_anti").unionByName(load)
    folder = f"load={uuid.uuid4().hex}"
    sorted_for_table(rows, derived).write.partitionBy(*PARTITION_COLS).parquet(f"{root}/{folder}")
    made = [f for f in versions.partitions(spark, root, folder, len(PARTITION_COLS)) if f != folder]
    return versions.commit(spark, root, before, schema.json(), [f for f in live if f not in affected] + made)
