"""Mixing sources to target weights by fitting word budgets.

Documents are counted by exact size within each source. All of a source's
budget but its last words is spread evenly over the sizes; the rest is filled
by a bounded-knapsack dynamic program over the documents not yet taken. Which
documents of a size are taken is decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import append_columns, boxed, content_key, materialise, texts_as_bytes, unboxed, with_rank, without

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 42
# Words of a budget that are left to the dynamic program.
EXACT_WORDS = 1 << 16


def with_sizes(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """``docs`` with the number of words of ``text`` (null: 0). On bytes,
    Python's split takes exactly space and \\x09-\\x0D as separators."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            yield [[len(t.split()) for t in texts_as_bytes(column)]]

    return append_columns(docs, T.StructType([T.StructField(size, T.LongType())]), make)


def source_targets(sized: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS,
                   share: float = SHARE, most: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, source_no, target): one row for each source.

    Sources in code-point order, null last, take the weights in turn and
    split ``share`` of all words; a target stops at ``most`` times its
    source's size and the excess is reshared by weight. That is one level
    ``L`` with target = min(most * size, weight * L), found with running sums
    over the sources in the order in which they reach their limit.
    """
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    # windows over one row a source, not over documents
    named = totals.withColumn("source_no", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), "source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1)
    caps = named.withColumns({"_weight": weight.cast("double"), "_cap": most * F.col("source_size").cast("double")})
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "source_no")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ahead = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = caps.withColumn("_level", left / ahead)
    full = F.col("_cap") <= F.col("_weight") * F.col("_level")
    level = F.max(F.when(~full, F.col("_level"))).over(whole)
    return levels.select(
        "source", "source_size", "source_no",
        F.when(full, F.col("_cap")).otherwise(F.col("_weight") * level).alias("target"))


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each size to take so that their words come to
    ``budget``, or as near below it as the documents allow."""
    take = np.zeros(len(sizes), np.int64)
    whole = int((sizes * counts).sum())
    if budget <= 0 or whole == 0:
        return take
    if budget >= whole:
        return counts.copy()
    # an even share of every size, with the fractions carried on
    even = max(0, budget - EXACT_WORDS)
    running = np.floor(np.cumsum(counts) * (even / whole)).astype(np.int64)
    take = np.minimum(np.diff(running, prepend=0), counts)
    rest = budget - int((take * sizes).sum())
    while rest < 0:
        held = np.nonzero((take > 0) & (sizes > 0))[0]
        big = held[sizes[held] >= -rest]
        give = big[0] if len(big) else held[-1]
        take[give] -= 1
        rest += int(sizes[give])
    for i in np.argsort(-sizes, kind="stable"):
        if rest <= EXACT_WORDS:
            break
        more = min(int(counts[i] - take[i]), rest // int(sizes[i])) if sizes[i] else 0
        take[i] += more
        rest -= more * int(sizes[i])
    return take + knapsack(sizes, counts - take, min(rest, EXACT_WORDS), seed)


def knapsack(sizes: np.ndarray, free: np.ndarray, rest: int, seed: int) -> np.ndarray:
    """Bounded knapsack by dynamic programming: bit w of ``reach`` says that
    the sizes seen so far can make w words. Counts are split into powers of
    two; the walk back tells which parts make the best sum."""
    take = np.zeros(len(sizes), np.int64)
    usable = np.nonzero((free > 0) & (sizes > 0) & (sizes <= rest))[0]
    usable = usable[np.random.default_rng(seed).permutation(len(usable))]
    limit = (1 << (rest + 1)) - 1
    reach, steps = 1, []
    for i in usable.tolist():
        size, left, part = int(sizes[i]), min(int(free[i]), rest // int(sizes[i])), 1
        while left > 0 and not reach >> rest & 1:
            part = min(part, left)
            wider = (reach | reach << (size * part)) & limit
            if wider != reach:
                steps.append((i, part, reach))
                reach = wider
            left -= part
            part *= 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            take[i] += part
            at -= int(sizes[i]) * part
    return take


def _fitted(histogram: DataFrame, seed: int) -> DataFrame:
    """(source_no, size, count, base, extra): all documents are taken ``base``
    times and ``extra`` of the ``count`` of a size once more. A group is one source's histogram: a
    row for each distinct size, however many documents have it."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        target, whole = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
        words = round(target)
        base = words // whole if whole else 0
        sizes, counts = (rows[c].to_numpy(np.int64) for c in ("size", "count"))
        extra = fit_budget(sizes, counts, words - base * whole, seed)
        return pd.DataFrame({"source_no": rows["source_no"].to_numpy(), "size": sizes, "count": counts, "base": base,
                             "extra": extra})

    return histogram.groupBy("source_no").applyInPandas(fit, "source_no int, size long, count long, base long, extra long")


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and size, source_size,
    target, repeats (0, 1 or 2) and taken = size * repeats.

    Null and empty texts have size 0 and take no words; they get the repeats
    that their source gives to every document. A null source is a source of
    its own and the last. Equal rows are separate documents; which of them is
    taken does not show. With no words at all every target is 0. An empty
    table gives an empty table. Columns of the input with the names of the
    added ones give way.

    Sizes are counted once and written with the kept columns. Only documents
    of sizes of which some are taken and some not are ranked, large groups of
    them in pieces (``with_rank``). Targets and plan have a row for each source
    and each of its sizes.
    """
    added = ["size", "source_size", "target", "repeats", "taken"]
    clean = without(docs, *added)
    keep = [c for c in (keep or clean.columns) if c in clean.columns]
    first, second = content_key(doc_id, text)
    rows = docs.select(boxed(keep), first.alias("_doc1"), second.alias("_doc2"), F.col(source).alias("_source"),
                       F.col(text).alias("_text"))
    sized = materialise(with_sizes(rows, "_text").drop("_text"), "sizes")

    targets = materialise(source_targets(sized, "_source", weights, share), "targets")
    placed = _placed(sized, targets)
    histogram = (placed.groupBy("source_no", "size").agg(F.count(F.lit(1)).alias("count"))
                 .join(targets.drop("source"), "source_no"))
    plan = materialise(_fitted(histogram, seed), "mix_plan")
    planned = placed.join(plan, ["source_no", "size"])
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("count"))
    order = F.xxhash64(F.lit(seed), "_doc1", "_doc2")
    ranked = with_rank(planned.where(some), ["source_no", "size"], order, [F.col("_doc1"), F.col("_doc2")], size="count")
    # all or none of the documents of other sizes are taken once more
    whole = planned.where(~some).withColumn("rank", F.lit(1))
    chosen = ranked.unionByName(whole).join(targets.drop("source"), "source_no").withColumn(
        "repeats", F.col("base") + (F.col("rank") <= F.col("extra")).cast("long"))
    return unboxed(chosen, {c: F.col(c) for c in added[:-1]} | {"taken": F.col("size") * F.col("repeats")})


def _placed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    numbers = targets.select(F.col("source").alias("_name"), "source_no")
    return sized.join(numbers, sized["_source"].eqNullSafe(numbers["_name"])).drop("_name", "_source")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix as documents: a row taken twice is there twice."""
    times = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return mixed.where("repeats > 0").select(*columns, times.alias("_copy")).drop("_copy")
