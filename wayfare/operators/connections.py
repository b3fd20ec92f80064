"""Two-leg connections: flights ``A -> X`` joined with ``X -> B`` on the same
date at the same transit airport, the second leg departing strictly after
the first arrives (times are ``HHMM`` strings compared as text).

Plan shape at scale
-------------------
* One pass tags each record as leg 1 and/or leg 2 (``tag_legs``); every
  totals form, join forms included, scans the input once.
* Totals never enumerate flight pairs. Both legs are first aggregated into
  *time buckets* ``(date, transit, time) -> (n1, s1, n2, s2)`` with a
  map-side partial aggregate, so a hot (date, transit) group shrinks to at
  most one row per distinct clock time (1,440 for HHMM) before any shuffle
  that groups it. Pairs are then counted by running sums over the ordered
  buckets (``totals_running``, no pairs at all) or by an equi-join of the
  buckets with the strict time residual (``totals_join``; its fan-out per
  group is bounded by the number of distinct times, not by the data).
* Counts and delay sums are BIGINT; under ANSI mode an overflow raises an
  error instead of wrapping (the reported totals are BIGINT as well).
* ``pairs`` materialises flight pairs and is used only where the pairs are
  the requested output. Given the groups' sizes it joins them in cells of
  bounded size (``celled_join``); without them its join shuffles are Spark's
  own, so AQE's skew-join split (which ignores user repartitions) handles hot
  partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.predicates import (
    all_clear,
    in_year_month_window,
    leg1_exclusive,
    leg1_loose,
    leg2_exclusive,
    leg2_loose,
    not_flagged,
)

# Fixed values of the reference question: Chicago O'Hare to New York JFK,
# June 2007 to May 2008.
ORIGIN, DEST = "ORD", "JFK"
WINDOW = ((2007, 6), (2008, 5))

KEY = ["flight_date", "transit"]
BIG = "bigint"
DELAY = "decimal(18,6)"


def tag_legs(
    flights: DataFrame,
    origin: str = ORIGIN,
    dest: str = DEST,
    window: tuple[tuple[int, int], tuple[int, int]] | None = WINDOW,
    rule: str = "reject",
    loose: bool = False,
    keep: list[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """One pass that emits (flight_date, transit, t, d, leg).

    ``loose`` uses the one-sided leg rules (a record may then be both legs);
    ``rule`` is ``reject`` (drop flag == 1 after truncation) or ``accept``
    (keep flag == 0); ``window`` filters on the record's year/month, None
    to skip. ``keep`` carries extra columns (e.g. year, month, ids). The delay
    ``d`` is truncated to an int, and a flight whose delay is NULL is no leg, so
    that counts and sums skip it alike; ``exact`` keeps the delay to six
    decimal places, NULLs too, for averages that skip these alone.

    With exclusive rules a record is at most one leg (a CASE); with loose
    rules it may be both, so legs come from a small generator.
    """
    on1 = leg1_loose(origin, dest) if loose else leg1_exclusive(origin, dest)
    on2 = leg2_loose(origin, dest) if loose else leg2_exclusive(origin, dest)
    flags = not_flagged("cancelled", "diverted") if rule == "reject" else all_clear("cancelled", "diverted")
    cond = flags
    if window is not None:
        cond = cond & in_year_month_window(*window)
    if not exact:
        cond = cond & F.col("arr_delay_min").isNotNull()
    pre = flights.where(cond & (on1 | on2))
    if loose:  # one output row per leg the record plays; NULL slots dropped
        legs = F.explode(F.array(F.when(on1, F.lit(1)), F.when(on2, F.lit(2))))
    else:
        legs = F.when(on1, F.lit(1)).otherwise(F.lit(2))
    tagged = pre.select(*(keep or []), "flight_date", "origin", "dest", "dep_time", "arr_time",
                        "arr_delay_min", legs.alias("leg"))
    if loose:
        tagged = tagged.where(F.col("leg").isNotNull())
    is1 = F.col("leg") == 1
    return tagged.select(
        *(keep or []),
        "flight_date",
        F.when(is1, F.col("dest")).otherwise(F.col("origin")).alias("transit"),
        F.when(is1, F.col("arr_time")).otherwise(F.col("dep_time")).alias("t"),
        F.col("arr_delay_min").cast(DELAY if exact else "int").alias("d"),
        "leg",
    )


def time_buckets(tagged: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Pre-aggregate both legs: one row per (date, transit, t[, extra]) with a
    struct ``legs`` = (n1, s1, m1, n2, s2, m2): leg-1 arrivals, the sum and the
    count of their delays that are not NULL, and the same of leg-2 departures,
    at that time.

    The sums travel as one struct so that Catalyst keeps all of them in the
    aggregate whichever of them a consumer reads; the two sides of a bucket
    join then have identical subtrees and share one scan and one shuffle
    (``ReusedExchange``) instead of each re-reading the input."""
    keys = KEY + ["t"] + (extra_keys or [])
    total = BIG if dict(tagged.dtypes)["d"] == "int" else "decimal(28,6)"

    def part(leg: int, v: Column, kind: str = BIG) -> Column:
        return F.coalesce(F.sum(F.when(F.col("leg") == leg, v)).cast(kind), F.lit(0).cast(kind))

    known = F.when(F.col("d").isNotNull(), 1)
    return tagged.groupBy(*keys).agg(F.struct(*[
        c for i in (1, 2) for c in (
            part(i, F.lit(1)).alias(f"n{i}"), part(i, F.col("d"), total).alias(f"s{i}"),
            part(i, known).alias(f"m{i}"))]).alias("legs"))


def _leg(field: str) -> Column:
    return F.col(f"legs.{field}")


def finish_totals(n_pairs: Column, delay: Column) -> list[Column]:
    """A5: ratio of sums (never an average of averages); NULL when empty."""
    n = F.coalesce(n_pairs, F.lit(0).cast(BIG))
    s = F.coalesce(delay, F.lit(0).cast(BIG))
    return [
        n.cast("bigint").alias("n_pairs"),
        s.cast("bigint").alias("sum_delay"),
        F.when(n > 0, s.cast("double") / n.cast("double")).alias("avg_delay"),
    ]


def running_pairs(buckets: DataFrame) -> DataFrame:
    """Per time bucket, the pairs its departures close and their delay.

    Inside (date, transit), buckets are ordered by time; the running leg-1
    sums over strictly earlier buckets (frame ends one row before the
    current one) give the arrivals each departure connects with, so equal
    times never pair.
    """
    w = (Window.partitionBy(*KEY).orderBy("t")
         .rowsBetween(Window.unboundedPreceding, -1))
    zero = F.lit(0).cast(BIG)
    ran = buckets.select(
        *KEY, "t", _leg("n2").alias("n2"), _leg("s2").alias("s2"),
        F.coalesce(F.sum(_leg("n1")).over(w), zero).alias("c1"),
        F.coalesce(F.sum(_leg("s1")).over(w), zero).alias("a1"),
    ).where(F.col("n2") > 0)
    return ran.select(
        *KEY, "t",
        (F.col("n2") * F.col("c1")).alias("pairs"),
        (F.col("n2") * F.col("a1") + F.col("c1") * F.col("s2")).alias("delay"),
    )


def partial_totals(buckets: DataFrame) -> DataFrame:
    """A4 as rows: one (n_pairs, sum_delay) partial per (date, transit) group
    with a second leg, the unit a later job can merge (``merge_partials``); a
    group whose departures all leave too early has a partial of zeros."""
    return running_pairs(buckets).groupBy(*KEY).agg(
        F.sum("pairs").alias("n_pairs"), F.sum("delay").alias("sum_delay"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """A5 over partial (n_pairs, sum_delay) rows, e.g. re-read from a previous
    job's part files: sum both, then one ratio (never a mean of means)."""
    return partials.agg(*finish_totals(F.sum("n_pairs").cast(BIG), F.sum("sum_delay").cast(BIG)))


def totals_running(buckets: DataFrame) -> DataFrame:
    """W1 + A4 + A5: connection count, delay sum and mean, no pairs built."""
    p = running_pairs(buckets)
    return p.agg(*finish_totals(F.sum("pairs"), F.sum("delay")))


def _sides(buckets: DataFrame, extra: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The two join sides. Both read the same bucket aggregate (see
    ``time_buckets``), so the input is scanned and shuffled once; the join
    then hash-partitions the small side rows on (date, transit) itself,
    which keeps AQE's skew-join split available for that exchange."""
    extra = extra or []

    def side(tag: str) -> DataFrame:
        return buckets.where(_leg(f"n{tag}") > 0).select(
            *KEY, F.col("t").alias(f"t{tag}"), _leg(f"n{tag}").alias(f"n{tag}"),
            _leg(f"s{tag}").alias(f"s{tag}"), _leg(f"m{tag}").alias(f"m{tag}"), *[F.col(c).alias(f"{c}{tag}") for c in extra])

    return side("1"), side("2")


def bucket_join(buckets: DataFrame, extra: list[str] | None = None, strict: bool = True) -> DataFrame:
    """J1/J2/J3 over buckets: equi-join on (date, transit), residual t1 < t2."""
    a, b = _sides(buckets, extra)
    theta = F.col("t1") < F.col("t2") if strict else F.col("t1") <= F.col("t2")
    return a.join(b, on=KEY, how="inner").where(theta)


def joined_totals(joined: DataFrame) -> DataFrame:
    """A4 + A5 over joined bucket pairs: each stands for n1*n2 flight pairs
    with total delay s1*n2 + n1*s2."""
    return joined.agg(*finish_totals(
        F.sum(F.col("n1") * F.col("n2")),
        F.sum(F.col("s1") * F.col("n2") + F.col("n1") * F.col("s2"))))


def totals_join(buckets: DataFrame) -> DataFrame:
    """J1 + A4 + A5 by joining time buckets; equals ``totals_running``."""
    return joined_totals(bucket_join(buckets))


def band_prune(buckets: DataFrame) -> DataFrame:
    """Inside (date, transit) drop leg-2 departures at or before the
    earliest leg-1 arrival, then leg-1 arrivals at or after the latest
    remaining departure. Result-neutral; shrinks the join input."""
    w = Window.partitionBy(*KEY)
    zero = F.lit(0).cast(BIG)
    min_arr = F.min(F.when(_leg("n1") > 0, F.col("t"))).over(w)
    step1 = buckets.withColumn("min_arr", min_arr)
    keep2 = (_leg("n2") > 0) & (F.col("t") > F.col("min_arr"))
    step2 = step1.withColumn("max_dep", F.max(F.when(keep2, F.col("t"))).over(w))
    keep1 = (_leg("n1") > 0) & (F.col("t") < F.col("max_dep"))
    pruned = step2.select(
        *[c for c in buckets.columns if c != "legs"],
        F.struct(
            *[F.when(kept, _leg(f"{field}{i}")).otherwise(zero).alias(f"{field}{i}")
              for i, kept in ((1, keep1), (2, keep2)) for field in "nsm"]).alias("legs"),
    )
    return pruned.where((_leg("n1") > 0) | (_leg("n2") > 0))


def leg_bounds(tagged: DataFrame) -> DataFrame:
    """Per (date, transit) with both legs, the earliest leg-1 arrival and
    the latest leg-2 departure where some connection fits between them: one
    row a group, however many flights it has."""
    time_of = lambda leg: F.when(F.col("leg") == leg, F.col("t"))
    bounds = tagged.groupBy(*KEY).agg(F.min(time_of(1)).alias("first_arr"), F.max(time_of(2)).alias("last_dep"))
    return bounds.where(F.col("first_arr") < F.col("last_dep"))


def prune_by_bounds(tagged: DataFrame, bounds: DataFrame) -> DataFrame:
    """J4 before the shuffle: drop leg-2 departures at or before the earliest
    arrival, leg-1 arrivals at or after the latest departure and groups
    without a connection, where the rows are read. Result-neutral. ``bounds``
    are broadcast: the caller has checked their size."""
    met = tagged.join(F.broadcast(bounds), KEY)
    keep = F.when(F.col("leg") == 1, F.col("t") < F.col("last_dep")).otherwise(F.col("t") > F.col("first_arr"))
    return met.where(keep).select(*tagged.columns)


#: Parts of a (date, transit) group that are joined apart.
SLICES = 16
#: Legs of a part where a group's size is known: a leg is cut into parts of
#: ``SMALL`` flights, at most ``PARTS`` of them until they hold ``LARGE``.
SMALL, PARTS, LARGE = 64, 8, 1024
#: Tasks of a join of parts for each core.
WAVES = 8
#: Of packed parts: cells for each task, most legs of a part and legs of a block.
CELLS, PACKED, BLOCK = 16, 1 << 15, 128


def leg_counts(tagged: DataFrame) -> DataFrame:
    """How many flights either leg of a (date, transit) with both has: one row
    a group, however many flights it has."""
    count_of = lambda leg: F.count(F.when(F.col("leg") == leg, 1))
    counts = tagged.groupBy(*KEY).agg(count_of(1).alias("_n1"), count_of(2).alias("_n2"))
    return counts.where((F.col("_n1") > 0) & (F.col("_n2") > 0))


def sliced_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """The equi-join of two legs on (date, transit), in ``SLICES`` parts of
    each group: a leg 2 is in one of them, by a hash of its columns, and a leg
    1 in each. A task then holds a slice of a group's departures and not all
    of them, and the few groups of a large table are dealt evenly over the
    tasks; what is shuffled stays a fixed multiple of the legs."""
    parts = a.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    dealt = b.withColumn("_slice", F.pmod(F.xxhash64(*b.columns), F.lit(SLICES)).cast("int"))
    return parts.join(dealt, [*KEY, "_slice"]).drop("_slice")


def celled_join(a: DataFrame, b: DataFrame, counts: DataFrame) -> DataFrame:
    """The equi-join of two legs on (date, transit), cut by the sizes of each
    group (``leg_counts``): both legs are in parts, by a hash of their columns,
    and each part of one meets each part of the other in a cell of its own, so
    that a cell's pairs are bounded however large the group is.

    The cells are dealt over a fixed number of tasks, ``WAVES`` for each core
    at least. AQE would merge the tasks of the join by the bytes they read to
    about one a core, but their work is the pairs, square in what they read:
    one task more than cores, or an uneven one, doubles the time."""
    spark = a.sparkSession
    n_tasks = max(WAVES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = [*KEY, "_part1", "_part2"]

    def n_parts(leg: int) -> Column:
        parts = lambda rows: F.ceil(F.col(f"_n{leg}") / F.lit(rows))
        return F.greatest(F.least(parts(SMALL), F.lit(PARTS)), parts(LARGE)).cast("int")

    def dealt(rows: DataFrame, own: int, other: int) -> DataFrame:
        return rows.join(counts, KEY).select(
            *rows.columns,
            F.pmod(F.xxhash64(*rows.columns), n_parts(own)).cast("int").alias(f"_part{own}"),
            F.explode(F.sequence(F.lit(0), n_parts(other) - 1)).alias(f"_part{other}"),
        ).repartition(n_tasks, *cells)

    # merged: a side is estimated by its rows before they are repeated, and would be broadcast
    return dealt(a, 1, 2).join(dealt(b, 2, 1).hint("merge"), cells).drop("_part1", "_part2")


def _legs_join(a: DataFrame, b: DataFrame, counts: DataFrame | None) -> DataFrame:
    return sliced_join(a, b) if counts is None else celled_join(a, b, counts)


def packed_join(
    a: DataFrame, b: DataFrame, counts: DataFrame, t1: str, t2: str, strict: bool = True, ids: list[str] | None = None,
) -> DataFrame:
    """``celled_join`` for pairs that are many more than their legs: with the
    time ``t1`` of the first leg before ``t2`` of the second, and without
    ``ids``, columns that tell copies of a leg apart.

    All parts have one size, by which there are ``CELLS`` cells for a task. A
    leg is in as many cells as the other leg of its group has parts, so what is
    shuffled is at most a fixed multiple of the legs (the square root of the
    cells) until parts are of ``PACKED`` legs, which bounds what a task holds;
    beyond, it is four legs for each ``PACKED`` pairs. A part is ordered by time
    and packed into blocks of ``BLOCK`` legs. Blocks are what is shuffled and
    joined, by their first and last times, and are unpacked two at a time, so
    that the values of either leg repeat within a few bytes where the pairs are
    written, and compress better."""
    spark = a.sparkSession
    n_tasks = max(WAVES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    work = counts.agg(F.sum(F.col("_n1").cast("double") * F.col("_n2"))).first()[0] or 0.0
    size = min(max(math.ceil(math.sqrt(work / (CELLS * n_tasks))), SMALL), PACKED)
    cells = [*KEY, "_part1", "_part2"]

    def n_parts(leg: int) -> Column:
        return F.ceil(F.col(f"_n{leg}") / F.lit(size)).cast("int")

    def dealt(rows: DataFrame, own: int, other: int, t: str) -> DataFrame:
        part, rest = f"_part{own}", [c for c in rows.columns if c not in (*KEY, t)]
        legs = rows.where(F.col(t).isNotNull()).join(counts, KEY).select(
            *rows.columns,
            F.pmod(F.xxhash64(*rows.columns), n_parts(own)).cast("int").alias(part),
            n_parts(other).alias("_others"))
        # whole but for equal rows: a block that is made again is the same
        place = F.row_number().over(Window.partitionBy(*KEY, part).orderBy(t, *rest))
        found = F.collect_list(F.struct(t, *[c for c in rest if c not in (ids or [])]))
        numbered = legs.withColumn("_block", F.floor((place - 1) / F.lit(BLOCK)))
        blocks = numbered.groupBy(*KEY, part, "_others", "_block").agg(
            F.sort_array(found).alias(f"_legs{own}"), F.min(t).alias(f"_first{own}"), F.max(t).alias(f"_last{own}"))
        return blocks.select(
            *KEY, part, f"_legs{own}", f"_first{own}", f"_last{own}",
            F.explode(F.sequence(F.lit(0), F.col("_others") - 1)).alias(f"_part{other}"),
        ).repartition(n_tasks, *cells)

    def before(left: Column, right: Column) -> Column:
        return left < right if strict else left <= right

    met = dealt(a, 1, 2, t1).join(dealt(b, 2, 1, t2).hint("merge"), cells).where(before(F.col("_first1"), F.col("_last2")))
    # a function over a lambda is not compiled into the stage of the join, which would hold all rows of its loops
    early = F.filter("_legs1", lambda leg: before(leg[t1], F.col("_last2")))
    first = met.select(*KEY, "_legs2", "_first2", F.inline(early))
    # a leg before a whole block is not compared with each of its legs
    found = [c for c in first.columns if c not in ("_legs2", "_first2")]
    whole = before(F.col(t1), F.col("_first2")).alias("_whole")
    pairs = first.select(*found, whole, "_legs2").select(*found, "_whole", F.inline("_legs2"))
    return pairs.where(F.col("_whole") | before(F.col(t1), F.col(t2))).drop("_whole")


def joined_counts(tagged: DataFrame, carry: list[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """J1 + P14 without the pairs: the joined relation as rows of different
    (leg 1, leg 2) column values with ``n``, how many flight pairs have them.
    Each leg's equal rows are counted before the join, so what is joined and
    what comes out grows with the different values and not with the square of
    the flights that share them. Every column of either leg is there, with the
    suffix 1 or 2, for filters after the join. With the groups' sizes
    (``leg_counts``) the legs are joined in cells (``celled_join``)."""
    carry = carry or []

    def side(leg: int) -> DataFrame:
        rows = tagged.where(F.col("leg") == leg).groupBy(*KEY, "t", "d", *carry).agg(F.count(F.lit(1)).alias("n"))
        return rows.select(*KEY, *[F.col(c).alias(f"{c}{leg}") for c in ["t", "d", *carry, "n"]])

    joined = _legs_join(side(1), side(2), counts).where(F.col("t1") < F.col("t2"))
    return joined.withColumn("n", F.col("n1") * F.col("n2")).drop("n1", "n2")


def bag_union(*relations: DataFrame) -> DataFrame:
    """Bag union of independent relations (duplicates kept; never the
    de-duplicating SQL UNION)."""
    out = relations[0]
    for r in relations[1:]:
        out = out.unionByName(r)
    return out


def bag_union_of_projections(df: DataFrame, *projections: list[Column]) -> DataFrame:
    """U1 for several projections of the *same* relation: every input row
    emits one row per projection in a single pass, the same multiset as the
    union of the projections without evaluating ``df`` once per branch."""
    structs = [F.struct(*cols) for cols in projections]
    return df.select(F.explode(F.array(*structs)).alias("__u")).select("__u.*")


def union_average(joined: DataFrame) -> DataFrame:
    """U1 + A6: average over the bag union of both legs' delays, times two.

    Each joined bucket pair stands for n1*n2 flight pairs; leg 1 contributes
    delay s1*n2 over m1*n2 delays that are not NULL, and leg 2 n1*s2 over
    n1*m2. The two delay relations are bag-unioned (duplicates kept) and
    averaged; like any average, it skips NULLs."""
    u = bag_union_of_projections(
        joined,
        [(F.col("m1") * F.col("n2")).alias("n"), (F.col("s1") * F.col("n2")).alias("s")],
        [(F.col("n1") * F.col("m2")).alias("n"), (F.col("n1") * F.col("s2")).alias("s")],
    )
    n, s = F.sum("n"), F.sum("s")
    return u.agg(F.when(n > 0, s.cast("double") / n.cast("double") * 2).alias("avg_delay"))


#: Number of a leg, to tell copies apart where legs are dealt to cells.
LEG_ID = "_leg_id"


def pairs(
    tagged: DataFrame, carry: list[str] | None = None, strict: bool = True, counts: DataFrame | None = None,
    packed: bool = False,
) -> DataFrame:
    """J1 on flight rows: every qualifying (leg 1, leg 2) pair.

    The output *is* the pair set, so its size is inherent; no task holds more
    than a slice of a group (``sliced_join``). The join's own
    exchanges (no user repartition) keep AQE's skew-join split in play: a hot
    (date, transit) partition is cut into several tasks. With the groups' sizes
    (``leg_counts``) the legs are joined in cells instead (``celled_join``),
    which bounds them by rows and deals them evenly; copies of a leg are spread
    over its parts if a stored column ``LEG_ID`` numbers them. ``packed`` joins
    blocks of legs (``packed_join``), for pairs that take fewer bytes when written.
    """
    carry = carry or []
    ids = [LEG_ID] if LEG_ID in tagged.columns else []

    def side(leg: int, p: str) -> DataFrame:
        return tagged.where(F.col("leg") == leg).select(
            *KEY, F.col("t").alias(f"{p}t"), F.col("d").alias(f"{p}d"),
            *[F.col(c).alias(f"{p}{c}") for c in carry + ids])

    a, b, own = side(1, "a_"), side(2, "b_"), [f"{p}{c}" for p in ("a_", "b_") for c in ids]
    if packed and counts is not None:
        return packed_join(a, b, counts, "a_t", "b_t", strict, own)
    theta = F.col("a_t") < F.col("b_t") if strict else F.col("a_t") <= F.col("b_t")
    return _legs_join(a, b, counts).where(theta).drop(*own)
