"""Ceiling of mean arrival delay per carrier and month.

The heavy step is one hash aggregate on (carrier, month) with a map-side
partial (count, sum): each task ships at most one row per carrier-month,
so a carrier holding a third of all flights costs nothing extra. All
later steps (dense vector, text, ordering, routing) work on that result,
which has at most carriers x 12 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.predicates import not_flagged, year_and_valid_month
from wayfare.functions.scalar import ceil_mean

TARGET_YEAR = 2008
MONTHS = list(range(1, 13))


def month_col(m: int) -> str:
    return f"m{m:02d}"


def monthly_input(flights: DataFrame, year: int = TARGET_YEAR, truncate: bool = False) -> DataFrame:
    """P12 + cancelled reject rule; ``truncate`` (A9) casts the delay to int
    first, as the keyed ingest does. Diverted flights are kept."""
    delay = F.col("arr_delay_min")
    delay = delay.cast("int").cast("double") if truncate else delay.cast("double")
    return flights.where(year_and_valid_month(year) & not_flagged("cancelled")).select(
        "carrier", "month", delay.alias("delay"))


def monthly_delay(rows: DataFrame) -> DataFrame:
    """A7 + F5 + F14: (carrier, month, n, sum_delay, avg_delay=ceil(mean)).
    A flight whose delay is NULL is neither counted nor summed. Delays are summed as decimals of six places, so the order of rows and
    tasks cannot change the ceiling."""
    agg = rows.where(F.col("delay").isNotNull()).groupBy("carrier", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("delay").cast("decimal(18,6)")).alias("total"))
    return agg.select("carrier", "month", "n", F.col("total").cast("double").alias("sum_delay"),
                      ceil_mean("total", "n").alias("avg_delay"))


def monthly_vector(long: DataFrame, value: str = "avg_delay") -> DataFrame:
    """Dense 12 slots per carrier, 0 for a month without flights.

    Pivot with explicit month values (no distinct-values job), then fill.
    There is one row per carrier-month, so ``max`` just picks it (and,
    unlike ``first``, does not depend on row order).
    """
    wide = long.groupBy("carrier").pivot("month", MONTHS).agg(F.max(value))
    return wide.select(
        "carrier", *[F.coalesce(F.col(str(m)), F.lit(0)).alias(month_col(m)) for m in MONTHS])


def vector_array(wide: DataFrame) -> Column:
    return F.array(*[F.col(month_col(m)) for m in MONTHS])


def monthly_text(wide: DataFrame) -> DataFrame:
    """K3: ``CARRIER, (1, v1), (2, v2), ..., (12, v12)`` per carrier."""
    slots = F.transform(vector_array(wide), lambda x, i: F.format_string("(%d, %d)", i + 1, x))
    return wide.select(
        "carrier", F.concat(F.col("carrier"), F.lit(", "), F.array_join(slots, ", ")).alias("line"))


def ordered_by_month(long: DataFrame) -> DataFrame:
    """O1: rows of each carrier in month order, exposed as ``rn``.

    The window runs over the carrier-month aggregate (<= carriers x 12 rows),
    never over raw flights."""
    w = Window.partitionBy("carrier").orderBy("month")
    return long.select("carrier", "month", "avg_delay", F.row_number().over(w).alias("rn"))


def secondary_sorted(long: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """O1 physical form: cluster by carrier, sort by (carrier, month) in partition."""
    part = long.repartition(n_partitions, "carrier") if n_partitions else long.repartition("carrier")
    return part.sortWithinPartitions("carrier", "month")
