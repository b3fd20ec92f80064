"""Monthly delay: filters, ceiling, zero fill, text and ordering."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import flight, flights_df
from wayfare.operators import monthly as M
from wayfare.plans import jobs


def _rows(spark):
    return flights_df(spark, [
        flight(1, "ORD", "LAX", date=(2008, 1, 1), delay=10.0, carrier="AA"),
        flight(2, "ORD", "LAX", date=(2008, 1, 2), delay=11.0, carrier="AA"),
        flight(3, "ORD", "LAX", date=(2008, 2, 2), delay=1.0, carrier="AA", cancelled=1),
        flight(4, "ORD", "LAX", date=(2008, 3, 2), delay=-3.5, carrier="AA", diverted=1),
        flight(5, "ORD", "LAX", date=(2008, 3, 2), delay=0.0, carrier="ZZ", month=13),
        flight(6, "ORD", "LAX", date=(2008, 3, 2), delay=4.0, carrier="ZZ"),
        flight(7, "ORD", "LAX", date=(2007, 3, 2), delay=99.0, carrier="AA"),
        flight(8, "ORD", "LAX", date=(2008, 4, 2), delay=40000.0, carrier="AA"),
    ])


def test_long_form(spark):
    got = {(r.carrier, r.month): (r.n, r.sum_delay, r.avg_delay)
           for r in M.monthly_delay(M.monthly_input(_rows(spark))).collect()}
    assert got == {
        ("AA", 1): (2, 21.0, 11),  # ceil(10.5)
        ("AA", 3): (1, -3.5, -3),  # diverted kept; ceil(-3.5) = -3
        ("AA", 4): (1, 40000.0, 40000),  # no 16-bit wrap
        ("ZZ", 3): (1, 4.0, 4),  # unknown carrier kept, month 13 dropped
    }


def test_vector_zero_fill_and_text(spark):
    long = M.monthly_delay(M.monthly_input(_rows(spark)))
    vec = {r.carrier: [r[M.month_col(m)] for m in M.MONTHS] for r in M.monthly_vector(long).collect()}
    assert vec["AA"] == [11, 0, -3, 40000, 0, 0, 0, 0, 0, 0, 0, 0]  # all-cancelled Feb -> 0
    text = {r.carrier: r.line for r in M.monthly_text(M.monthly_vector(long)).collect()}
    assert text["ZZ"] == "ZZ, (1, 0), (2, 0), (3, 4), " + ", ".join(f"({m}, 0)" for m in range(4, 13))


def test_truncate_option(spark):
    got = {(r.carrier, r.month): r.sum_delay
           for r in M.monthly_delay(M.monthly_input(_rows(spark), truncate=True)).collect()}
    assert got[("AA", 3)] == -3.0


def test_zero_fill_on_filtered_fixture(spark):
    fl = jobs.flight_rows(spark, SF001).where((F.col("origin") == "ORD") & (F.col("dest") == "LAX"))
    long = M.monthly_delay(M.monthly_input(fl))
    assert long.count() == 111
    vec = M.monthly_vector(long)
    zeros = vec.select(sum((F.col(M.month_col(m)) == 0).cast("int") for m in M.MONTHS).alias("z"))
    assert vec.count() * 12 - zeros.agg(F.sum("z")).collect()[0][0] <= 111


def test_ordered_by_month(spark):
    rows = M.ordered_by_month(M.monthly_delay(M.monthly_input(_rows(spark)))).collect()
    aa = sorted((r.rn, r.month) for r in rows if r.carrier == "AA")
    assert aa == [(1, 1), (2, 3), (3, 4)]


def test_secondary_sorted_layout(spark):
    long = M.monthly_delay(M.monthly_input(jobs.flight_rows(spark, SF001)))
    for part in M.secondary_sorted(long, 4).rdd.glom().collect():
        keys = [(r.carrier, r.month) for r in part]
        assert keys == sorted(keys)


def test_carrier_routing(spark):
    got = {r.carrier: r.part for r in jobs.carrier_partition_assignment(spark, SF001).collect()}
    assert got["9E"] == 0 and got["AA"] == 1 and got["YV"] == 19 % 4
