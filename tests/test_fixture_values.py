"""Expected values on the driver's tables (FIXTURES.md, part C)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from wayfare.plans import jobs


@pytest.mark.parametrize("sf,pairs,total,mean", [
    (SF001, 221, 3722, 16.84162895927602),
    (SF01, 20734, 380371, 18.345278286871803),
])
def test_two_leg_totals_all_forms(spark, sf, pairs, total, mean):
    for q in (jobs.two_leg_total, jobs.two_leg_running, jobs.two_leg_band_pruned):
        r = q(spark, sf).collect()[0]
        assert (r.n_pairs, r.sum_delay) == (pairs, total), q.__name__
        assert r.avg_delay == pytest.approx(mean, rel=1e-15)
    u = jobs.two_leg_union_avg(spark, sf).collect()[0]
    assert u.avg_delay == pytest.approx(mean, rel=1e-15)


def test_loose_legs_and_year_rows(spark):
    assert jobs.two_leg_join_first_left(spark, SF001).collect()[0].n_pairs == 344
    assert jobs.two_leg_join_first_both(spark, SF001).collect()[0].n_pairs == 221  # exclusive legs
    assert jobs.two_leg_year_2007_rows(spark, SF001).count() == 175
    assert jobs.two_leg_pairs(spark, SF001).count() == 221


def test_word_totals(spark):
    wc = jobs.word_count(spark, SF001)
    r = wc.agg(F.count("*").alias("w"), F.sum("n").alias("t")).collect()[0]
    assert (r.w, r.t) == (4250, 12149)


def test_monthly_totals(spark):
    m = jobs.monthly_delay(spark, SF001)
    r = m.agg(F.count("*").alias("rows"), F.sum("avg_delay").alias("s")).collect()[0]
    assert (r.rows, r.s) == (240, 2291)


def test_monthly_text_sample(spark):
    lines = {r.carrier: r.line for r in jobs.monthly_delay_text(spark, SF001).collect()}
    assert lines["9E"] == ("9E, (1, 13), (2, 11), (3, 12), (4, 11), (5, 9), (6, 8), (7, 7), "
                           "(8, 7), (9, 10), (10, 14), (11, 0), (12, 5)")


def test_upsert_key_count(spark):
    assert jobs.keyed_upsert_last(spark, SF001).count() == 4599


def test_keyed_monthly_equals_flat(spark):
    flat = jobs.monthly_delay(spark, SF001)
    for q in (jobs.keyed_scan_filter, jobs.keyed_scan_range):
        keyed = q(spark, SF001)
        assert flat.exceptAll(keyed).count() == 0 and keyed.exceptAll(flat).count() == 0
