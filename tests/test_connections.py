"""Two-leg connection operators: edge rows and brute-force equivalence."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import flight, flights_df
from wayfare.operators import connections as C
from wayfare.plans.inspect import final_plan, plan_summary


def _all_totals(df, **tag):
    b = C.time_buckets(C.tag_legs(df, **tag))
    out = {
        "running": C.totals_running(b).collect()[0],
        "join": C.totals_join(b).collect()[0],
        "pruned": C.totals_join(C.band_prune(b)).collect()[0],
    }
    avg = C.union_average(C.bucket_join(b)).collect()[0].avg_delay
    return out, avg, C.pairs(C.tag_legs(df, **tag)).count()


def test_tie_is_not_a_connection(spark):
    df = flights_df(spark, [flight(1, "ORD", "LAX", arr="0955", delay=5),
                            flight(2, "LAX", "JFK", dep="0955", delay=7)])
    out, avg, n = _all_totals(df)
    for r in out.values():
        assert (r.n_pairs, r.sum_delay, r.avg_delay) == (0, 0, None)
    assert avg is None and n == 0


def test_simple_connection_and_direct_flight(spark):
    df = flights_df(spark, [
        flight(1, "ORD", "LAX", arr="0900", delay=5),
        flight(2, "LAX", "JFK", dep="1000", delay=7),
        flight(3, "ORD", "JFK", dep="0700", arr="0800", delay=100),  # direct: in neither leg
    ])
    out, avg, n = _all_totals(df)
    for r in out.values():
        assert (r.n_pairs, r.sum_delay) == (1, 12)
    assert avg == pytest.approx(12.0) and n == 1


def test_next_day_and_window(spark):
    df = flights_df(spark, [
        flight(1, "ORD", "LAX", arr="0900", date=(2007, 7, 1)),
        flight(2, "LAX", "JFK", dep="1000", date=(2007, 7, 2)),  # next day
        flight(3, "ORD", "ATL", arr="0900", date=(2007, 5, 1)),  # before the window
        flight(4, "ATL", "JFK", dep="1000", date=(2007, 5, 1)),
    ])
    out, _, n = _all_totals(df)
    assert out["running"].n_pairs == 0 and n == 0
    out, _, n = _all_totals(df, window=None)
    assert out["running"].n_pairs == 1 and n == 1


def test_flag_rules(spark):
    rows = [flight(1, "ORD", "LAX", arr="0900"), flight(2, "LAX", "JFK", dep="1000", cancelled=2)]
    df = flights_df(spark, rows)
    assert _all_totals(df, rule="reject")[0]["join"].n_pairs == 1  # 2 is not "== 1"
    assert _all_totals(df, rule="accept")[0]["join"].n_pairs == 0  # only 0 is accepted


def test_loose_rule_admits_self_loops(spark):
    df = flights_df(spark, [
        flight(1, "ORD", "JFK", arr="0900"),  # loose leg 1 with transit JFK
        flight(2, "JFK", "JFK", dep="1000"),  # loose leg 2 from JFK
    ])
    assert _all_totals(df)[0]["join"].n_pairs == 0
    assert _all_totals(df, loose=True)[0]["join"].n_pairs == 1


def _brute(rows, window=((2007, 6), (2008, 5))):
    def ok(r):
        ym = r[2] * 100 + r[3]
        return r[12] != 1 and r[13] != 1 and window[0][0] * 100 + window[0][1] <= ym <= window[1][0] * 100 + window[1][1]

    l1 = [r for r in rows if ok(r) and r[7] == "ORD" and r[8] != "JFK"]
    l2 = [r for r in rows if ok(r) and r[7] != "ORD" and r[8] == "JFK"]
    n = s = 0
    for a in l1:
        for b in l2:
            if a[4] == b[4] and a[8] == b[7] and a[10] < b[9]:
                n += 1
                s += int(a[11]) + int(b[11])
    return n, s


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forms_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    airports = ["ORD", "JFK", "LAX", "ATL"]
    rows = []
    for i in range(400):
        o, d = rnd.choice(airports), rnd.choice(airports)
        dep = f"{rnd.randrange(0, 24):02d}{rnd.choice([0, 15, 30]):02d}"
        arr = f"{rnd.randrange(0, 24):02d}{rnd.choice([0, 15, 30]):02d}"
        date = (rnd.choice([2007, 2008]), rnd.choice([1, 5, 6, 7, 12]), rnd.choice([1, 2]))
        rows.append(flight(i, o, d, dep=dep, arr=arr, delay=rnd.choice([0, 3, 17, 60, -4]) + 0.7,
                           date=date, cancelled=rnd.choice([0, 0, 0, 1]),
                           diverted=rnd.choice([0, 0, 0, 0, 1])))
    df = flights_df(spark, rows)
    n, s = _brute(rows)
    out, avg, npairs = _all_totals(df)
    for form, r in out.items():
        assert (r.n_pairs, r.sum_delay) == (n, s), form
    assert npairs == n
    if n:
        assert avg == pytest.approx(s / n)


def test_band_prune_is_result_neutral_and_shrinks(spark):
    rows = [flight(1, "ORD", "LAX", arr="2300"), flight(2, "ORD", "LAX", arr="0800"),
            flight(3, "LAX", "JFK", dep="0700"), flight(4, "LAX", "JFK", dep="0900")]
    b = C.time_buckets(C.tag_legs(flights_df(spark, rows)))
    pruned = C.band_prune(b)
    # 2300 arrival never connects, 0700 departure precedes every arrival
    assert pruned.count() == 2
    assert C.totals_join(pruned).collect()[0].n_pairs == 1


def test_pairs_carry_columns(spark):
    df = flights_df(spark, [flight(7, "ORD", "LAX", arr="0900", delay=1),
                            flight(8, "LAX", "JFK", dep="1000", delay=2)])
    p = C.pairs(C.tag_legs(df, keep=["l_orderkey"]), carry=["l_orderkey"]).collect()
    assert [(r.a_l_orderkey, r.b_l_orderkey, r.a_t, r.b_t) for r in p] == [(7, 8, "0900", "1000")]


def test_running_form_is_single_scan(spark):
    from tests.conftest import SF001
    from wayfare.plans import jobs

    plan = jobs.two_leg_running(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan


def test_join_first_filter_pushed_below_join(spark):
    from tests.conftest import SF001
    from wayfare.plans import jobs

    df = jobs.two_leg_join_first_left(spark, SF001)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    # the left-side window on year1/month1 is evaluated before the join
    join_at = opt.index("Join Inner")
    assert "Filter" in opt[join_at:] and "= 2007)" in opt[join_at:]


def test_theta_inside_join(spark):
    from tests.conftest import SF001
    from wayfare.plans import jobs

    plan = jobs.two_leg_pairs(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    join_line = next(line for line in plan.split("\n") if "Join" in line)
    assert "Inner" in join_line and "<" in join_line


def test_bag_unions_keep_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert C.bag_union(a, b).count() == 3
    both = C.bag_union_of_projections(a, [F.col("x").alias("y")], [(F.col("x") + 1).alias("y")])
    assert sorted(r.y for r in both.collect()) == [1, 1, 2, 2]


def test_union_average_single_join(spark):
    from tests.conftest import SF001
    from wayfare.plans import jobs

    plan = jobs.two_leg_union_avg(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("name", ["two_leg_total", "two_leg_band_pruned", "two_leg_join_first_both",
                                  "two_leg_union_avg"])
def test_join_forms_scan_once(spark, name):
    """Symmetric join forms share one scan. (The left-only window of
    ``two_leg_join_first_left`` is pushed into the left side alone, so there
    each side keeps its own, differently filtered scan.)"""
    from tests.conftest import SF001
    from wayfare.plans import jobs

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        final = final_plan(getattr(jobs, name)(spark, SF001))
        assert plan_summary(final)["scans"] == "1 (+1 reused)"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_join_splits_hot_group(spark):
    """A (date, transit) group holding most rows is split by AQE's skew join."""
    from pyspark.sql import Row

    hot = [flight(i, "ORD", "LAX", arr=f"{i % 10:02d}00") for i in range(3000)]
    hot += [flight(10000 + i, "LAX", "JFK", dep="2300") for i in range(300)]
    cold = [flight(20000 + i, "ORD", "ATL", arr="0100", date=(2007, 7, 1 + i % 20)) for i in range(200)]
    cold += [flight(30000 + i, "ATL", "JFK", dep="0200", date=(2007, 7, 1 + i % 20)) for i in range(200)]
    df = flights_df(spark, hot + cold).repartition(8)  # several map outputs to split
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        p = C.pairs(C.tag_legs(df))
        n = p.count()
        assert n == 3000 * 300 + sum(len([j for j in range(200) if j % 20 == d]) ** 2 for d in range(20))
        assert "skew=true" in final_plan(p)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_group_totals_from_buckets(spark):
    """One (date, transit) group with thousands of flights: the buckets hold
    at most one row per distinct time, and totals match a direct count."""
    times = [f"{h:02d}{m:02d}" for h in range(0, 24) for m in (0, 30)]  # 48 distinct times
    leg1 = [flight(i, "ORD", "LAX", arr=times[i % 48], delay=i % 7) for i in range(3000)]
    leg2 = [flight(10**5 + i, "LAX", "JFK", dep=times[(5 * i) % 48], delay=i % 11) for i in range(3000)]
    df = flights_df(spark, leg1 + leg2)
    b = C.time_buckets(C.tag_legs(df))
    assert b.count() <= 48
    n = s = 0
    for a in leg1:
        for c in leg2:
            if a[10] < c[9]:
                n += 1
                s += int(a[11]) + int(c[11])
    for totals in (C.totals_running(b), C.totals_join(b)):
        r = totals.collect()[0]
        assert (r.n_pairs, r.sum_delay) == (n, s)


def test_two_job_chain_through_part_files(spark, tmp_path):
    """Job 1 writes partial (n, sum) rows as tab-separated part files; job 2
    re-reads them (S4) and merges (A5); the result equals the one-job totals."""
    from tests.conftest import SF001
    from wayfare.plans import jobs
    from wayfare.sources.text import read_tab_parts

    b = jobs._buckets(spark, SF001)
    out = str(tmp_path / "temp")
    C.partial_totals(b).select("n_pairs", "sum_delay").repartition(4) \
        .write.option("sep", "\t").csv(out)
    merged = C.merge_partials(read_tab_parts(spark, out, "n_pairs long, sum_delay long")).collect()[0]
    direct = C.totals_running(b).collect()[0]
    assert tuple(merged) == tuple(direct) == (221, 3722, pytest.approx(16.84162895927602))


def test_union_average_keeps_fractions_and_skips_nulls(spark):
    def average(first, second):
        rows = flights_df(spark, [flight(1, "ORD", "LAX", arr="0900", delay=first or 0),
                                  flight(2, "LAX", "JFK", dep="1000", delay=second or 0)])
        if first is None:
            rows = rows.withColumn("arr_delay_min", F.expr("if(l_orderkey = 1, null, arr_delay_min)"))
        legs = C.tag_legs(rows, rule="accept", exact=True)
        return C.union_average(C.bucket_join(C.time_buckets(legs))).collect()[0].avg_delay

    assert average(5.9, 7.9) == 13.8
    assert average(None, 7) == 14.0


@pytest.fixture
def one_hot_group(spark):
    """Legs of one date and transit, whose join would go to one task."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    rows = [flight(i, "ORD", "LAX", arr=f"{i % 24:02d}{i % 60:02d}", delay=i % 9) for i in range(200)]
    rows += [flight(1000 + i, "LAX", "JFK", dep=f"{i % 23:02d}{i % 59:02d}", delay=i % 7) for i in range(300)]
    yield rows
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tasks(df):
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def expected_pairs(rows):
    return sorted((a[0], b[0]) for a in rows for b in rows
                  if (a[7], b[8]) == ("ORD", "JFK") and a[8] == b[7] and a[10] < b[9])


def test_pairs_of_one_group_are_joined_in_several_tasks(spark, one_hot_group):
    p = C.pairs(C.tag_legs(flights_df(spark, one_hot_group), keep=["l_orderkey"]), carry=["l_orderkey"])
    assert "_slice" not in p.columns
    assert sorted((r.a_l_orderkey, r.b_l_orderkey) for r in p.collect()) == expected_pairs(one_hot_group)
    assert tasks(p) > 1


def test_year_rows_of_one_group_are_joined_in_several_tasks(spark, one_hot_group, monkeypatch):
    from wayfare.plans import jobs

    monkeypatch.setattr(jobs, "flight_rows", lambda spark, sf_dir: flights_df(spark, one_hot_group))
    p = jobs.two_leg_year_2007_rows(spark, "")
    assert p.count() == len(expected_pairs(one_hot_group))
    assert tasks(p) > 1


def test_flattened_rows_of_one_group_are_joined_in_several_tasks(spark, one_hot_group):
    p = C.joined_counts(C.tag_legs(flights_df(spark, one_hot_group), exact=True))
    assert p.columns == ["flight_date", "transit", "t1", "d1", "t2", "d2", "n"]
    assert sum(r.n for r in p.collect()) == len(expected_pairs(one_hot_group))
    assert tasks(p) > 1


@pytest.fixture
def merged_tasks(spark):
    """Joins by shuffle, their tasks merged by the bytes they read (the default)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def year_rows(spark, monkeypatch, rows):
    from wayfare.plans import jobs

    monkeypatch.setattr(jobs, "flight_rows", lambda spark, sf_dir: flights_df(spark, rows))
    return jobs.two_leg_year_2007_rows(spark, "")


def test_year_rows_tasks_are_not_merged_by_bytes(spark, merged_tasks, monkeypatch):
    rows = [flight(i, "ORD", "LAX", arr=f"{i % 24:02d}00", delay=i % 9, date=(2007, 7, 1 + i % 7)) for i in range(140)]
    rows += [flight(1000 + i, "LAX", "JFK", dep=f"{i % 23:02d}30", date=(2007, 7, 1 + i % 7)) for i in range(210)]
    # groups of one leg, of another year and of a missing place
    rows += [flight(2000, "ORD", "SEA"), flight(2001, "ATL", "JFK"), flight(2002, "ORD", None), flight(2003, None, "JFK")]
    rows += [flight(2004, "ORD", "LAX", date=(2008, 7, 1)), flight(2005, "LAX", "JFK", dep="2300", date=(2008, 7, 1))]
    p = year_rows(spark, monkeypatch, rows)
    assert p.columns == ["flight_date", "transit", "a_t", "a_d", "a_year", "a_month", "b_t", "b_d", "b_year", "b_month"]
    legs = [r for r in rows if r[4].year == 2007]
    assert sorted(map(tuple, p.collect())) == sorted(
        (a[4], a[8], a[10], int(a[11]), 2007, 7, b[9], int(b[11]), 2007, 7) for a in legs for b in legs
        if (a[7], b[8]) == ("ORD", "JFK") and a[8] == b[7] and a[8] and a[4] == b[4] and a[10] < b[9])
    assert tasks(p) > 3


def test_year_rows_of_copies_are_joined_in_several_tasks(spark, merged_tasks, monkeypatch):
    rows = [flight(i, "ORD", "LAX", arr="0900", delay=5) for i in range(300)]
    rows += [flight(1000 + i, "LAX", "JFK", dep="1000", delay=7) for i in range(200)]
    p = year_rows(spark, monkeypatch, rows)
    assert p.groupBy("a_t", "a_d", "b_t", "b_d").count().collect() == [("0900", 5, "1000", 7, 60000)]
    assert tasks(p) > 3


def test_cells_of_a_large_group_hold_few_legs(spark, merged_tasks, monkeypatch):
    monkeypatch.setattr(C, "LARGE", 100)
    rows = [flight(i, "ORD", "LAX", arr=f"{i % 24:02d}{i % 60:02d}", delay=i % 9) for i in range(2000)]
    rows += [flight(5000 + i, "LAX", "JFK", dep=f"{i % 23:02d}{i % 59:02d}") for i in range(30)]
    tagged = C.tag_legs(flights_df(spark, rows), keep=["l_orderkey"])
    p = C.pairs(tagged, carry=["l_orderkey"], strict=False, counts=C.leg_counts(tagged))
    got = p.select("a_l_orderkey", "b_l_orderkey", F.spark_partition_id().alias("task")).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted(
        (a[0], b[0]) for a in rows[:2000] for b in rows[2000:] if a[10] <= b[9])
    assert len({r.task for r in got}) > 8  # of 20 cells


@pytest.fixture
def large_group(spark):
    """4,000 legs each way of one date and transit; few depart late enough."""
    rows = spark.range(8000).selectExpr(
        "date'2007-07-01' AS flight_date", "'LAX' AS transit", "cast(id % 2 + 1 AS int) AS leg", "id",
        "lpad(cast(if(id % 2 = 0, 1200 + id % 1100, id % 1230) AS string), 4, '0') AS t", "cast(id % 31 AS int) AS d")
    return rows.select("id", "flight_date", "transit", "t", "d", "leg")


def shuffled_rows(plan):
    """Rows written by the exchanges of a plan that has run."""
    name, under = plan.nodeName(), [plan.children().apply(i) for i in range(plan.children().size())]
    if name.startswith("AdaptiveSparkPlan"):
        under = [plan.executedPlan()]
    elif "QueryStage" in name:
        under = [plan.plan()]
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(shuffled_rows(p) for p in under)


@pytest.mark.parametrize("packed", [False, True])
def test_pairs_of_a_large_group_by_cells(spark, merged_tasks, large_group, packed):
    counts = C.leg_counts(large_group)
    p = C.pairs(large_group, carry=["id"], counts=counts, packed=packed)
    assert p.columns == ["flight_date", "transit", "a_t", "a_d", "a_id", "b_t", "b_d", "b_id"]
    got = sorted((r.a_id, r.b_id) for r in p.collect())
    rows = large_group.collect()
    late = [r for r in rows if r.leg == 2 and r.t > "1200"]
    assert got == sorted((a.id, b.id) for a in rows if a.leg == 1 for b in late if a.t < b.t)


def test_pairs_query_shuffles_few_rows_of_a_large_group(spark, merged_tasks, large_group, monkeypatch):
    from wayfare.plans import jobs

    legs = large_group.withColumnRenamed("id", "l_orderkey").withColumn("l_linenumber", F.lit(1))
    monkeypatch.setattr(jobs, "_stored_legs", lambda spark, sf_dir, **tag_args: (legs, C.leg_counts(legs)))
    p = jobs.two_leg_pairs(spark, "")
    qe = p._jdf.queryExecution()
    assert qe.toRdd().count() > 0
    # each leg once, then its block for each part of the other leg; 64,000 of legs for each part before
    assert shuffled_rows(qe.executedPlan()) < 24000


def test_written_pairs_repeat_within_few_bytes(spark, merged_tasks, monkeypatch, tmp_path):
    from wayfare.plans import jobs

    rows = [flight(i, "ORD", "LAX", arr=f"{i * 7 % 12:02d}{i * 11 % 60:02d}", delay=i % 31) for i in range(1500)]
    rows += [flight(5000 + i, "LAX", "JFK", dep=f"{6 + i * 5 % 18:02d}{i * 13 % 60:02d}", delay=i % 29) for i in range(1500)]
    monkeypatch.setattr(jobs, "flight_rows", lambda spark, sf_dir: flights_df(spark, rows))
    p = jobs.two_leg_pairs(spark, "")
    p.coalesce(1).write.parquet(str(tmp_path / "pairs"))
    written = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    n = spark.read.parquet(str(tmp_path / "pairs")).count()
    assert n == len(expected_pairs(rows))
    assert written < n
