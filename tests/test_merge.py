"""Tables replaced at once, loads into existing tables, split ranges, bounds
before the shuffle and joins with multiplicities."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import flight, flights_df
from wayfare.operators import connections as C
from wayfare.operators import keyed as K
from wayfare.operators import merge
from wayfare.plans import jobs
from wayfare.sinks import versions, write_single_row


def ids(df):
    return sorted(r["id"] for r in df.collect())


# -------------------------------------------------------------------- versions
def test_a_failing_writer_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(spark.range(3), root)
    bad = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error("broken")).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.replace(bad, root)
    assert ids(versions.read(spark, root)) == [0, 1, 2] and versions.latest(spark, root) == 1
    versions.replace(spark.range(5, 7), root)
    assert ids(versions.read(spark, root)) == [5, 6]
    assert len(versions.vacuum(spark, root)) == 2 and ids(versions.read(spark, root)) == [5, 6]


def test_of_two_writers_the_first_wins_and_readers_see_whole_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(spark.range(3), root)
    reader = versions.read(spark, root)

    def slow(folder):
        spark.range(100, 110).write.parquet(folder)
        versions.replace(spark.range(7), root)  # another writer commits meanwhile
        assert ids(versions.read(spark, root)) == list(range(7))

    with pytest.raises(versions.ConcurrentWrite):
        versions.publish(spark, root, slow, schema=spark.range(1).schema.json())
    assert ids(versions.read(spark, root)) == list(range(7))
    assert ids(reader) == [0, 1, 2]  # the version that it opened


def test_modes(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    versions.replace(spark.range(2).limit(0), root, "errorifexists")
    assert versions.read(spark, root).dtypes == [("id", "bigint")] and ids(versions.read(spark, root)) == []
    with pytest.raises(FileExistsError):
        versions.replace(spark.range(2), root, "errorifexists")
    versions.replace(spark.range(2), root, "ignore")
    assert ids(versions.read(spark, root)) == []


# ----------------------------------------------------------------------- loads
ROW = "k string, seq int, year int, cancelled int, month int, rowkey binary, v int"


def load(spark, rows):
    full = [(k, s, y, c, 1, bytearray(f"{y}{c}{k}".encode()), v) for k, s, y, c, v in rows]
    return merge.with_record(spark.createDataFrame(full, ROW), ["k"], ["seq"])


def content(spark, root):
    return sorted(((r["k"] or "", r["seq"], r["year"], r["cancelled"], r["v"]) for r in versions.read(spark, root).collect()))


def test_loads_repeat_change_move_and_add(spark, tmp_path):
    root = str(tmp_path / "t")
    first = [("a", 1, 2007, 0, 1), ("a", 1, 2007, 0, 1), ("b", 1, 2007, 1, 2), ("c", 1, 2008, 0, 3), (None, 1, 2008, 1, 4)]
    assert merge.merge_load(spark, root, load(spark, first)) == 1
    before = versions.contents(spark, root)[1]
    assert merge.merge_load(spark, root, load(spark, first[:2])) == 2  # equal records stay two
    assert content(spark, root) == sorted((k or "", *r) for k, *r in first)
    after = versions.contents(spark, root)[1]
    # only the touched partition is written anew
    assert set(before) - set(after) == {f for f in before if f.endswith("year=2007/cancelled=0")}
    second = [("b", 1, 2007, 0, 20), (None, 1, 2008, 1, 40), ("d", 1, 2009, 0, 5)]
    merge.merge_load(spark, root, load(spark, second))
    assert content(spark, root) == sorted([("a", 1, 2007, 0, 1)] * 2 + [("b", 1, 2007, 0, 20), ("c", 1, 2008, 0, 3),
                                                                        ("", 1, 2008, 1, 40), ("d", 1, 2009, 0, 5)])
    assert not any(f.endswith("year=2007/cancelled=1") for f in versions.contents(spark, root)[1])  # b was all of it
    merge.merge_load(spark, root, load(spark, first[:1]).limit(0))
    assert len(content(spark, root)) == 6
    merge.merge_load(spark, root, load(spark, second), fresh=True)
    assert len(content(spark, root)) == 3


def test_a_load_that_meets_another_starts_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    merge.merge_load(spark, root, load(spark, [("a", 1, 2007, 0, 1)]))
    commit, other = versions.commit, load(spark, [("b", 1, 2007, 0, 2)])

    def meet(*args):
        monkeypatch.setattr(versions, "commit", commit)
        merge.merge_load(spark, root, other)
        return commit(*args)

    monkeypatch.setattr(versions, "commit", meet)
    assert merge.merge_load(spark, root, load(spark, [("c", 1, 2007, 0, 3)])) == 3
    assert [r[0] for r in content(spark, root)] == ["a", "b", "c"]


@pytest.mark.parametrize("hot", [100_000, 20])
def test_occurrences_number_each_identity(spark, monkeypatch, hot):
    rows = spark.range(900).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), F.when(F.col("id") > 5, F.col("id")).alias("v"))
    whole = {(r["k"], r["v"]): r["occurrence"] for r in merge.with_occurrence(rows.where("v is not null"), ["k"], ["v"]).collect()}
    monkeypatch.setattr(merge, "HOT_ROWS", hot)
    got = merge.with_occurrence(rows, ["k"], ["v"]).collect()
    for k in {r["k"] for r in got}:
        assert sorted(r["occurrence"] for r in got if r["k"] == k) == list(range(1, sum(r["k"] == k for r in got) + 1))
    # the same numbers whether an identity is divided or not
    assert {(r["k"], r["v"]): r["occurrence"] for r in merge.with_occurrence(rows.where("v is not null"), ["k"], ["v"]).collect()} == whole


# ---------------------------------------------------------------------- splits
def test_even_splits():
    points = K.even_splits(b"\x02\x00", b"\x0c\x00", 20)
    assert len(points) == 19 and points[0] == b"\x02\x00" and points[-1] == b"\x0c\x00" and points == sorted(points)
    with pytest.raises(ValueError):
        K.even_splits(b"\x02", b"\x02", 20)


def test_range_scan_opens_only_the_files_it_needs(spark, tmp_path):
    rows = K.keyed_rows(jobs.flight_rows(spark, SF001), spark).withColumn("rowkey", K.row_key(K.SPLIT_KEY_PARTS))
    path = str(tmp_path / "split")
    key = lambda m: K.literal_key({"month": m}, K.SPLIT_KEY_PARTS)
    K.write_split_table(rows, path, K.even_splits(key(2), key(12), 20))
    some = K.scan_split_range(spark, path, key(3), key(6))
    assert some.count() == rows.where("month between 3 and 5").count() > 0
    opened = some.inputFiles()
    assert 0 < len(opened) <= len(spark.read.parquet(path).inputFiles()) / 2
    for file in opened:
        assert spark.read.parquet(file).where("month between 3 and 5").count() > 0
    assert K.scan_split_range(spark, path, key(13), key(14)).count() == 0


def test_file_bounds_sort_no_table_rows(spark, tmp_path):
    """The keys of the bounds are picked by place; no task sorts the rows of its files."""
    path = str(tmp_path / "t")
    rows = spark.range(1000).select((F.col("id") % 3).cast("int").alias("part"),
                                    F.when(F.col("id") % 7 > 0, F.unhex(F.hex("id"))).alias("k"))
    rows = rows.unionByName(spark.range(5).select(F.lit(9).alias("part"), F.lit(None).cast("binary").alias("k")))
    rows.repartition("part").sortWithinPartitions("part", "k").write.partitionBy("part").parquet(path)
    table = spark.read.parquet(path)
    bounds = K.file_bounds(table, "k")
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastHashJoin"):]  # what runs over all rows
    assert "Sort" not in below and "HashAggregate" in below
    by_hand = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n"))
    key = lambda r: (r["file"], r["low"], r["high"], r["n"])
    assert sorted(map(key, bounds.collect())) == sorted(map(key, by_hand.collect()))


# ------------------------------------------------------- bounds, multiplicities
def test_bounds_drop_rows_before_the_shuffle(spark):
    tagged = C.tag_legs(jobs.flight_rows(spark, SF001))
    pruned = C.prune_by_bounds(tagged, C.leg_bounds(tagged))
    assert C.time_buckets(pruned).count() < 0.8 * C.time_buckets(tagged).count()
    assert pruned.columns == tagged.columns
    plan = C.time_buckets(pruned)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("hashpartitioning(flight_date"):]
    assert "BroadcastHashJoin" in below  # the rows are pruned before they are shuffled
    exact = C.totals_join(C.time_buckets(tagged)).collect()
    assert C.totals_join(C.time_buckets(pruned)).collect() == exact


def test_too_many_bounds_prune_after_the_shuffle(spark, monkeypatch):
    expected = jobs.two_leg_total(spark, SF001).collect()
    monkeypatch.setattr(jobs, "BOUND_GROUPS", 1)
    assert jobs.two_leg_bounds_pruned(spark, SF001).collect() == expected


def test_equal_flights_are_joined_once(spark):
    rows = [flight(i, "ORD", "LAX", arr="0900", delay=1.5) for i in range(300)]
    rows += [flight(1000 + i, "LAX", "JFK", dep="1000", delay=2.25) for i in range(400)]
    tagged = C.tag_legs(flights_df(spark, rows), exact=True, keep=["year"])
    (row,) = C.joined_counts(tagged, carry=["year"]).collect()
    assert (row["n"], float(row["d1"]), float(row["d2"]), row["t1"], row["t2"]) == (120_000, 1.5, 2.25, "0900", "1000")


def test_a_group_without_a_connection_has_a_partial_of_zeros(spark):
    rows = [flight(1, "ORD", "LAX", arr="2300"), flight(2, "LAX", "JFK", dep="0700"), flight(3, "SEA", "JFK", dep="0700")]
    partials = C.partial_totals(C.time_buckets(C.tag_legs(flights_df(spark, rows))))
    assert sorted((r["transit"], r["n_pairs"], r["sum_delay"]) for r in partials.collect()) == [("LAX", 0, 0), ("SEA", 0, 0)]


def test_unknown_delays_are_neither_counted_nor_summed(spark):
    from wayfare.operators import monthly as M

    rows = [flight(1, "ORD", "LAX", arr="0900", delay=5), flight(2, "ORD", "LAX", arr="0900", delay=None),
            flight(3, "LAX", "JFK", dep="1000", delay=7), flight(4, "LAX", "JFK", dep="1100", delay=None)]
    df = flights_df(spark, rows)
    (total,) = C.totals_running(C.time_buckets(C.tag_legs(df))).collect()
    assert (total.n_pairs, total.sum_delay) == (1, 12)
    long = M.monthly_delay(df.select("carrier", "month", F.col("arr_delay_min").alias("delay")))
    assert [(r.n, r.sum_delay, r.avg_delay) for r in long.collect()] == [(2, 12.0, 6)]


def test_a_large_result_is_no_single_row(spark, tmp_path, monkeypatch):
    from wayfare.sinks import files

    monkeypatch.setattr(files, "SINGLE_ROWS", 5)
    with pytest.raises(ValueError, match="too many"):
        write_single_row(spark.range(6), str(tmp_path / "x"))
    write_single_row(spark.range(5), str(tmp_path / "x"))


# --------------------------------------------------------------- what is moved
def test_derived_columns_and_exact_records(spark, tmp_path):
    """Columns that follow from others are made where rows are written, and a
    record as a struct tells NULLs, copies and moves as the hash does."""
    root = str(tmp_path / "t")
    derived = {"k": F.col("record.k"), "rowkey": F.encode(F.concat_ws("-", "year", "cancelled", "k"), "UTF-8")}

    def put(rows):
        full = spark.createDataFrame([(k, s, y, c, 1, bytearray(b"?"), v) for k, s, y, c, v in rows], ROW)
        merge.merge_load(spark, root, merge.with_record(full, ["k"], ["seq"], exact=True), derived=derived)

    first = [("a", 1, 2007, 0, 1), ("a", 1, 2007, 0, 1), ("b", 1, 2007, 1, 2), (None, 1, 2008, 1, 4)]
    put(first)
    put([("b", 1, 2007, 0, 20), (None, 1, 2008, 1, 40), ("c", 1, 2009, 0, 5)])
    assert content(spark, root) == sorted([("a", 1, 2007, 0, 1)] * 2 + [("b", 1, 2007, 0, 20), ("", 1, 2008, 1, 40), ("c", 1, 2009, 0, 5)])
    keys = {(r["k"], bytes(r["rowkey"]).decode()) for r in versions.read(spark, root).collect()}
    assert keys == {("a", "2007-0-a"), ("b", "2007-0-b"), (None, "2008-1"), ("c", "2009-0-c")}
    assert not any(f.endswith("year=2007/cancelled=1") for f in versions.contents(spark, root)[1])


def test_a_load_into_a_new_table_is_written_once(spark, tmp_path, monkeypatch):
    made, written = [], merge.written
    monkeypatch.setattr(merge, "written", lambda df, name: made.append(name) or written(df, name))
    root = str(tmp_path / "t")
    merge.merge_load(spark, root, load(spark, [("a", 1, 2007, 0, 1)]))
    assert made == []  # neither the load nor hot identities, of which there are none
    merge.merge_load(spark, root, load(spark, [("b", 1, 2007, 0, 1)]))
    assert made == ["load"]


def test_numbering_shuffles_no_hash(spark):
    rows = spark.range(50).select((F.col("id") % 7).alias("k"), "id")
    plan = merge.with_occurrence(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "xxhash64" not in plan[plan.index("Exchange"):]
