"""Keyed table: key codec, lookup, upsert, partitioned write, scans."""

import glob

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.helpers import flight, flights_df
from wayfare.operators import keyed as K
from wayfare.plans import jobs


def test_key_bytes_and_order(spark):
    df = spark.createDataFrame([(2008, 0, 3, 19, 40000, 2)],
                               "year int, cancelled int, month int, carrier_idx int, l_orderkey long, l_linenumber int")
    r = df.select(K.row_key().alias("k"), K.row_key_hex().alias("h")).collect()[0]
    assert r.h == "07D8" + "00" + "03" + "13" + "00000000009C40" + "02"
    assert bytes(r.k) == K.literal_key({"year": 2008, "month": 3, "carrier_idx": 19,
                                        "l_orderkey": 40000, "l_linenumber": 2})
    assert K.literal_key({"year": 2008, "cancelled": 1}) > K.literal_key({"year": 2008, "month": 255})


def test_key_part_out_of_range_raises(spark):
    df = spark.createDataFrame([(2008, 0, 300, 1, 1, 1)],
                               "year int, cancelled int, month int, carrier_idx int, l_orderkey long, l_linenumber int")
    with pytest.raises(SPARK_ERRORS):
        df.select(K.row_key()).collect()


def test_unknown_carrier_rejected_by_ingest(spark):
    df = flights_df(spark, [flight(1, "ORD", "LAX", carrier="ZZ")])
    with pytest.raises(SPARK_ERRORS):
        K.keyed_rows(df, spark).collect()
    loose = K.carrier_to_index(df.select("carrier"), spark, strict=False).collect()[0]
    assert loose.carrier_idx is None


def test_upsert_last_by_total_order(spark):
    rows = spark.createDataFrame(
        [(1, 1, 5, "a"), (1, 1, 9, "b"), (1, 1, 7, "c"), (2, 1, 1, "d")],
        "k1 long, k2 int, seq int, v string")
    got = {(r.k1, r.k2): r.v for r in K.upsert_last(rows, ["k1", "k2"], ["seq"]).collect()}
    assert got == {(1, 1): "b", (2, 1): "d"}
    plan = K.upsert_last(rows, ["k1", "k2"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_partitioned_write_and_scans(spark, tmp_path):
    from wayfare.plans import jobs

    path = str(tmp_path / "flights_keyed")
    rows = K.keyed_rows(jobs.flight_rows(spark, SF001), spark)
    K.write_keyed_table(rows, path)
    assert K.scan_predicate(spark, path, 2008, 0).count() == 3156
    pf = K.scan_predicate(spark, path, 2008, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pf and "(year#" in pf
    rng = K.scan_key_range(spark, path, {"year": 2008, "cancelled": 0, "month": 1},
                           {"year": 2008, "cancelled": 0, "month": 13})
    assert rng.count() == 3156
    rp = rng._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in rp and "rowkey" in rp
    with pytest.raises(SPARK_ERRORS):
        K.write_keyed_table(rows, path, mode="errorifexists")


def test_range_layout_and_hot_key_copies(spark, tmp_path):
    from wayfare.plans import jobs

    rows = K.keyed_rows(jobs.flight_rows(spark, SF001), spark)
    ranged = str(tmp_path / "ranged")
    K.write_keyed_table(rows, ranged, layout="range", n_ranges=4)
    assert spark.read.parquet(ranged).count() == 6000
    # a third of the rows are copies of one key: every copy is written
    first = rows.agg(F.min("l_orderkey")).collect()[0][0]
    one = rows.where(F.col("l_orderkey") == first)
    n_one = one.count()
    copies = one.select("*", F.explode(F.array_repeat(F.lit(0), 3000)).alias("_r")).drop("_r")
    many = str(tmp_path / "many")  # several files, so several map tasks
    copies.unionByName(rows).repartition(8).write.parquet(many)
    out = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        K.write_keyed_table(spark.read.parquet(many), out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    assert n_one >= 1
    assert spark.read.parquet(out).count() == 6000 + 3000 * n_one
    r = one.collect()[0]
    hot_files = glob.glob(f"{out}/year={r.year}/cancelled={r.cancelled}/part-*")
    assert len(hot_files) > 1  # the hot key was split across writer tasks


def test_decode_key(spark):
    df = spark.createDataFrame([(2008, 0, 11, 17, 5, 1)],
                               "year int, cancelled int, month int, carrier_idx int, l_orderkey long, l_linenumber int")
    r = K.decode_key(df.select(K.row_key().alias("rowkey"))).collect()[0]
    assert (r.key_month, r.key_carrier_idx) == (11, 17)


def test_create_table_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "rowkey binary, month int, carrier string, delay int, year int, cancelled int"
    assert K.create_table_if_absent(spark, "wayfare_flights_t", path, schema) is True
    assert K.create_table_if_absent(spark, "wayfare_flights_t", path, schema) is False
    rows = spark.createDataFrame([(bytearray(b"k"), 1, "AA", 5, 2008, 0)], schema)
    K.append_by_name(rows.select(*reversed(rows.columns)), "wayfare_flights_t")
    assert K.create_table_if_absent(spark, "wayfare_flights_t", path, schema) is False
    assert [tuple(r) for r in spark.table("wayfare_flights_t").select("carrier", "delay", "year").collect()] == [("AA", 5, 2008)]
    with pytest.raises(ValueError, match="other columns"):
        K.create_table_if_absent(spark, "wayfare_flights_t", path, schema.replace("delay int", "delay bigint"))
    with pytest.raises(ValueError, match="has the columns"):
        K.append_by_name(rows.drop("delay"), "wayfare_flights_t")
    assert spark.table("wayfare_flights_t").count() == 1
    spark.sql("DROP TABLE wayfare_flights_t")


def test_flag_two_is_not_cancelled_everywhere(spark, tmp_path):
    """A cancelled flag of 2 is kept by the reject rule; every keyed scan
    must agree with the flat monthly job on such rows."""
    from wayfare.operators import monthly as M

    rows = [flight(i, "ORD", "LAX", date=(2008, 1 + i % 3, 1), delay=10 + i, cancelled=c)
            for i, c in enumerate([0, 1, 2, 2, 0, 1, 2, 0, 0])]
    rows += [flight(100 + i, "ORD", "LAX", date=(2007, 1, 1), delay=99, cancelled=2) for i in range(3)]
    fl = flights_df(spark, rows)
    flat = M.monthly_delay(M.monthly_input(fl))
    path = str(tmp_path / "t")
    K.write_keyed_table(K.keyed_rows(fl, spark), path)
    by_pred = K.scan_predicate(spark, path, 2008, 0).select(
        "carrier", "month", F.col("delay").cast("double").alias("delay"))
    packed = K.index_to_carrier(K.scan_packed(spark, path, 2), spark).select(
        "carrier", "month", F.col("delay").cast("double").alias("delay"))
    ranged = K.scan_key_range(spark, path, {"year": 2008, "cancelled": 0, "month": 1},
                              {"year": 2008, "cancelled": 0, "month": 13}).select(
        "carrier", "month", F.col("delay").cast("double").alias("delay"))
    for scan in (by_pred, packed, ranged):
        got = M.monthly_delay(scan)
        assert got.exceptAll(flat).count() == 0 and flat.exceptAll(got).count() == 0


def test_derived_tables_publish_once(spark):
    first = jobs.keyed_table(spark, SF001)
    again = jobs.keyed_table(spark, SF001)
    fresh = jobs.keyed_table(spark, SF001, rebuild=True)
    assert first == again and fresh != first
    assert spark.read.parquet(fresh).count() == spark.read.parquet(first).count() == 6000


def test_every_file_ascends_and_the_table_reads_by_name(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = K.keyed_rows(jobs.flight_rows(spark, SF001), spark)
    K.write_keyed_table(rows, path)
    read = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    for part in read.select("file").distinct().collect():
        keys = [bytes(r.rowkey) for r in spark.read.parquet(part.file).select("rowkey").collect()]
        assert keys == sorted(keys)
    schema = ", ".join(f"{c} {t}" for c, t in read.drop("file").dtypes)
    try:
        assert K.create_table_if_absent(spark, "wayfare_by_name", path, schema)
        assert spark.table("wayfare_by_name").count() == rows.count()
    finally:
        spark.sql("DROP TABLE IF EXISTS wayfare_by_name")


def test_unknown_carrier_index_raises(spark):
    import pytest
    from pyspark.errors import PySparkException

    assert [r.carrier for r in K.index_to_carrier(spark.sql("select 0 as carrier_idx"), spark).collect()] == ["9E"]
    with pytest.raises(PySparkException, match="unknown carrier index: 99"):
        K.index_to_carrier(spark.sql("select 99 as carrier_idx"), spark).collect()


def test_packed_scan_opens_one_partition(spark, tmp_path):
    path = str(tmp_path / "packed")
    K.write_keyed_table(K.keyed_rows(jobs.flight_rows(spark, SF001), spark), path)
    plan = K.scan_packed(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert "(year" in plan.split("PartitionFilters")[1].split("]")[0]
