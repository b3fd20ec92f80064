"""Partition layout helpers, tab split and the packed predicate."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from wayfare.functions.scalar import pack_bits, tab_fields
from wayfare.operators import connections as C
from wayfare.operators import keyed as K
from wayfare.operators import layout as L
from wayfare.plans import jobs


def test_cluster_sorted_groups_and_orders(spark):
    tagged = C.tag_legs(jobs.flight_rows(spark, SF001))
    parts = L.cluster_sorted(tagged, ["flight_date", "transit"], ["t"]).rdd.glom().collect()
    seen = {}
    for i, part in enumerate(parts):
        keys = [(r.flight_date, r.transit, r.t) for r in part]
        assert keys == sorted(keys)
        for k in keys:
            assert seen.setdefault(k[:2], i) == i  # one group, one partition


def test_route_by_index_mod(spark):
    df = spark.createDataFrame([(i,) for i in range(10)] + [(None,)], "idx int")
    got = {r.idx: r.part for r in L.route_by_index(df, F.col("idx"), 4).collect()}
    assert got == {**{i: i % 4 for i in range(10)}, None: 0}


def test_single_partition_and_sorted_within(spark):
    df = spark.createDataFrame([("b",), ("a",), ("B",)], "w string").repartition(3)
    one = L.single_partition(L.sorted_within(df, "w"))
    assert one.rdd.getNumPartitions() == 1


def test_tab_split(spark):
    df = spark.createDataFrame([("466756\t23651106",)], "v string")
    assert df.select(tab_fields("v").alias("f")).collect()[0].f == ["466756", "23651106"]


def test_packed_predicate_equals_typed(spark):
    rows = K.keyed_rows(jobs.flight_rows(spark, SF001), spark)
    packed = rows.where(F.col("cond") == 2).count()
    typed = rows.where((F.col("year") == 2008) & (F.col("cancelled") == 0)).count()
    assert packed == typed == 3156
    assert rows.where(F.col("cond") != pack_bits(F.col("year") - 2007, F.col("cancelled"), 1)).count() == 0
