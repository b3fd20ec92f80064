"""Positional flight CSV: quoting, trimming, strict and ingest parsing."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)
from pyspark.sql import functions as F

from tests.helpers import flight, flights_df
from wayfare.functions import scalar as S
from wayfare.functions.predicates import leg1_exclusive, leg2_exclusive
from wayfare.operators import connections as C
from wayfare.sources.csv import (
    N_FIELDS,
    field_count,
    parse_flight_lines,
    read_flights_csv,
    two_leg_flights,
    typed_flights,
)


def _line(**fields):
    from wayfare.sources.csv import FLIGHT_COLUMNS

    parts = [""] * N_FIELDS
    for k, v in fields.items():
        parts[FLIGHT_COLUMNS[k]] = v
    return ",".join(parts)


def test_quoted_fields(spark):
    line = 'x,"a ""q"", b", "ORD" ,0.00'
    df = spark.createDataFrame([(line,)], "value string")
    r = parse_flight_lines(df, n_fields=4).collect()[0]
    assert (r.f01, r.month_raw, r.f03) == ('a "q", b', "ORD", "0.00")
    with pytest.raises(SPARK_ERRORS):  # too few fields for the flight layout
        parse_flight_lines(df).collect()


def test_java_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\t a b\u0001 ",)], "s string")
    assert df.select(S.java_trim("s").alias("t")).collect()[0].t == "a b"


def test_strict_and_ingest_parsing(spark):
    good = _line(year="2008", month=" 3", flight_date="2008-03-01", carrier="AA", origin="ORD",
                 dest="JFK", dep_time="0900", arr_time="1000", arr_delay_min="12.5",
                 cancelled="0.00", diverted="1.00")
    df = spark.createDataFrame([(good,)], "value string")
    r = typed_flights(parse_flight_lines(df)).collect()[0]
    assert (r.year, r.month, r.arr_delay_min, r.cancelled, r.diverted) == (2008, 3, 12.5, 0, 1)

    blank = good.replace("12.5", "")
    bdf = spark.createDataFrame([(blank,)], "value string")
    assert typed_flights(parse_flight_lines(bdf), mode="ingest").collect()[0].arr_delay_min == 0.0
    with pytest.raises(SPARK_ERRORS):
        typed_flights(parse_flight_lines(bdf), mode="strict").collect()

    bad = good.replace("12.5", "x")
    xdf = spark.createDataFrame([(bad,)], "value string")
    for mode in ("strict", "ingest"):
        with pytest.raises(SPARK_ERRORS):
            typed_flights(parse_flight_lines(xdf), mode=mode).collect()


def test_strict_int_rejects_decimal_text(spark):
    df = spark.createDataFrame([("5.0",)], "s string")
    with pytest.raises(SPARK_ERRORS):
        df.select(S.strict_int("s")).collect()


def test_truncation_and_ceiling(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,)], "d double")
    got = [tuple(r) for r in df.select(S.trunc_int("d"), S.ceil_int("d")).collect()]
    assert got == [(1, 2), (-1, -1)]


def test_read_csv_files(spark, tmp_path):
    p = tmp_path / "flights.csv"
    p.write_text(_line(year="2007", month="7", flight_date="2007-07-01", carrier='"9E"',
                       origin="ORD", dest="LAX", dep_time="0800", arr_time="0930",
                       arr_delay_min="3.00", cancelled="0.00", diverted="0.00") + "\n")
    r = typed_flights(read_flights_csv(spark, str(p))).collect()[0]
    assert (r.year, r.carrier, r.arr_time, r.arr_delay_min) == (2007, "9E", "0930", 3.0)


def test_bit_packing_round_trip(spark):
    df = spark.createDataFrame([(1, 0, 40000, 19), (1, 1, -5, 3)], "y int, c int, d int, i int")
    r = df.select(S.pack_bits("y", "c", 1).alias("cond"), S.pack_bits("d", "i", 8).alias("cell"))
    out = r.select("cond", S.unpack_high("cell", 8).alias("d"), S.unpack_low("cell", 8).alias("i")).collect()
    assert [tuple(x) for x in out] == [(2, 40000, 19), (3, -5, 3)]


def test_null_fields_keep_their_place(spark):
    from wayfare.sources.csv import flights_to_csv_lines

    row = flight(1, "ORD", "JFK", carrier=None)
    df = flights_df(spark, [row]).withColumn("arr_delay_min", F.lit(None).cast("double"))
    line = flights_to_csv_lines(df).first().value
    fields = line.split(",")
    assert len(fields) == 44 and fields[6] == "" and fields[37] == ""


_LEG = dict(year="2007", month="7", flight_date="2007-07-01", carrier="AA", dep_time="0900", arr_time="1000",
            arr_delay_min="5.90", cancelled="0.00", diverted="0.00")


def test_wide_lines_are_read_and_short_ones_raise(spark, tmp_path):
    line = _line(**_LEG, origin='"ORD"', dest="LAX")
    wide = line + ',"a, b",x' + "," * 60
    (tmp_path / "wide.csv").write_text(f"{wide}\n\n{line}\n")
    rows = typed_flights(read_flights_csv(spark, str(tmp_path / "wide.csv"))).collect()
    assert [(r.origin, r.arr_delay_min, r.diverted) for r in rows] == [("ORD", 5.9, 0)] * 2
    short = spark.createDataFrame([(line.rsplit(",", 1)[0],)], "value string")
    with pytest.raises(SPARK_ERRORS):  # also where no missing field is asked for
        parse_flight_lines(short).select("origin_raw").collect()


def test_commas_in_quotes_are_no_fields(spark):
    df = spark.createDataFrame([('a,"b,c ""d,e""",f',), ("",), (None,)], "value string")
    assert [r.n for r in df.select(field_count(F.col("value")).alias("n")).collect()] == [3, 1, None]


def test_two_leg_job_parses_only_what_it_reaches(spark, tmp_path):
    lines = [
        _line(year="Year", month="Month", origin="Origin", dest="Dest", cancelled="Cancelled"),  # a header
        _line(**_LEG | {"cancelled": ""}, origin="SEA", dest="ATL"),  # another route
        _line(**_LEG | {"year": "2006", "month": "x"}, origin="ORD", dest="LAX"),  # another year
        _line(**_LEG | {"cancelled": "1.00", "arr_delay_min": ""}, origin="ORD", dest="LAX"),  # not flown
        _line(**_LEG, origin="ORD", dest="LAX"),
        _line(**_LEG | {"dep_time": "1001", "arr_delay_min": "7.90"}, origin="LAX", dest="JFK"),
    ]

    def totals(some):
        fields = parse_flight_lines(spark.createDataFrame([(x,) for x in some], "value string"))
        legs = leg1_exclusive("ORD", "JFK") | leg2_exclusive("ORD", "JFK")
        return C.totals_running(C.time_buckets(C.tag_legs(two_leg_flights(fields, legs, C.WINDOW)))).collect()[0]

    assert tuple(totals(lines)) == (1, 12, 12.0)
    with pytest.raises(SPARK_ERRORS):  # a delay that is read must be a number
        totals(lines + [_line(**_LEG | {"arr_delay_min": ""}, origin="ORD", dest="LAX")])


@pytest.mark.parametrize("name", ["two_leg_running_csv", "monthly_delay_text_csv", "csv_flights_files"])
def test_lines_are_parsed_once(spark, name):
    """No filter that follows parses a line again for a field it reads."""
    import __spark_entry__ as E
    from tests.conftest import SF001

    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_wide_lines_pass_and_short_ones_raise(spark):
    df = lambda *lines: spark.createDataFrame([(x,) for x in lines], "value string")
    rows = parse_flight_lines(df('1,"a,b",3,4,5,6', "1,2,3,", '"x\ny",,,'), n_fields=4).collect()
    assert [tuple(r) for r in rows] == [("1", "a,b", "3", "4"), ("1", "2", "3", None), ("x\ny", None, None, None)]
    for bad in ("1,2,3", '1,"2,3",4', "", " \t "):
        with pytest.raises(SPARK_ERRORS):
            parse_flight_lines(df(bad), n_fields=4).collect()


def test_exported_files_are_compressed_and_cut(spark, monkeypatch):
    import os

    from tests.conftest import SF001
    from wayfare.plans import jobs

    monkeypatch.setattr(jobs, "CSV_LINES", 900)
    path = jobs.flight_csv_files(spark, SF001, rebuild=True).removeprefix("file:")
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    lines = [spark.read.text(f).agg(F.count("value"), F.sum(F.length("value") + 1)).first() for f in files]
    assert sum(n for n, _ in lines) == 6000 and max(n for n, _ in lines) <= 900  # a compressed file is read by one task
    assert sum(os.path.getsize(f) for f in files) < 0.5 * sum(size for _, size in lines)
