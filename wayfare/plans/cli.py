"""Command-line jobs over real input files, writing result files.

    python -m wayfare wordcount <text path> <out dir>   [--letters mnopq] [--reducers N]
    python -m wayfare twoleg    <csv path>  <out dir>   [--origin ORD --dest JFK]
    python -m wayfare monthly   <csv path>  <out dir>   [--year 2008]
    python -m wayfare populate  <csv path>  <table dir>
    python -m wayfare compute   <table dir> <out dir>   [--year 2008] [--range]

``monthly`` and ``compute`` accept ``--named-parts`` to write
``average_delay_NNNNN`` files directly into the output directory.

Each job is one Spark lineage; an existing output directory is an error
unless ``--overwrite`` is given. ``populate`` merges into an existing table,
and replaces it with ``--overwrite``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.predicates import DEFAULT_LETTERS, leg1_exclusive, leg2_exclusive
from wayfare.operators import connections as C
from wayfare.operators import keyed as K
from wayfare.operators import monthly as M
from wayfare.operators import words as W
from wayfare.operators.merge import merge_load, with_record
from wayfare.sinks import (
    versions,
    write_average_delay,
    write_key_value_text,
    write_named_parts,
    write_single_row,
)
from wayfare.sources.csv import read_flights_csv, two_leg_flights, typed_flights
from wayfare.sources.text import read_lines


def word_count_job(spark: SparkSession, src: str, out: str, letters: str = DEFAULT_LETTERS,
                   reducers: int | None = None, mode: str = "errorifexists") -> None:
    """Q1: ``word<TAB>n`` part files, each sorted by word; ``reducers`` routes
    the words by initial to that many ``part=<k>`` folders."""
    counts = W.word_count(W.letter_tokens(read_lines(spark, src), text_col="value", letters=letters))
    if reducers:
        write_key_value_text(W.route_by_initial(counts, reducers, letters), out, "word", "n", mode=mode, route="part")
    else:
        write_key_value_text(counts, out, "word", "n", mode=mode)


def _strict_flights(spark: SparkSession, src: str) -> DataFrame:
    return typed_flights(read_flights_csv(spark, src), mode="strict")


def two_leg_job(spark: SparkSession, src: str, out: str, origin: str = C.ORIGIN,
                dest: str = C.DEST, mode: str = "errorifexists") -> DataFrame:
    """Q2: one line ``n_pairs<TAB>sum_delay<TAB>avg_delay``; the sum is
    written as a double (``2.3651106E7`` style), as the original result file
    has it."""
    legs = leg1_exclusive(origin, dest) | leg2_exclusive(origin, dest)
    flights = two_leg_flights(read_flights_csv(spark, src), legs, C.WINDOW)
    tagged = C.tag_legs(flights, origin=origin, dest=dest)
    totals = C.totals_running(C.time_buckets(tagged))
    line = totals.select("n_pairs", F.col("sum_delay").cast("double").alias("sum_delay"), "avg_delay")
    write_single_row(line, out, mode=mode)
    return totals


def _write_report(text: DataFrame, out: str, mode: str, named_parts: bool) -> str:
    if named_parts:  # average_delay_NNNNN files directly in ``out``
        write_named_parts(text, out, "average_delay_", overwrite=mode == "overwrite")
        return out
    return write_average_delay(text, out, mode=mode)


def monthly_job(spark: SparkSession, src: str, out: str, year: int = M.TARGET_YEAR,
                mode: str = "errorifexists", named_parts: bool = False) -> str:
    """Q3 flat-file form: CRLF lines per carrier in ``<out>/average_delay``
    (or ``average_delay_NNNNN`` files in ``out`` with ``named_parts``)."""
    long = M.monthly_delay(M.monthly_input(_strict_flights(spark, src), year=year))
    return _write_report(M.monthly_text(M.monthly_vector(long)), out, mode, named_parts)


#: What a flight is known by when a file is loaded again; its delay and flags may change.
SCHEDULE = ["flight_date", "carrier", "origin", "dest", "dep_time", "arr_time"]


def populate_job(spark: SparkSession, src: str, table: str, fresh: bool = False) -> int:
    """Q4 ingest: blank numbers read as 0, unknown carriers rejected. A load
    is merged into an existing table (K7): flights that are there are written
    over, so loading a file twice changes nothing. Plain CSV has no record
    number; the hash of the schedule stands for it in the row key. ``fresh``
    replaces the table. Returns its version."""
    fl = typed_flights(read_flights_csv(spark, src), mode="ingest").select(
        "*", F.pmod(F.xxhash64(*SCHEDULE), F.lit(1 << 55)).alias("l_orderkey"), F.lit(0).alias("l_linenumber"))
    rows = K.keyed_rows(fl, spark, extra=[c for c in SCHEDULE if c != "carrier"])
    keyed = with_record(rows, SCHEDULE, ["cancelled", "delay"]).drop(*[c for c in SCHEDULE if c != "carrier"])
    return merge_load(spark, table, keyed, fresh)


def compute_job(spark: SparkSession, table: str, out: str, year: int = M.TARGET_YEAR,
                by_range: bool = False, mode: str = "errorifexists",
                named_parts: bool = False) -> str:
    """Q3 over the keyed table: predicate scan (default) or key-range scan."""
    keyed = versions.read(spark, table)
    if by_range:
        t = K.scan_key_range(spark, keyed, {"year": year, "cancelled": 0, "month": 1},
                             {"year": year, "cancelled": 0, "month": 13})
    else:
        t = K.scan_predicate(spark, keyed, year, 0).where(F.col("month").between(1, 12))
    rows = t.select("carrier", "month", F.col("delay").cast("double").alias("delay"))
    return _write_report(M.monthly_text(M.monthly_vector(M.monthly_delay(rows))), out, mode,
                         named_parts)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="wayfare")
    ap.add_argument("job", choices=["wordcount", "twoleg", "monthly", "populate", "compute"])
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--letters", default=DEFAULT_LETTERS)
    ap.add_argument("--reducers", type=int, default=None)
    ap.add_argument("--origin", default=C.ORIGIN)
    ap.add_argument("--dest", default=C.DEST)
    ap.add_argument("--year", type=int, default=M.TARGET_YEAR)
    ap.add_argument("--range", action="store_true", help="compute: scan by key range")
    ap.add_argument("--overwrite", action="store_true")
    ap.add_argument("--named-parts", action="store_true",
                    help="monthly/compute: write average_delay_NNNNN files into the output dir")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"wayfare-{args.job}").getOrCreate()
    mode = "overwrite" if args.overwrite else "errorifexists"
    if args.job == "wordcount":
        word_count_job(spark, args.input, args.output, args.letters, args.reducers, mode)
    elif args.job == "twoleg":
        two_leg_job(spark, args.input, args.output, args.origin, args.dest, mode)
    elif args.job == "monthly":
        monthly_job(spark, args.input, args.output, args.year, mode, args.named_parts)
    elif args.job == "populate":
        populate_job(spark, args.input, args.output, fresh=args.overwrite)
    else:
        compute_job(spark, args.input, args.output, args.year, args.range, mode, args.named_parts)
