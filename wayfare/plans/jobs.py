"""The four jobs as end-to-end DataFrame lineages over the driver tables.

Every function takes (spark, sf_dir) and returns a DataFrame over the whole
input tables; nothing is sampled, capped or filtered to a subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.functions.scalar import tab_fields
from wayfare.functions.predicates import in_year_month_window, leg1_exclusive, leg2_exclusive
from wayfare.operators import connections as C
from wayfare.operators import keyed as K
from wayfare.operators import layout as L
from wayfare.operators import monthly as M
from wayfare.operators import words as W
from wayfare.operators.merge import merge_load, with_record
from wayfare.session import input_token, shared_dir, table_path, written
from wayfare.sinks import (
    dump,
    versions,
    write_average_delay,
    write_key_value_text,
    write_routed,
    write_single_row,
)
from wayfare.sources.csv import (
    flights_to_csv_lines,
    parse_flight_lines,
    read_flights_csv,
    two_leg_flights,
    typed_flights,
)
from wayfare.sources.text import document_lines, read_lines, read_tab_parts
from wayfare.sources.flights import FLIGHTS_SQL, LINEITEM_COLUMNS, flights, rough_flights
from wayfare.sources.tables import read_table

WORD_PARTITIONS = 3
CARRIER_PARTITIONS = 4
# Columns of lineitem that order duplicate (order, line) records totally.
WRITE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


# ---------------------------------------------------------------- inputs
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS))


def rough_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rough_flights(spark, flight_rows(spark, sf_dir))


def _letter_tokens(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return W.letter_tokens(documents(spark, sf_dir), keep=keep)


# ------------------------------------------------------------ Q1: words
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_count(_letter_tokens(spark, sf_dir))


def doc_term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.doc_term_frequency(_letter_tokens(spark, sf_dir, keep=["doc_id"]))


def word_count_from_doc_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.roll_up_term_frequency(doc_term_frequency(spark, sf_dir))


def word_count_partition_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_count_native_tally(_letter_tokens(spark, sf_dir))


def word_partition_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the route of every counted word."""
    return W.route_by_initial(word_count(spark, sf_dir), WORD_PARTITIONS)


def letter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.letter_totals(word_count(spark, sf_dir))


def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + O3 + O6, then S4: the counts as ``word<TAB>n`` lines in a folder
    for each route, read again."""
    out = shared_dir(spark, "results", "word_count", unique=True)
    routed = word_partition_assignment(spark, sf_dir)
    write_key_value_text(routed, out, "word", "n", route="part")
    lines = spark.read.text(out).select(tab_fields("value").alias("f"), F.col("part").cast("int").alias("part"))
    return lines.select(F.get("f", 0).alias("word"), F.get("f", 1).cast("bigint").alias("n"), "part")


# ---------------------------------------------------- Q2: connections
def _buckets(spark: SparkSession, sf_dir: str, rows=flight_rows, **tag_args) -> DataFrame:
    extra = tag_args.pop("extra_keys", None)
    tagged = C.tag_legs(rows(spark, sf_dir), keep=extra, **tag_args)
    return C.time_buckets(tagged, extra)


def two_leg_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A4 + A5 (join of pre-aggregated time buckets)."""
    return C.totals_join(_buckets(spark, sf_dir))


def two_leg_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + A4 + A5 (running sums, no join)."""
    return C.totals_running(_buckets(spark, sf_dir))


def two_leg_band_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 then J1 + A4 + A5."""
    return C.totals_join(C.band_prune(_buckets(spark, sf_dir)))


#: Most (date, transit) groups whose bounds are broadcast: under 100 MB.
BOUND_GROUPS = 1 << 20


def two_leg_bounds_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 before the shuffle, then J1 + A4 + A5: the bounds of each group are
    made first and applied where the legs are read; with more groups than
    ``BOUND_GROUPS``, rows are pruned after the shuffle instead."""
    tagged = C.tag_legs(flight_rows(spark, sf_dir))
    bounds = written(C.leg_bounds(tagged), "leg_bounds")
    if bounds.count() > BOUND_GROUPS:
        return C.totals_join(C.band_prune(C.time_buckets(tagged)))
    return C.totals_join(C.time_buckets(C.prune_by_bounds(tagged, bounds)))


def two_leg_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs: the first writes A4's partial rows as tab-separated part
    files, the second reads them again (S4) and merges them (A5)."""
    out = shared_dir(spark, "chain", "partials", unique=True)
    C.partial_totals(_buckets(spark, sf_dir)).select("n_pairs", "sum_delay").write.option("sep", "\t").csv(out)
    return C.merge_partials(read_tab_parts(spark, out, "n_pairs bigint, sum_delay bigint"))


def _stored_legs(spark: SparkSession, sf_dir: str, **tag_args) -> tuple[DataFrame, DataFrame]:
    """The legs, numbered and stored, so that the input is read once for both
    sides of their join, and the sizes of their groups."""
    tagged = C.tag_legs(flight_rows(spark, sf_dir), **tag_args)
    legs = written(tagged.withColumn(C.LEG_ID, F.monotonically_increasing_id()), "legs")
    return legs, written(C.leg_counts(legs), "leg_counts")


def two_leg_flattened_2007(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined relation of the accepted legs, with every column of
    both, and the number of flight pairs of each row; a filter on the left
    leg's year, as text cast to a number, follows the join."""
    legs, counts = _stored_legs(spark, sf_dir, window=None, rule="accept", exact=True, keep=["year", "month"])
    # a number of its leg, made before the join and not for each joined row
    tagged = legs.withColumn("delay", F.col("d").cast("double"))
    joined = C.joined_counts(tagged, carry=["year", "month", "delay"], counts=counts)
    flat = joined.select(*[c for c in joined.columns if c not in ("d1", "d2", "delay1", "delay2")], "delay1", "delay2")
    return flat.where(F.col("year1").cast("string").cast("int") == 2007)


def two_leg_result_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + O7: the totals as one line of one file, read again."""
    out = shared_dir(spark, "results", "two_leg", unique=True)
    write_single_row(two_leg_running(spark, sf_dir), out)
    return read_tab_parts(spark, out, "n_pairs bigint, sum_delay bigint, avg_delay double")


def _join_first(spark: SparkSession, sf_dir: str, both: bool) -> DataFrame:
    """P11 legs without a date window, J2 join, J3 time filter and the window
    applied to the joined rows: P8 (left) over the loose legs P6, P9 (both)
    over the exclusive legs P5. Catalyst pushes the window below the join."""
    b = _buckets(spark, sf_dir, window=None, rule="accept", loose=not both,
                 extra_keys=["year", "month"])
    joined = C.bucket_join(b, extra=["year", "month"])
    cond = in_year_month_window(*C.WINDOW, year="year1", month="month1")
    if both:
        cond = cond & in_year_month_window(*C.WINDOW, year="year2", month="month2")
    return C.joined_totals(joined.where(cond))


def two_leg_join_first_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _join_first(spark, sf_dir, both=False)


def two_leg_join_first_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _join_first(spark, sf_dir, both=True)


def two_leg_union_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + A6 with the accept rule (filter-first form)."""
    return C.union_average(C.bucket_join(_buckets(spark, sf_dir, rule="accept", exact=True)))


def two_leg_join_first_avg(spark: SparkSession, sf_dir: str, rows=flight_rows) -> DataFrame:
    """U1 + A6 over the loose legs P6 with the left window P8."""
    b = _buckets(spark, sf_dir, rows, window=None, rule="accept", loose=True, exact=True,
                 extra_keys=["year", "month"])
    joined = C.bucket_join(b, extra=["year", "month"])
    return C.union_average(joined.where(in_year_month_window(*C.WINDOW, year="year1", month="month1")))


def two_leg_running_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + A4 + A5 over delays that are NULL or not whole, a flag of 2 and a month of 0."""
    return C.totals_running(_buckets(spark, sf_dir, rough_rows))


def two_leg_union_avg_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + A6 over delays that are NULL or not whole and a flag of 2."""
    return C.union_average(C.bucket_join(_buckets(spark, sf_dir, rough_rows, rule="accept", exact=True)))


def two_leg_join_first_avg_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_leg_join_first_avg(spark, sf_dir, rough_rows)


def monthly_delay_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 over delays that are NULL or not whole, a flag of 2 and a month of 0."""
    return M.monthly_delay(M.monthly_input(rough_rows(spark, sf_dir)))


def two_leg_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 pairs themselves (filter-first legs)."""
    legs, counts = _stored_legs(spark, sf_dir, keep=["l_orderkey", "l_linenumber"])
    return C.pairs(legs, carry=["l_orderkey", "l_linenumber"], counts=counts, packed=True)


def two_leg_year_2007_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened join rows (accept rule, no window) whose left leg
    is in 2007; the year filter is applied after the join."""
    legs, counts = _stored_legs(spark, sf_dir, window=None, rule="accept", keep=["year", "month"])
    joined = C.pairs(legs, carry=["year", "month"], counts=counts)
    return joined.where(F.col("a_year") == 2007)


# ------------------------------------------------------- Q3: monthly
def monthly_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.monthly_delay(M.monthly_input(flight_rows(spark, sf_dir)))


def monthly_delay_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.monthly_vector(monthly_delay(spark, sf_dir))


def monthly_delay_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.monthly_text(monthly_delay_vector(spark, sf_dir))


def monthly_delay_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.ordered_by_month(monthly_delay(spark, sf_dir))


def monthly_delay_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O4 + O6: the carrier-months written in files by route, sorted by
    carrier and month, and the order read off the files: ``place`` counts the
    rows of a carrier by their position in its file, and ``in_order`` says
    that the row before, in the same file, does not come after."""
    out = shared_dir(spark, "results", "monthly", unique=True)
    indexed = K.carrier_to_index(monthly_delay(spark, sf_dir), spark, strict=False)
    routed = L.route_by_index(indexed, F.col("carrier_idx"), CARRIER_PARTITIONS)
    write_routed(routed, out, "part", ["carrier", "month"])
    rows = spark.read.parquet(out).select(
        "part", "carrier", "month", "avg_delay", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("position"))
    at = Window.partitionBy("file").orderBy("position")
    own = Window.partitionBy("file", "carrier").orderBy("position")
    key = F.struct("carrier", "month")
    return rows.select(
        F.col("part").cast("int").alias("part"), "carrier", "month", "avg_delay", F.row_number().over(own).alias("place"),
        F.coalesce(F.lag(key).over(at) <= key, F.lit(True)).alias("in_order"))


def monthly_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K4 + K5, then S1: the report as CRLF lines in ``average_delay``,
    read again."""
    out = write_average_delay(monthly_delay_text(spark, sf_dir), shared_dir(spark, "results", "report", unique=True),
                              mode="errorifexists")
    return read_lines(spark, out).select(F.substring("value", 1, 2).alias("carrier"), F.col("value").alias("line"))


def monthly_dump_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, then S1: every row of the vector as a parenthesised line."""
    out = shared_dir(spark, "results", "dump", unique=True)
    dump(monthly_delay_vector(spark, sf_dir), out)
    return read_lines(spark, out).withColumnRenamed("value", "line")


def monthly_delay_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10 + K11: a table written, an attempt to create it again, which is an
    error and leaves it alone, and its replacement by the monthly means."""
    root = shared_dir(spark, "results", "replaced", unique=True)
    long = monthly_delay(spark, sf_dir)
    versions.replace(long.where("month <= 6"), root, "errorifexists")
    try:
        versions.replace(long.limit(0), root, "errorifexists")
        raise AssertionError("an existing table was created again")
    except FileExistsError:
        versions.replace(long, root)
    return versions.read(spark, root)


def carrier_partition_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    carriers = monthly_delay_vector(spark, sf_dir).select("carrier")
    indexed = K.carrier_to_index(carriers, spark, strict=False)
    return L.route_by_index(indexed, F.col("carrier_idx"), CARRIER_PARTITIONS).select(
        "carrier", "carrier_idx", "part")


# ------------------------------------------------------ Q4: keyed table
def keyed_populate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = K.keyed_rows(flight_rows(spark, sf_dir), spark)
    return rows.withColumn("rowkey", F.hex("rowkey"))


def keyed_upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS + ["l_extendedprice"])
    fl = flights(spark, li, extra=WRITE_ORDER)
    rows = K.keyed_rows(fl, spark, extra=WRITE_ORDER)
    last = K.upsert_last(rows, ["l_orderkey", "l_linenumber"], WRITE_ORDER)
    return last.drop(*WRITE_ORDER).withColumn("rowkey", F.hex("rowkey"))


RECORD = ["l_orderkey", "l_linenumber"]


def _second_load(rows: DataFrame) -> DataFrame:
    """Of some orders again all records: a half as they were, a half late by
    another 7 minutes, of these a third with the flag turned, which moves them
    to another partition; and new records under new orders."""
    again = rows.where("l_orderkey % 3 = 0")
    late = F.col("l_orderkey") % 2 == 0
    turned = late & (F.col("l_linenumber") % 3 == 0)
    changed = again.withColumns({
        "arr_delay_min": F.when(late, F.col("arr_delay_min") + 7).otherwise(F.col("arr_delay_min")),
        "cancelled": F.when(turned, 1 - F.col("cancelled")).otherwise(F.col("cancelled"))})
    return changed.unionByName(rows.where("l_orderkey % 50 = 7").withColumn("l_orderkey", F.col("l_orderkey") + 10**9))


def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: a load into a new table, then one into the existing table that
    repeats, changes, moves and adds records; the last write of each stays."""
    root = shared_dir(spark, "tables", "merged", unique=True)
    li = read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS + ["l_extendedprice"])
    first = flights(spark, li, extra=WRITE_ORDER)
    derived = {c: F.col(f"record.{c}") for c in RECORD} | K.derived_columns()
    for load in (first, _second_load(first)):
        # equal records are interchangeable only if what they say is equal too;
        # the order's columns are not stored
        named = with_record(load, RECORD, WRITE_ORDER + ["arr_delay_min"], exact=True)
        merge_load(spark, root, K.keyed_rows(named, spark, extra=["record"]), derived=derived)
    return versions.read(spark, root).drop("record").withColumn("rowkey", F.hex("rowkey"))


SPLIT_RANGES = 20


def _split_key(month: int) -> bytes:
    return K.literal_key({"month": month}, K.SPLIT_KEY_PARTS)


def split_table(spark: SparkSession, sf_dir: str) -> str:
    """K9: the keyed rows under a key led by the month, in 20 ranges split
    evenly from month 2 to month 12."""
    def write(path: str) -> None:
        rows = K.keyed_rows(flight_rows(spark, sf_dir), spark)
        rows = rows.withColumn("rowkey", K.row_key(K.SPLIT_KEY_PARTS))
        K.write_split_table(rows, path, K.even_splits(_split_key(2), _split_key(12), SPLIT_RANGES))

    return _derived(spark, sf_dir, "lineitem", "flights_split", f"split-v1 {FLIGHTS_SQL}", write)


def keyed_split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: how many rows each range has, and their first and last month."""
    t = spark.read.parquet(split_table(spark, sf_dir))
    return t.groupBy(F.col("range").cast("int").alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def keyed_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 over the split table: the files that may have months 3 to 5, then
    the monthly means of the target year out of them."""
    t = K.scan_split_range(spark, split_table(spark, sf_dir), _split_key(3), _split_key(6))
    kept = t.where((F.col("year") == M.TARGET_YEAR) & (F.col("cancelled") == 0))
    return M.monthly_delay(kept.select("carrier", "month", F.col("delay").cast("double").alias("delay")))


def keyed_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a catalog table created if absent, filled by name, created again,
    which keeps it and its rows, and read by name."""
    rows = K.keyed_rows(flight_rows(spark, sf_dir), spark)
    path = shared_dir(spark, "tables", "catalog", unique=True)
    name = "wayfare_" + path.rsplit("-", 1)[1]
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    if not K.create_table_if_absent(spark, name, path, schema):
        raise AssertionError(f"{name} was there before")
    K.append_by_name(rows, name)
    if K.create_table_if_absent(spark, name, path, schema):
        raise AssertionError(f"{name} was created twice")
    t = spark.table(name).where((F.col("year") == M.TARGET_YEAR) & (F.col("cancelled") == 0))
    kept = t.where(F.col("month").between(1, 12))
    return M.monthly_delay(kept.select("carrier", "month", F.col("delay").cast("double").alias("delay")))


def _derived(spark: SparkSession, sf_dir: str, source: str, name: str, version: str,
             write, rebuild: bool = False) -> str:
    """Path of a table derived from ``source`` under the shared checkpoint
    folder, written by ``write(path)`` unless one made from the same input
    files by the same ``version`` exists (create if absent; of two concurrent
    first writers the faster one's table is used). ``rebuild`` writes a fresh
    copy to a path of its own (for timing the job)."""
    token = input_token(spark, [table_path(sf_dir, source)], salt=version)
    if rebuild:
        fresh = shared_dir(spark, "tables", f"{name}_{token}_rebuild", unique=True)
        write(fresh)
        return fresh
    return versions.publish(spark, shared_dir(spark, "tables", f"{name}_{token}"), write, "ignore")


def keyed_table(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Populate the keyed flights table (K7-K9) for ``sf_dir`` and return its
    path; an existing committed copy for the same input is reused (K8)."""
    return _derived(spark, sf_dir, "lineitem", "flights_keyed", f"{K.LAYOUT_VERSION} {FLIGHTS_SQL}",
                    lambda p: K.write_keyed_table(K.keyed_rows(flight_rows(spark, sf_dir), spark), p),
                    rebuild)


def keyed_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition-pruned scan, then the monthly aggregate."""
    t = K.scan_predicate(spark, keyed_table(spark, sf_dir), year=M.TARGET_YEAR, cancelled=0)
    rows = t.where(F.col("month").between(1, 12)).select(
        "carrier", "month", F.col("delay").cast("double").alias("delay"))
    return M.monthly_delay(rows)


def keyed_scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-range scan; month and carrier decoded from the key bytes."""
    y = M.TARGET_YEAR
    t = K.scan_key_range(spark, keyed_table(spark, sf_dir),
                         start={"year": y, "cancelled": 0, "month": 1},
                         stop={"year": y, "cancelled": 0, "month": 13})
    dec = K.decode_key(t.select("rowkey", "delay"))
    rows = K.index_to_carrier(dec.withColumnRenamed("key_carrier_idx", "carrier_idx"), spark)
    rows = rows.select("carrier", F.col("key_month").alias("month"),
                       F.col("delay").cast("double").alias("delay"))
    return M.monthly_delay(rows)


def keyed_scan_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value predicate on the packed condition (2 = 2008, not
    cancelled), delay and carrier decoded from the packed cell."""
    cond = (M.TARGET_YEAR - K.BASE_YEAR) << 1
    t = K.scan_packed(spark, keyed_table(spark, sf_dir), cond)
    rows = K.index_to_carrier(t.where(F.col("month").between(1, 12)), spark)
    return M.monthly_delay(rows.select("carrier", "month",
                                       F.col("delay").cast("double").alias("delay")))


# --------------------------------------------------- S2: CSV round trip
FLIGHT_OUTPUT = ["l_orderkey", "l_linenumber", "year", "month", "flight_date", "carrier",
                 "carrier_idx", "origin", "dest", "dep_time", "arr_time", "arr_delay_min",
                 "cancelled", "diverted"]


def _as_flights(typed: DataFrame, spark: SparkSession) -> DataFrame:
    """Parsed flights in the derived relation's shape (carrier index by J6)."""
    return K.carrier_to_index(typed, spark).select(*FLIGHT_OUTPUT)


def csv_flights_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render flights as 44-field quoted CSV lines (diverted left blank when
    0), parse them back positionally and type them with the ingest rule."""
    fl = flight_rows(spark, sf_dir)
    lines = flights_to_csv_lines(
        fl.withColumn("diverted_txt", F.when(F.col("diverted") == 0, F.lit(""))
                      .otherwise(F.format_string("%.2f", F.col("diverted").cast("double")))),
        extra={
            1: F.lit('"note, with ""quotes"""'),
            3: F.col("l_linenumber").cast("string"),
            8: F.col("l_orderkey").cast("string"),
        },
        replace={43: F.col("diverted_txt")},
    )
    fields = parse_flight_lines(lines)
    typed = typed_flights(fields, mode="ingest", keep=[
        F.col("f08").cast("bigint").alias("l_orderkey"),
        F.col("f03").cast("int").alias("l_linenumber")])
    typed = typed.withColumn("flight_date", F.col("flight_date").cast("date"))
    return _as_flights(typed, spark)


# ------------------------------------------ S1 / S2 over real text files
def document_text_files(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Export the documents as plain text files (one line per text line)."""
    return _derived(spark, sf_dir, "documents", "documents_text", "lines-v1",
                    lambda p: document_lines(documents(spark, sf_dir)).select("value")
                    .write.mode("overwrite").text(p), rebuild)


#: Lines of an exported CSV file, which is compressed and so read by one task: about 100 MB of text.
CSV_LINES = 1_000_000


def flight_csv_files(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Export the flights as 44-field quoted CSV files, compressed (lz4: a third of the text in no more time)."""
    def write(p: str) -> None:
        fl = flight_rows(spark, sf_dir)
        lines = flights_to_csv_lines(fl, extra={
            3: F.col("l_linenumber").cast("string"), 8: F.col("l_orderkey").cast("string")})
        lines.write.mode("overwrite").option("maxRecordsPerFile", CSV_LINES).text(p, compression="lz4")

    return _derived(spark, sf_dir, "lineitem", "flights_csv", f"csv-v2 {FLIGHTS_SQL}", write, rebuild)


def word_count_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1 + P2 + A1 over text files read line by line."""
    lines = read_lines(spark, document_text_files(spark, sf_dir))
    return W.word_count(W.letter_tokens(lines, text_col="value"))


def _csv_flights(spark: SparkSession, sf_dir: str, keep: list | None = None) -> DataFrame:
    """Flights parsed from the CSV files with the strict rules."""
    fields = read_flights_csv(spark, flight_csv_files(spark, sf_dir))
    return typed_flights(fields, mode="strict", keep=keep)


def csv_flights_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over CSV files: positional fields, strict typing."""
    typed = _csv_flights(spark, sf_dir, keep=[
        F.col("f08").cast("bigint").alias("l_orderkey"),
        F.col("f03").cast("int").alias("l_linenumber")])
    typed = typed.withColumn("flight_date", F.col("flight_date").cast("date"))
    return _as_flights(typed, spark)


def two_leg_running_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 end to end from flight CSV files (dates compared as text)."""
    fields = read_flights_csv(spark, flight_csv_files(spark, sf_dir))
    legs = leg1_exclusive(C.ORIGIN, C.DEST) | leg2_exclusive(C.ORIGIN, C.DEST)
    return C.totals_running(C.time_buckets(C.tag_legs(two_leg_flights(fields, legs, C.WINDOW))))


def monthly_delay_text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 flat-file job end to end: CSV files -> monthly means -> text lines."""
    long = M.monthly_delay(M.monthly_input(_csv_flights(spark, sf_dir)))
    return M.monthly_text(M.monthly_vector(long))
