"""Flight records as positional CSV (S2/S3) and their typed view.

Lines have at least 44 comma-separated fields, quoted with ``"`` and with
``""`` as an escaped quote inside a quoted field. Fields are read by
position as strings and typed afterwards, either strictly (a blank or
malformed number raises, as in the analysis jobs) or with the ingest rule
(a blank number reads as 0, a malformed one still raises).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfare.functions.predicates import in_year_month_window, not_flagged
from wayfare.functions.scalar import blank_zero, java_trim, strict_double, strict_int

N_FIELDS = 44

# Positions of the fields the jobs use.
FLIGHT_COLUMNS = {
    "year": 0,
    "month": 2,
    "flight_date": 5,
    "carrier": 6,
    "origin": 11,
    "dest": 17,
    "dep_time": 24,
    "arr_time": 35,
    "arr_delay_min": 37,
    "cancelled": 41,
    "diverted": 43,
}

# Options that make the CSV reader split like the record parser: a doubled
# quote is an escaped quote, and blanks around a quoted field are dropped.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",  # what may be malformed, the number of fields, is checked apart
}


#: Holds a line that has more or fewer fields than the layout.
ODD_LINE = "_odd_line"


def field_name(pos: int) -> str:
    for name, p in FLIGHT_COLUMNS.items():
        if p == pos:
            return name + "_raw"
    return f"f{pos:02d}"


def flight_csv_schema(n_fields: int = N_FIELDS) -> StructType:
    return StructType([StructField(field_name(i), StringType(), True) for i in range(n_fields)])


def read_flights_csv(spark: SparkSession, path: str, n_fields: int = N_FIELDS) -> DataFrame:
    """Positional string fields from CSV files (splittable, no inference);
    blank lines are skipped."""
    lines = spark.read.text(path)
    return parse_flight_lines(lines.where(F.trim("value") != ""), n_fields=n_fields)


def field_count(line: Column) -> Column:
    """Fields of a CSV line; commas inside quotes do not count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def parse_flight_lines(lines: DataFrame, value: str = "value", n_fields: int = N_FIELDS,
                       keep: list[str] | None = None) -> DataFrame:
    """Parse a column of CSV lines into positional string fields. Fields past
    ``n_fields`` are ignored; a line with fewer raises.

    The fields come out of a generator of one row a line, because filters are
    not pushed below it: pushed down, each of their references to a field
    would parse the line once more."""
    fields = flight_csv_schema(n_fields)
    marked = StructType([*fields.fields, StructField(ODD_LINE, StringType(), True)])
    parsed = F.from_csv(F.col(value), marked.simpleString(), CSV_OPTIONS | {"columnNameOfCorruptRecord": ODD_LINE})
    short = lambda line: F.raise_error(F.concat(F.lit(f"fewer than {n_fields} fields: "), line))
    if n_fields > 1:  # the parser does not mark a blank line
        parsed = F.when(java_trim(value) == "", short(F.col(value))).otherwise(parsed)
    rows = lines.select(*(keep or []), F.inline(F.array(parsed)))
    # it marks one with more or fewer fields; only there are they counted
    odd = F.col(ODD_LINE)
    return rows.where(F.when(odd.isNull(), True).when(field_count(odd) >= n_fields, True).otherwise(short(odd).cast("boolean"))).drop(ODD_LINE)


def _raw(name: str) -> Column:
    return F.col(name + "_raw")


def typed_flights(fields: DataFrame, mode: str = "strict", keep: list[str] | None = None) -> DataFrame:
    """Type the positional fields.

    ``strict``: trim then ANSI cast (blank/malformed raises); flags are read
    as doubles and truncated to int. ``ingest``: blank numbers read as 0.
    """
    if mode == "strict":
        as_int, as_double = strict_int, strict_double
    elif mode == "ingest":
        as_int = lambda c: blank_zero(c, "int")
        as_double = lambda c: blank_zero(c, "double")
    else:
        raise ValueError(f"unknown parse mode {mode!r}")
    return fields.select(
        *(keep or []),
        as_int(_raw("year")).alias("year"),
        as_int(_raw("month")).alias("month"),
        java_trim(_raw("flight_date")).alias("flight_date"),
        java_trim(_raw("carrier")).alias("carrier"),
        java_trim(_raw("origin")).alias("origin"),
        java_trim(_raw("dest")).alias("dest"),
        java_trim(_raw("dep_time")).alias("dep_time"),
        java_trim(_raw("arr_time")).alias("arr_time"),
        as_double(_raw("arr_delay_min")).alias("arr_delay_min"),
        as_double(_raw("cancelled")).cast("int").alias("cancelled"),
        as_double(_raw("diverted")).cast("int").alias("diverted"),
    )


def two_leg_flights(fields: DataFrame, legs: Column, window: tuple[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """Flights typed strictly, but only as far as the two-leg job reads them:
    the route (``legs``, over origin and dest) first, then the window, then
    the flags, then the delay. A number that is not reached is NULL, however
    malformed, so a header or a blank flag of another route does no harm.

    Each number is tried once, and a malformed one raises where it is reached.
    No guard is built on another guarded column, so the expressions, which
    the optimizer copies into the filters that follow, stay small enough to
    be compiled."""
    texts = ["flight_date", "carrier", "origin", "dest", "dep_time", "arr_time"]
    types = {"year": "int", "month": "int", "cancelled": "double", "diverted": "double", "arr_delay_min": "double"}
    tried = {c: java_trim(F.coalesce(_raw(c), F.lit(""))).try_cast(t) for c, t in types.items()}
    flags = {c: tried[c].try_cast("int") for c in ("cancelled", "diverted")}
    rows = fields.select(
        *[java_trim(_raw(c)).alias(c) for c in texts], *[_raw(c) for c in types],
        *[c.alias("try_" + name) for name, c in (tried | flags).items()])

    def reached(name: str, guard: Column) -> Column:
        bad = F.raise_error(F.concat(F.lit(f"no number in {name}: "), F.coalesce(_raw(name), F.lit(""))))
        return F.when(guard, F.coalesce(F.col("try_" + name), bad)).alias(name)

    (first, _), (last, _) = window
    inside = legs & in_year_month_window(*window, year="try_year", month="try_month")
    return rows.select(
        *texts, reached("year", legs), reached("month", legs & F.col("try_year").between(first, last)),
        reached("arr_delay_min", inside & not_flagged("try_cancelled", "try_diverted")),
        reached("cancelled", inside), reached("diverted", inside))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def flights_to_csv_lines(flights: DataFrame, extra: dict[int, Column] | None = None,
                         replace: dict[int, Column] | None = None) -> DataFrame:
    """Render typed flights as 44-field CSV lines (strings quoted).

    ``extra`` places further columns at unused positions (as text);
    ``replace`` substitutes the text of a used position.
    """
    by_pos: dict[int, Column] = {
        0: F.col("year").cast("string"),
        2: F.col("month").cast("string"),
        5: _quoted(F.col("flight_date").cast("string")),
        6: _quoted(F.col("carrier")),
        11: F.concat(F.lit(" "), _quoted(F.col("origin")), F.lit(" ")),
        17: _quoted(F.col("dest")),
        24: _quoted(F.col("dep_time")),
        35: _quoted(F.col("arr_time")),
        37: F.when(F.col("arr_delay_min").isNotNull(), F.format_string("%.2f", F.col("arr_delay_min"))),
        41: F.when(F.col("cancelled").cast("double").isNotNull(), F.format_string("%.2f", F.col("cancelled").cast("double"))),
        43: F.when(F.col("diverted").cast("double").isNotNull(), F.format_string("%.2f", F.col("diverted").cast("double"))),
    }
    for pos, c in (extra or {}).items():
        if pos in by_pos:
            raise ValueError(f"position {pos} is already used")
        by_pos[pos] = c
    by_pos.update(replace or {})
    # a NULL is an empty field; it must not shift those after it
    fields = [F.coalesce(by_pos.get(i, F.lit("")), F.lit("")) for i in range(N_FIELDS)]
    return flights.select(F.concat_ws(",", *fields).alias("value"))
