"""The ``flights`` relation derived from ``lineitem``.

The driver ships TPC-H-style tables, not on-time flight records, so the
flight jobs run over a deterministic relation computed from ``lineitem``.
The same SQL text runs on Spark (over the DataFrame passed in) and on the
DuckDB oracle (over the registered ``lineitem`` view), so both engines see
identical input rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators.keyed import CARRIER_CODES

CARRIERS = ",".join(CARRIER_CODES)
# The five airports.
AIRPORTS = "ORD,JFK,LAX,ATL,SEA"

FLIGHTS_SQL = f"""
SELECT l_orderkey, l_linenumber, year, month, make_date(year, month, 1 + l_linenumber) AS flight_date,
 split_part('{CARRIERS}', ',', CAST((l_partkey + l_suppkey) % 20 + 1 AS INT)) AS carrier,
 CAST((l_partkey + l_suppkey) % 20 AS INT) AS carrier_idx,
 split_part('{AIRPORTS}', ',', CAST(l_partkey % 5 + 1 AS INT)) AS origin,
 split_part('{AIRPORTS}', ',', CAST((l_orderkey + l_linenumber) % 5 + 1 AS INT)) AS dest,
 lpad(CAST(CAST(floor(dm / 60) * 100 + dm % 60 AS INT) AS STRING), 4, '0') AS dep_time,
 lpad(CAST(CAST(floor(am / 60) * 100 + am % 60 AS INT) AS STRING), 4, '0') AS arr_time,
 CAST(greatest(CAST(l_quantity AS INT) - 20, 0) AS DOUBLE) AS arr_delay_min,
 CASE WHEN CAST(round(l_discount * 100) AS INT) = 10 THEN 1 ELSE 0 END AS cancelled,
 CASE WHEN CAST(round(l_tax * 100) AS INT) = 8 THEN 1 ELSE 0 END AS diverted{{extra}}
FROM (SELECT *, CAST(2007 + year(l_shipdate) % 2 AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
 CAST((l_orderkey * 37 + l_partkey * 11) % 1440 AS INT) AS dm,
 CAST((l_orderkey * 37 + l_partkey * 11 + 45 + l_suppkey % 90) % 1440 AS INT) AS am FROM {{lineitem}}) b
"""

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_discount", "l_tax", "l_shipdate",
]


# The same flights with delays that are NULL or not whole, a flag of 2 and a month of 0.
ROUGH_SQL = """
SELECT flight_date, origin, dest, dep_time, arr_time, carrier, year,
 CASE WHEN l_orderkey % 19 = 0 THEN 0 ELSE month END AS month,
 CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN NULL
  ELSE arr_delay_min + CAST(l_orderkey % 100 AS DOUBLE) / 100 END AS arr_delay_min,
 CASE WHEN l_orderkey % 13 = 0 THEN 2 ELSE cancelled END AS cancelled, diverted
FROM {flights}
"""


def rough_flights(spark: SparkSession, flights: DataFrame) -> DataFrame:
    return spark.sql(ROUGH_SQL, flights=flights)


def _with_extra(extra: list[str] | None) -> str:
    """``extra`` passes further lineitem columns through unchanged."""
    return FLIGHTS_SQL.replace("{extra}", "".join(f", {c}" for c in (extra or [])))


def flights_sql(table: str = "lineitem", extra: list[str] | None = None) -> str:
    """The derivation as plain SQL over a table name (used by the oracle)."""
    return _with_extra(extra).replace("{lineitem}", table)


def flights(spark: SparkSession, lineitem: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Derive flights from a lineitem DataFrame (no global temp view)."""
    cols = LINEITEM_COLUMNS + [c for c in (extra or []) if c not in LINEITEM_COLUMNS]
    return spark.sql(_with_extra(extra), lineitem=lineitem.select(*cols))


def read_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wayfare.sources.tables import read_table

    return flights(spark, read_table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS))
