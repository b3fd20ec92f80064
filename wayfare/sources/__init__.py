"""Scans: driver parquet tables, text lines, flight CSV and the keyed table."""

from wayfare.sources.tables import read_table
from wayfare.sources.text import read_lines, read_tab_parts
from wayfare.sources.flights import flights, FLIGHTS_SQL, flights_sql
from wayfare.sources.csv import (
    FLIGHT_COLUMNS,
    flight_csv_schema,
    parse_flight_lines,
    read_flights_csv,
    typed_flights,
    flights_to_csv_lines,
)

__all__ = [
    "read_table",
    "read_lines",
    "read_tab_parts",
    "flights",
    "FLIGHTS_SQL",
    "flights_sql",
    "FLIGHT_COLUMNS",
    "flight_csv_schema",
    "parse_flight_lines",
    "read_flights_csv",
    "typed_flights",
    "flights_to_csv_lines",
]
