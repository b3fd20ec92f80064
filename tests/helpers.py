import datetime as dt

FLIGHT_SCHEMA = (
    "l_orderkey bigint, l_linenumber int, year int, month int, flight_date date, carrier string, "
    "carrier_idx int, origin string, dest string, dep_time string, arr_time string, "
    "arr_delay_min double, cancelled int, diverted int")


def flight(i, origin, dest, dep="0800", arr="0900", delay=0.0, date=(2007, 7, 1), carrier="AA",
           cancelled=0, diverted=0, year=None, month=None):
    d = dt.date(*date)
    return (i, 1, year if year is not None else d.year, month if month is not None else d.month, d,
            carrier, 1, origin, dest, dep, arr, None if delay is None else float(delay), cancelled, diverted)


def flights_df(spark, rows):
    return spark.createDataFrame(rows, FLIGHT_SCHEMA)
