"""Independent SQL for each registered query, runnable by DuckDB over the
driver's tables registered as views. Column names and types match the
Spark results (counts BIGINT, ceilings INT, means DOUBLE)."""

from __future__ import annotations

from wayfare.sources.flights import CARRIERS, ROUGH_SQL, flights_sql

WRITE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
FLIGHTS = f"flights AS ({flights_sql('lineitem')})"
ROUGH = f"base AS ({flights_sql('lineitem')}), flights AS ({ROUGH_SQL.format(flights='base')})"
FLIGHTS_X = f"flights AS ({flights_sql('lineitem', extra=WRITE_ORDER)})"

TOKENS = r"""tokens AS (
 SELECT doc_id, word FROM (
  SELECT doc_id, unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents) t
 WHERE word <> '' AND substr(word, 1, 1) IN ('M','N','O','P','Q','m','n','o','p','q'))"""

WORD_COUNT = f"WITH {TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word"

DOC_TF = f"WITH {TOKENS} SELECT doc_id, word, count(*) AS tf FROM tokens GROUP BY doc_id, word"

PART = """CASE lower(substr(word, 1, 1)) WHEN 'm' THEN 0 WHEN 'n' THEN 1 % {k}
 WHEN 'o' THEN 2 % {k} WHEN 'p' THEN 3 % {k} WHEN 'q' THEN 4 % {k} ELSE 0 END"""

WORD_PARTITION = (f"WITH {TOKENS}, c AS (SELECT word, count(*) AS n FROM tokens GROUP BY word) "
                  f"SELECT word, n, CAST({PART.format(k=3)} AS INT) AS part FROM c")

LETTER_TOTALS = (f"WITH {TOKENS}, c AS (SELECT word, count(*) AS n FROM tokens GROUP BY word) "
                 "SELECT lower(substr(word, 1, 1)) AS letter, count(*) AS n_words, "
                 "CAST(sum(n) AS BIGINT) AS n_tokens FROM c GROUP BY 1")

WINDOW_YM = "((year = 2007 AND month >= 6) OR (year = 2008 AND month <= 5))"


def _legs(loose: bool = False, rule: str = "reject", window: bool = True,
          keep: str = "", delay: str = "CAST(trunc(arr_delay_min) AS INT)") -> str:
    flags = ("cancelled <> 1 AND diverted <> 1" if rule == "reject"
             else "cancelled = 0 AND diverted = 0")
    w = f" AND {WINDOW_YM}" if window else ""
    o1 = "origin = 'ORD'" if loose else "origin = 'ORD' AND dest <> 'JFK'"
    o2 = "dest = 'JFK'" if loose else "origin <> 'ORD' AND dest = 'JFK'"
    return (
        f"f1 AS (SELECT flight_date, dest AS transit, arr_time AS t, {delay} AS d{keep} "
        f"FROM flights WHERE {o1} AND {flags}{w}), "
        f"f2 AS (SELECT flight_date, origin AS transit, dep_time AS t, {delay} AS d{keep} "
        f"FROM flights WHERE {o2} AND {flags}{w})")


TOTALS = ("SELECT CAST(count(*) AS BIGINT) AS n_pairs, CAST(coalesce(sum(a.d + b.d), 0) AS BIGINT) AS sum_delay, "
          "CAST(sum(a.d + b.d) AS DOUBLE) / count(*) AS avg_delay "
          "FROM f1 a JOIN f2 b ON a.flight_date = b.flight_date AND a.transit = b.transit AND a.t < b.t")

TWO_LEG_TOTAL = f"WITH {FLIGHTS}, {_legs()} {TOTALS}"

TWO_LEG_RUNNING = f"""WITH {FLIGHTS}, {_legs()}
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n_pairs, CAST(coalesce(sum(s + c * d), 0) AS BIGINT) AS sum_delay,
 CAST(sum(s + c * d) AS DOUBLE) / sum(c) AS avg_delay FROM (
 SELECT leg, d, sum(CASE WHEN leg = 1 THEN 1 ELSE 0 END) OVER w AS c,
  sum(CASE WHEN leg = 1 THEN d ELSE 0 END) OVER w AS s FROM (
  SELECT 1 AS leg, * FROM f1 x UNION ALL SELECT 2 AS leg, * FROM f2 y) u
 WINDOW w AS (PARTITION BY flight_date, transit ORDER BY t, leg DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) z WHERE leg = 2"""

_JF_WIN = lambda p: WINDOW_YM.replace("year", f"{p}.year").replace("month", f"{p}.month")

TWO_LEG_JOIN_FIRST_LEFT = (
    f"WITH {FLIGHTS}, {_legs(loose=True, rule='accept', window=False, keep=', year, month')} "
    + TOTALS + f" WHERE {_JF_WIN('a')}")

TWO_LEG_JOIN_FIRST_BOTH = (
    f"WITH {FLIGHTS}, {_legs(rule='accept', window=False, keep=', year, month')} "
    + TOTALS + f" WHERE {_JF_WIN('a')} AND {_JF_WIN('b')}")

# the delay as it is: to six places, so that its sum is exact, and NULLs skipped
_EXACT = "CAST(arr_delay_min AS DECIMAL(18,6))"


def _union_avg(flights: str, legs: str, where: str = "") -> str:
    return f"""WITH {flights}, {legs},
p AS (SELECT a.d AS d1, b.d AS d2 FROM f1 a JOIN f2 b
 ON a.flight_date = b.flight_date AND a.transit = b.transit AND a.t < b.t {where})
SELECT CAST(sum(d) AS DOUBLE) / count(d) * 2 AS avg_delay
FROM (SELECT d1 AS d FROM p UNION ALL SELECT d2 AS d FROM p) u"""


_FILTER_FIRST = _legs(rule="accept", delay=_EXACT)
_JOIN_FIRST = _legs(loose=True, rule="accept", window=False, keep=", year, month", delay=_EXACT)
TWO_LEG_UNION_AVG = _union_avg(FLIGHTS, _FILTER_FIRST)
TWO_LEG_JOIN_FIRST_AVG = _union_avg(FLIGHTS, _JOIN_FIRST, f"WHERE {_JF_WIN('a')}")
TWO_LEG_UNION_AVG_ROUGH = _union_avg(ROUGH, _FILTER_FIRST)
TWO_LEG_JOIN_FIRST_AVG_ROUGH = _union_avg(ROUGH, _JOIN_FIRST, f"WHERE {_JF_WIN('a')}")
# a leg without a known delay is neither counted nor summed
TWO_LEG_RUNNING_ROUGH = f"WITH {ROUGH}, {_legs()} {TOTALS} AND a.d IS NOT NULL AND b.d IS NOT NULL"

TWO_LEG_PAIRS = f"""WITH {FLIGHTS}, {_legs(keep=', l_orderkey, l_linenumber')}
SELECT a.flight_date, a.transit, a.t AS a_t, a.d AS a_d, a.l_orderkey AS a_l_orderkey,
 a.l_linenumber AS a_l_linenumber, b.t AS b_t, b.d AS b_d, b.l_orderkey AS b_l_orderkey,
 b.l_linenumber AS b_l_linenumber
FROM f1 a JOIN f2 b ON a.flight_date = b.flight_date AND a.transit = b.transit AND a.t < b.t"""

TWO_LEG_YEAR_2007 = f"""WITH {FLIGHTS}, {_legs(rule='accept', window=False, keep=', year, month')}
SELECT a.flight_date, a.transit, a.t AS a_t, a.d AS a_d, a.year AS a_year, a.month AS a_month,
 b.t AS b_t, b.d AS b_d, b.year AS b_year, b.month AS b_month
FROM f1 a JOIN f2 b ON a.flight_date = b.flight_date AND a.transit = b.transit AND a.t < b.t
WHERE a.year = 2007"""


def _monthly(delay: str = "arr_delay_min") -> str:
    return (f"m AS (SELECT carrier, month, count(*) AS n, sum({delay}) AS sum_delay, "
            f"CAST(ceil(sum({delay}) / count(*)) AS INT) AS avg_delay FROM flights "
            "WHERE year = 2008 AND month BETWEEN 1 AND 12 AND CAST(cancelled AS INT) <> 1 "
            "GROUP BY carrier, month)")


MONTHLY_ROUGH = f"""WITH {ROUGH}, s AS (SELECT carrier, month, count(arr_delay_min) AS n, sum({_EXACT}) AS total
 FROM flights WHERE arr_delay_min IS NOT NULL AND year = 2008 AND month BETWEEN 1 AND 12 AND cancelled <> 1 GROUP BY carrier, month)
SELECT carrier, month, n, CAST(total AS DOUBLE) AS sum_delay, CAST(ceil(CAST(total AS DOUBLE) / n) AS INT) AS avg_delay
FROM s"""
MONTHLY = f"WITH {FLIGHTS}, {_monthly()} SELECT * FROM m"

_SLOTS = ", ".join(
    f"CAST(coalesce(max(CASE WHEN month = {i} THEN avg_delay END), 0) AS INT) AS m{i:02d}"
    for i in range(1, 13))
MONTHLY_VECTOR = f"WITH {FLIGHTS}, {_monthly()} SELECT carrier, {_SLOTS} FROM m GROUP BY carrier"

_TEXT = " || ', ' || ".join(f"'({i}, ' || m{i:02d} || ')'" for i in range(1, 13))
MONTHLY_TEXT = (f"WITH {FLIGHTS}, {_monthly()}, v AS (SELECT carrier, {_SLOTS} FROM m GROUP BY carrier) "
                f"SELECT carrier, carrier || ', ' || {_TEXT} AS line FROM v")

MONTHLY_ORDERED = (f"WITH {FLIGHTS}, {_monthly()} SELECT carrier, month, avg_delay, "
                   "CAST(row_number() OVER (PARTITION BY carrier ORDER BY month) AS INT) AS rn FROM m")

CARRIER_PARTITION = (
    f"WITH {FLIGHTS}, {_monthly()}, c AS (SELECT DISTINCT carrier FROM m), "
    f"d AS (SELECT unnest(string_split('{CARRIERS}', ',')) AS carrier, "
    "CAST(unnest(range(20)) AS INT) AS carrier_idx) "
    "SELECT c.carrier, d.carrier_idx, CAST(coalesce(d.carrier_idx % 4, 0) AS INT) AS part "
    "FROM c LEFT JOIN d ON c.carrier = d.carrier")

_CANCEL = "CASE WHEN cancelled = 1 THEN 1 ELSE 0 END"
_KEY = (f"printf('%04X%02X%02X%02X%014X%02X', year, {_CANCEL}, month, carrier_idx, "
        "l_orderkey, l_linenumber)")
_KEYED_COLS = (f"{_KEY} AS rowkey, l_orderkey, l_linenumber, year, {_CANCEL} AS cancelled, month, "
               "carrier, carrier_idx, CAST(arr_delay_min AS INT) AS delay, "
               f"CAST((year - 2007) * 2 + {_CANCEL} AS INT) AS cond, "
               "CAST(CAST(arr_delay_min AS INT) AS BIGINT) * 256 + carrier_idx AS cell")
KEYED_POPULATE = f"WITH {FLIGHTS} SELECT {_KEYED_COLS} FROM flights"

_ORDER_DESC = ", ".join(f"{c} DESC" for c in WRITE_ORDER)
KEYED_UPSERT_LAST = (
    f"WITH {FLIGHTS_X}, r AS (SELECT {_KEYED_COLS}, row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_DESC}) AS rk FROM flights) "
    "SELECT rowkey, l_orderkey, l_linenumber, year, cancelled, month, carrier, carrier_idx, "
    "delay, cond, cell FROM r WHERE rk = 1")

KEYED_MONTHLY = (f"WITH {FLIGHTS}, {_monthly('CAST(CAST(arr_delay_min AS INT) AS DOUBLE)')} "
                 "SELECT * FROM m")

TWO_LEG_FLATTENED = f"""WITH {FLIGHTS}, {_legs(rule='accept', window=False, keep=', year, month', delay='arr_delay_min')}
SELECT a.flight_date, a.transit, a.t AS t1, a.d AS delay1, a.year AS year1, a.month AS month1,
 b.t AS t2, b.d AS delay2, b.year AS year2, b.month AS month2, count(*) AS n
FROM f1 a JOIN f2 b ON a.flight_date = b.flight_date AND a.transit = b.transit AND a.t < b.t
WHERE a.year = 2007 GROUP BY ALL"""

_COLS = "l_orderkey, l_linenumber, year, month, carrier, carrier_idx, arr_delay_min, cancelled"
_OCC = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(WRITE_ORDER)}, arr_delay_min)"
KEYED_MERGE = f"""WITH base AS ({flights_sql('lineitem', extra=WRITE_ORDER)}),
again AS (SELECT * REPLACE (
  CASE WHEN l_orderkey % 2 = 0 THEN arr_delay_min + 7 ELSE arr_delay_min END AS arr_delay_min,
  CASE WHEN l_orderkey % 2 = 0 AND l_linenumber % 3 = 0 THEN 1 - cancelled ELSE cancelled END AS cancelled)
 FROM base WHERE l_orderkey % 3 = 0),
added AS (SELECT * REPLACE (l_orderkey + 1000000000 AS l_orderkey) FROM base WHERE l_orderkey % 50 = 7),
loads AS (SELECT 1 AS load, {_OCC} AS occ, {_COLS} FROM base
 UNION ALL SELECT 2, {_OCC}, {_COLS} FROM (SELECT * FROM again UNION ALL SELECT * FROM added)),
flights AS (SELECT * FROM loads
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, occ ORDER BY load DESC) = 1)
SELECT {_KEYED_COLS} FROM flights"""

# the keys as numbers of 13 bytes, month first; 20 ranges need 19 split points
_SPLIT_KEY = (f"(((((month::HUGEINT * 65536 + year) * 256 + {_CANCEL}) * 256 + carrier_idx) * 72057594037927936 "
              "+ l_orderkey) * 256 + l_linenumber)")
_MONTH = "79228162514264337593543950336::HUGEINT"  # 2 ** 96
SPLIT_RANGES = f"""WITH {FLIGHTS}, keyed AS (SELECT month, {_SPLIT_KEY} AS k FROM flights),
points AS (SELECT 2 * {_MONTH} + (10 * {_MONTH} * i) // 18 AS p FROM range(19) r(i)),
placed AS (SELECT month, (SELECT count(*) FROM points WHERE p <= k) AS range FROM keyed)
SELECT CAST(range AS INT) AS range, count(*) AS n, min(month) AS first_month, max(month) AS last_month
FROM placed GROUP BY 1"""
MONTHLY_SPLITS = KEYED_MONTHLY + " WHERE month BETWEEN 3 AND 5"
_IDX = f"list_position(string_split('{CARRIERS}', ','), carrier) - 1"
MONTHLY_FILES = (f"WITH {FLIGHTS}, {_monthly()} SELECT CAST(({_IDX}) % 4 AS INT) AS part, carrier, month, avg_delay, "
                 "CAST(row_number() OVER (PARTITION BY carrier ORDER BY month) AS INT) AS place, true AS in_order FROM m")
_DUMP = " || ',' || ".join(f"m{i:02d}" for i in range(1, 13))
MONTHLY_DUMP = (f"WITH {FLIGHTS}, {_monthly()}, v AS (SELECT carrier, {_SLOTS} FROM m GROUP BY carrier) "
                f"SELECT '(' || carrier || ',' || {_DUMP} || ')' AS line FROM v")

CSV_ROUNDTRIP = f"WITH {FLIGHTS} SELECT * FROM flights"

ORACLE = {
    "word_count": WORD_COUNT,
    "doc_term_frequency": DOC_TF,
    "word_count_from_doc_tf": WORD_COUNT,
    "word_count_partition_tally": WORD_COUNT,
    "word_partition_assignment": WORD_PARTITION,
    "letter_totals": LETTER_TOTALS,
    "two_leg_total": TWO_LEG_TOTAL,
    "two_leg_running": TWO_LEG_RUNNING,
    "two_leg_band_pruned": TWO_LEG_TOTAL,
    "two_leg_join_first_left": TWO_LEG_JOIN_FIRST_LEFT,
    "two_leg_join_first_both": TWO_LEG_JOIN_FIRST_BOTH,
    "two_leg_union_avg": TWO_LEG_UNION_AVG,
    "two_leg_union_avg_rough": TWO_LEG_UNION_AVG_ROUGH,
    "two_leg_join_first_avg": TWO_LEG_JOIN_FIRST_AVG,
    "two_leg_join_first_avg_rough": TWO_LEG_JOIN_FIRST_AVG_ROUGH,
    "two_leg_running_rough": TWO_LEG_RUNNING_ROUGH,
    "two_leg_pairs": TWO_LEG_PAIRS,
    "two_leg_year_2007_rows": TWO_LEG_YEAR_2007,
    "monthly_delay": MONTHLY,
    "monthly_delay_rough": MONTHLY_ROUGH,
    "monthly_delay_vector": MONTHLY_VECTOR,
    "monthly_delay_text": MONTHLY_TEXT,
    "monthly_delay_ordered": MONTHLY_ORDERED,
    "carrier_partition_assignment": CARRIER_PARTITION,
    "keyed_populate": KEYED_POPULATE,
    "keyed_upsert_last": KEYED_UPSERT_LAST,
    "keyed_scan_filter": KEYED_MONTHLY,
    "keyed_scan_range": KEYED_MONTHLY,
    "keyed_scan_packed": KEYED_MONTHLY,
    "csv_flights_roundtrip": CSV_ROUNDTRIP,
    "word_count_text_files": WORD_COUNT,
    "csv_flights_files": CSV_ROUNDTRIP,
    "two_leg_running_csv": TWO_LEG_TOTAL,
    "monthly_delay_text_csv": MONTHLY_TEXT,
    "word_count_files": WORD_PARTITION,
    "two_leg_bounds_pruned": TWO_LEG_TOTAL,
    "two_leg_chain": TWO_LEG_TOTAL,
    "two_leg_flattened_2007": TWO_LEG_FLATTENED,
    "two_leg_result_file": TWO_LEG_TOTAL,
    "monthly_delay_files": MONTHLY_FILES,
    "monthly_report_files": MONTHLY_TEXT,
    "monthly_dump_files": MONTHLY_DUMP,
    "monthly_delay_replaced": MONTHLY,
    "keyed_merge": KEYED_MERGE,
    "keyed_split_ranges": SPLIT_RANGES,
    "keyed_scan_splits": MONTHLY_SPLITS,
    "keyed_scan_table": KEYED_MONTHLY,
}
