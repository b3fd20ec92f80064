"""Row predicates of the flight jobs, as Column builders with parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.scalar import first_char

# The five initials the word job keeps.
DEFAULT_LETTERS = "mnopq"


# Keep tokens whose first character is one of ``letters`` in either case.
def starts_with_letter(word: Column, letters: str = DEFAULT_LETTERS) -> Column:
    allowed = sorted(set(letters.lower()) | set(letters.upper()))
    return first_char(word).isin(allowed)


# P5: exclusive leg rules (leg 1 leaves ``origin`` for anywhere but ``dest``;
# leg 2 reaches ``dest`` from anywhere but ``origin``).
def leg1_exclusive(origin: str, dest: str) -> Column:
    return (F.col("origin") == origin) & (F.col("dest") != dest)


def leg2_exclusive(origin: str, dest: str) -> Column:
    return (F.col("origin") != origin) & (F.col("dest") == dest)


# Loose leg rules (no exclusion of the far endpoint).
def leg1_loose(origin: str, dest: str) -> Column:
    return F.col("origin") == origin


def leg2_loose(origin: str, dest: str) -> Column:
    return F.col("dest") == dest


# Inclusive year-month window, e.g. (2007, 6) .. (2008, 5).
def in_year_month_window(
    start: tuple[int, int], end: tuple[int, int], year: str = "year", month: str = "month"
) -> Column:
    # plain comparisons, which reach the file statistics
    y, m = F.col(year), F.col(month)
    after = (y > start[0]) | ((y == start[0]) & (m >= start[1]))
    before = (y < end[0]) | ((y == end[0]) & (m <= end[1]))
    return after & before


# P10: reject rule: drop a record whose flag truncates to exactly 1.
def not_flagged(*flags: str) -> Column:
    cond = F.lit(True)
    for f in flags:
        cond = cond & (F.col(f).cast("int") != 1)
    return cond


# Accept rule: keep only records whose flags equal 0.
def all_clear(*flags: str) -> Column:
    cond = F.lit(True)
    for f in flags:
        cond = cond & (F.col(f) == 0)
    return cond


# Target year and a valid month.
def year_and_valid_month(year: int) -> Column:
    return (F.col("year") == year) & F.col("month").between(1, 12)
