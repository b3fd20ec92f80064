"""Scalar Column builders (all JVM-side, codegen-friendly).

Each returns a ``Column``; none of them runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# strip every character <= U+0020 from both ends (Spark's default trim
# strips spaces only; record fields may carry tabs and control characters).
_CONTROL_AND_SPACE = "".join(chr(i) for i in range(0x21))


def java_trim(c: ColumnOrName) -> Column:
    return F.trim(_col(c), F.lit(_CONTROL_AND_SPACE))


# strict parse. Under ANSI mode a blank or malformed field raises
# CAST_INVALID_INPUT, and '5.0' does not parse as an int. A missing field
# (NULL, which is how the CSV reader returns an empty one) counts as blank.
def strict_int(c: ColumnOrName) -> Column:
    return java_trim(F.coalesce(_col(c), F.lit(""))).cast("int")


def strict_double(c: ColumnOrName) -> Column:
    return java_trim(F.coalesce(_col(c), F.lit(""))).cast("double")


# blank-as-zero parse: an empty field becomes 0, a malformed one still raises.
def blank_zero(c: ColumnOrName, dtype: str = "double") -> Column:
    return F.coalesce(F.nullif(java_trim(c), F.lit("")).cast(dtype), F.lit(0).cast(dtype))


# truncate a double toward zero (1.9 -> 1, -1.9 -> -1).
def trunc_int(c: ColumnOrName) -> Column:
    return _col(c).cast("int")


# mean with 0 for an empty group.
def mean_or_zero(total: ColumnOrName, n: ColumnOrName) -> Column:
    return F.when(_col(n) > 0, _col(total) / _col(n)).otherwise(F.lit(0.0))


# F5 over F14: ceiling of a mean, 0 for an empty group. ``total`` is a decimal, so the
# remainder is exact and the ceiling does not depend on rounding or on the order of the sum.
def ceil_mean(total: ColumnOrName, n: ColumnOrName) -> Column:
    rest = F.pmod(_col(total), _col(n))
    whole = ((_col(total) - rest) / _col(n)).cast("int") + F.when(rest > 0, 1).otherwise(0)
    return F.when(_col(n) > 0, whole).otherwise(0)


# ceiling to int (ceil alone returns bigint).
def ceil_int(c: ColumnOrName) -> Column:
    return F.ceil(_col(c)).cast("int")


# first character.
def first_char(c: ColumnOrName) -> Column:
    return F.substring(_col(c), 1, 1)


# tab split.
def tab_fields(c: ColumnOrName) -> Column:
    return F.split(_col(c), "\t")


# bit packing, e.g. (year - 2007) << 1 | cancelled, delay << 8 | carrier.
def pack_bits(high: ColumnOrName, low: ColumnOrName, low_bits: int) -> Column:
    return F.shiftleft(_col(high), low_bits).bitwiseOR(_col(low))


# the inverse of pack_bits; the high part keeps its sign.
def unpack_low(packed: ColumnOrName, low_bits: int) -> Column:
    return _col(packed).bitwiseAND(F.lit((1 << low_bits) - 1))


def unpack_high(packed: ColumnOrName, low_bits: int) -> Column:
    return F.shiftright(_col(packed), low_bits)


# fixed-width, order-preserving binary key. Each part is written
# big-endian in ``width`` bytes; a value that does not fit raises instead of
# wrapping (wrapping would make distinct rows collide or sort out of order).
def _checked(c: Column, width: int, name: str) -> Column:
    limit = 1 << (8 * width)
    return F.when((c >= 0) & (c < F.lit(limit)), c).otherwise(
        F.raise_error(F.concat(F.lit(f"key part {name} out of range: "), c.cast("string")))
    )


def key_hex(parts: list[tuple[ColumnOrName, int]]) -> Column:
    """Upper-case hex text of the key; widths are in bytes (max 7 per part)."""
    fmt = "".join(f"%0{2 * width}X" for _, width in parts)
    cols = [
        _checked(_col(c).cast("long"), width, f"#{i}") for i, (c, width) in enumerate(parts)
    ]
    return F.format_string(fmt, *cols)


def binary_key(parts: list[tuple[ColumnOrName, int]]) -> Column:
    return F.unhex(key_hex(parts))


def key_byte(key: ColumnOrName, offset: int, width: int = 1) -> Column:
    """Decode ``width`` bytes at 0-based ``offset`` of a binary key."""
    return F.conv(F.hex(F.substring(_col(key), offset + 1, width)), 16, 10).cast("long")
