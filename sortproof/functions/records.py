"""Column expressions over fixed-width records.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so it
stays inside Catalyst / whole-stage codegen: no Python runs per row.

A record is ``key || value``; keys compare as unsigned bytes, which is exactly
Spark's ``BinaryType`` ordering.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: record layout of the sort benchmark ---------------------
KEY_LENGTH = 10
VALUE_LENGTH = 90
RECORD_LENGTH = KEY_LENGTH + VALUE_LENGTH
# binary record: bytes 10-11 = 00 11, 12-43 row number as 32 upper-case hex
# digits, 44-47 = 88 99 AA BB, 48-95 twelve state hex digits (20..31) each four
# times, 96-99 = CC DD EE FF.
# ascii record: bytes 0-9 printable key (base 95 from ' '), 10-11 two spaces,
# 12-43 row hex, 44-45 two spaces, 46-97 thirteen state hex digits (19..31)
# each four times, 98-99 CR LF.
ROW_HEX_OFFSET = 12
ROW_HEX_DIGITS = 32
BINARY_FILLER_OFFSET = 48
BINARY_FILLER_DIGITS = 12
ASCII_FILLER_OFFSET = 46
ASCII_FILLER_DIGITS = 13
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# B1 / B2 / B3 ---------------------------------------------------------------

def record_key(rec, key_length: int = KEY_LENGTH) -> Column:
    """First ``key_length`` bytes of a record (B1)."""
    return F.substring(_c(rec), 1, key_length)


def record_value(rec, key_length: int = KEY_LENGTH,
                 value_length: int = VALUE_LENGTH) -> Column:
    """Bytes after the key (B1)."""
    return F.substring(_c(rec), key_length + 1, value_length)


def join_record(key="key", value="value") -> Column:
    """``key || value`` as one binary record (B2)."""
    return F.concat(_c(key), _c(value))


def to_bytes(text) -> Column:
    """Text to bytes (B3), UTF-8."""
    return F.encode(_c(text), "UTF-8")


def to_text(data) -> Column:
    """Bytes to text (B3), UTF-8."""
    return F.decode(_c(data), "UTF-8")


# B4 / B5 / B6 ----------------------------------------------------------------

def row_hex(n) -> Column:
    """Row number as 32 upper-case hex digits, zero padded."""
    return F.lpad(F.hex(_c(n)), ROW_HEX_DIGITS, "0")


def hex_to_decimal(h) -> Column:
    """Parse up to 32 hex digits into DECIMAL(38,0).

    Split into two 16-digit halves; ``conv`` handles each unsigned 64-bit half.
    Values at or above 10^38 (only possible above 2^126), other characters,
    nothing or more than 32 digits give null, under ANSI mode too.
    """
    h = F.when(_c(h).rlike("^[0-9a-fA-F]{1,32}$"), F.lpad(_c(h), 32, "0"))
    hi = F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(38,0)")
    lo = F.conv(F.substring(h, 17, 16), 16, 10).cast("decimal(38,0)")
    return F.try_add(F.try_multiply(hi, F.lit(Decimal(2 ** 64)).cast("decimal(20,0)"))
                     .try_cast("decimal(38,0)"), lo).try_cast("decimal(38,0)")


def decimal_to_hex(n) -> Column:
    """A non-negative integral number as lower-case hex, no leading zeros."""
    n = _c(n).cast("decimal(38,0)")
    two64 = F.lit(Decimal(2 ** 64)).cast("decimal(38,0)")
    hi = F.call_function("div", n, two64).cast("decimal(38,0)")
    lo = (n - hi * two64).cast("decimal(38,0)")
    lo_hex = F.conv(lo.cast("string"), 10, 16)
    hi_hex = F.conv(hi.cast("string"), 10, 16)
    return F.lower(F.when(hi > 0, F.concat(hi_hex, F.lpad(lo_hex, 16, "0")))
                   .otherwise(lo_hex))


def parse_decimal_strict(s) -> Column:
    """Decimal digits only, else null (B6); null above 38 digits too."""
    s = _c(s)
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("decimal(38,0)"))


# B9 / B10 / B11 ---------------------------------------------------------------

def spaced_hex(key) -> Column:
    """Key bytes as lower-case hex pairs separated by spaces."""
    return F.trim(F.regexp_replace(F.lower(F.hex(_c(key))), "(..)", "$1 "))


def byte_at(data, index) -> Column:
    """Unsigned value of the byte at 0-based ``index``; 0 when out of range."""
    idx = _c(index) if not isinstance(index, int) else F.lit(index)
    b = F.substring(_c(data), idx + 1, 1)
    return F.coalesce(
        F.when(F.length(b) == 1, F.conv(F.hex(b), 16, 10).cast("int")),
        F.lit(0))


def key_byte_values(key) -> Column:
    """Key bytes as an array of unsigned ints."""
    k = _c(key)
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(k), F.lit(1))),
        lambda i: F.conv(F.hex(F.substring(k, i, 1)), 16, 10).cast("int"))


def hex_digit_at(h, index) -> Column:
    """Hex character at 0-based ``index`` of a hex string; '0' when out of range."""
    idx = _c(index) if not isinstance(index, int) else F.lit(index)
    ch = F.substring(_c(h), idx + 1, 1)
    return F.when(F.length(ch) == 1, F.upper(ch)).otherwise(F.lit("0"))


# B12 / B13 --------------------------------------------------------------------

def key_prefix_int(key, nbytes: int) -> Column:
    """First ``nbytes`` (<= 7) key bytes as a non-negative BIGINT.

    Short keys are right-padded with zero bytes first, so that the prefix is
    always left-aligned.
    """
    if not 1 <= nbytes <= 7:
        raise ValueError("prefix must be 1..7 bytes to fit a signed bigint")
    padded = F.substring(F.concat(_c(key), F.lit(bytes(nbytes))), 1, nbytes)
    return F.conv(F.hex(padded), 16, 10).cast("bigint")


# B14 / B15 / B16 --------------------------------------------------------------

def crc_record(key="key", value="value") -> Column:
    """CRC-32 of the whole record, as an unsigned BIGINT."""
    return F.crc32(join_record(key, value))


def crc_key(key="key") -> Column:
    """CRC-32 of the key only."""
    return F.crc32(_c(key))


def checksum_sum(crc) -> Column:
    """Exact sum of CRCs: DECIMAL avoids BIGINT overflow past ~2^31 rows."""
    return F.sum(_c(crc).cast("decimal(20,0)")).cast("decimal(38,0)")


def key_lt(a, b) -> Column:
    """Unsigned byte comparison ``a < b`` (B16): Spark's binary ordering."""
    return _c(a) < _c(b)
