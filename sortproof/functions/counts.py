"""Row counts and sizes as text (B7, B8), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: count suffixes and size units ----------------------------
COUNT_SUFFIXES = {"k": 10 ** 3, "m": 10 ** 6, "b": 10 ** 9, "t": 10 ** 12}
SIZE_UNITS = [("TB", 10 ** 12), ("GB", 10 ** 9), ("MB", 10 ** 6), ("KB", 10 ** 3)]
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(n, d) -> Column:
    """``n div d`` (SQL integral division, BIGINT, codegen'd)."""
    d = F.lit(d) if isinstance(d, int) else _c(d)
    return F.call_function("div", _c(n).cast("bigint"), d.cast("bigint"))


def parse_human_count(s) -> Column:
    """``'12k'`` -> 12000; suffix k, m, b or t in any case; plain digits allowed.

    Anything else (sign, spaces, other suffix, overflow) gives null. ``t`` is
    10^12 computed in BIGINT, not the overflowing int product.
    """
    s = F.lower(_c(s))
    digits = F.regexp_extract(s, r"^([0-9]+)([kmbt]?)$", 1)
    suffix = F.regexp_extract(s, r"^([0-9]+)([kmbt]?)$", 2)
    mult = F.lit(1).cast("bigint")
    for suf, m in COUNT_SUFFIXES.items():
        mult = F.when(suffix == suf, F.lit(m).cast("bigint")).otherwise(mult)
    # 20 digits or more are above 2^63 already
    base = F.when((digits != "") & (F.length(F.ltrim(digits, F.lit("0"))) < 20),
                  F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")))
    return F.try_multiply(base.try_cast("bigint"), mult)


def format_size(n) -> Column:
    """Bytes as ``<n div unit><unit>``; a unit applies only when strictly above it."""
    n = _c(n).cast("bigint")
    out = F.concat(n.cast("string"), F.lit("B"))
    for unit, scale in reversed(SIZE_UNITS):
        out = F.when(n > scale, F.concat(int_div(n, scale).cast("string"),
                                         F.lit(unit))).otherwise(out)
    return out
