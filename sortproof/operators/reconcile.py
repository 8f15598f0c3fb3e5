"""Which rows differ between two tables, without moving the rows that are equal.

Every row is put, by a 124-bit fingerprint, into three cells of an invertible Bloom
look-up table: the cell adds +1 (before) or -1 (after), and so many times the two halves of the
fingerprint and a check of it.  Sums are exact, equal rows cancel and what is left are the
differences, each as often as it is missing.  A cell with one kind of row gives its
fingerprint (its sums divided by its count); taking that row out of its two other cells
sets more cells free, until the table is empty (peeling).

Both tables are aggregated where they lie: a task sends at most as many cells as the table
has, never a row.  The table is sized by a first, small one (an estimator that keeps
fingerprints by their trailing zeros in strata); the rows that have the fingerprints found
are then named by a join with that small list.  Where the difference is too large, or
peeling ends early, the rows themselves are counted (one shuffle of both tables).
"""

from __future__ import annotations

from collections import Counter, deque
from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof.session import small_table

#: Cells of a stratum of the estimator, strata, and most differences that are peeled.
STRATUM_CELLS, STRATA, MOST = 90, 32, 200_000
_HALF, _LOW = (1 << 62) - 1, (1 << 31) - 1


def _signed(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(sign, a, b): the halves of every row's fingerprint."""
    def side(df, sign):
        a, b = _prints(df, columns)
        return df.select(F.lit(sign).cast("long").alias("sign"), a.alias("a"), b.alias("b"))
    return side(before, 1).unionAll(side(after, -1))


def _prints(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 62-bit halves of a row's fingerprint; a null and an empty value differ."""
    cols = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit(_HALF)) for seed in (1, 2)]


def _places(a, b, third: int, high=lambda x: x >> 31) -> tuple:
    """The cells of a fingerprint, one in each third of the table (numbers or columns)."""
    return a % third, b % third + third, (high(a) + high(b)) % third + 2 * third


def _check(a: int, b: int) -> int:
    """A product, which sums of several fingerprints do not keep."""
    return (a & _LOW) * (b & _LOW)


def _cells(signed: DataFrame, cells: int, group: Sequence[str] = ()) -> DataFrame:
    """Sums of every cell that is not empty; ``cells`` is a multiple of 3."""
    a, b = F.col("a"), F.col("b")
    at = F.array(*_places(a, b, cells // 3, lambda x: F.shiftright(x, 31)))
    check = a.bitwiseAND(F.lit(_LOW)) * b.bitwiseAND(F.lit(_LOW))
    d = signed.select(*group, F.explode(at).alias("cell"), "sign", "a", "b", check.alias("c"))
    wide = lambda c: F.sum((F.col("sign") * F.col(c)).cast("decimal(38,0)")).alias(c)
    return d.groupBy(*group, "cell").agg(F.sum("sign").alias("count"), wide("a"), wide("b"), wide("c")).where(
        "count <> 0 or a <> 0 or b <> 0 or c <> 0")


def _peel(rows: list, cells: int) -> tuple[dict, bool]:
    """({fingerprint: copies}, emptied) of the cells of a table (on the driver; at most ``cells``)."""
    table = {r["cell"]: [int(r["count"]), int(r["a"]), int(r["b"]), int(r["c"])] for r in rows}
    found: Counter = Counter()
    free = deque(table)
    while free:
        cell = free.popleft()
        n, a, b, c = table[cell]
        if not n or a % n or b % n:
            continue
        a, b = a // n, b // n
        if not (0 <= a <= _HALF and 0 <= b <= _HALF) or c != n * _check(a, b):
            continue
        places = _places(a, b, cells // 3)
        if cell not in places:
            continue
        found[a, b] += n
        for x in places:
            t = table.setdefault(x, [0, 0, 0, 0])
            t[0], t[1], t[2], t[3] = t[0] - n, t[1] - n * a, t[2] - n * b, t[3] - n * _check(a, b)
            if t[0]:
                free.append(x)
    return {p: n for p, n in found.items() if n}, not any(map(any, table.values()))


def estimate_differences(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> int:
    """About how many distinct rows differ (0 only if the tables are equal).

    Stratum i holds the fingerprints with i trailing zeros (of their upper bits), a
    2^-(i + 1) part of them; from the highest stratum down they are peeled while they can
    be, and what was found above is scaled up.  At most 32 x 90 cells reach the driver.
    """
    high = F.shiftright("a", 31)
    low = high.bitwiseAND(-high)                       # the lowest bit that is set
    zeros = F.when(low == 0, STRATA - 1).otherwise(F.round(F.log2(low.cast("double"))).cast("int"))
    signed = _signed(before, after, columns).withColumn("stratum", zeros)
    strata: dict = {}
    for r in _cells(signed, STRATUM_CELLS, ["stratum"]).collect():
        strata.setdefault(r["stratum"], []).append(r)
    seen = 0
    for i in range(STRATA - 1, -1, -1):
        got, emptied = _peel(strata.get(i, []), STRATUM_CELLS)
        if not emptied:
            # this stratum holds more than were seen above it; all lower ones twice as many each
            return max(seen, len(got), STRATUM_CELLS // 3) << (i + 1)
        seen += len(got)
    return seen


def changed_by_counting(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(side, <columns>, copies)`` by counting every distinct row of both tables."""
    side = lambda df, n: df.select(*columns, F.lit(n).cast("long").alias("_n"))
    n = side(before, 1).unionAll(side(after, -1)).groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return n.select(F.when(F.col("_n") > 0, "before").otherwise("after").alias("side"), *columns,
                    F.abs("_n").alias("copies"))


def changed_rows(before: DataFrame, after: DataFrame, columns: Optional[Sequence[str]] = None,
                 most: int = MOST) -> DataFrame:
    """``(side, <columns>, copies)``: rows that are in one table more often than in the other.

    ``columns`` (all of ``before`` by default) make up a row; nulls equal nulls; ``copies``
    says how often a row is missing on the other side.  More than about ``most`` distinct
    differences are counted in full (``changed_by_counting``), with the same result.
    Column names that start with an underscore are reserved.
    """
    columns = list(columns or before.columns)
    spark = before.sparkSession
    about = estimate_differences(before, after, columns)
    if about > most:
        return changed_by_counting(before, after, columns)
    # about 1.3 cells a difference suffice; more for an estimate that is too low
    cells = 3 * (about + 30)
    rows = _cells(_signed(before, after, columns), cells).collect()
    found, emptied = _peel(rows, cells)
    if not emptied:
        return changed_by_counting(before, after, columns)
    prints = spark.createDataFrame([(a, b, n) for (a, b), n in found.items()], "_a bigint, _b bigint, _n bigint")
    prints = small_table(prints, 24 * max(1, len(found)))

    def named(df, name, sign):
        a, b = _prints(df, columns)
        d = df.select(*columns, a.alias("_x"), b.alias("_y")).join(
            prints.where(F.col("_n") * sign > 0), (F.col("_x") == F.col("_a")) & (F.col("_y") == F.col("_b")))
        return d.groupBy(*columns).agg(F.first("_n").alias("_n")).select(
            F.lit(name).alias("side"), *columns, F.abs("_n").alias("copies"))
    return reduce(DataFrame.unionAll, [named(before, "before", 1), named(after, "after", -1)])
