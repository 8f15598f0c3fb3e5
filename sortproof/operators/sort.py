"""Total-order sort.

Every method is one shuffle followed by a per-partition sort that spills:

* ``range``   -- Spark's own range exchange (it samples the keys itself);
* ``sampled`` -- the systematic block sampler + explicit split points + routing by id;
* ``prefix7`` / ``prefix3`` -- routing by a key prefix, no sampling at all
  (only for flat key distributions: a hot prefix lands in one partition).

Partition i then holds keys no greater than any key of partition i+1, so
writing partition i to file ``part-i`` gives files whose name order is the
sort order.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortproof.functions.counts import int_div
from sortproof.operators import partition as P
from sortproof.session import small_table

METHODS = ("range", "sampled", "prefix7", "prefix3")
# --- fixed values: sorts with positions ------------------------------------------
# Bytes of rows a sort task takes (a bin of equal keys or prefixes is never cut).
RANGE_BYTES = 128 << 20
# Rows a partition up to which it is one range without a histogram.
SMALL_ROWS = 20_000
# Bins of the histogram: of all partitions together, and sampled split points.
PREFIX_BINS = 1 << 15
SAMPLED_BINS = 1 << 11
# Bytes of a key that its sampled bin is found by.
BIN_KEY_BYTES = 64
# ----------------------------------------------------------------------------------


def _tie_columns(key: str, tie_breaker: Optional[Sequence[str]]):
    return [F.col(key)] + [F.col(c) for c in (tie_breaker or [])]


def total_order_sort(df: DataFrame, num_partitions: Optional[int] = None,
                     method: str = "range", key: str = "key",
                     tie_breaker: Optional[Sequence[str]] = None,
                     splits: Optional[Sequence[bytes]] = None,
                     sample: Optional[DataFrame] = None,
                     with_position: bool = False,
                     salt_columns: Optional[Sequence[str]] = None) -> DataFrame:
    """Sort ``df`` by ``key`` across ``num_partitions`` ordered partitions.

    Adds ``pid`` (the output partition) and, with ``with_position``, ``pos``
    (0-based position inside the partition).  Rows with equal keys share a
    partition unless the key is hot (see below); their order is open unless
    ``tie_breaker`` columns are given.

    For ``method='sampled'`` give either ``splits`` (sorted bytes) or a
    ``sample`` DataFrame with a ``key`` column (e.g. from ``block_sample``).

    Without positions Spark's partition i is ``pid`` i.  With them, ``pid`` and ``pos``
    tell the order, and a partition larger than ``RANGE_BYTES`` is sorted as several
    consecutive Spark partitions (not by ``range``), so that the memory of a task does
    not grow with the table.

    Skew: ``range`` and ``sampled`` spread a hot key over several partitions
    using a deterministic row hash (``salt_columns``, default all columns), or
    ranges of the ``tie_breaker`` columns, whose order then holds throughout;
    ``prefix7`` / ``prefix3`` cannot, by definition, split a hot prefix.
    """
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = num_partitions
    if p < 1:
        raise ValueError("num_partitions must be >= 1")
    order = _tie_columns(key, tie_breaker)
    if method == "range":
        # Range bounds over (key, salt): a key holding a large share of the
        # rows is cut across several partitions instead of one task.
        salted = df.withColumn("_salt", P.row_salt(df, salt_columns))
        bound = order + [F.col("_salt")]
        out = (salted.repartitionByRange(p, *bound)
                     .sortWithinPartitions(*order)
                     .drop("_salt")
                     .withColumn("pid", F.spark_partition_id()))
    elif method in ("prefix7", "prefix3", "sampled"):
        if method == "sampled" and splits is None:
            if sample is None:
                raise ValueError("method='sampled' needs splits or a sample")
            splits = P.split_points(sample, p, "key")
        with_pid = P.assign_partition(df, p, method, key, splits, salt_columns=salt_columns,
                                      tie_breaker=tie_breaker)
        if with_position:
            return _sort_ranges(with_pid, p, method, key, order)
        out = P.route(with_pid, p).sortWithinPartitions(*order)
    else:
        raise ValueError(f"unknown sort method {method!r}; use one of {METHODS}")
    if with_position:
        out = with_partition_position(out)
    return out


def with_partition_position(sorted_df: DataFrame) -> DataFrame:
    """``pos`` = 0-based position inside the partition, taken straight after the sort.

    ``monotonically_increasing_id`` is partition_index << 33 plus the row's
    index in the partition, and is computed in the same stage as the sort, so
    it reads the sorted order without another exchange.
    """
    mono = F.monotonically_increasing_id()
    part = F.spark_partition_id().cast("bigint")
    return sorted_df.withColumn("pos", mono - F.shiftleft(part, 33))


def _bin(d: DataFrame, p: int, method: str, key: str, rows: int) -> DataFrame:
    """Add ``_bin``: within a ``pid`` it never falls as the key grows (null keys: 0).

    Finer prefixes of the prefix methods; by ``sampled``, split points of a sample of
    about SAMPLED_BINS key beginnings.  They bound a task's work, not the order.
    """
    if method == "sampled":
        head = d.select(F.substring(key, 1, BIN_KEY_BYTES).alias("_head")).where("_head is not null")
        got = head.sample(min(1.0, 2 * SAMPLED_BINS / rows), 7).distinct().collect()
        got = sorted(bytes(r["_head"]) for r in got)
        step = max(1, len(got) // SAMPLED_BINS)
        # only binary columns compare with the split points
        d = P._range_ids(d.withColumn("_head", F.substring(key, 1, BIN_KEY_BYTES)), "_head",
                         got[step::step], "_bin")
        return d.drop("_head")
    nbytes, per = (7, P.PREFIX7_MAX // p) if method == "prefix7" else (3, -(-P.PREFIX3_SPAN // p))
    bins = max(1, PREFIX_BINS // p)
    inside = P.R.key_prefix_int(key, nbytes) - F.col("pid").cast("bigint") * per
    return d.withColumn("_bin", F.coalesce(int_div(inside, -(-per // bins)), F.lit(0)).cast("int"))


def _sort_ranges(with_pid: DataFrame, p: int, method: str, key: str, order) -> DataFrame:
    """Sort every ``pid`` as consecutive ranges of about RANGE_BYTES; adds ``pos`` in the pid.

    A histogram of rows and bytes by ``(pid, bin)`` (bounded by the number of bins, however
    many rows) cuts the ranges and tells where each starts; ids depend on the row only, so
    a second evaluation gives the same.
    """
    spark = with_pid.sparkSession
    safe = F.least(F.greatest(F.col("pid"), F.lit(0)), F.lit(p - 1)).cast("int")
    d = with_pid.withColumn("pid", safe)
    rows = d.count()
    if rows <= p * SMALL_ROWS:
        return with_partition_position(P.route(d, p).sortWithinPartitions(*order))
    columns = d.columns
    binned = _bin(d, p, method, key, rows)
    size = F.lit(32 + 16 * len(columns))
    for name, kind in d.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    hist = binned.groupBy("pid", "_bin").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size")).collect()
    table, starts, last = [], [], None
    for h in sorted(hist, key=lambda h: (h["pid"], h["_bin"])):
        if last != h["pid"]:
            last, at, held = h["pid"], 0, None
        if held is None or held + h["size"] > RANGE_BYTES:
            starts.append((len(starts), at))
            held = 0
        table.append((h["pid"], h["_bin"], len(starts) - 1))
        at, held = at + h["n"], held + h["size"]
    ranges = len(starts)
    table = small_table(spark.createDataFrame(table, "pid int, _bin int, _range int"), 64 * len(table))
    starts = F.broadcast(spark.createDataFrame(starts, "_range int, _start long"))      # two numbers a range
    routed = binned.join(table, ["pid", "_bin"]).select(*columns, "_range").repartitionById(ranges, "_range")
    out = with_partition_position(routed.sortWithinPartitions(*order)).join(starts, "_range")
    return out.withColumn("pos", F.col("pos") + F.col("_start")).select(*columns, "pos")


def _offsets(counts: DataFrame) -> DataFrame:
    """Exclusive running sum of per-partition counts (one row per partition)."""
    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("pid", F.coalesce(F.sum("n").over(w), F.lit(0))
                         .cast("bigint").alias("offset"))


def global_position(sorted_df: DataFrame, counts: Optional[DataFrame] = None) -> DataFrame:
    """``global_pos`` = position in the total order.

    Needs ``pid`` and ``pos`` from ``total_order_sort(with_position=True)``.
    Per-partition counts are one row per partition (bounded by p); their
    running sum is broadcast back, so the big side is never re-shuffled.

    ``pid`` must be reproducible in a second evaluation: true for the id-based
    methods, not for ``range`` (its bounds come from a fresh sample).  A sort by
    ``range`` is refused; ``sort_with_global_position`` materialises it first.
    """
    if counts is None and "rangepartitioning" in \
            sorted_df._jdf.queryExecution().executedPlan().toString().lower():
        raise ValueError("a 'range' sort has no reproducible partition ids; "
                         "use sort_with_global_position")
    if counts is None:
        counts = sorted_df.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    # one row of two numbers per partition: a few MB for a million partitions
    return (sorted_df.join(F.broadcast(_offsets(counts)), "pid")
                     .withColumn("global_pos", F.col("offset") + F.col("pos"))
                     .drop("offset"))


def sort_with_global_position(df: DataFrame, num_partitions: Optional[int] = None,
                              method: str = "sampled", key: str = "key",
                              tie_breaker: Optional[Sequence[str]] = None,
                              splits: Optional[Sequence[bytes]] = None,
                              sample: Optional[DataFrame] = None) -> DataFrame:
    """Total-order sort plus ``pid``, ``pos`` and ``global_pos``.

    Id-based methods: the counts per partition are a partial aggregate of the
    input (map-side combine, p rows shuffled), independent of the sort.
    ``range``: the sorted result is checkpointed to the shared checkpoint
    folder first, so counts and rows come from the same partitioning.
    """
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = num_partitions
    if method == "range":
        from sortproof.session import shared_dir
        shared_dir(spark)
        s = total_order_sort(df, p, "range", key, tie_breaker, with_position=True)
        s = s.checkpoint(eager=True)
        return global_position(s, s.groupBy("pid").agg(F.count(F.lit(1)).alias("n")))
    if method == "sampled" and splits is None:
        if sample is None:
            raise ValueError("method='sampled' needs splits or a sample")
        splits = P.split_points(sample, p, "key")
    with_pid = P.assign_partition(df, p, method, key, splits, tie_breaker=tie_breaker)
    counts = with_pid.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    s = _sort_ranges(with_pid, p, method, key, _tie_columns(key, tie_breaker))
    return global_position(s, counts)
