"""Sampling, split points and partition assignment.

Partition ids are ordinary columns, so routing is ``repartitionById`` and the
id expressions stay in codegen.  Only bounded things ever reach the driver:
the p-1 split points (bounded by the partition count) and the count of a
sample (bounded by ``sample_size``).
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.functions.counts import int_div
from sortproof.session import small_table

# --- fixed values: sampler defaults --------------------------------------------
DEFAULT_SAMPLE_BLOCKS = 10
DEFAULT_SAMPLE_SIZE = 100_000
PREFIX7_MAX = (1 << 56) - 1
PREFIX3_SPAN = 1 << 24
# -----------------------------------------------------------------------------
# Sampled rows per partition that bound the tie ranges of a hot key.
TIE_SAMPLE = 200
# Keys that split_point_table ranks at most; more raise.
MAX_RANKED = 50_000_000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# D5-D8 -------------------------------------------------------------------------

def prefix7_partition(key, num_partitions: int) -> Column:
    """``prefix7 div ((2^56-1) div p)``, clamped to p-1.

    The unclamped formula gives p for the highest prefixes (always for seven
    FF bytes); ``repartitionById`` would wrap that id to 0 silently.
    """
    p = num_partitions
    per = PREFIX7_MAX // p
    return F.least(F.lit(p - 1), int_div(R.key_prefix_int(key, 7), per)).cast("int")


def prefix3_partition(key, num_partitions: int) -> Column:
    """``prefix3 div ceil(2^24/p)``, clamped to p-1."""
    p = num_partitions
    per = -(-PREFIX3_SPAN // p)
    return F.least(F.lit(p - 1), int_div(R.key_prefix_int(key, 3), per)).cast("int")


# D4 ---------------------------------------------------------------------------

# Split points are looked up by a search tree with LOOKUP_FANOUT branches a level:
# the top separators are literals of a balanced CASE WHEN, every further level is a
# join on the integer block number that brings the block's separators as columns,
# compared by the same balanced CASE WHEN.  All of it is codegen'd, costs log2(p)
# comparisons and one small hash join per level, and depends on the number of split
# points alone, not on what the keys look like.
LOOKUP_FANOUT = 64
# Split points of the Column form, which has the first level only.
COLUMN_LOOKUP_MAX = 2047


def _tree(k: Column, splits: Sequence[Column], lo: int, hi: int) -> Column:
    """Count of splits <= k, knowing it lies in [lo, hi]; null splits are above all keys."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(splits[mid] <= k, _tree(k, splits, mid + 1, hi)) \
            .otherwise(_tree(k, splits, lo, mid))


def _count_splits(k: Column, splits: Sequence[bytes]) -> Column:
    """Number of split points <= k."""
    return _tree(k, [F.lit(bytes(s)) for s in splits], 0, len(splits)).cast("int")


def hot_split_keys(splits: Sequence[bytes]) -> dict:
    """Split values that occur c >= 2 times: ``{key: (first index, c)}``."""
    out = {}
    for i, s in enumerate(splits):
        s = bytes(s)
        if s in out:
            out[s] = (out[s][0], out[s][1] + 1)
        else:
            out[s] = (i, 1)
    return {k: v for k, v in out.items() if v[1] >= 2}


def range_partition(key, splits: Sequence[bytes], salt: Optional[Column] = None) -> Column:
    """Number of split points <= key: the upper-bound rule of the range partitioner.

    ``splits`` must be sorted, at most COLUMN_LOOKUP_MAX of them; ``assign_partition``
    takes any number.

    Hot keys: a key equal to c >= 2 split points (it fills whole partitions of
    the sample) would leave c-1 partitions empty and put all its rows in one.
    With a ``salt`` (a deterministic per-row hash) its rows are spread over
    those c partitions instead -- they hold only that key, and ties have no
    fixed order, so the total order holds.  Keys equal to one split point keep
    the upper-bound rule.  The salt is only evaluated for hot-key rows.
    """
    k = _c(key)
    if len(splits) == 0:
        return F.lit(0)
    if len(splits) > COLUMN_LOOKUP_MAX:
        raise ValueError(f"{len(splits)} split points; use assign_partition")
    pid = _count_splits(k, splits)
    if salt is None:
        return pid
    for hk, (first, c) in hot_split_keys(splits).items():
        pid = F.when(k == F.lit(hk), F.lit(first + 1) + F.pmod(salt, F.lit(c)).cast("int")) \
               .otherwise(pid)
    return pid.cast("int")


def _range_ids(df: DataFrame, key: str, splits: Sequence[bytes], out: str) -> DataFrame:
    """Upper-bound partition ids: the search tree described above.

    A null key (sorted first) goes to partition 0.  The level tables hold every
    split point once and are broadcast if their bytes allow (``small_table``).
    """
    spark, m, b = df.sparkSession, len(splits), LOOKUP_FANOUT
    stride = 1
    while m // stride >= b:
        stride *= b
    k = F.col(key)
    # separators of a level with this stride are splits[stride - 1], splits[2 * stride - 1], ..
    d = df.drop(out).withColumn(out, _count_splits(k, splits[stride - 1::stride]))
    while stride > 1:
        last, stride = stride, stride // b
        names = [f"_s{i}" for i in range(b - 1)]
        rows = []
        for block in range(m // last + 1):
            at = [block * last + (i + 1) * stride - 1 for i in range(b - 1)]
            rows.append([block, *(bytearray(splits[x]) if x < m else None for x in at)])
        table = spark.createDataFrame(rows, "_block int, " + ", ".join(f"{n} binary" for n in names))
        table = small_table(table, sum(len(x) if x is not None else 0 for r in rows for x in r[1:])
                            + 16 * b * len(rows))
        d = d.join(table, d[out] == table["_block"], "left").withColumn(
            out, (F.col(out) * b + _tree(k, [F.col(n) for n in names], 0, b - 1)).cast("int"))
        d = d.drop("_block", *names)
    return d


def _spread_hot(d: DataFrame, key: str, splits: Sequence[bytes], out: str, salt: Column,
                tie_breaker: Optional[Sequence[str]], source: DataFrame) -> DataFrame:
    """Spread the keys that equal c >= 2 split points over their c partitions.

    Without a tie breaker by the salt; with one by ranges of the tie columns, whose
    bounds come from a hash sample of the hot rows (about TIE_SAMPLE rows per
    partition they fill), so (key, tie) order holds across partitions.  The hot
    keys are rows of a table joined on the partition id.
    """
    hot = hot_split_keys(splits)
    if not hot:
        return d
    spark = d.sparkSession
    rows = [(first + c, bytearray(hk), c) for hk, (first, c) in hot.items()]
    table = spark.createDataFrame(rows, "_hot_pid int, _hot_key binary, _hot_n int")
    if tie_breaker:
        tie = F.struct(*[F.col(c) for c in tie_breaker])
        mine = source.select(F.col(key).alias("_hot_key"), tie.alias("tie")).join(
            small_table(table, sum(len(hk) for hk in hot) + 32 * len(hot)), "_hot_key")
        n = mine.groupBy("_hot_key").agg(F.count(F.lit(1)).alias("n"))
        u = F.pmod(F.xxhash64("tie"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        picked = mine.join(n, "_hot_key").where(u * F.col("n") < F.col("_hot_n") * TIE_SAMPLE)
        bounds = picked.groupBy("_hot_key", "_hot_n").agg(F.sort_array(F.collect_list("tie")).alias("t"))
        # c - 1 even bounds of the sorted sample
        bounds = bounds.select("_hot_key", F.transform(
            F.sequence(F.lit(1), F.col("_hot_n") - 1),
            lambda i: F.get("t", int_div(F.size("t") * i, F.col("_hot_n")).cast("int"))).alias("_ties"))
        table = table.join(bounds, "_hot_key", "left")
        part = F.size(F.filter("_ties", lambda t: t <= tie))
        part = F.when(F.col("_ties").isNull(), F.lit(0)).otherwise(part)
    else:
        part = F.pmod(salt, F.col("_hot_n")).cast("int")
    table = small_table(table, sum(len(hk) for hk in hot) + 32 * len(hot)
                        + (64 * TIE_SAMPLE * sum(c for _, c in hot.values()) if tie_breaker else 0))
    j = d.join(table, d[out] == table["_hot_pid"], "left")
    pid = F.when(F.col(key) == F.col("_hot_key"), F.col(out) - F.col("_hot_n") + 1 + part) \
           .otherwise(F.col(out))
    return j.withColumn(out, pid.cast("int")).drop("_hot_pid", "_hot_key", "_hot_n", "_ties")


def row_salt(df: DataFrame, columns: Optional[Sequence[str]] = None) -> Column:
    """Deterministic per-row salt: xxhash64 of the given (default: all) columns.

    Recomputing a task gives the same salt, so a retried task routes every row
    exactly as before.  Rows that are complete copies share a salt; give a
    position column (e.g. ``file``, ``pos`` from the record source) to split
    those too.
    """
    cols = list(columns) if columns else df.columns
    return F.xxhash64(*[F.col(c) for c in cols])


# D1 ---------------------------------------------------------------------------

def file_blocks(file_rows: DataFrame, block_rows: int, file: str = "file",
                rows: str = "rows") -> DataFrame:
    """Cut every file into blocks of ``block_rows`` records, numbered globally.

    ``file_rows`` has one row per file (e.g. from a listing, or a count), so
    the window below sees one row per file, never one per record.
    """
    per_file = file_rows.select(
        F.col(file).alias("file"),
        int_div(F.col(rows) + F.lit(block_rows - 1), block_rows).alias("nblocks"))
    w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return per_file.withColumn("first_block", F.coalesce(F.sum("nblocks").over(w), F.lit(0))
                               .cast("bigint"))


def sampled_blocks(file_rows: DataFrame, block_rows: int,
                   num_samples: int = DEFAULT_SAMPLE_BLOCKS,
                   sample_size: int = DEFAULT_SAMPLE_SIZE,
                   file: str = "file", rows: str = "rows") -> DataFrame:
    """The blocks the systematic sampler reads: ``(file, block, take)``.

    ``samples = min(num_samples, #blocks)`` blocks, the i-th being block
    ``i * #blocks div samples``, so they reach from the first to the last part of
    the data; ``sample_size div samples`` records of each, one at least.  At most
    ``num_samples`` rows come out.
    """
    fb = file_blocks(file_rows, block_rows, file, rows)
    tot = Window.partitionBy(F.lit(1))
    fb = (fb.withColumn("total", F.sum("nblocks").over(tot))
            .withColumn("samples", F.least(F.lit(num_samples), F.col("total")))
            .where(F.col("samples") > 0))
    def ceil_div(n, d):
        return int_div(n + d - 1, d)
    # block i * total div samples lies in the file from its first to its last i
    first_i = ceil_div(F.col("first_block") * F.col("samples"), F.col("total"))
    last_i = ceil_div((F.col("first_block") + F.col("nblocks")) * F.col("samples"), F.col("total")) - 1
    chosen = fb.where(first_i <= last_i).select(
        "file", "first_block", "samples",
        F.explode(F.transform(F.sequence(first_i, last_i),
                              lambda i: int_div(i * F.col("total"), F.col("samples")))).alias("g"))
    return chosen.select(
        "file", (F.col("g") - F.col("first_block")).alias("block"),
        F.greatest(F.lit(1), int_div(F.lit(sample_size), F.col("samples"))).alias("take"))


def block_sample(df: DataFrame, file_rows: DataFrame, block_rows: int,
                 key: str = "key", file: str = "file", pos: str = "pos",
                 num_samples: int = DEFAULT_SAMPLE_BLOCKS,
                 sample_size: int = DEFAULT_SAMPLE_SIZE) -> DataFrame:
    """Systematic block sample (D1): the first keys of evenly spaced blocks.

    Returns ``(file, block, pos, key)``.  The chosen blocks (at most
    ``num_samples`` rows) are collected and become literal file and position
    ranges, which reach the scan: what is not sampled is skipped.
    """
    blocks = sampled_blocks(file_rows, block_rows, num_samples, sample_size).collect()
    wanted = F.lit(False)
    for b in blocks:
        lo = b["block"] * block_rows
        wanted = wanted | ((F.col(file) == F.lit(b["file"])) &
                           F.col(pos).between(lo, lo + min(b["take"], block_rows) - 1))
    return df.where(wanted).select(
        F.col(file).alias("file"), int_div(F.col(pos), block_rows).alias("block"),
        F.col(pos).alias("pos"), F.col(key).alias("key"))


def file_block_sample(spark, path: str, block_rows: Optional[int] = None,
                      num_samples: int = DEFAULT_SAMPLE_BLOCKS,
                      sample_size: int = DEFAULT_SAMPLE_SIZE,
                      record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """Systematic block sample of a fixed-record dataset, reading only the sample.

    Blocks default to the reader's input splits (128 MB of records).  The
    chosen-block list (at most ``num_samples`` rows) is collected and handed
    to the reader as byte ranges, so at most ``sample_size`` records are read.
    Returns ``(file, block, pos, key)``.
    """
    from sortproof.sources import fixed_record as FR
    if block_rows is None:
        block_rows = max(1, FR.DEFAULT_SPLIT_BYTES // record_length)
    files = FR.file_record_counts(spark, path, record_length)
    chosen = sampled_blocks(files, block_rows, num_samples, sample_size).collect()
    ranges = [(r["file"], r["block"] * block_rows, min(r["take"], block_rows)) for r in chosen]
    recs = FR.read_fixed_records(spark, path, record_length=record_length, ranges=ranges)
    return recs.select("file", int_div(F.col("pos"), block_rows).alias("block"), "pos", "key")


def file_spread_sample(spark, path: str, sample_size: int = DEFAULT_SAMPLE_SIZE,
                       split_bytes: Optional[int] = None, seed: int = 0,
                       record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """A few records from every input split, at seeded offsets: ``(file, pos, key)``.

    Unlike the systematic block sample (the reference's: the first records of
    at most ten blocks), this covers every part of the dataset, so split
    points stay even when the input is already ordered; it still reads only
    about ``sample_size`` records.
    """
    from sortproof.sources import fixed_record as FR
    split_bytes = split_bytes or FR.DEFAULT_SPLIT_BYTES
    per_split = max(1, split_bytes // record_length)
    splits = sum(-(-(size // record_length) // per_split)
                 for _, size in FR.list_files(path) if size >= record_length)
    k = max(1, -(-sample_size // max(1, splits)))
    recs = FR.read_fixed_records(spark, path, record_length=record_length,
                                 split_bytes=split_bytes, sample_per_split=k, sample_seed=seed,
                                 columns=["file", "pos", "key"])
    return recs


# D2, D3, E6 -----------------------------------------------------------------------

def split_point_table(sample: DataFrame, num_partitions: int, key: str = "key") -> DataFrame:
    """Even split points of a (bounded) sample as ``(idx, key)``, idx = 1..p-1.

    Element ``round(n*i/p)`` of the sorted sample, with the rounding done as
    ``(2*n*i + p) div (2*p)`` in exact integers.  The sample is bounded by
    the sampler's ``sample_size``, so ordering it in one task is fine; more than
    MAX_RANKED keys, or fewer than partitions, raise when the table is read.
    """
    p = num_partitions
    ranked = sample.select(
        F.col(key).alias("key"),
        (F.row_number().over(Window.orderBy(F.col(key))) - 1).cast("bigint").alias("rn"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("n"))
    n, rn = F.col("n"), F.col("rn")

    def position(i):
        return int_div(2 * n * i + p, 2 * p)

    # round(n*i/p) = rn has at most one solution i (n >= p), and it is
    # floor(rn*p/n) or the next integer.
    i1 = int_div(rn * p, n)
    i2 = i1 + 1

    def hit(i):
        return (i >= 1) & (i <= p - 1) & (position(i) == rn)

    idx = F.when(hit(i1), i1).when(hit(i2), i2)
    checked = F.when(n < p, F.raise_error(F.concat(
        F.lit(f"{p} partitions need at least as many sampled keys, not "), n.cast("string")))) \
        .when(n > MAX_RANKED, F.raise_error(F.lit(f"a sample of over {MAX_RANKED} keys"))) \
        .otherwise(idx.cast("int"))
    return ranked.select(checked.cast("int").alias("idx"), "key").where(F.col("idx").isNotNull())


def split_points(sample: DataFrame, num_partitions: int, key: str = "key") -> list:
    """Split points as a sorted Python list of bytes (at most p-1 of them).

    Raises ``ValueError`` if the sample has fewer keys than partitions (D3).
    An empty sample gives no split points (one partition).
    """
    if num_partitions <= 1:
        return []
    head = sample.limit(num_partitions).count()
    if head == 0:
        return []
    if head < num_partitions:
        raise ValueError(f"{num_partitions} partitions need at least as many sampled keys, not {head}")
    rows = split_point_table(sample, num_partitions, key).orderBy("idx").collect()
    return [bytes(r["key"]) for r in rows]


def save_split_points(split_table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store split points ``(idx, key)`` as parquet, one small file."""
    split_table.select("idx", "key").coalesce(1).write.mode(mode).parquet(path)


def load_split_points(spark, path: str) -> list:
    """Split points stored by ``save_split_points``, in order (p-1 rows)."""
    rows = spark.read.parquet(path).orderBy("idx").collect()
    return [bytes(r["key"]) for r in rows]


def assign_partition(df: DataFrame, num_partitions: int, method: str = "prefix7",
                     key: str = "key", splits: Optional[Sequence[bytes]] = None,
                     out: str = "pid", salt_columns: Optional[Sequence[str]] = None,
                     spread_hot_keys: bool = True,
                     tie_breaker: Optional[Sequence[str]] = None) -> DataFrame:
    """Add the partition id column for ``method`` in prefix7 | prefix3 | sampled.

    For ``sampled``, keys equal to split points are spread over the partitions
    reserved for them (see ``range_partition``) unless ``spread_hot_keys`` is off:
    by a row hash, or by ranges of the ``tie_breaker`` columns if given.
    """
    if method == "prefix7":
        pid = prefix7_partition(key, num_partitions)
    elif method == "prefix3":
        pid = prefix3_partition(key, num_partitions)
    elif method == "sampled":
        if splits is None:
            raise ValueError("method='sampled' needs split points")
        d = _range_ids(df, key, splits, out)
        if not spread_hot_keys:
            return d
        return _spread_hot(d, key, splits, out, row_salt(df, salt_columns), tie_breaker, df)
    else:
        raise ValueError(f"unknown partition method {method!r}")
    return df.withColumn(out, pid)


def route(df: DataFrame, num_partitions: int, pid: str = "pid") -> DataFrame:
    """Send every row to partition ``pid`` (D9): one pass-through shuffle.

    Ids are clamped to [0, p-1] first because ``repartitionById`` takes them
    modulo p.
    """
    safe = F.least(F.greatest(F.col(pid), F.lit(0)), F.lit(num_partitions - 1)).cast("int")
    return df.withColumn(pid, safe).repartitionById(num_partitions, pid)
