"""Validation of sorted output (F1-F16).

Input: records with ``file`` (the unit of order, e.g. an output file or a
partition id), ``pos`` (position inside it; unique per file), ``key`` and
``value``.  Nothing is collected; every result is a DataFrame.

Two methods, chosen by a property of the source, not by size:

* contiguous sources (``method='scan'``: the record files, freshly sorted
  partitions -- positions of a file run on without gaps and a task reads them in
  order): the records are read once.  A vectorised per-batch helper cuts each
  task's rows into runs of consecutive positions, compares every key with its
  neighbour inside a run, and emits one summary row per run plus one row per
  misorder.  That run table, about one row per input split, is checkpointed;
  file summaries, run-edge checks (``lag`` over the runs of a file), the
  cross-file check (``lag`` over one row per file) and the checksum all read it.
* any table (default, ``method='window'`` / ``'agg'``): ``lag`` over windows of
  ``(file, pos div block_rows)`` -- one shuffle of every key; block edges come
  from the same window, so a huge (or hot) file never lands in one task.
  Positions may have gaps.

A null key sorts before all keys and, like a null value, counts as no bytes in
the CRC.
"""

from __future__ import annotations

from typing import Iterator, Optional

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortproof.functions import records as R
from sortproof.functions.counts import int_div

DEFAULT_BLOCK_ROWS = 1_000_000
# A run is closed once it holds this many rows, so its CRC sum fits a BIGINT.
MAX_RUN_ROWS = 1 << 30


def _file_name(df: DataFrame, file: str):
    """The unit of order as a string whose order is the files' order.

    Integral ids (e.g. partition ids) are zero-padded, so that 10 sorts after 9.
    """
    c = F.col(file)
    if isinstance(df.schema[file].dataType, T.IntegralType):
        return F.lpad(c.cast("string"), 20, "0")
    return c.cast("string")


def _norm(df: DataFrame, key: str, file: str, pos: str, value: Optional[str]) -> DataFrame:
    cols = [_file_name(df, file).alias("file"), F.col(pos).cast("bigint").alias("pos"),
            F.col(key).alias("key")]
    if value is not None:
        cols.append(F.col(value).alias("value"))
    return df.select(*cols)


def _crc(columns: str):
    none = F.lit(b"")
    if columns == "record":
        return R.crc_record(F.coalesce(F.col("key"), none), F.coalesce(F.col("value"), none))
    if columns == "key":
        return R.crc_key(F.coalesce(F.col("key"), none))
    raise ValueError("columns must be 'record' or 'key'")


# F1, F5, F8, F16 --------------------------------------------------------------------

def file_summary(df: DataFrame, key: str = "key", file: str = "file", pos: str = "pos",
                 value: Optional[str] = "value", columns: str = "record",
                 method: str = "agg") -> DataFrame:
    """``(file, rows, first_key, last_key, checksum)`` per file.

    first/last are the keys at the smallest / largest position, not the
    smallest / largest keys.  ``checksum`` is the exact sum of CRC-32s as
    DECIMAL(38,0); ``columns='key'`` sums key CRCs only.

    ``method='scan'``, for contiguous sources, summarises runs of consecutive
    positions in each task and aggregates only those; ``method='agg'`` (default)
    is one grouped ``min_by`` / ``max_by`` over every record (binary buffers make
    that a sort-based aggregate, so it sorts every input partition by file).
    """
    if method == "scan":
        return summary_from_runs(scan_runs(df, key, file, pos, value, columns,
                                           materialize=False))
    if method != "agg":
        raise ValueError("method must be 'scan' or 'agg'")
    d = _norm(df, key, file, pos, value if columns == "record" else None)
    return d.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by("key", "pos").alias("first_key"),
        F.max_by("key", "pos").alias("last_key"),
        R.checksum_sum(_crc(columns)).alias("checksum"))


def file_bounds(df: DataFrame, key: str = "key", file: str = "file",
                pos: str = "pos", method: str = "agg") -> DataFrame:
    """``(file, first_key, last_key)`` (F1); ``method`` as in ``file_summary``."""
    if method == "scan":
        return file_summary(df, key, file, pos, None, "key").select(
            "file", "first_key", "last_key")
    d = _norm(df, key, file, pos, None)
    return d.groupBy("file").agg(F.min_by("key", "pos").alias("first_key"),
                                 F.max_by("key", "pos").alias("last_key"))


# F2, F3 ---------------------------------------------------------------------------

def _falls(key: str, prev: str):
    """Is ``key`` below ``prev``, null before all?"""
    return F.col(prev).isNotNull() & (F.col(key).isNull() | (F.col(key) < F.col(prev)))


def _misorder_text():
    """Report text of a misorder (fixed: output that must match)."""
    none = F.lit("")
    return F.concat(F.lit("misorder in "), F.col("file"), F.lit(" between "),
                    F.coalesce(R.spaced_hex("prev_key"), none), F.lit(" and "),
                    F.coalesce(R.spaced_hex("key"), none))


def misorders(df: DataFrame, key: str = "key", file: str = "file", pos: str = "pos",
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rows whose key is below the key just before them in the same file (F2).

    ``(file, pos, prev_key, key, detail)``.  Windows run over ``(file, pos div
    block_rows)``; the first row of every block is compared with the last row of
    the previous non-empty block of the file in a second, tiny window.
    """
    d = _norm(df, key, file, pos, None).withColumn("block", int_div(F.col("pos"), block_rows))
    w = Window.partitionBy("file", "block").orderBy("pos")
    d = (d.withColumn("prev_key", F.lag("key").over(w))
          .withColumn("is_first", F.lag("pos").over(w).isNull())
          .withColumn("is_last", F.lead("pos").over(w).isNull()))
    inner = d.where(~F.col("is_first") & _falls("key", "prev_key")).select(
        "file", "pos", "prev_key", "key")
    # Block edges come from the same window: the first row of a block has no
    # previous position, the last no next one.  Among those edge rows (two
    # per block), the row before a block's first row is the previous block's
    # last row.
    edge_rows = d.where(F.col("is_first") | F.col("is_last")).select(
        "file", "pos", "key", "is_first")
    we = Window.partitionBy("file").orderBy("pos")
    edges = (edge_rows.withColumn("prev_key", F.lag("key").over(we))
                      .where(F.col("is_first") & _falls("key", "prev_key"))
                      .select("file", "pos", "prev_key", "key"))
    out = inner.unionByName(edges)
    return out.withColumn("detail", _misorder_text())


# Single-pass scan (F1, F2, F5 in one read) ------------------------------------------

RUN_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),        # 'run' or 'misorder'
    T.StructField("file", T.StringType()),
    T.StructField("pos", T.LongType()),           # run: first pos; misorder: its pos
    T.StructField("last_pos", T.LongType()),
    T.StructField("prev_key", T.BinaryType()),    # misorder only
    T.StructField("key", T.BinaryType()),         # run: first key
    T.StructField("last_key", T.BinaryType()),
    T.StructField("rows", T.LongType()),
    T.StructField("crc", T.LongType()),
    T.StructField("groups", T.LongType()),        # run: groups of equal adjacent keys
])


_RUN_ARROW = pa.schema([("kind", pa.string()), ("file", pa.string()), ("pos", pa.int64()),
                        ("last_pos", pa.int64()), ("prev_key", pa.binary()),
                        ("key", pa.binary()), ("last_key", pa.binary()),
                        ("rows", pa.int64()), ("crc", pa.int64()), ("groups", pa.int64())])


def _runs_batch(file, pos, last_pos, key, last_key, rows, crc, groups) -> pa.RecordBatch:
    n = len(pos)
    return pa.RecordBatch.from_arrays([
        pa.array(["run"] * n, pa.string()), file, pa.array(pos, pa.int64()),
        pa.array(last_pos, pa.int64()), pa.nulls(n, pa.binary()), key, last_key,
        pa.array(rows, pa.int64()), pa.array(crc, pa.int64()),
        pa.array(groups, pa.int64())], schema=_RUN_ARROW)


def _misorder_batch(file, pos, prev_key, key) -> pa.RecordBatch:
    n = len(pos)
    return pa.RecordBatch.from_arrays([
        pa.array(["misorder"] * n, pa.string()), file, pa.array(pos, pa.int64()),
        pa.nulls(n, pa.int64()), prev_key, key, pa.nulls(n, pa.binary()),
        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
        schema=_RUN_ARROW)


def _one_run(r) -> pa.RecordBatch:
    return _runs_batch(pa.array([r[0]], pa.string()), [r[1]], [r[2]],
                       pa.array([r[3]], pa.binary()), pa.array([r[4]], pa.binary()),
                       [r[5]], [r[6]], [r[7]])


def _file_order(t: pa.Table):
    """(files, pos, same): ``same[i]`` = rows i and i+1 are in one file.

    The file column is dictionary-encoded once per batch, so neighbours are
    compared as integers rather than as path strings.
    """
    files = t.column("file").combine_chunks()
    pos = t.column("pos").to_numpy()
    ids = pc.dictionary_encode(files).indices.to_numpy(zero_copy_only=False)
    return files, pos, ids[1:] == ids[:-1]


def _in_order(files: pa.Array, pos: np.ndarray, same: np.ndarray) -> bool:
    """Rows ordered by (file, pos)?  Paths are compared only where the file changes."""
    if not np.all(~same | (pos[1:] > pos[:-1])):
        return False
    change = np.flatnonzero(~same)
    if len(change) == 0:
        return True
    nxt = files.take(pa.array(change + 1))
    cur = files.take(pa.array(change))
    return bool(pc.all(pc.greater(nxt, cur)).as_py())


def _scan_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut each task's rows into runs of consecutive positions of one file.

    Inside a run every key is compared with the one before it; each run is
    reported as one summary row.  All of it is vectorised over the Arrow
    batch; only the run left open at a batch end is carried as Python values.
    A batch whose rows are not in (file, pos) order is sorted locally first,
    so the result never depends on physical row order -- only the number of
    runs does.
    """
    open_run = None  # [file, first_pos, last_pos, first_key, last_key, rows, crc, groups]
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        t = pa.Table.from_batches([b])
        files, pos, same = _file_order(t)
        if not _in_order(files, pos, same):
            t = t.take(pc.sort_indices(t, sort_keys=[("file", "ascending"),
                                                     ("pos", "ascending")]))
            files, pos, same = _file_order(t)
        keys = t.column("key").combine_chunks()
        crc = t.column("crc").to_numpy()
        cont = same & (pos[1:] == pos[:-1] + 1)
        out = []
        lt = pc.fill_null(pc.less(keys[1:], keys[:-1]), False)
        if keys.null_count:             # a null key falls below any other
            lt = pc.or_(lt, pc.and_(pc.is_null(keys[1:]), pc.is_valid(keys[:-1])))
        lt = lt.to_numpy(zero_copy_only=False)
        bad = np.flatnonzero(cont & lt) + 1
        if len(bad):
            out.append(_misorder_batch(files.take(bad), pos[bad], keys.take(bad - 1),
                                       keys.take(bad)))
        starts = np.flatnonzero(np.concatenate([[True], ~cont]))
        ends = np.concatenate([starts[1:], [n]]) - 1
        sums = np.add.reduceat(crc, starts)
        rows = ends - starts + 1
        # groups of equal adjacent keys in each run: 1 + key changes inside it
        ne = pc.not_equal(keys[1:], keys[:-1])
        if keys.null_count:
            ne = pc.fill_null(ne, pc.xor(pc.is_null(keys[1:]), pc.is_null(keys[:-1])))
        ne = ne.to_numpy(zero_copy_only=False)
        changes = np.concatenate([[0], np.cumsum(ne, dtype=np.int64)])
        groups = 1 + changes[ends] - changes[starts]
        first = 0
        if open_run is not None:
            f0, p0, k0 = files[0].as_py(), int(pos[0]), keys[0].as_py()
            if (open_run[0] == f0 and open_run[2] + 1 == p0
                    and open_run[5] + int(rows[0]) <= MAX_RUN_ROWS):
                if open_run[4] is not None and (k0 is None or k0 < open_run[4]):
                    out.append(_misorder_batch(pa.array([f0], pa.string()), [p0],
                                               pa.array([open_run[4]], pa.binary()),
                                               pa.array([k0], pa.binary())))
                e0 = int(ends[0])
                open_run[7] += int(groups[0]) - (1 if k0 == open_run[4] else 0)
                open_run[2], open_run[4] = int(pos[e0]), keys[e0].as_py()
                open_run[5] += int(rows[0])
                open_run[6] += int(sums[0])
                first = 1
            if first < len(starts):
                out.append(_one_run(open_run))
                open_run = None
        last = len(starts) - 1
        if first <= last:
            if first < last:
                sel = slice(first, last)
                st, en = starts[sel], ends[sel]
                out.append(_runs_batch(files.take(st), pos[st], pos[en], keys.take(st),
                                       keys.take(en), rows[sel], sums[sel], groups[sel]))
            a, z = int(starts[last]), int(ends[last])
            open_run = [files[a].as_py(), int(pos[a]), int(pos[z]), keys[a].as_py(),
                        keys[z].as_py(), int(rows[last]), int(sums[last]), int(groups[last])]
        for o in out:
            yield o
    if open_run is not None:
        yield _one_run(open_run)


def scan_runs(df: DataFrame, key: str = "key", file: str = "file", pos: str = "pos",
              value: Optional[str] = "value", columns: str = "record",
              materialize: bool = True) -> DataFrame:
    """One read of the records -> runs and in-run misorders.

    The CRC is computed in the JVM before the Arrow hand-off; the per-batch
    helper only compares neighbours and cuts runs.  The result is small (one
    row per run of consecutive positions, plus one per misorder).  With
    ``materialize`` it is checkpointed to the shared checkpoint folder, so the
    checks built on it never scan the records again.
    """
    d = _norm(df, key, file, pos, value if columns == "record" else None)
    d = d.select("file", "pos", "key", _crc(columns).alias("crc"))
    from sortproof.session import ship_package
    ship_package(df.sparkSession)
    runs = d.mapInArrow(_scan_runs, RUN_SCHEMA)
    if materialize:
        from sortproof.session import shared_dir
        shared_dir(df.sparkSession)
        runs = runs.checkpoint(eager=True)
    return runs


def summary_from_runs(runs: DataFrame) -> DataFrame:
    """``(file, rows, first_key, last_key, checksum)`` from ``scan_runs``."""
    r = runs.where(F.col("kind") == "run")
    return r.groupBy("file").agg(
        F.sum("rows").alias("rows"),
        F.min_by("key", "pos").alias("first_key"),
        F.max_by("last_key", "last_pos").alias("last_key"),
        F.sum(F.col("crc").cast("decimal(38,0)")).cast("decimal(38,0)").alias("checksum"))


def misorders_from_runs(runs: DataFrame) -> DataFrame:
    """In-run misorders plus run edges, as ``misorders`` returns them."""
    inner = runs.where(F.col("kind") == "misorder").select("file", "pos", "prev_key", "key")
    r = runs.where(F.col("kind") == "run")
    w = Window.partitionBy("file").orderBy("pos")
    edges = (r.withColumn("prev_key", F.lag("last_key").over(w))
              .where(_falls("key", "prev_key"))
              .select("file", "pos", "prev_key", "key"))
    return inner.unionByName(edges).withColumn("detail", _misorder_text())


def key_groups_from_runs(runs: DataFrame) -> DataFrame:
    """``(file, key_groups)``: groups of equal adjacent keys per file.

    For a sorted file this is its number of distinct keys, computed from the
    run table -- no second shuffle of the keys.  Runs that meet on an equal
    key are one group, found by ``lag`` over the runs of a file.
    """
    r = runs.where(F.col("kind") == "run")
    w = Window.partitionBy("file").orderBy("pos")
    joined = F.lag("last_key").over(w).eqNullSafe(F.col("key")) & F.lag("pos").over(w).isNotNull()
    return (r.withColumn("joined", joined.cast("long"))
             .groupBy("file").agg((F.sum("groups") - F.sum("joined")).alias("key_groups")))


# F4 ---------------------------------------------------------------------------------

def boundary_table(bounds: DataFrame) -> DataFrame:
    """Every file with its predecessor's last key and a ``bad`` flag."""
    w = Window.orderBy("file")
    b = (bounds.withColumn("prev_file", F.lag("file").over(w))
               .withColumn("prev_last_key", F.lag("last_key").over(w)))
    bad = (F.coalesce(F.col("first_key") < F.col("prev_last_key"), F.lit(False)) |
           (F.col("last_key") < F.col("first_key")))
    return b.select("file", "prev_file", "prev_last_key", "first_key", "last_key",
                    bad.alias("bad"))


def boundary_errors(bounds: DataFrame) -> DataFrame:
    """Cross-file check over ``(file, first_key, last_key)``, files in name order.

    The sequence first_1, last_1, first_2, last_2, ... must never fall: an error
    when a file's first key is below the previous file's last key, or a file's
    last key below its own first key.  ``(file, prev_file, prev_last_key,
    first_key, last_key, detail)``; one row per file goes through the window.
    """
    w = Window.orderBy("file")
    b = (bounds.withColumn("prev_file", F.lag("file").over(w))
               .withColumn("prev_last_key", F.lag("last_key").over(w)))
    cross = F.col("first_key") < F.col("prev_last_key")
    inside = F.col("last_key") < F.col("first_key")
    detail = F.when(cross, F.concat(
        F.lit("bad key partitioning:\n  file "), F.col("prev_file"), F.lit(":end key "),
        R.spaced_hex("prev_last_key"), F.lit("\n  file "), F.col("file"),
        F.lit(":begin key "), R.spaced_hex("first_key"))).otherwise(F.concat(
        F.lit("bad key partitioning:\n  file "), F.col("file"), F.lit(":begin key "),
        R.spaced_hex("first_key"), F.lit("\n  file "), F.col("file"),
        F.lit(":end key "), R.spaced_hex("last_key")))
    return (b.where(cross | inside)
             .select("file", "prev_file", "prev_last_key", "first_key", "last_key",
                     detail.alias("detail")))


# F6, F7, F15 ----------------------------------------------------------------------

def checksum_total(df: DataFrame, key: str = "key", value: Optional[str] = "value",
                   columns: str = "record") -> DataFrame:
    """``(rows, checksum, checksum_hex)`` over all records."""
    cols = [F.col(key).alias("key")]
    if columns == "record":
        cols.append(F.col(value).alias("value"))
    d = df.select(*cols)
    agg = d.agg(F.count(F.lit(1)).alias("rows"),
                F.coalesce(R.checksum_sum(_crc(columns)),
                           F.lit(0).cast("decimal(38,0)")).alias("checksum"))
    return agg.withColumn("checksum_hex", R.decimal_to_hex("checksum"))


def compare_checksums(before: DataFrame, after: DataFrame, key: str = "key",
                      value: Optional[str] = "value", columns: str = "record") -> DataFrame:
    """Same multiset before and after (F15): rows and checksums of both sides."""
    b = checksum_total(before, key, value, columns).select(
        F.col("rows").alias("rows_before"), F.col("checksum").alias("checksum_before"),
        F.lit(1).alias("_k"))
    a = checksum_total(after, key, value, columns).select(
        F.col("rows").alias("rows_after"), F.col("checksum").alias("checksum_after"),
        F.lit(1).alias("_k"))
    j = b.join(a, "_k").drop("_k")
    return j.withColumn("equal", (F.col("rows_before") == F.col("rows_after")) &
                        (F.col("checksum_before") == F.col("checksum_after")))


# F8, F9, F10 ----------------------------------------------------------------------

def partition_summary(sorted_df: DataFrame, key: str = "key", value: Optional[str] = "value",
                      pid: str = "pid", pos: str = "pos", columns: str = "record",
                      method: str = "scan") -> DataFrame:
    """``(pid, rows, first_key, last_key, checksum)``: one row per non-empty partition (F8)."""
    s = file_summary(sorted_df, key, pid, pos, value, columns, method)
    return s.select(F.col("file").cast("int").alias("pid"), "rows", "first_key",
                    "last_key", "checksum")


def partition_stats(sorted_df: DataFrame, key: str = "key", value: Optional[str] = "value",
                    pid: str = "pid", pos: str = "pos",
                    columns: str = "record") -> DataFrame:
    """``(pid, rows, key_groups, first_key, last_key, checksum)`` from one read.

    The sorted data are scanned once into a checkpointed run table; the
    summary and the distinct-key count (groups of equal adjacent keys) both
    come from it, so the sort runs once and keys are never shuffled again.
    """
    runs = scan_runs(sorted_df, key, pid, pos, value, columns)
    summ = summary_from_runs(runs)
    return (summ.join(key_groups_from_runs(runs), "file")
                .select(F.col("file").cast("int").alias("pid"), "rows", "key_groups",
                        "first_key", "last_key", "checksum"))


def partition_checks(summary: DataFrame) -> DataFrame:
    """``(pid, first_le_last, prev_le_first)`` over a partition summary."""
    w = Window.orderBy("pid")
    prev = F.lag("last_key").over(w)
    return summary.select(
        "pid",
        (F.col("first_key") <= F.col("last_key")).alias("first_le_last"),
        F.coalesce(prev <= F.col("first_key"), F.lit(True)).alias("prev_le_first"))


def report_from_summary(summary: DataFrame, mis: DataFrame) -> DataFrame:
    """``(kind, file, detail)`` of file summaries and misorders."""
    mis = mis.select(F.lit("error").alias("kind"), "file", "detail")
    bnd = boundary_errors(summary).select(F.lit("error").alias("kind"), "file", "detail")
    errors = mis.unionByName(bnd)
    total = summary.agg(F.coalesce(F.sum("checksum"), F.lit(0)).cast("decimal(38,0)")
                        .alias("checksum"))
    ok = (total.select(F.lit("checksum").alias("kind"), F.lit(None).cast("string").alias("file"),
                       R.decimal_to_hex("checksum").alias("detail"), F.lit(1).alias("_k"))
               .join(errors.select(F.lit(1).alias("_k")).limit(1), "_k", "left_anti")
               .drop("_k"))
    report = errors.unionByName(ok)
    return report


def report_from_runs(runs: DataFrame, names: Optional[DataFrame] = None) -> DataFrame:
    """The report of a run table; ``names`` ``(file, name)`` replaces file ids by names."""
    if names is not None:
        names = names.select(_file_name(names, "file").alias("file"), "name")
        runs = runs.join(names, "file").withColumn("file", F.col("name")).drop("name")
    return report_from_summary(summary_from_runs(runs), misorders_from_runs(runs))


# F11-F14 ----------------------------------------------------------------------------

def validate(df: DataFrame, key: str = "key", file: str = "file", pos: str = "pos",
             value: Optional[str] = "value", columns: str = "record",
             block_rows: int = DEFAULT_BLOCK_ROWS, raise_on_error: bool = False,
             method: str = "window") -> DataFrame:
    """The validation report (F12): ``(kind, file, detail)``.

    All misorder and boundary errors as ``kind='error'`` rows; when there are
    none, a single ``kind='checksum'`` row with the checksum in hex.  With
    ``raise_on_error`` the report is evaluated and a ``ValueError`` raised if it
    holds errors (F13).

    ``method='window'`` (default) takes any table: a window over ``(file, block)``,
    which shuffles every key.  ``method='scan'``, for contiguous sources, reads the
    records once and shuffles only run summaries.
    """
    if method == "scan":
        report = report_from_runs(scan_runs(df, key, file, pos, value, columns))
    elif method == "window":
        summary = file_summary(df, key, file, pos, value, columns, method="agg")
        mis = misorders(df, key, file, pos, block_rows)
        report = report_from_summary(summary, mis)
    else:
        raise ValueError("method must be 'scan' or 'window'")
    if raise_on_error:
        bad = report.where(F.col("kind") == "error").limit(1).collect()
        if bad:
            raise ValueError("Data validation failed: " + bad[0]["detail"])
    return report
