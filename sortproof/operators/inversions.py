"""How far a table is from its order: the number of inversions, exactly and without a self-join.

An inversion is a pair of rows of one file whose keys fall (the earlier row has the greater
key).  Positions are cut into blocks and keys into ranges, and every pair is counted once:

* rows of one range: each (file, range), in order of position, by a merge count;
* rows of one block but different ranges: the same count over range numbers;
* rows of different blocks and ranges: from the table of rows per (file, block, range),
  by sums over later blocks and lower ranges.

The first two are one shuffle each, of bounded groups: a block has ``block_rows`` rows, and
ranges follow split points of a quantile sketch, each of which is a range of its own: in
a group of equal keys nothing can fall, so it is only counted.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.functions.counts import int_div
from sortproof.operators import quantiles as QS
from sortproof.operators.partition import assign_partition

DEFAULT_BLOCK_ROWS = 1 << 17
GROUP_ROWS, MOST_RANGES = 1 << 20, 4096


def count_inversions(a: np.ndarray) -> int:
    """Pairs i < j with a[i] > a[j], by merging runs bottom up, all runs of a level at once."""
    n = len(a)
    if n < 2:
        return 0
    a = np.unique(a, return_inverse=True)[1].astype(np.int64)
    total, width, top = 0, 1, int(a.max()) + 1
    place = np.arange(n)
    while width < n:
        # of each pair of runs: for every row of the right one, the greater rows of the left
        pair = place // (2 * width)
        right = place // width % 2 == 1
        left = pair[~right] * top + a[~right]          # sorted: runs are, and pairs go up
        ends = np.searchsorted(pair[~right], pair[right], side="right")
        total += int((ends - np.searchsorted(left, pair[right] * top + a[right], side="right")).sum())
        a = a[np.lexsort((a, pair))]
        width *= 2
    return total


def _groups(df: DataFrame, group: list, order: str, value: str) -> DataFrame:
    """(file, inversions) summed over groups; rows come sorted by (group, order), group by group."""
    columns = [*group, value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, out = None, [], {}

        def close():
            if now is not None:
                values = np.concatenate(parts) if isinstance(parts[0], np.ndarray) else pa.concat_arrays(parts)
                if not isinstance(values, np.ndarray):
                    codes = values.dictionary_encode()
                    rank = np.empty(len(codes.dictionary), np.int64)
                    rank[pc.sort_indices(codes.dictionary).to_numpy()] = np.arange(len(rank))
                    values = rank[codes.indices.to_numpy()]
                out[now[0]] = out.get(now[0], 0) + count_inversions(values)

        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(*[b.column(i).to_pylist() for i in range(len(group))]))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            column = b.column(len(group))
            column = column if pa.types.is_binary(column.type) else column.to_numpy(zero_copy_only=False)
            for x, y in zip(cuts, cuts[1:]):
                if keys[x] != now:
                    close()
                    now, parts = keys[x], []
                parts.append(column[x:y] if isinstance(column, np.ndarray) else column.slice(x, y - x))
        close()
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())],
                                         names=["file", "inversions"])
    d = df.repartition(*group).sortWithinPartitions(*group, order).select(*columns)
    return d.mapInArrow(run, "file string, inversions bigint")


def _across(counts: DataFrame, n_ranges: int) -> DataFrame:
    """(file, inversions) between blocks and ranges, from rows (file, block, r, n), by one
    pass over each file's blocks from the last to the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = block = None
        later, mine, out = np.zeros(n_ranges, np.int64), np.zeros(n_ranges, np.int64), {}

        def close():
            nonlocal later, mine
            # rows of a range times the rows of lower ranges in later blocks
            lower = np.concatenate([[0], np.cumsum(later)[:-1]])
            out[file] = out.get(file, 0) + sum(int(x) * int(y) for x, y in zip(mine, lower) if x)
            later, mine = later + mine, np.zeros(n_ranges, np.int64)

        for b in batches:
            for f, k, r, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (f, k) != (file, block):
                    if file is not None:
                        close()
                    if f != file:
                        later = np.zeros(n_ranges, np.int64)
                    file, block = f, k
                mine[r] = n
        if file is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.string()), pa.array([str(x) for x in out.values()], pa.string())],
            names=["file", "inversions"])
    d = counts.repartition("file").sortWithinPartitions("file", F.desc("block"), "r").select("file", "block", "r", "n")
    return d.mapInArrow(run, "file string, inversions string")


def inversions(df: DataFrame, key: str = "key", file: str = "file", pos: str = "pos",
               group_rows: int = GROUP_ROWS, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``(file, rows, inversions)`` of every file; 0 for a sorted one.

    Positions may have gaps but not repeat within a file; files have a name.  Null keys
    sort before all others; equal keys are no inversion.  Counts are DECIMAL(38,0), as a
    file of n rows may have n (n - 1) / 2 of them.  An empty table gives no rows.
    Key ranges hold about ``group_rows`` rows of the largest file (``MOST_RANGES`` of them
    at most, so groups grow again in single files of over 4 billion rows).
    """
    from sortproof.session import shared_dir, ship_package
    spark = df.sparkSession
    ship_package(spark)
    shared_dir(spark)
    d = df.select(F.col(file).cast("string").alias("file"), F.col(pos).cast("long").alias("pos"),
                  F.col(key).cast("binary").alias("key"))
    files = d.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    largest = files.agg(F.max("rows")).first()[0] or 0
    sketch = QS.key_sketch(d, "key")
    n = sketch.first()["n"]
    ranges = max(1, min(MOST_RANGES, -(-largest // group_rows), n))
    splits = {bytes(r["key"]) for r in QS.sketch_split_points(sketch, ranges).collect()} if n else set()
    # a split point has a range of its own, so a key however frequent is never sorted
    bounds = sorted({x for s in splits for x in (s, s + b"\x00")})
    own = [i + 2 for i, x in enumerate(bounds) if x in splits]
    d = assign_partition(d, len(bounds) + 1, "sampled", splits=bounds, out="r", spread_hot_keys=False)
    # 0: null keys
    d = d.withColumn("r", F.when(F.col("key").isNull(), 0).otherwise(F.col("r") + 1)).withColumn(
        "block", int_div(F.col("pos"), block_rows))
    within_range = _groups(d.where((F.col("r") > 0) & ~F.col("r").isin(own)), ["file", "r"], "pos", "key")
    within_block = _groups(d, ["file", "block"], "pos", "r")
    counts = d.groupBy("file", "block", "r").agg(F.count(F.lit(1)).alias("n"))
    wide = lambda x: x.select("file", F.col("inversions").cast("decimal(38,0)").alias("inversions"))
    total = wide(within_range).unionAll(wide(within_block)).unionAll(wide(_across(counts, len(bounds) + 2)))
    total = total.groupBy("file").agg(F.sum("inversions").cast("decimal(38,0)").alias("inversions"))
    return files.join(total, "file").select("file", "rows", "inversions")
