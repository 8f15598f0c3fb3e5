"""Keys that hold more than a share of the rows, exactly.

A first pass keeps a frequent-items summary a task: counters for at most ``counters`` keys;
when there are more, the least of the larger ones is taken off all and counters that
reach nothing go.  What is taken off bounds what any key may have lost, at most
n / counters.  The summaries meet in one aggregate by key.  Every key above the share
stands among those whose counters reach it less the loss: fewer than 4 / (3 share) keys,
which are sent to a second pass that counts their rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.session import small_table


class FrequentKeys:
    """The summary of one task (Misra and Gries, a batch at a time)."""

    def __init__(self, counters: int):
        self.counters, self.n, self.lost = counters, 0, 0
        self.keys, self.count = pa.array([], pa.binary()), np.zeros(0, np.int64)

    def add(self, keys: pa.Array) -> None:
        keys = keys.drop_null()
        self.n += len(keys)
        got = pc.value_counts(keys.cast(pa.binary()))
        self.merge(got.field("values"), got.field("counts").to_numpy(zero_copy_only=False))

    def merge(self, keys: pa.Array, count: np.ndarray) -> None:
        codes = pa.concat_arrays([self.keys, keys]).dictionary_encode()
        total = np.bincount(codes.indices.to_numpy(), np.concatenate([self.count, count]),
                            len(codes.dictionary)).astype(np.int64)
        keys = codes.dictionary
        if len(total) > self.counters:
            off = int(np.partition(total, -self.counters - 1)[-self.counters - 1])
            self.lost += off
            total -= off
            left = total > 0
            keys, total = keys.filter(pa.array(left)), total[left]
        self.keys, self.count = keys, total


def frequent_keys(df: DataFrame, counters: int, key: str = "key") -> DataFrame:
    """``(key, count, lost, n)``: merged counters; the row of a null key has the rows seen
    and what a key may have lost of them."""
    from sortproof.session import ship_package
    ship_package(df.sparkSession)

    def run(batches):
        s = FrequentKeys(counters)
        for b in batches:
            s.add(b.column(0))
        if s.n:
            m = len(s.keys)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([s.keys, pa.nulls(1, pa.binary())]), pa.array([*s.count.tolist(), 0], pa.int64()),
                 pa.array([0] * m + [s.lost], pa.int64()), pa.array([0] * m + [s.n], pa.int64())],
                names=["key", "count", "lost", "n"])
    parts = df.select(F.col(key).cast("binary").alias("key")).mapInArrow(
        run, "key binary, count bigint, lost bigint, n bigint")
    return parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("count", "lost", "n")])


def hot_keys(df: DataFrame, share: float, key: str = "key") -> DataFrame:
    """``(key, rows)`` of every key in more than ``share`` of the rows with a key.

    ``share`` is in (0, 1]; null keys are no keys; an empty table has no hot keys.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    from sortproof.session import shared_dir
    shared_dir(df.sparkSession)
    # at most about 4 / share counters from each task; kept, as two steps read them
    found = frequent_keys(df, math.ceil(4 / share), key).checkpoint(eager=True)
    total = found.where("key is null").select("lost", "n").first()
    if total is None:
        return found.select("key", F.col("count").alias("rows")).limit(0)
    least = share * total["n"] - total["lost"]
    some = found.where(F.col("key").isNotNull() & (F.col("count") >= F.lit(least))).select("key")
    n_some = some.count()
    size = some.agg(F.sum(F.length("key"))).first()[0] or 0
    mine = df.select(F.col(key).cast("binary").alias("key"))
    return mine.join(small_table(some, size + 32 * n_some), "key").groupBy("key").agg(
        F.count(F.lit(1)).alias("rows")).where(F.col("rows") > F.lit(share) * F.lit(total["n"]))
