"""Split points from a mergeable quantile sketch over binary keys.

A sketch is a ladder of buffers of keys; a key on step h stands for 2^h records.  A step
of more than ``k`` keys is compacted: sorted, and every other key goes one step up (an
odd one stays).  One compaction moves any rank by at most 2^h, and the sketch adds this
up, so it knows a bound of its own error: about n log2(n / k) / k for n records, in any
order, however often the key repeats.  Which half is taken alternates, without chance.

Sketches are made by one task a partition in one pass over the keys, merged by some
tasks and then by one, a sketch at a time; every sketch has at most k keys a step,
whatever the data.  They merge in any order, so sketches of old files can be kept and
merged with those of new ones.  Null keys (partition 0 of every sort) are left out.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 1 << 14
SCHEMA = "n bigint, error bigint, steps array<array<binary>>"
_ARROW = pa.schema([("n", pa.int64()), ("error", pa.int64()), ("steps", pa.list_(pa.list_(pa.binary())))])


class KeySketch:
    def __init__(self, k: int = DEFAULT_K):
        if k < 2:
            raise ValueError("k must be at least 2")
        self.k, self.n, self.error = k, 0, 0
        self.steps: list = [[]]             # per step: Arrow arrays of keys
        self.odd: list = [0]                # which half the next compaction takes

    def add(self, keys: pa.Array) -> None:
        keys = keys.drop_null()
        self.n += len(keys)
        self._put(0, keys)
        self._settle()

    def merge(self, n: int, error: int, steps: list) -> None:
        """Take in another sketch, as its row."""
        self.n += n
        self.error += error
        for h, keys in enumerate(steps):
            self._put(h, pa.array(keys, pa.binary()))
        self._settle()

    def _put(self, h: int, keys: pa.Array) -> None:
        while len(self.steps) <= h:
            self.steps.append([])
            self.odd.append(0)
        if len(keys):
            self.steps[h].append(keys.cast(pa.binary()))

    def _settle(self) -> None:
        h = 0
        while h < len(self.steps):
            if sum(map(len, self.steps[h])) > self.k:
                keys = pa.concat_arrays(self.steps[h])
                keys = keys.take(pc.sort_indices(keys))
                even = len(keys) // 2 * 2
                self.steps[h] = [keys.slice(even)] if even < len(keys) else []
                self._put(h + 1, keys.take(pa.array(np.arange(self.odd[h], even, 2))))
                self.odd[h] ^= 1
                self.error += 1 << h
            h += 1

    def row(self) -> pa.RecordBatch:
        steps = [pa.concat_arrays(s).to_pylist() if s else [] for s in self.steps]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (self.n, self.error, steps), _ARROW.types)], schema=_ARROW)

    def ranked(self) -> tuple[pa.Array, np.ndarray]:
        """(sorted keys, records up to and with each of them)."""
        parts = [(pa.concat_arrays(s), 1 << h) for h, s in enumerate(self.steps) if s]
        if not parts:
            return pa.array([], pa.binary()), np.zeros(0, np.int64)
        keys = pa.concat_arrays([p for p, _ in parts])
        weight = np.concatenate([np.full(len(p), w, np.int64) for p, w in parts])
        order = pc.sort_indices(keys)
        return keys.take(order), np.cumsum(weight[order.to_numpy()])


def _merged(batches: Iterator[pa.RecordBatch], k: int) -> KeySketch:
    s = KeySketch(k)
    for b in batches:
        for r in b.to_pylist():
            s.merge(r["n"], r["error"], r["steps"])
    return s


def merge_sketches(sketches: DataFrame, k: int = DEFAULT_K, fan: int = 32) -> DataFrame:
    """One sketch of rows of sketches: ``fan`` tasks merge first, then one merges theirs."""
    def run(batches):
        yield _merged(batches, k).row()
    spread = sketches.repartition(fan).mapInArrow(run, SCHEMA)
    return spread.repartition(1).mapInArrow(run, SCHEMA)


def key_sketch(df: DataFrame, key: str = "key", k: int = DEFAULT_K) -> DataFrame:
    """The sketch of a column of binary keys, one row (n, error, steps); n = 0 for an empty table."""
    from sortproof.session import ship_package
    ship_package(df.sparkSession)

    def run(batches):
        s = KeySketch(k)
        for b in batches:
            s.add(b.column(0))
        if s.n:
            yield s.row()
    return merge_sketches(df.select(F.col(key).cast("binary").alias("key")).mapInArrow(run, SCHEMA), k)


def sketch_split_points(sketch: DataFrame, num_partitions: int) -> DataFrame:
    """``(idx, key, target, error, n)``: p - 1 even split points of a sketched table.

    ``target`` is the place (from 0) round(n i / p) that the key should have in the sorted
    table; the places it has lie within ``error`` of it.  No rows for an empty table;
    fewer keys than partitions raise, as sampled split points do.
    """
    p = num_partitions
    if p < 1:
        raise ValueError("num_partitions must be at least 1")

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                s = KeySketch()
                s.k = 1 << 62                # keep what is there
                s.merge(r["n"], r["error"], r["steps"])
                if not s.n:
                    continue
                if s.n < p:
                    raise ValueError(f"{p} partitions need at least as many sampled keys, not {s.n}")
                keys, upto = s.ranked()
                i = np.arange(1, p)
                target = [(2 * s.n * int(x) + p) // (2 * p) for x in i]
                at = np.minimum(np.searchsorted(upto, np.array(target, np.int64), side="right"), len(keys) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, pa.int32()), keys.take(pa.array(at)), pa.array(target, pa.int64()),
                     pa.array([s.error] * (p - 1), pa.int64()), pa.array([s.n] * (p - 1), pa.int64())],
                    names=["idx", "key", "target", "error", "n"])
    return sketch.mapInArrow(run, "idx int, key binary, target bigint, error bigint, n bigint")


def split_points(df: DataFrame, num_partitions: int, key: str = "key", k: int = DEFAULT_K) -> list:
    """Split points of all keys of a table as sorted bytes, by a sketch (p - 1 keys reach the driver)."""
    if num_partitions <= 1:
        return []
    rows = sketch_split_points(key_sketch(df, key, k), num_partitions).select("idx", "key").orderBy("idx").collect()
    return [bytes(r["key"]) for r in rows]
