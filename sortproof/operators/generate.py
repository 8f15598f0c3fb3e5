"""Reproducible record generation.

``spark.range`` gives the row numbers and their partitioning; one
``mapInArrow`` turns each Arrow batch of row numbers into 100-byte records with
numpy (one skip-ahead per batch, then a vectorised run).  The output does not
depend on the number of partitions or batches: record n is a pure function of n.
"""

from __future__ import annotations

from typing import Iterator, Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortproof.functions import lcg
from sortproof.functions import records as R
from sortproof.functions.counts import int_div

# --- fixed values: record marks ------------------------------------------------
BINARY_MARK_1 = bytes([0x00, 0x11])
BINARY_MARK_2 = bytes([0x88, 0x99, 0xAA, 0xBB])
BINARY_MARK_3 = bytes([0xCC, 0xDD, 0xEE, 0xFF])
ASCII_MARK = b"  "
ASCII_END = b"\r\n"
HEX_DIGITS = b"0123456789ABCDEF"
# -----------------------------------------------------------------------------

_HEX = np.frombuffer(HEX_DIGITS, dtype=np.uint8)
ROWS_PER_TASK = 5_000_000


# two hex characters for every byte value
_HEX2 = np.stack([_HEX[np.arange(256) >> 4], _HEX[np.arange(256) & 15]], axis=1)


def _hex_of_bytes(b: np.ndarray) -> np.ndarray:
    """(n, k) bytes -> (n, 2k) upper-case hex characters, by table lookup."""
    return np.take(_HEX2, b, axis=0).reshape(b.shape[0], 2 * b.shape[1])


def _fill_fourfold(rec: np.ndarray, offset: int, digits: np.ndarray) -> None:
    """Write every digit four times from byte ``offset`` on, in place."""
    n, k = digits.shape
    view = rec[:, offset: offset + 4 * k]
    view.shape = (n, k, 4)          # a view: raises rather than copy
    view[...] = digits[:, :, None]


def build_records(rows: np.ndarray, ascii: bool = False) -> np.ndarray:
    """(n, 100) uint8 array: the records for the given row numbers."""
    n = len(rows)
    s = lcg.states(rows)
    state = np.stack([s[3], s[2], s[1], s[0]], axis=1).astype(">u4").view(np.uint8)
    state = state.reshape(n, 16)                 # the 128-bit state, big-endian
    rec = np.empty((n, R.RECORD_LENGTH), dtype=np.uint8)
    rec[:, 12:28] = ord("0")                     # high 64 bits of the row number are zero
    rec[:, 28:44] = _hex_of_bytes(rows.astype(">u8").view(np.uint8).reshape(n, 8))
    if not ascii:
        rec[:, 0:10] = state[:, :10]             # key: top 10 bytes of the state
        rec[:, 10:12] = np.frombuffer(BINARY_MARK_1, dtype=np.uint8)
        rec[:, 44:48] = np.frombuffer(BINARY_MARK_2, dtype=np.uint8)
        digits = _hex_of_bytes(state[:, 10:16])  # state hex digits 20..31
        _fill_fourfold(rec, 48, digits)
        rec[:, 96:100] = np.frombuffer(BINARY_MARK_3, dtype=np.uint8)
    else:
        base = np.uint64(95)
        space = np.uint64(32)
        t = (s[3] << np.uint64(32)) | s[2]
        for j in range(8):
            rec[:, j] = space + t % base
            t = t // base
        t = (s[1] << np.uint64(32)) | s[0]
        for j in (8, 9):
            rec[:, j] = space + t % base
            t = t // base
        rec[:, 10:12] = np.frombuffer(ASCII_MARK, dtype=np.uint8)
        rec[:, 44:46] = np.frombuffer(ASCII_MARK, dtype=np.uint8)
        digits = _hex_of_bytes(state[:, 9:16])[:, 1:]   # state hex digits 19..31
        _fill_fourfold(rec, 46, digits)
        rec[:, 98:100] = np.frombuffer(ASCII_END, dtype=np.uint8)
    return rec


def fixed_binary_array(block: np.ndarray) -> pa.Array:
    """(n, w) uint8 -> Arrow ``binary`` array of n values of w bytes, zero copy of rows."""
    n, w = block.shape
    data = np.ascontiguousarray(block)
    offsets = np.arange(0, (n + 1) * w, w, dtype=np.int32) if n * w < 2 ** 31 else None
    if offsets is None:
        return pa.array([bytes(r) for r in data], type=pa.binary())
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets),
                                                  pa.py_buffer(data)])


def _generator(row_col: str, ascii: bool):
    def gen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(row_col).to_numpy(zero_copy_only=False).astype(np.int64)
            if (rows < 0).any():
                raise ValueError("row numbers must be non-negative")
            rec = build_records(rows, ascii)
            key = fixed_binary_array(rec[:, :R.KEY_LENGTH])
            value = fixed_binary_array(rec[:, R.KEY_LENGTH:])
            cols = list(batch.columns) + [key, value]
            names = list(batch.schema.names) + ["key", "value"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return gen


def with_records(df: DataFrame, row_col: str = "id", ascii: bool = False) -> DataFrame:
    """Append ``key`` and ``value`` of record ``row_col`` to every row.

    Row numbers may come in any order and from any table; consecutive runs
    inside an Arrow batch take the fast path.  The column must be non-null.
    """
    from sortproof.session import ship_package
    ship_package(df.sparkSession)
    schema = T.StructType(df.schema.fields + [
        T.StructField("key", T.BinaryType(), False),
        T.StructField("value", T.BinaryType(), False)])
    return df.mapInArrow(_generator(row_col, ascii), schema)


def generate_records(spark: SparkSession, num_rows: int, start: int = 0,
                     ascii: bool = False, num_partitions: Optional[int] = None) -> DataFrame:
    """Records ``start .. start+num_rows-1`` as ``(row, key, value)``.

    ``spark.range`` splits the rows; every task generates its own rows with no
    shuffle, and the result is the same for any ``num_partitions``.  Exactly
    ``num_rows`` rows are produced.
    """
    if num_rows < 0 or start < 0:
        raise ValueError("num_rows and start must be non-negative")
    if num_partitions is None:
        # about 500 MB of records per task, and at least one task per core
        num_partitions = max(spark.sparkContext.defaultParallelism,
                             -(-num_rows // ROWS_PER_TASK))
    base = spark.range(start, start + num_rows, 1, num_partitions)
    return with_records(base, "id", ascii).select(F.col("id").alias("row"), "key", "value")


def range_splits(total_rows, num_splits: int) -> DataFrame:
    """The generator's row cut for ``num_splits`` tasks (A1).

    Split i ends at ceil(N*(i+1)/p), in exact integer arithmetic.  ``total_rows``
    is a DataFrame with one BIGINT column ``n`` (e.g. a table's count), so the
    cut is a plan, not a driver loop.
    """
    p = num_splits
    if p < 1:
        raise ValueError("num_splits must be >= 1")
    n = F.col("n").cast("bigint")
    s = F.col("split").cast("bigint")

    def ceil_div(a):
        return int_div(a + F.lit(p - 1), p)

    first = ceil_div(n * s)
    end = ceil_div(n * (s + 1))
    return (total_rows.select(F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("split"), "n")
            .select(F.col("split").cast("int").alias("split"),
                    first.alias("first_row"), (end - first).alias("row_count")))


def generation_checksum(records: DataFrame) -> DataFrame:
    """(rows, checksum) of generated records (C7): partial + final sum."""
    return records.agg(F.count(F.lit(1)).alias("rows"),
                       R.checksum_sum(R.crc_record()).alias("checksum"))
