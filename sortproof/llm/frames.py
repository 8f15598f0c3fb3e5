"""Helpers shared by the operators: tables, cut lineage, hashes, Arrow words."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortproof import session

#: A word of every contract here: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    Used where a costly step is read more than once or a loop would grow its
    plan; the copy survives lost executors.
    """
    spark = df.sparkSession
    session.ship_package(spark)
    session.shared_dir(spark)
    release(spark)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so once the driver has collected the plans that made them, which a large
    heap puts off for long; asking for it where the lineage is cut keeps the disk at
    the files of a step or two instead of those of the whole query.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame) -> DataFrame:
    """As ``cut``, as a compressed table: for larger intermediate results."""
    spark = df.sparkSession
    session.ship_package(spark)
    release(spark)
    path = session.new_output_path(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str, trim: bool = False) -> DataFrame:
    """``mapInArrow`` with this package available to local Python workers.

    With ``trim`` a worker gives the memory it has freed back to the system at the end
    of a task: Spark keeps workers for later stages, which need it for other things.
    """
    session.ship_package(df.sparkSession)
    if not trim:
        return df.mapInArrow(fn, schema)

    def run(batches):
        yield from fn(batches)
        give_back()
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of Arrow's pool and of the C library to the system."""
    import ctypes
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m``; a null id counts as ''."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m)


def unit_hash(*cols: str | Column, seed: int = 0) -> Column:
    """A uniform double in (0, 1) that depends on the columns and seed only."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    h = F.xxhash64(F.lit(seed), *cs)
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * F.lit(2.0 ** -53)


def words(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words of every row: (flat words, row offsets).  Null rows have none."""
    t = pc.fill_null(text, "")
    if lower:
        t = pc.ascii_lower(t)
    lists = pc.ascii_split_whitespace(t)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.not_equal(flat, ""))
    ends = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), ends[offsets]


def slices(batch: pa.RecordBatch, column: str, most: int = 16 << 20):
    """Cut a batch into runs of rows of about ``most`` bytes of ``column``."""
    n = batch.num_rows
    if n == 0:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    run = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))
