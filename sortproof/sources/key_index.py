"""Sparse key index of sorted record files, and reads by key through it.

``build_key_index`` looks at one record in ``block_rows`` and keeps its key: a piece of
first keys for every segment of ``SEGMENT_BLOCKS`` blocks, beside the data files under
``_index``, and a table of one row a segment (its first and last key).  A new index is
a new folder; the file ``current`` names the one in force, so readers see the old one or
the new one.  A data file that is new, or has another size than when it was indexed, is
read in full.

* ``read_key_range``: a scan of only those blocks that may hold keys in a range or a
  list.  The driver compares segment bounds, the tasks search their piece.  Predicates on
  ``key`` use the same way when they are pushed into the source.
* ``lookup``: a table of keys, of any size, joined with the records.  Every key goes to
  the segments whose bounds hold it; tasks read only the blocks that their keys need.

The records of a file must be in key order (null keys can't be stored); ``lookup`` also
needs the files to be in order.  Building raises where indexed keys fall.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from bisect import bisect_left, bisect_right
from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.sources import fixed_record as FR

INDEX_DIR = "_index"
SEGMENT_BLOCKS = 1024

_BOUNDS = ("segment bigint, file string, file_id int, size bigint, first bigint, rows bigint, "
           "first_key binary, last_key binary, piece string, ordered boolean")


def _index_root(path: str) -> str:
    return posixpath.join(path.rstrip("/"), INDEX_DIR)


def current(path: str) -> Optional[dict]:
    """The index in force: its folder, ``block_rows`` and the sizes of its files; None if there is none."""
    from pyarrow import fs as pafs
    fs, root = FR._fs(_index_root(path))
    name = posixpath.join(root, "current")
    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(name) as f:
        got = json.loads(f.read())
    return got | {"folder": posixpath.join(root, got["version"])}


def first_keys(f, record_length: int, key_length: int, first: int, rows: int, block_rows: int) -> list:
    """Keys of the records ``first``, ``first + block_rows``, .. of an open file, and of the last of them."""
    out = []
    for at in [*range(first, first + rows, block_rows), first + rows - 1]:
        f.seek(at * record_length)
        out.append(f.read(key_length))
    return out


def build_key_index(spark: SparkSession, path: str, block_rows: int = 1000,
                    key_length: int = R.KEY_LENGTH, record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """Index a dataset; returns the table of segments.

    Raises ``ValueError`` if indexed keys fall inside a file (the dataset is not sorted);
    disorder between indexed keys is the validation's to find.  An empty dataset gives
    an empty index.  Interrupted builds leave the index in force as it was.
    """
    if block_rows < 1:
        raise ValueError("block_rows must be at least 1")
    from sortproof.session import ship_package
    ship_package(spark)
    files = FR.list_files(path)
    step, version = block_rows * SEGMENT_BLOCKS, uuid.uuid4().hex[:12]
    segments = [(n, name, i, size, first, min(step, size // record_length - first))
                for n, (i, name, size, first) in enumerate(
                    (i, name, size, first) for i, (name, size) in enumerate(files)
                    for first in range(0, size // record_length, step))]
    fs, root = FR._fs(_index_root(path))
    folder = posixpath.join(root, version)
    fs.create_dir(folder, recursive=True)
    todo = spark.createDataFrame(segments, "segment bigint, file string, file_id int, size bigint, first bigint, rows bigint")
    tasks = max(1, min(len(segments), 8 * spark.sparkContext.defaultParallelism))

    def run(batches):
        import pyarrow as pa
        fs, _ = FR._fs(path)
        for b in batches:
            out = []
            for r in b.to_pylist():
                with fs.open_input_file(r["file"]) as f:
                    *keys, last = first_keys(f, record_length, key_length, r["first"], r["rows"], block_rows)
                # a rerun task writes another piece; the row names the one that counts
                piece = f"{r['segment']:010d}-{uuid.uuid4().hex[:8]}.keys"
                with fs.open_output_stream(posixpath.join(folder, piece)) as f:
                    f.write(b"".join(keys))
                out.append(r | {"first_key": keys[0], "last_key": last, "piece": piece,
                                "ordered": all(x <= y for x, y in zip(keys, [*keys[1:], last]))})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(T.StructType.fromDDL(_BOUNDS))
    bounds = todo.repartition(tasks).mapInArrow(run, _BOUNDS)
    scheme = path[:path.index(":") + 1] if path.startswith("file:") else ""
    table = f"{scheme}{folder}/bounds" if "://" not in path or scheme else f"{_index_root(path)}/{version}/bounds"
    bounds.sort("segment").coalesce(1).write.parquet(table)
    bounds = spark.read.parquet(table)
    # within a file a segment may not start below the end of the one before
    w = Window.partitionBy("file_id").orderBy("first")
    falls = bounds.where(~F.col("ordered")).select("file").unionAll(
        bounds.withColumn("before", F.lag("last_key").over(w)).where("first_key < before").select("file"))
    bad = falls.limit(1).collect()
    if bad:
        fs.delete_dir(folder)
        raise ValueError(f"{bad[0]['file']} is not in key order")
    meta = {"version": version, "block_rows": block_rows, "key_length": key_length,
            "record_length": record_length, "files": {name: size for name, size in files}}
    staged = posixpath.join(root, f"current-{version}")
    with fs.open_output_stream(staged) as f:
        f.write(json.dumps(meta).encode())
    fs.move(staged, posixpath.join(root, "current"))
    return bounds


def piece_keys(fs, piece: str, key_length: int) -> list:
    """First keys of the blocks of a segment."""
    with fs.open_input_file(piece) as f:
        data = f.read()
    return [data[i:i + key_length] for i in range(0, len(data), key_length)]


def blocks_of_range(keys: list, lo: Optional[bytes], hi: Optional[bytes]) -> range:
    """Blocks (by their first keys) that may hold keys in [lo, hi]."""
    start = max(0, bisect_left(keys, lo) - 1) if lo is not None else 0
    stop = bisect_right(keys, hi) if hi is not None else len(keys)
    return range(start, max(start, stop))


def blocks_of_keys(keys: list, wanted: Iterable[bytes]) -> list:
    """Runs of neighbouring blocks (as ranges) that may hold any of the wanted keys."""
    return blocks_of_ranges(keys, [(k, k) for k in sorted(wanted)])


def blocks_of_ranges(keys: list, ranges: Iterable[tuple]) -> list:
    """Runs of neighbouring blocks that may hold keys in any of the rising ranges [lo, hi]."""
    out: list = []
    for lo, hi in ranges:
        got = blocks_of_range(keys, lo, hi)
        if not len(got):
            continue
        if out and got.start <= out[-1].stop:
            out[-1] = range(out[-1].start, max(out[-1].stop, got.stop))
        else:
            out.append(got)
    return out


class KeyRange:
    """What is known of the wanted keys: [lo, hi], and possibly a list of them or of ranges."""

    def __init__(self, lo: Optional[bytes] = None, hi: Optional[bytes] = None, keys=None, ranges=None):
        self.lo, self.hi, self.keys, self.ranges = lo, hi, None, ranges
        if keys is not None:
            self.only(keys)

    def only(self, keys) -> None:
        keys = set(keys)
        self.keys = keys if self.keys is None else self.keys & keys
        if self.keys:
            self.above(min(self.keys))
            self.below(max(self.keys))

    def above(self, lo: bytes) -> None:
        self.lo = lo if self.lo is None else max(self.lo, lo)

    def below(self, hi: bytes) -> None:
        self.hi = hi if self.hi is None else min(self.hi, hi)

    def known(self) -> bool:
        return any(x is not None for x in (self.lo, self.hi, self.keys, self.ranges))

    def meets(self, first: bytes, last: bytes) -> bool:
        if self.keys is not None and not any(first <= k <= last for k in self.keys):
            return False
        if self.ranges is not None and not any(
                (lo is None or last >= lo) and (hi is None or first <= hi) for lo, hi in self.ranges):
            return False
        return (self.lo is None or last >= self.lo) and (self.hi is None or first <= self.hi)

    def runs(self, keys: list) -> list:
        if self.keys is not None:
            return blocks_of_keys(keys, self.keys)
        if self.ranges is not None:
            return blocks_of_ranges(keys, self.ranges)
        got = blocks_of_range(keys, self.lo, self.hi)
        return [got] if len(got) else []


def segments_for(path: str, files: list, wanted: KeyRange) -> Optional[tuple]:
    """(index, segments that may hold wanted keys, files to read in full); None without an index.

    The bounds are filtered while they are read, so the driver holds the matching
    segments and the list of files only.
    """
    import pyarrow.parquet as pq
    index = current(path)
    if index is None:
        return None
    fs, _ = FR._fs(path)
    tests = []
    if wanted.lo is not None:
        tests.append(("last_key", ">=", wanted.lo))
    if wanted.hi is not None:
        tests.append(("first_key", "<=", wanted.hi))
    rows = pq.read_table(posixpath.join(index["folder"], "bounds"), filesystem=fs,
                         filters=tests or None).to_pylist()
    same = {name for name, size in files if index["files"].get(name) == size}
    ids = {name: i for i, (name, _) in enumerate(files)}
    found = [r | {"file_id": ids[r["file"]]} for r in rows
             if r["file"] in same and wanted.meets(r["first_key"], r["last_key"])]
    return index, found, [(name, size) for name, size in files if name not in same]


def read_key_range(spark: SparkSession, path: str, lo: Optional[bytes] = None, hi: Optional[bytes] = None,
                   keys: Optional[Iterable[bytes]] = None, **options) -> DataFrame:
    """Records with lo <= key <= hi, or with one of ``keys`` (a list that fits the driver).

    Only the blocks that may hold them are read if the dataset has an index, all of it
    otherwise; the result is the same.  ``options`` are those of ``read_fixed_records``.
    """
    keys = None if keys is None else [bytes(k) for k in keys]
    d = FR.read_fixed_records(spark, path, engine="python", key_from=lo, key_to=hi, keys=keys, **options)
    if lo is not None:
        d = d.where(F.col("key") >= F.lit(lo))
    if hi is not None:
        d = d.where(F.col("key") <= F.lit(hi))
    return d if keys is None else d.where(F.col("key").isin(keys) if keys else F.lit(False))


def read_key_ranges(spark: SparkSession, path: str, ranges: Iterable[tuple], **options) -> DataFrame:
    """Records with lo <= key < hi for one of the ``(lo, hi)``, which rise and do not overlap
    (a list that fits the driver; None is open), in one scan of the blocks that may hold them."""
    ranges = [tuple(None if x is None else bytes(x) for x in r) for r in ranges]
    d = FR.read_fixed_records(spark, path, engine="python", key_ranges=ranges, **options)
    test = F.lit(False)
    for lo, hi in ranges:
        above = F.lit(True) if lo is None else F.col("key") >= F.lit(lo)
        test = test | (above if hi is None else above & (F.col("key") < F.lit(hi)))
    return d.where(test)


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "key") -> DataFrame:
    """``(key, value, file, pos)`` of every record whose key is in a table of keys.

    Repeated and null keys ask once or for nothing.  Keys are dealt by ranges of
    (segment, key), so any number of them in one segment spreads over tasks; a task
    reads the blocks its keys need, a batch of keys at a time.  The dataset must have an
    index that covers all its files, in order; ``ValueError`` otherwise.
    """
    from sortproof.operators.partition import assign_partition
    from sortproof.session import ship_package
    ship_package(spark)
    files = FR.list_files(path)
    index = current(path)
    if index is None or index["files"] != dict(files):
        raise ValueError(f"{path} has no index of its present files")
    _, segments, _ = segments_for(path, files, KeyRange())
    firsts, lasts = ([bytes(r[c]) for r in segments] for c in ("first_key", "last_key"))
    if any(a > b for a, b in zip(lasts, firsts[1:])):
        raise ValueError(f"the files of {path} are not in key order")
    wanted = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    # segments from the first whose last key is not below to the last that starts not above
    d = assign_partition(wanted, len(firsts) + 1, "sampled", splits=firsts, out="after", spread_hot_keys=False)
    # last + 00 is the least key above a last one: those of them up to a key end below it
    d = assign_partition(d, len(lasts) + 1, "sampled", splits=[x + b"\x00" for x in lasts], out="first",
                         spread_hot_keys=False)
    d = d.where("first < after").select(
        F.explode(F.sequence(F.col("first"), F.col("after") - 1)).alias("segment"), "key")
    where = spark.createDataFrame(
        [(i, r["file"], r["first"], r["rows"], r["piece"]) for i, r in enumerate(segments)],
        "segment int, file string, first bigint, rows bigint, piece string")
    from sortproof.session import small_table
    d = d.join(small_table(where, sum(len(r["file"]) + len(r["piece"]) + 40 for r in segments)), "segment")
    d = d.repartitionByRange("segment", "key").sortWithinPartitions("segment", "key")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        fs, _ = FR._fs(path)
        reader = FR.FixedRecordReader({"path": path, "key_length": index["key_length"],
                                       "record_length": index["record_length"]}, None)
        per, known = index["block_rows"], (None, [])
        for b in batches:
            t = pa.Table.from_batches([b])
            for segment in pc.unique(t.column("segment")).to_pylist():
                mine = t.filter(pc.equal(t.column("segment"), segment))
                r = mine.slice(0, 1).to_pylist()[0]
                asked = mine.column("key").combine_chunks()
                if known[0] != segment:
                    known = (segment, piece_keys(fs, posixpath.join(index["folder"], r["piece"]),
                                                 index["key_length"]))
                for run in blocks_of_keys(known[1], asked.to_pylist()):
                    at = r["first"] + run.start * per
                    stop = min(r["first"] + r["rows"], r["first"] + run.stop * per)
                    for got in reader.read(FR.RecordRange(r["file"], at, stop - at, 0)):
                        yield got.filter(pc.is_in(got.column("key"), value_set=asked))

    return d.mapInArrow(run, FR.SCHEMA)
