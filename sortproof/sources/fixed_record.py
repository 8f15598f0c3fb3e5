"""``fixed_record``: a Spark data source for files of fixed-width binary records.

Read:  ``spark.read.format("fixed_record").load(path)`` ->
       ``key BINARY, value BINARY, file STRING, pos BIGINT``.
       Files are cut into byte ranges on record boundaries (one input
       partition each); a record belongs to the range it starts in.  A file
       whose length is not a multiple of the record length fails the read
       (a truncated last record), a clean end does not.
Write: ``df.write.format("fixed_record").mode(...).save(path)`` with ``key`` and
       ``value`` columns: key bytes then value bytes, no separators, one file
       ``part-NNNNNNNNNN`` per partition, so that name order is partition order.
       Every task attempt writes its own temporary file; the driver renames
       the committed ones (a lost executor just reruns its task) and removes
       the rest on abort.  ``overwrite`` leaves the old files in place until
       all new ones are written; they are set aside, replaced and only then
       deleted, so a failed job leaves the dataset as it was and a dataset
       may be rewritten from itself.

File access goes through ``pyarrow.fs`` (local, HDFS, S3, GCS, ...).

``read_fixed_records`` scans whole datasets on local and HDFS paths inside the JVM:
Hadoop's fixed-length input splits become rows without a Python worker, with the
same columns.  The data source above serves the other cases (chosen ranges, samples,
predicates pushed into the reader, other stores).
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass, replace
from typing import Iterator, List

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull,
                                    InputPartition, LessThan, LessThanOrEqual,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from sortproof.functions import records as R
from sortproof.session import small_table

FORMAT = "fixed_record"
SCHEMA = "key binary, value binary, file string, pos bigint"
# Columns a reader can produce; a user schema picks any subset, in any order.
# file_id is the index of the file in path order: a cheap stand-in for file.
COLUMN_TYPES = {"key": "binary", "value": "binary", "file": "string", "pos": "bigint",
                "file_id": "int"}
DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024
READ_CHUNK_RECORDS = 65536
SAMPLE_RUN = 8              # records per contiguous read of the spread sampler


def part_name(partition: int, suffix: str = "") -> str:
    """Name of a partition's file; wide enough that name order is partition order
    for any INT partition id."""
    return f"part-{partition:010d}{suffix}"


def _fs(path: str):
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        # file:/x, file:///x and file://localhost/x are one local path
        from urllib.parse import unquote, urlsplit
        return pafs.LocalFileSystem(), posixpath.normpath("/" + unquote(urlsplit(path).path).lstrip("/"))
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), posixpath.abspath(path)


def same_path(a: str, b: str) -> bool:
    """Do two paths name one place?"""
    (fa, pa_), (fb, pb) = _fs(a), _fs(b)
    return fa == fb and posixpath.normpath(pa_) == posixpath.normpath(pb)


def exists(path: str) -> bool:
    from pyarrow import fs as pafs
    fs, p = _fs(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def append_bytes(path: str, name: str, data: bytes) -> None:
    """Put a small file of raw bytes into a dataset folder (for checks of the reader)."""
    fs, base = _fs(path)
    with fs.open_output_stream(posixpath.join(base, name)) as out:
        out.write(data)


def split_count(path: str, record_length: int = R.RECORD_LENGTH,
                split_bytes: int = 128 * 1024 * 1024) -> int:
    """Number of input splits of a dataset."""
    per = max(1, split_bytes // record_length)
    return sum(-(-(size // record_length) // per) for _, size in list_files(path))


def _hidden(name: str) -> bool:
    return name.startswith("_") or name.startswith(".")


def list_files(path: str):
    """(full path, size) of the data files under ``path``, sorted by path."""
    from pyarrow import fs as pafs
    fs, p = _fs(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{path} does not exist")
    if info.type == pafs.FileType.File:
        return [(p, info.size)]
    out = []
    for f in fs.get_file_info(pafs.FileSelector(p, recursive=True)):
        if f.type == pafs.FileType.File and not _hidden(posixpath.basename(f.path)):
            rel = posixpath.relpath(f.path, p)
            if not any(_hidden(part) for part in rel.split("/")):
                out.append((f.path, f.size))
    return sorted(out)


@dataclass
class RangeGroup(InputPartition):
    """Several small record ranges read by one task (the spread sampler)."""
    ranges: list     # [(path, first, count, file_id), ...]


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int       # first record index
    count: int       # records in this range
    tail: int        # bytes after the last whole record when this range ends the file
    file_id: int = 0  # index of the file in path order


@dataclass
class IndexedRange(RecordRange):
    """Records of one segment of a sorted file, of which only blocks by key are read."""
    piece: str = ""          # file of the segment's first keys
    block_rows: int = 1
    segment_first: int = 0   # the segment's first record


class FixedRecordReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixed_record: option 'path' is required")
        self.key_length = int(options.get("key_length", R.KEY_LENGTH))
        self.record_length = int(options.get("record_length", R.RECORD_LENGTH))
        self.split_bytes = int(options.get("split_bytes", DEFAULT_SPLIT_BYTES))
        self.ranges = json.loads(options.get("ranges", "null"))
        self.sample_per_split = int(options.get("sample_per_split", "0"))
        self.sample_seed = int(options.get("sample_seed", "0"))
        self.wanted = _wanted_keys(options)
        if not 0 < self.key_length <= self.record_length:
            raise ValueError("need 0 < key_length <= record_length")
        self.columns = list(schema.fieldNames()) if schema is not None else \
            ["key", "value", "file", "pos"]
        unknown = [c for c in self.columns if c not in COLUMN_TYPES]
        if unknown:
            raise ValueError(f"fixed_record: unknown columns {unknown}; "
                             f"choose from {sorted(COLUMN_TYPES)}")

    def partitions(self) -> List[InputPartition]:
        if self.ranges is not None:
            return self._restrict(self._range_partitions())
        if self.sample_per_split > 0:
            picks = self._restrict(self._spread_sample_ranges())
            group = 1024   # about a thousand short ranges per task
            return [RangeGroup([(r.path, r.first, r.count, r.file_id) for r in picks[i:i + group]])
                    for i in range(0, len(picks), group)]
        return self._restrict(self._by_key())

    def _by_key(self) -> List[InputPartition]:
        """The input splits, or the segments that may hold the wanted keys."""
        from sortproof.sources import key_index as K
        listing = list_files(self.path)
        found = K.segments_for(self.path, listing, self.wanted) if self.wanted.known() else None
        if found is None or found[0]["record_length"] != self.record_length \
                or found[0]["key_length"] != self.key_length:
            return self._split_partitions()
        index, segments, other = found
        other = {name for name, _ in other}
        return [p for p in self._split_partitions() if p.path in other] + [
            IndexedRange(r["file"], r["first"], r["rows"], 0, r["file_id"],
                         posixpath.join(index["folder"], r["piece"]), index["block_rows"], r["first"])
            for r in segments]

    def _spread_sample_ranges(self) -> List[RecordRange]:
        """``sample_per_split`` records from every input split.

        They are taken as short runs spaced evenly through the split, with a
        seeded phase, so the sample covers the whole dataset (whatever its
        order) while reading a tiny part of it.
        """
        import zlib
        k = self.sample_per_split
        picks = []
        for r in self._split_partitions():
            if r.count == 0:
                continue
            if k >= r.count:
                picks.append(RecordRange(r.path, r.first, r.count, 0, r.file_id))
                continue
            run = min(SAMPLE_RUN, k)
            n_runs = -(-k // run)
            stride = r.count // n_runs
            h = zlib.crc32(f"{self.sample_seed}:{r.path}:{r.first}".encode())
            left = k
            for j in range(n_runs):
                take = min(run, left, stride)
                start = r.first + j * stride + (h + 7919 * j) % (stride - take + 1)
                picks.append(RecordRange(r.path, start, take, 0, r.file_id))
                left -= take
        return picks

    def _split_partitions(self) -> List[InputPartition]:
        per_split = max(1, self.split_bytes // self.record_length)
        parts: List[InputPartition] = []
        for file_id, (path, size) in enumerate(list_files(self.path)):
            n = size // self.record_length
            tail = size - n * self.record_length
            if n == 0:
                if tail:
                    parts.append(RecordRange(path, 0, 0, tail, file_id))
                continue
            for first in range(0, n, per_split):
                count = min(per_split, n - first)
                last = first + count == n
                parts.append(RecordRange(path, first, count, tail if last else 0, file_id))
        return parts

    def _restrict(self, parts: List[InputPartition]) -> List[InputPartition]:
        return parts

    def _range_partitions(self) -> List[InputPartition]:
        """Only the given ``[file, first record, count]`` ranges (e.g. sampled blocks)."""
        listing = list_files(self.path)
        sizes = dict(listing)
        ids = {f: i for i, (f, _) in enumerate(listing)}
        parts: List[InputPartition] = []
        for path, first, count in self.ranges:
            if path not in sizes:
                raise FileNotFoundError(f"{path} is not a data file under {self.path}")
            n = sizes[path] // self.record_length
            first = max(0, int(first))
            count = max(0, min(int(count), n - first))
            if count:
                parts.append(RecordRange(path, first, count, 0, ids[path]))
        return parts

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:       # no input partition at all: an empty dataset
            return
        if isinstance(partition, RangeGroup):
            for path, first, count, file_id in partition.ranges:
                yield from self._read_range(RecordRange(path, first, count, 0, file_id))
            return
        if isinstance(partition, IndexedRange):
            yield from self._read_blocks(partition)
            return
        yield from self._read_range(partition)

    def _read_blocks(self, part: IndexedRange) -> Iterator[pa.RecordBatch]:
        """The blocks of a segment that may hold wanted keys, cut to the range's records."""
        from sortproof.sources import key_index as K
        fs, _ = _fs(self.path)
        per = part.block_rows
        for run in self.wanted.runs(K.piece_keys(fs, part.piece, self.key_length)):
            first = max(part.first, part.segment_first + run.start * per)
            stop = min(part.first + part.count, part.segment_first + run.stop * per)
            if first < stop:
                yield from self._read_range(RecordRange(part.path, first, stop - first, 0, part.file_id))

    def _read_range(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        from sortproof.operators.generate import fixed_binary_array
        if partition.tail:
            raise EOFError(f"truncated file: {partition.path} ends with a partial record "
                           f"of {partition.tail} bytes")
        fs, _ = _fs(self.path)
        rl, kl = self.record_length, self.key_length
        with fs.open_input_file(partition.path) as f:
            f.seek(partition.first * rl)
            done = 0
            while done < partition.count:
                k = min(READ_CHUNK_RECORDS, partition.count - done)
                buf = f.read(k * rl)
                if len(buf) != k * rl:
                    raise EOFError(f"truncated file: {partition.path} is shorter than when it was listed")
                block = np.frombuffer(buf, dtype=np.uint8).reshape(k, rl)
                cols = []
                for c in self.columns:
                    if c == "key":
                        cols.append(fixed_binary_array(block[:, :kl]))
                    elif c == "value":
                        cols.append(fixed_binary_array(block[:, kl:]))
                    elif c == "file":
                        cols.append(pa.array(np.full(k, partition.path, dtype=object),
                                             type=pa.string()))
                    elif c == "pos":
                        cols.append(pa.array(np.arange(partition.first + done,
                                                       partition.first + done + k,
                                                       dtype=np.int64)))
                    else:
                        cols.append(pa.array(np.full(k, partition.file_id, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays(cols, names=self.columns)
                done += k


def _wanted_keys(options):
    from sortproof.sources.key_index import KeyRange
    lo, hi, keys, ranges = (options.get(k) for k in ("key_from", "key_to", "keys", "key_ranges"))
    plain = lambda x: None if x is None else bytes.fromhex(x)
    return KeyRange(plain(lo), plain(hi), [bytes.fromhex(k) for k in json.loads(keys)] if keys is not None else None,
                    [tuple(map(plain, r)) for r in json.loads(ranges)] if ranges is not None else None)


class PrunedFixedRecordReader(FixedRecordReader):
    """Reader that takes ``file``, ``file_id`` and ``pos`` predicates: whole input splits
    and files are skipped, and ranges are cut to the asked positions, so the
    predicates are applied exactly here and never reach Spark again.  Predicates on
    ``key`` choose the blocks to read where the dataset has a sparse index; Spark
    applies them again to the records of those blocks."""

    def __init__(self, options, schema: StructType):
        super().__init__(options, schema)
        self.pos_lo = 0
        self.pos_hi = None
        self.files = None
        self.file_ids = None

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if len(f.attribute) == 1 else None
            if col in ("pos", "file", "file_id", "key", "value") and isinstance(f, IsNotNull):
                continue  # no column of this source is ever null
            if col == "key":
                self._key_filter(f)
                yield f
                continue
            if col == "pos" and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan,
                                               LessThanOrEqual, EqualTo)) \
                    and isinstance(f.value, int) and not isinstance(f.value, bool):
                v = f.value
                lo, hi = {GreaterThan: (v + 1, None), GreaterThanOrEqual: (v, None),
                          LessThan: (None, v), LessThanOrEqual: (None, v + 1),
                          EqualTo: (v, v + 1)}[type(f)]
                if lo is not None:
                    self.pos_lo = max(self.pos_lo, lo)
                if hi is not None:
                    self.pos_hi = hi if self.pos_hi is None else min(self.pos_hi, hi)
            elif col == "file" and isinstance(f, (EqualTo, In)):
                vals = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.files = vals if self.files is None else self.files & vals
            elif col == "file_id" and isinstance(f, (EqualTo, In)):
                vals = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.file_ids = vals if self.file_ids is None else self.file_ids & vals
            else:
                yield f

    def _key_filter(self, f) -> None:
        if isinstance(f, In) and all(isinstance(v, bytes) for v in f.value):
            self.wanted.only(f.value)
        elif isinstance(getattr(f, "value", None), bytes):
            if isinstance(f, EqualTo):
                self.wanted.only([f.value])
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.wanted.above(f.value)
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.wanted.below(f.value)

    def _restrict(self, parts: List[InputPartition]) -> List[InputPartition]:
        out = []
        for r in parts:
            if self.files is not None and r.path not in self.files:
                continue
            if self.file_ids is not None and r.file_id not in self.file_ids:
                continue
            end = r.first + r.count
            first = max(r.first, self.pos_lo)
            stop = end if self.pos_hi is None else min(end, self.pos_hi)
            if stop <= first and not (r.tail and stop == end):
                continue  # nothing asked for in this range
            out.append(replace(r, first=first, count=max(0, stop - first),
                               tail=r.tail if stop == end else 0))
        return out


@dataclass
class WrittenFile(WriterCommitMessage):
    partition: int
    temp_path: str
    rows: int
    bytes: int


def _column_block(arr: pa.Array, width: int, what: str) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes, as an (n, width) array."""
    if arr.null_count:
        raise ValueError(f"fixed_record: null {what}")
    large = pa.types.is_large_binary(arr.type)
    if not (large or pa.types.is_binary(arr.type)):
        arr = arr.cast(pa.binary())
    n = len(arr)
    if n == 0:
        return np.empty((0, width), dtype=np.uint8)
    odt = np.int64 if large else np.int32
    offsets = np.frombuffer(arr.buffers()[1], dtype=odt)[arr.offset: arr.offset + n + 1]
    if not np.all(np.diff(offsets) == width):
        raise ValueError(f"fixed_record: every {what} must be {width} bytes")
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)
    return data[offsets[0]: offsets[0] + n * width].reshape(n, width)


def _remove_if_empty(fs, path: str) -> None:
    from pyarrow import fs as pafs
    try:
        if not fs.get_file_info(pafs.FileSelector(path)):
            fs.delete_dir(path)
    except Exception:
        pass


class FixedRecordWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixed_record: output path is required")
        self.key_length = int(options.get("key_length", R.KEY_LENGTH))
        self.record_length = int(options.get("record_length", R.RECORD_LENGTH))
        self.job = uuid.uuid4().hex[:12]
        self.append = options.get("allow_existing", "false").lower() == "true"
        self.overwrite = overwrite
        from pyarrow import fs as pafs
        fs, p = _fs(self.path)
        exists = fs.get_file_info(p).type != pafs.FileType.NotFound
        if exists and not overwrite and not self.append:
            raise FileExistsError(f"{self.path} exists; choose another output or mode='overwrite'")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        fs, base = _fs(self.path)
        tmp_dir = posixpath.join(base, "_temporary", self.job)
        fs.create_dir(tmp_dir, recursive=True)
        tmp = posixpath.join(tmp_dir, f"{part_name(pid)}-attempt-{attempt}-{uuid.uuid4().hex[:8]}")
        kl, vl = self.key_length, self.record_length - self.key_length
        rows = 0
        with fs.open_output_stream(tmp) as out:
            for batch in iterator:
                n = batch.num_rows
                if n == 0:
                    continue
                k = _column_block(batch.column("key"), kl, "key")
                v = _column_block(batch.column("value"), vl, "value")
                rec = np.empty((n, kl + vl), dtype=np.uint8)
                rec[:, :kl] = k
                rec[:, kl:] = v
                out.write(rec)
                rows += n
        return WrittenFile(pid, tmp, rows, rows * self.record_length)

    def commit(self, messages: List[WrittenFile]) -> None:
        from concurrent.futures import ThreadPoolExecutor
        fs, base = _fs(self.path)
        # appended files carry the job id, so they never replace earlier ones
        suffix = f"-{self.job}" if self.append else ""
        moves = [(m.temp_path, posixpath.join(base, part_name(m.partition, suffix)))
                 for m in messages if m is not None]
        job_dir = posixpath.join(base, "_temporary", self.job)
        fs.create_dir(job_dir, recursive=True)
        old = []
        if self.overwrite:
            from pyarrow import fs as pafs
            old = [(f.path, posixpath.join(job_dir, "replaced", f.base_name))
                   for f in fs.get_file_info(pafs.FileSelector(base)) if f.base_name != "_temporary"]
            fs.create_dir(posixpath.join(job_dir, "replaced"), recursive=True)
        # one rename per output file; object stores make each a copy, so
        # run them concurrently
        with ThreadPoolExecutor(max_workers=min(32, max(1, len(moves)))) as pool:
            done = []

            def move(mv):
                fs.move(*mv)
                done.append(mv)
            try:
                list(pool.map(move, old))
                list(pool.map(move, moves))
            except Exception:
                for a, b in reversed(done):     # back to how it was
                    fs.move(b, a)
                raise
        fs.delete_dir(job_dir)
        _remove_if_empty(fs, posixpath.join(base, "_temporary"))
        with fs.open_output_stream(posixpath.join(base, "_SUCCESS")):
            pass

    def abort(self, messages: List[WrittenFile]) -> None:
        fs, base = _fs(self.path)
        try:
            fs.delete_dir(posixpath.join(base, "_temporary", self.job))
            _remove_if_empty(fs, posixpath.join(base, "_temporary"))
        except Exception:
            pass


class FixedRecordDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        # Spark refuses a reader with filter pushdown unless the session
        # enables it; read_fixed_records sets this option from that conf.
        if self.options.get("pushdown", "false").lower() == "true":
            return PrunedFixedRecordReader(self.options, schema)
        return FixedRecordReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> FixedRecordWriter:
        names = set(schema.fieldNames())
        if not {"key", "value"} <= names:
            raise ValueError("fixed_record: the DataFrame needs 'key' and 'value' columns")
        return FixedRecordWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    from sortproof.session import ship_package
    ship_package(spark)
    spark.dataSource.register(FixedRecordDataSource)


def scans_in_jvm(spark: SparkSession, path: str) -> bool:
    """Can a whole dataset be read without Python workers?

    It needs a classic session (not Spark Connect), a local or HDFS path free of the
    characters that Hadoop reads as patterns, and no wish to push predicates down.
    """
    if not hasattr(spark, "_jsparkSession") or _pushdown(spark):
        return False
    if "://" in path and not path.startswith(("file:", "hdfs:")):
        return False
    return not set(path) & set("{}[]*?\\,")


def _pushdown(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower() == "true"


def _jvm_scan(spark: SparkSession, path: str, key_length: int, record_length: int,
              split_bytes: int, columns) -> DataFrame:
    """The records of a dataset through Hadoop's fixed-length splits.

    A split starts and ends between records.  ``file`` is the split's file, ``pos`` the
    split's first record plus the row's place in its partition, which is one split.  HDFS
    lists a folder in name order; local files are named one by one to have that order.
    """
    from pyspark.sql import functions as F
    files = list_files(path)
    for name, size in files:
        if size % record_length:
            raise EOFError(f"truncated file: {name} ends with a partial record "
                           f"of {size % record_length} bytes")
    names = [name for name, size in files if size]
    odd = any(set(name) & set("{}[]*?\\,") for name in names)
    if not names or odd:
        return None if odd else spark.createDataFrame(
            [], ", ".join(f"{c} {COLUMN_TYPES[c]}" for c in columns))
    local = not path.startswith("hdfs:")
    sc = spark._jsparkSession.sparkContext()
    conf = spark._jvm.org.apache.hadoop.conf.Configuration(sc.hadoopConfiguration())
    conf.setBoolean("mapreduce.input.fileinputformat.input.dir.recursive", True)
    conf.setLong("mapreduce.input.fileinputformat.split.maxsize", max(split_bytes, record_length))
    rdd = sc.binaryRecords(",".join("file:" + n for n in names) if local else path, record_length, conf)
    rows = spark._jsparkSession.createDataset(rdd, spark._jvm.org.apache.spark.sql.Encoders.BINARY())
    # a Hadoop split's name is scheme and authority before the path
    start = len("file:") + 1 if local else path.index("/", len("hdfs://")) + 1
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    made = {
        "key": F.substring("value", 1, key_length),
        "value": F.substring("value", key_length + 1, record_length - key_length),
        "file": F.substring(F.input_file_name(), start, 1 << 20),
        "pos": F.expr(f"input_file_block_start() div {record_length}") + in_partition,
    }
    scan = DataFrame(rows.toDF(), spark)
    need = [c for c in columns if c != "file_id"]
    if "file_id" not in columns:
        return scan.select(*[made[c].alias(c) for c in need])
    ids = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(files)], "_file string, file_id int")
    ids = small_table(ids, sum(len(name) + 32 for name, _ in files))
    with_file = scan.select(*[made[c].alias(c) for c in need], made["file"].alias("_file"))
    return with_file.join(ids, "_file").select(*columns)


def read_fixed_records(spark: SparkSession, path: str, key_length: int = R.KEY_LENGTH,
                       record_length: int = R.RECORD_LENGTH,
                       split_bytes: int = DEFAULT_SPLIT_BYTES,
                       ranges=None, columns=None, sample_per_split: int = 0,
                       sample_seed: int = 0, engine: str = "auto",
                       key_from: bytes | None = None, key_to: bytes | None = None,
                       keys=None, key_ranges=None) -> DataFrame:
    """``(key, value, file, pos)`` of every record under ``path``.

    ``ranges``: optional list of ``(file, first_record, count)`` to read only
    those records (the sampler reads a few blocks, not the dataset).
    ``sample_per_split``: read only that many records from every input split
    (at an offset chosen by ``sample_seed``) -- the spread sampler.
    ``columns``: the columns to produce, from ``key, value, file, pos,
    file_id``; a Python source cannot prune columns by itself, so naming only
    what is needed (``file_id`` instead of the ``file`` path string) saves the
    per-row work at the scan.
    ``engine``: ``jvm`` reads the whole dataset without Python workers, ``python`` by
    the data source; ``auto`` takes the first where it can (``scans_in_jvm``).
    """
    # key_from, key_to, keys and key_ranges only choose blocks by the index; key_index.read_key_range filters
    by_key = {"key_from": None if key_from is None else key_from.hex(),
              "key_to": None if key_to is None else key_to.hex(),
              "keys": json.dumps([k.hex() for k in keys]) if keys is not None else None,
              "key_ranges": None if key_ranges is None else json.dumps(
                  [[None if x is None else x.hex() for x in r] for r in key_ranges])}
    if engine not in ("auto", "jvm", "python"):
        raise ValueError("engine must be 'auto', 'jvm' or 'python'")
    whole = ranges is None and not sample_per_split and not any(v is not None for v in by_key.values())
    if engine == "jvm" and not (whole and scans_in_jvm(spark, path)):
        raise ValueError(f"{path}: the JVM scan reads whole local or HDFS datasets, without pushdown")
    if engine != "python" and whole and scans_in_jvm(spark, path):
        names = list(columns) if columns is not None else ["key", "value", "file", "pos"]
        unknown = [c for c in names if c not in COLUMN_TYPES]
        if unknown:
            raise ValueError(f"unknown columns {unknown}; choose from {sorted(COLUMN_TYPES)}")
        scan = _jvm_scan(spark, path, key_length, record_length, split_bytes, names)
        if scan is not None:
            return scan
    register(spark)
    pushdown = str(_pushdown(spark)).lower()
    r = (spark.read.format(FORMAT)
         .option("key_length", key_length).option("record_length", record_length)
         .option("split_bytes", split_bytes).option("pushdown", pushdown)
         .options(**{k: v for k, v in by_key.items() if v is not None}))
    if ranges is not None:
        r = r.option("ranges", json.dumps([[f, int(a), int(n)] for f, a, n in ranges]))
    if sample_per_split:
        r = r.option("sample_per_split", int(sample_per_split)).option("sample_seed",
                                                                       int(sample_seed))
    if columns is not None:
        r = r.schema(", ".join(f"{c} {COLUMN_TYPES[c]}" for c in columns))
    return r.load(path)


def global_positions(spark: SparkSession, path: str,
                     record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """Read a sorted dataset with ``global_pos`` = position in the whole order.

    Offsets come from the file sizes alone (listing, one row per file) and meet
    the records on the integer file id that the scan carries; nothing but the
    records themselves is read.
    """
    from itertools import accumulate

    from pyspark.sql import functions as F
    sizes = [size // record_length for _, size in list_files(path)]
    offsets = spark.createDataFrame(
        [(i, o) for i, o in enumerate(accumulate([0, *sizes[:-1]]))] if sizes else [],
        "file_id int, offset bigint")
    recs = read_fixed_records(spark, path, record_length=record_length,
                              columns=["key", "value", "file", "pos", "file_id"])
    # one small row per file
    return (recs.join(small_table(offsets, 32 * len(sizes)), "file_id")
                .withColumn("global_pos", F.col("offset") + F.col("pos")).drop("offset", "file_id"))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """``(file int, name string)``: the file ids of a scan and their paths."""
    return spark.createDataFrame([(i, f) for i, (f, _) in enumerate(list_files(path))],
                                 "file int, name string")


def file_record_counts(spark: SparkSession, path: str,
                       record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """``(file, rows)`` per data file, from the listing only (no data read).

    The listing is the same metadata pass every Spark file source makes on
    the driver; the result has one row per file.
    """
    rows = [(f, size // record_length) for f, size in list_files(path)]
    return spark.createDataFrame(rows, "file string, rows bigint")


def write_fixed_records(df: DataFrame, path: str, mode: str = "errorifexists",
                        key_length: int = R.KEY_LENGTH,
                        record_length: int = R.RECORD_LENGTH) -> None:
    """Write ``key || value`` per row, one file per partition.

    ``mode``: ``errorifexists`` (default: refuse an existing output),
    ``overwrite``, or ``append`` (write next to existing files).
    """
    register(df.sparkSession)
    if mode not in ("errorifexists", "error", "overwrite", "append"):
        raise ValueError(f"unsupported mode {mode!r}")
    w = (df.select("key", "value").write.format(FORMAT)
         .option("key_length", key_length).option("record_length", record_length))
    if mode == "append":
        w = w.option("allow_existing", "true")
    w.mode("overwrite" if mode == "overwrite" else "append").save(path)
