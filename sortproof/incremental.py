"""Validation that reads only files it has not seen.

The state of a dataset holds what a full validation needs of every file: rows, first key,
last key and checksum, and the file's misorders.  A call reads the files that are new or
changed (by size or modification time) once, adds their state as a new batch, and makes
the report from the state of all present files.

States combine by an ordered monoid: two neighbouring pieces make one with the rows and
checksums added, the first key of the left, the last key of the right, and one more fall
if the right begins below the left's end (``merge``).  The same holds for runs of a file,
files of a folder and days of a dataset, so a summary of the whole never needs the records.

Layout under the state's path: ``batch-<id>/files`` and ``batch-<id>/misorders`` (Parquet),
and ``current``, which names the batches in force and is replaced last; an interrupted call
leaves the old state.  One writer at a time.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.operators import validate as V
from sortproof.sources import fixed_record as FR

_FILES = ("file string, size bigint, modified bigint, rows bigint, first_key binary, last_key binary, "
          "checksum decimal(38,0)")
_MISORDERS = "file string, size bigint, modified bigint, pos bigint, prev_key binary, key binary, detail string"

#: More batches than this are written together as one.
MOST_BATCHES = 32


def merge(left: dict, right: dict) -> dict:
    """The summary of two neighbouring pieces, in order; ``{"rows": 0}`` is the neutral element.

    A piece is ``rows, first_key, last_key, checksum, falls``; associative, so pieces may be
    merged in any grouping (not in any order).
    """
    if not left["rows"]:
        return right
    if not right["rows"]:
        return left
    # a null key lies before all others
    end, start = left["last_key"], right["first_key"]
    fall = end is not None and (start is None or start < end)
    return {"rows": left["rows"] + right["rows"], "first_key": left["first_key"], "last_key": right["last_key"],
            "checksum": left["checksum"] + right["checksum"], "falls": left["falls"] + right["falls"] + int(fall)}


def present_files(path: str) -> list:
    """(file, size, modification time in ns or 0 if the store has none) of the data files, in order."""
    fs, _ = FR._fs(path)
    files = FR.list_files(path)
    times = {i.path: i.mtime_ns or 0 for i in fs.get_file_info([f for f, _ in files])} if files else {}
    return [(f, size, times.get(f, 0)) for f, size in files]


def _root(state: str) -> tuple:
    fs, root = FR._fs(state)
    return fs, root


def _current(state: str) -> Optional[dict]:
    from pyarrow import fs as pafs
    fs, root = _root(state)
    name = posixpath.join(root, "current")
    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(name) as f:
        return json.loads(f.read())


def _publish(state: str, meta: dict) -> None:
    fs, root = _root(state)
    staged = posixpath.join(root, f"current-{uuid.uuid4().hex[:8]}")
    with fs.open_output_stream(staged) as f:
        f.write(json.dumps(meta).encode())
    fs.move(staged, posixpath.join(root, "current"))


def _read(spark: SparkSession, state: str, batches: list, part: str, schema: str) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{state.rstrip('/')}/{b}/{part}" for b in batches])


def new_files(spark: SparkSession, path: str, state: str) -> list:
    """(file, size, modified) of the present files that the state does not know."""
    known = _current(state)
    files = present_files(path)
    if known is None or not files:
        return files
    now = spark.createDataFrame(files, "file string, size bigint, modified bigint")
    seen = _read(spark, state, known["batches"], "files", _FILES)
    return [tuple(r) for r in now.join(seen, ["file", "size", "modified"], "left_anti").orderBy("file").collect()]


def _scan(spark: SparkSession, path: str, files: list, columns: str, key_length: int, record_length: int,
          split_bytes: int) -> DataFrame:
    """The run table of some files of a dataset, in pieces of ``split_bytes``."""
    for name, size, _ in files:
        if size % record_length:
            raise EOFError(f"truncated file: {name} ends with a partial record of {size % record_length} bytes")
    step = max(1, split_bytes // record_length)
    pieces = [(name, first, min(step, size // record_length - first))
              for name, size, _ in files for first in range(0, size // record_length, step)]
    data = FR.read_fixed_records(spark, path, key_length, record_length, ranges=pieces,
                                 columns=["key", "value", "file", "pos"])
    return V.scan_runs(data, columns=columns)


def update_state(spark: SparkSession, path: str, state: str, columns: str = "record",
                 key_length: int = R.KEY_LENGTH, record_length: int = R.RECORD_LENGTH,
                 split_bytes: int = FR.DEFAULT_SPLIT_BYTES) -> list:
    """Read the new and changed files of a dataset into its state; returns them.

    A file rewritten with the same size within the clock step of the store is not noticed.
    ``ValueError`` if the state was kept with other ``columns`` or record sizes;
    ``EOFError`` for a file with a partial last record (the state stays as it was).
    """
    settings = {"columns": columns, "key_length": key_length, "record_length": record_length}
    known = _current(state)
    if known is not None and known["settings"] != settings:
        raise ValueError(f"{state} was kept with {known['settings']}, not {settings}")
    todo = new_files(spark, path, state)
    batches = list(known["batches"]) if known else []
    if todo:
        runs = _scan(spark, path, todo, columns, key_length, record_length, split_bytes)
        listed = spark.createDataFrame(todo, "file string, size bigint, modified bigint")
        batch = f"batch-{uuid.uuid4().hex[:12]}"
        base = f"{state.rstrip('/')}/{batch}"
        # files without records have no run; they are remembered too
        done = listed.join(V.summary_from_runs(runs), "file", "left").withColumn(
            "rows", F.coalesce("rows", F.lit(0)))
        done.select(*[c.split()[0] for c in _FILES.split(", ")]).write.parquet(f"{base}/files")
        V.misorders_from_runs(runs).join(listed, "file").select(
            "file", "size", "modified", "pos", "prev_key", "key", "detail").write.parquet(f"{base}/misorders")
        batches.append(batch)
        if len(batches) > MOST_BATCHES:
            batches = [_compact(spark, path, state, batches)]
    if todo or known is None:
        _root(state)[0].create_dir(_root(state)[1], recursive=True)
        _publish(state, {"batches": batches, "settings": settings})
    return todo


def _compact(spark: SparkSession, path: str, state: str, batches: list) -> str:
    """One batch with the state of the present files; old batches stay for readers of the old state."""
    batch = f"batch-{uuid.uuid4().hex[:12]}"
    base = f"{state.rstrip('/')}/{batch}"
    now = spark.createDataFrame(present_files(path), "file string, size bigint, modified bigint")
    for part, schema in (("files", _FILES), ("misorders", _MISORDERS)):
        d = _read(spark, state, batches, part, schema)
        d.join(now, ["file", "size", "modified"], "left_semi").select(
            *[c.split()[0] for c in schema.split(", ")]).write.parquet(f"{base}/{part}")
    return batch


def present_state(spark: SparkSession, path: str, state: str) -> tuple:
    """(file summaries, misorders) of the present files, from the state alone.

    Files that have gone since are left out; ``ValueError`` if a present file is not in
    the state (``update_state`` first).
    """
    known = _current(state)
    files = present_files(path)
    if known is None:
        raise ValueError(f"{state} holds no state")
    now = spark.createDataFrame(files, "file string, size bigint, modified bigint")
    on = ["file", "size", "modified"]
    got = now.join(_read(spark, state, known["batches"], "files", _FILES), on)
    if got.count() != len(files):
        raise ValueError(f"{path} has files that {state} does not know")
    mis = now.join(_read(spark, state, known["batches"], "misorders", _MISORDERS), on)
    return (got.select("file", "rows", "first_key", "last_key", "checksum"),
            mis.select("file", "pos", "prev_key", "key", "detail"))


def validate_incremental(spark: SparkSession, path: str, state: str, columns: str = "record",
                         raise_on_error: bool = False, **sizes) -> DataFrame:
    """The report ``(kind, file, detail)`` of a full validation, reading new files only.

    ``sizes``: ``key_length``, ``record_length`` and ``split_bytes`` of ``update_state``.
    """
    update_state(spark, path, state, columns, **sizes)
    summary, mis = present_state(spark, path, state)
    report = V.report_from_summary(summary.where("rows > 0"), mis)
    if raise_on_error:
        bad = report.where(F.col("kind") == "error").limit(1).collect()
        if bad:
            raise ValueError("Data validation failed: " + bad[0]["detail"])
    return report


def dataset_summary(summary: DataFrame) -> dict:
    """``rows, first_key, last_key, checksum, falls`` of a dataset from its file summaries.

    ``falls`` counts file ends above the next file's start; neighbouring files are merged
    in the tasks first, one piece a task reaches the driver.
    """
    from functools import reduce

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = "at int, rows bigint, first_key binary, last_key binary, checksum decimal(38,0), falls bigint"
    fields = ("rows", "first_key", "last_key", "checksum", "falls")
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def pieces(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        whole = {"rows": 0}
        for b in batches:
            whole = reduce(merge, (r | {"falls": 0} for r in b.to_pylist()), whole)
        if whole["rows"]:
            yield pa.RecordBatch.from_pylist([{"at": TaskContext.get().partitionId()} | {f: whole[f] for f in fields}],
                                             schema=arrow)

    from sortproof.session import ship_package
    ship_package(summary.sparkSession)
    d = summary.where("rows > 0").repartitionByRange("file").sortWithinPartitions("file")
    got = d.select("file", "rows", "first_key", "last_key", "checksum").mapInArrow(pieces, schema).collect()
    empty = {"rows": 0, "first_key": None, "last_key": None, "checksum": 0, "falls": 0}
    return reduce(merge, ({f: r[f] for f in fields} for r in sorted(got, key=lambda r: r["at"])), empty)
