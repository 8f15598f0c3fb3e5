"""The scan without Python workers gives the rows of the Python source."""

import os

import pytest
from pyspark.sql import functions as F

from sortproof import jobs
from sortproof.operators import generate as G
from sortproof.operators import validate as V
from sortproof.sources import fixed_record as FR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect())


def test_same_rows_and_order(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 3456, num_partitions=5), out_dir)
    os.makedirs(f"{out_dir}/deep/_hidden")
    for name in ("deep/x-last", "deep/_hidden/skipped", ".skipped"):
        with open(f"{out_dir}/{name}", "wb") as f:
            f.write(os.urandom(700))
    for columns in (None, ["pos", "file_id", "key"], ["file_id"], ["value"], ["file", "pos"]):
        a = FR.read_fixed_records(spark, out_dir, columns=columns, engine="jvm", split_bytes=33_333)
        b = FR.read_fixed_records(spark, out_dir, columns=columns, engine="python")
        assert a.dtypes == b.dtypes and rows(a) == rows(b)
        assert "Python" not in plan(a) and "BatchScan" not in plan(a)
    a = FR.read_fixed_records(spark, out_dir, engine="jvm", split_bytes=33_333)
    assert a.rdd.getNumPartitions() > 5
    got = [(r.file, r.pos) for r in a.collect()]
    assert got == sorted(got)                             # partitions come in path and record order


def test_record_and_key_length(spark, out_dir):
    os.makedirs(out_dir)
    data = bytes(range(240)) * 7
    with open(f"{out_dir}/a", "wb") as f:
        f.write(data)
    d = FR.read_fixed_records(spark, out_dir, key_length=3, record_length=8, engine="jvm", split_bytes=100)
    got = [(r.pos, bytes(r.key) + bytes(r.value)) for r in d.orderBy("pos").collect()]
    assert got == [(i, data[8 * i:8 * i + 8]) for i in range(210)]


def test_partial_record_is_named(spark, out_dir):
    os.makedirs(out_dir)
    with open(f"{out_dir}/part-0000000000", "wb") as f:
        f.write(bytes(203))
    with pytest.raises(EOFError, match="part-0000000000 ends with a partial record of 3 bytes"):
        FR.read_fixed_records(spark, out_dir, engine="jvm")


def test_file_cut_after_the_listing(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 100, num_partitions=1), out_dir)
    d = FR.read_fixed_records(spark, out_dir, engine="jvm")
    with open(f"{out_dir}/part-0000000000", "r+b") as f:
        f.truncate(9950)
    with pytest.raises(Exception, match="EOFException"):
        d.count()


def test_refusals_and_other_cases(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 40, num_partitions=2), out_dir)
    with pytest.raises(ValueError, match="unknown columns"):
        FR.read_fixed_records(spark, out_dir, columns=["x"], engine="jvm")
    with pytest.raises(ValueError, match="whole"):
        FR.read_fixed_records(spark, out_dir, sample_per_split=2, engine="jvm")
    with pytest.raises(ValueError, match="engine"):
        FR.read_fixed_records(spark, out_dir, engine="fast")
    with pytest.raises(FileNotFoundError, match="does not exist"):
        FR.read_fixed_records(spark, out_dir + "-none")
    odd = out_dir + "[1]"
    FR.write_fixed_records(G.generate_records(spark, 40, num_partitions=2), odd)
    assert FR.read_fixed_records(spark, odd).count() == 40         # by the Python source
    empty = out_dir + "-empty"
    os.makedirs(empty)
    assert FR.read_fixed_records(spark, empty, engine="jvm").count() == 0
    spaced = out_dir + " with ü space"
    FR.write_fixed_records(G.generate_records(spark, 40, num_partitions=2), spaced)
    assert rows(FR.read_fixed_records(spark, spaced, engine="jvm")) == \
        rows(FR.read_fixed_records(spark, spaced, engine="python"))


def test_positions_survive_filters_and_joins(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 2000, num_partitions=2), out_dir)
    d = FR.read_fixed_records(spark, out_dir, engine="jvm", split_bytes=30_000)
    p = FR.read_fixed_records(spark, out_dir, engine="python")
    odd = F.substring("key", 10, 1) < F.lit(b"\x40")
    assert rows(d.where(odd).select("file", "pos")) == rows(p.where(odd).select("file", "pos"))
    assert V.compare_checksums(d, p).collect()[0].equal


def test_sort_job_reads_without_python(spark, tmp_path):
    gen, srt = str(tmp_path / "gen"), str(tmp_path / "sorted")
    got = jobs.generate_job(spark, 3000, gen, num_partitions=3)
    assert jobs.sort_job(spark, gen, srt, num_partitions=4) == got
    assert [r.kind for r in jobs.validate_job(spark, srt, expected=got).collect()] == ["checksum"]


def test_cli_defaults_are_the_jobs(monkeypatch, spark, tmp_path):
    import inspect

    from sortproof import __main__ as cli
    seen = {}
    monkeypatch.setattr(jobs, "sort_job", lambda s, i, o, n, method, sampler: seen.update(
        method=method, sampler=sampler) or {"rows": 0, "checksum": 0})
    assert cli.main(["sort", str(tmp_path / "a"), str(tmp_path / "b")]) == 0
    monkeypatch.undo()
    defaults = inspect.signature(jobs.sort_job).parameters
    assert seen == {k: defaults[k].default for k in seen}
