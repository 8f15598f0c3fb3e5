import numpy as np
import pytest
from pyspark.sql import functions as F

from sortproof.operators import generate as G
from sortproof.operators import partition as P
from sortproof.operators import sort as S
from sortproof.operators import validate as V


@pytest.fixture(scope="module")
def recs(spark):
    return G.generate_records(spark, 20_000, num_partitions=4).cache()


@pytest.mark.parametrize("method", ["range", "sampled", "prefix7", "prefix3"])
def test_total_order(spark, recs, method):
    sample = recs.select("key") if method == "sampled" else None
    s = S.total_order_sort(recs, 6, method, sample=sample, with_position=True)
    rows = s.select("pid", "pos", "key").collect()
    rows.sort(key=lambda r: (r.pid, r.pos))
    keys = [bytes(r.key) for r in rows]
    assert keys == sorted(keys) and len(keys) == 20_000
    report = V.validate(s.withColumn("file", F.format_string("part-%010d", "pid")), method="scan")
    kinds = [r.kind for r in report.collect()]
    assert kinds == ["checksum"]
    c = V.compare_checksums(recs, s).collect()[0]
    assert c.equal


def test_global_position(spark, recs):
    order = sorted(bytes(r.key) for r in recs.select("key").collect())
    rank = {k: i for i, k in enumerate(order)}
    for method in ("prefix7", "range"):
        g = S.sort_with_global_position(recs, 5, method).select("key", "global_pos").collect()
        assert all(rank[bytes(r.key)] == r.global_pos for r in g)


def test_ties_and_tie_breaker(spark):
    df = spark.createDataFrame([(b"\x05" * 10, i) for i in range(50)] +
                               [(b"\x01" * 10, i) for i in range(50)], "key binary, t int")
    s = S.total_order_sort(df, 4, "prefix7", tie_breaker=["t"], with_position=True).collect()
    by_pid = {}
    for r in s:
        by_pid.setdefault(r.pid, []).append(r)
    assert len(by_pid) == 1  # equal prefixes -> one partition
    rows = sorted(s, key=lambda r: r.pos)
    assert [(r.key, r.t) for r in rows] == sorted((r.key, r.t) for r in rows)


def test_empty_input(spark):
    df = spark.createDataFrame([], "key binary, value binary")
    assert S.total_order_sort(df, 3, "prefix7").count() == 0
    rep = V.validate(df.withColumn("file", F.lit("x")).withColumn("pos", F.lit(0)))
    assert [(r.kind, r.detail) for r in rep.collect()] == [("checksum", "0")]


def _files(spark, layout):
    rows = [(f, i, k, b"v" * 90) for f, keys in layout.items() for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "file string, pos bigint, key binary, value binary")


def test_misorder_inside_file(spark):
    df = _files(spark, {"p0": [b"\x01", b"\x03", b"\x02", b"\x04"], "p1": [b"\x05", b"\x06"]})
    m = V.misorders(df).collect()
    assert [(r.file, r.pos) for r in m] == [("p0", 2)]
    assert m[0].detail == "misorder in p0 between 03 and 02"
    # two adjacent swapped rows far apart in value give one error; a row moved gives two
    df2 = _files(spark, {"p0": [b"\x01", b"\x05", b"\x02", b"\x03", b"\x04"]})
    assert V.misorders(df2).count() == 1
    df3 = _files(spark, {"p0": [b"\x01", b"\x04", b"\x03", b"\x02", b"\x05"]})
    assert V.misorders(df3).count() == 2


def test_block_edges_match_whole_file(spark):
    rng = np.random.default_rng(3)
    keys = [bytes(rng.integers(0, 256, 4, dtype=np.uint8)) for _ in range(3000)]
    df = _files(spark, {"a": keys[:1700], "b": keys[1700:]})
    full = {(r.file, r.pos) for r in V.misorders(df, block_rows=10 ** 9).collect()}
    blocked = {(r.file, r.pos) for r in V.misorders(df, block_rows=97).collect()}
    assert full == blocked and len(full) > 0


def test_boundary_and_empty_file(spark):
    ok = _files(spark, {"p0": [b"\x01", b"\x02"], "p2": [b"\x03", b"\x04"]})
    assert V.boundary_errors(V.file_bounds(ok)).count() == 0
    swapped = _files(spark, {"p0": [b"\x03", b"\x04"], "p1": [b"\x01", b"\x02"]})
    b = V.boundary_errors(V.file_bounds(swapped)).collect()
    assert [r.file for r in b] == ["p1"]
    assert b[0].detail.startswith("bad key partitioning:\n  file p0:end key 04")
    rep = V.validate(swapped).collect()
    assert {r.kind for r in rep} == {"error"}
    with pytest.raises(ValueError):
        V.validate(swapped, raise_on_error=True)


def test_changed_value_only_seen_by_record_checksum(spark):
    a = _files(spark, {"p0": [b"\x01", b"\x02"]})
    b = a.withColumn("value", F.when(F.col("pos") == 1, F.lit(b"w" + b"v" * 89))
                     .otherwise(F.col("value")))
    assert not V.compare_checksums(a, b).collect()[0].equal
    assert V.compare_checksums(a, b, columns="key").collect()[0].equal


def test_partition_checks(spark, recs):
    s = S.total_order_sort(recs, 4, "prefix7", with_position=True)
    checks = V.partition_checks(V.partition_summary(s)).collect()
    assert all(r.first_le_last and r.prev_le_first for r in checks)


def test_scan_equals_window(spark):
    rng = np.random.default_rng(11)
    keys = [bytes(rng.integers(0, 256, 3, dtype=np.uint8)) for _ in range(4000)]
    layout = {"a": keys[:1500], "b": sorted(keys[1500:2600]), "c": keys[2600:]}
    df = _files(spark, layout)
    # scramble the physical order and drop some positions (gaps)
    df = df.where(F.col("pos") % 13 != 5).repartition(5)
    a = sorted((r.kind, r.file, r.detail) for r in V.validate(df, method="scan").collect())
    b = sorted((r.kind, r.file, r.detail) for r in V.validate(df, method="window").collect())
    assert a == b and len(a) > 100
    sa = sorted(tuple(r) for r in V.summary_from_runs(V.scan_runs(df)).collect())
    sb = sorted(tuple(r) for r in V.file_summary(df).collect())
    assert sa == sb


def test_scan_single_exchange(spark, recs):
    s = S.total_order_sort(recs, 4, "prefix7", with_position=True)
    rep = V.validate(s.withColumn("file", F.format_string("part-%010d", "pid")), method="scan")
    rep.collect()
    plan = rep._jdf.queryExecution().executedPlan().toString()
    # the run table was materialised once; the checks read it, not the records
    assert "MapInArrow" not in plan and "Sort [key" not in plan


@pytest.mark.parametrize("method", ["range", "sampled"])
def test_hot_key_is_spread(spark, method):
    # a third of the rows share one key; the rest are distinct
    hot = spark.range(0, 6000).select(F.lit(b"\x80" * 10).alias("key"),
                                      F.format_string("%090d", "id").cast("binary").alias("value"))
    rest = G.generate_records(spark, 12000, num_partitions=4).select("key", "value")
    df = hot.unionByName(rest)
    sample = df.select("key") if method == "sampled" else None
    s = S.total_order_sort(df, 8, method, sample=sample, with_position=True).cache()
    sizes = [r["count"] for r in s.groupBy("pid").count().collect()]
    assert sum(sizes) == 18000 and max(sizes) < 6000
    rep = V.validate(s.withColumn("file", F.format_string("part-%010d", "pid")), method="scan")
    assert [r.kind for r in rep.collect()] == ["checksum"]
    assert V.compare_checksums(df, s).collect()[0].equal
    s.unpersist()


def test_numeric_file_ids_keep_numeric_order(spark, recs):
    s = S.total_order_sort(recs, 12, "prefix7", with_position=True)
    for method in ("scan", "window"):
        rep = V.validate(s, file="pid", method=method).collect()
        assert [r.kind for r in rep] == ["checksum"], method
    checks = V.partition_checks(V.partition_summary(s)).collect()
    assert sorted(r.pid for r in checks) == list(range(12))
    assert all(r.first_le_last and r.prev_le_first for r in checks)


def test_global_position_with_ties_is_a_permutation(spark):
    df = spark.createDataFrame([(bytes([i % 7]) * 3, i) for i in range(700)], "key binary, t int")
    g = S.sort_with_global_position(df, 5, "prefix7").select("key", "global_pos").collect()
    assert sorted(r.global_pos for r in g) == list(range(700))
    by_pos = sorted(g, key=lambda r: r.global_pos)
    assert [r.key for r in by_pos] == sorted(r.key for r in g)


def test_key_groups_equal_distinct_on_sorted_output(spark):
    rng = np.random.default_rng(5)
    keys = [bytes([int(x)]) for x in rng.integers(0, 40, 5000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, t long")
    s = S.total_order_sort(df, 4, "prefix7", with_position=True)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")  # runs span batches
    try:
        runs = V.scan_runs(s.withColumn("value", F.lit(b"x")), file="pid", materialize=False)
        got = {int(r.file): r.key_groups for r in V.key_groups_from_runs(runs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r.pid: r.n for r in s.groupBy("pid").agg(F.count_distinct("key").alias("n")).collect()}
    assert got == want


def test_null_keys_in_both_methods(spark):
    rows = [("a", 0, None, b"v"), ("a", 1, b"\x01", b"v"), ("a", 2, None, None), ("a", 3, b"\x00", b"v"),
            ("b", 0, b"\x05", b"v"), ("b", 1, None, b"v"), ("c", 0, None, b"v")]
    df = spark.createDataFrame(rows, "file string, pos long, key binary, value binary").coalesce(1)
    got = {}
    for method in ("scan", "window"):
        got[method] = sorted((r.kind, r.file or "", r.detail) for r in V.validate(df, method=method).collect())
    assert got["scan"] == got["window"]
    assert [f for _, f, d in got["scan"] if d.startswith("misorder")] == ["a", "b"]
    ok = df.where("file = 'c' or file = 'a' and pos < 2")
    assert [r.kind for r in V.validate(ok.where("file = 'a'"), method="scan").collect()] == ["checksum"]


def test_sparse_positions_use_windows_of_file_and_block(spark):
    df = spark.range(5000).select(F.lit("hot").alias("file"), (F.col("id") * 977).alias("pos"),
                                  F.encode(F.lpad(F.col("id").cast("string"), 6, "0"), "utf-8").alias("key"),
                                  F.lit(b"v").alias("value"))
    rep = V.validate(df, block_rows=100_000)
    assert [r.kind for r in rep.collect()] == ["checksum"]
    plan = V.misorders(df, block_rows=100_000)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "hashpartitioning(block" in plan


@pytest.mark.parametrize("method", ["prefix7", "prefix3", "sampled"])
def test_a_large_partition_is_sorted_in_ranges(spark, monkeypatch, method):
    """What one task sorts is bounded, whatever the number of partitions asked for."""
    monkeypatch.setattr(S, "RANGE_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(S, "SMALL_ROWS", 100, raising=False)
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(
            F.unhex(F.substring(F.md5((F.col("id") % 9000).cast("string")), 1, 20))).alias("key"),
        F.lit(b"v" * 90).alias("value"), F.col("id").alias("t"))
    splits = P.split_points(df.where("key is not null").select("key"), 3) if method == "sampled" else None
    s = S.total_order_sort(df, 3, method, splits=splits, tie_breaker=["t"], with_position=True)
    rows = s.select("*", F.spark_partition_id().alias("part")).collect()
    want = {r.t: r.pid for r in P.assign_partition(df, 3, method, splits=splits).select("t", "pid").collect()}
    parts, by_pid = {}, {}
    for r in rows:
        parts[r.part] = parts.get(r.part, 0) + 1
        by_pid.setdefault(r.pid, []).append(r)
        assert want[r.t] == r.pid
    assert len(rows) == n and max(parts.values()) < 8000
    for pid, got in by_pid.items():
        got.sort(key=lambda r: r.pos)
        assert [r.pos for r in got] == list(range(len(got)))
        order = [(r.key is not None, bytes(r.key or b""), r.t) for r in got]
        assert order == sorted(order)
