import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sortproof.operators import generate as G
from sortproof.operators import sort as S
from sortproof.operators import validate as V
from sortproof.sources import fixed_record as FR
from sortproof.sources import inventory as INV


def test_roundtrip_and_positions(spark, out_dir):
    recs = G.generate_records(spark, 5000, num_partitions=3)
    FR.write_fixed_records(S.total_order_sort(recs, 4, "prefix7"), out_dir)
    names = sorted(os.listdir(out_dir))
    assert names == ["_SUCCESS"] + [f"part-{i:010d}" for i in range(4)]
    back = FR.read_fixed_records(spark, out_dir, split_bytes=100 * 700)
    assert back.rdd.getNumPartitions() > 4
    assert back.count() == 5000
    assert V.compare_checksums(recs, back).collect()[0].equal
    rep = V.validate(back).collect()
    assert [r.kind for r in rep] == ["checksum"]
    # positions are record indexes inside each file
    mx = back.groupBy("file").agg(F.max("pos").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.m == r.n - 1 for r in mx)


def test_refuses_existing_output(spark, out_dir):
    recs = G.generate_records(spark, 10)
    FR.write_fixed_records(recs, out_dir)
    with pytest.raises(Exception):
        FR.write_fixed_records(recs, out_dir)
    FR.write_fixed_records(recs, out_dir, mode="overwrite")
    assert FR.read_fixed_records(spark, out_dir).count() == 10


def test_truncated_file_fails(spark, out_dir):
    os.makedirs(out_dir)
    with open(os.path.join(out_dir, "part-0000000000"), "wb") as f:
        f.write(bytes(203))
    with pytest.raises(Exception, match="past eof|partial record"):
        FR.read_fixed_records(spark, out_dir).count()
    inv = INV.inventory(spark, out_dir).collect()
    assert [(r.records, r.remainder) for r in inv] == [(2, 3)]


def test_empty_file_between_sorted_files_passes(spark, out_dir):
    os.makedirs(out_dir)
    recs = sorted(bytes(G.build_records(__import__("numpy").arange(i, i + 1))[0]) for i in range(6))
    for name, chunk in (("part-0000000000", recs[:3]), ("part-0000000001", []), ("part-0000000002", recs[3:])):
        with open(os.path.join(out_dir, name), "wb") as f:
            f.write(b"".join(chunk))
    back = FR.read_fixed_records(spark, out_dir)
    assert [r.kind for r in V.validate(back).collect()] == ["checksum"]


def test_observe_checksum_while_writing(spark, out_dir):
    recs = G.generate_records(spark, 1000, num_partitions=2)
    obs = Observation("gen")
    observed = recs.observe(obs, F.count(F.lit(1)).alias("rows"),
                            F.sum(F.crc32(F.concat("key", "value"))).alias("checksum"))
    FR.write_fixed_records(observed, out_dir)
    assert obs.get == {"rows": 1000, "checksum": 0x1f9ffe645ec}


def test_wrong_width_rejected(spark, out_dir):
    df = spark.createDataFrame([(b"short", b"v" * 90)], "key binary, value binary")
    with pytest.raises(Exception, match="must be 10 bytes"):
        FR.write_fixed_records(df, out_dir)


def test_jobs_end_to_end(spark, tmp_path):
    from sortproof import jobs
    gen, srt, rep = (str(tmp_path / x) for x in ("gen", "sorted", "report"))
    got = jobs.generate_job(spark, 1000, gen, num_partitions=3)
    assert got == {"rows": 1000, "checksum": 0x1f9ffe645ec}
    for method, sub in (("range", "a"), ("sampled", "b"), ("prefix7", "c")):
        out = f"{srt}-{sub}"
        assert jobs.sort_job(spark, gen, out, num_partitions=4, method=method,
                             sample_size=400) == got
        report = jobs.validate_job(spark, out, report_path=f"{rep}-{sub}").collect()
        assert [(r.kind, r.detail) for r in report] == [("checksum", "1f9ffe645ec")]
    assert os.path.exists(f"{rep}-a/_SUCCESS")


def test_file_block_sample_reads_only_sample(spark, out_dir):
    from sortproof.operators import partition as P
    FR.write_fixed_records(G.generate_records(spark, 5000, num_partitions=5), out_dir)
    s = P.file_block_sample(spark, out_dir, block_rows=100, num_samples=10, sample_size=200)
    # 50 blocks -> every 5th block, 20 records each; only those ranges are read
    assert s.count() == 200
    assert sorted({(r.block) for r in s.collect()}) == [0, 5]  # blocks per file of 1000 rows


def test_ascii_records_roundtrip(spark, out_dir):
    recs = G.generate_records(spark, 300, ascii=True, num_partitions=2)
    FR.write_fixed_records(S.total_order_sort(recs, 3, "range"), out_dir)
    back = FR.read_fixed_records(spark, out_dir)
    assert [r.kind for r in V.validate(back).collect()] == ["checksum"]
    # the same files read as CRLF text lines
    lines = spark.read.option("lineSep", "\r\n").text(out_dir + "/part-*")
    assert lines.count() == 300 and lines.where(F.length("value") != 98).count() == 0


def test_global_positions_from_files(spark, out_dir):
    recs = G.generate_records(spark, 2000, num_partitions=3)
    FR.write_fixed_records(S.total_order_sort(recs, 5, "prefix7"), out_dir)
    g = FR.global_positions(spark, out_dir).select("key", "global_pos").collect()
    order = sorted(bytes(r.key) for r in g)
    assert all(order[r.global_pos] == bytes(r.key) for r in g)


def test_pushdown_prunes_splits(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 3000, num_partitions=3), out_dir)
    full = FR.read_fixed_records(spark, out_dir, split_bytes=100 * 100)
    files = sorted({r.file for r in full.select("file").distinct().collect()})
    want = sorted((r.file, r.pos) for r in full.where((F.col("pos") >= 150) & (F.col("pos") < 420)
                                                      & (F.col("file") == files[1])).collect())
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = FR.read_fixed_records(spark, out_dir, split_bytes=100 * 100)
        q = df.where((F.col("pos") >= 150) & (F.col("pos") < 420) & (F.col("file") == files[1]))
        got = sorted((r.file, r.pos) for r in q.collect())
        assert got == want and len(got) == 270
        assert q.rdd.getNumPartitions() == 4  # splits 100-199 .. 400-499 of one file only
        other = df.where(F.col("pos") % 7 == 0).count()   # not pushable: Spark filters
        assert other == full.where(F.col("pos") % 7 == 0).count()
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_cli(spark, tmp_path):
    from sortproof.__main__ import main
    gen, srt = str(tmp_path / "gen"), str(tmp_path / "sorted")
    assert main(["gen", "1k", gen, "--partitions", "2"]) == 0
    assert main(["sort", gen, srt, "--partitions", "3", "--method", "prefix7"]) == 0
    assert main(["validate", srt, str(tmp_path / "report")]) == 0
    assert main(["check", srt]) == 0
    lines = spark.read.text(str(tmp_path / "report")).collect()
    assert len(lines) == 1 and lines[0].value.startswith("checksum\t\t")


def test_column_subset(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 500, num_partitions=2), out_dir)
    full = FR.read_fixed_records(spark, out_dir).collect()
    ids = {f: i for i, f in enumerate(sorted({r.file for r in full}))}
    sub = FR.read_fixed_records(spark, out_dir, columns=["pos", "file_id", "key"])
    assert sub.columns == ["pos", "file_id", "key"]
    assert sorted(tuple(r) for r in sub.collect()) == \
        sorted((r.pos, ids[r.file], r.key) for r in full)


def test_pushdown_with_spread_sample(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 4000, num_partitions=2), out_dir)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = FR.read_fixed_records(spark, out_dir, split_bytes=100 * 500, sample_per_split=40)
        files = sorted({r.file for r in df.select("file").collect()})
        allrows = df.collect()
        got = df.where((F.col("file") == files[0]) & (F.col("pos") < 1000)).collect()
        assert got and all(r.file == files[0] and r.pos < 1000 for r in got)
        assert sorted(r.pos for r in got) == sorted(r.pos for r in allrows
                                                    if r.file == files[0] and r.pos < 1000)
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_append_keeps_earlier_files(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 100, num_partitions=2), out_dir)
    FR.write_fixed_records(G.generate_records(spark, 50, start=100, num_partitions=2), out_dir,
                           mode="append")
    back = FR.read_fixed_records(spark, out_dir)
    assert back.count() == 150
    assert V.compare_checksums(G.generate_records(spark, 150), back).collect()[0].equal


def test_inventory_total(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 1234, num_partitions=3), out_dir)
    from sortproof.sources.inventory import inventory_total
    t = inventory_total(spark, out_dir).collect()[0]
    assert (t.files, t.bytes, t.records, t.remainder) == (3, 123400, 1234, 0)


def test_pushdown_file_id(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 900, num_partitions=3), out_dir)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = FR.read_fixed_records(spark, out_dir, columns=["file_id", "pos", "key"])
        q = df.where(F.col("file_id").isin(0, 2))
        assert q.rdd.getNumPartitions() == 2
        assert {r.file_id for r in q.collect()} == {0, 2} and q.count() == 600
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_empty_datasets(spark, tmp_path):
    from sortproof import jobs
    from sortproof.operators import validate as V
    (tmp_path / "none").mkdir()
    (tmp_path / "zero").mkdir()
    (tmp_path / "zero" / "part-0000000000").write_bytes(b"")
    for name in ("none", "zero"):
        path = str(tmp_path / name)
        assert FR.read_fixed_records(spark, path).count() == 0
        assert [r.kind for r in V.validate(FR.read_fixed_records(spark, path)).collect()] == ["checksum"]
        got = jobs.sort_job(spark, path, str(tmp_path / f"{name}-sorted"))
        assert got == {"rows": 0, "checksum": 0}
        assert FR.global_positions(spark, path).count() == 0


def test_predicate_that_matches_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    FR.write_fixed_records(G.generate_records(spark, 50, num_partitions=2), path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert FR.read_fixed_records(spark, path).where("pos > 1000").count() == 0
        assert FR.read_fixed_records(spark, path).where("file = 'x'").count() == 0
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_overwrite_swaps_at_commit(spark, tmp_path):
    path = str(tmp_path / "d")
    FR.write_fixed_records(G.generate_records(spark, 60, num_partitions=3), path)
    before = sorted((r.file, r.pos, bytes(r.key)) for r in FR.read_fixed_records(spark, path).collect())
    bad = FR.read_fixed_records(spark, path).select("key", F.lit(b"short").alias("value"))
    with pytest.raises(Exception):
        FR.write_fixed_records(bad, path, mode="overwrite")
    assert sorted((r.file, r.pos, bytes(r.key)) for r in FR.read_fixed_records(spark, path).collect()) == before
    # rewriting a dataset from itself
    FR.write_fixed_records(FR.read_fixed_records(spark, path).coalesce(1), path, mode="overwrite")
    assert sorted(bytes(r.key) for r in FR.read_fixed_records(spark, path).collect()) == sorted(k for *_, k in before)
    assert sorted(os.listdir(path)) == ["_SUCCESS", "part-0000000000"]
    from sortproof import jobs
    with pytest.raises(ValueError):
        jobs.sort_job(spark, path, f"file:{path}/", mode="overwrite")


def test_file_uris(spark, tmp_path):
    path = str(tmp_path / "d")
    FR.write_fixed_records(G.generate_records(spark, 10, num_partitions=1), "file:" + path)
    for p in (path, "file:" + path, "file://" + path):
        assert FR.read_fixed_records(spark, p).count() == 10


def test_name_order_above_a_hundred_thousand_parts(spark, tmp_path):
    from sortproof.operators import validate as V
    path = tmp_path / "d"
    path.mkdir()
    for i, n in ((99_999, 3), (100_000, 2)):
        rec = b"".join(bytes([i == 100_000, k]) + bytes(98) for k in range(n))
        (path / FR.part_name(i)).write_bytes(rec)
    d = FR.read_fixed_records(spark, str(path))
    assert [r.kind for r in V.validate(d).collect()] == ["checksum"]
    got = sorted((r.global_pos, bytes(r.key)[:2]) for r in FR.global_positions(spark, str(path)).collect())
    assert got == [(0, b"\0\0"), (1, b"\0\1"), (2, b"\0\2"), (3, b"\1\0"), (4, b"\1\1")]


def test_stored_split_points_are_reused(spark, tmp_path):
    from sortproof import jobs
    src, splits = str(tmp_path / "src"), str(tmp_path / "splits")
    jobs.generate_job(spark, 3000, src, num_partitions=3)
    a = jobs.sort_job(spark, src, str(tmp_path / "a"), num_partitions=4, splits_path=splits)
    b = jobs.sort_job(spark, src, str(tmp_path / "b"), num_partitions=4, splits_path=splits)
    assert a == b and len(spark.read.parquet(splits).collect()) == 3
    sizes = [[os.path.getsize(os.path.join(str(tmp_path / x), f)) for f in sorted(os.listdir(str(tmp_path / x)))]
             for x in "ab"]
    assert sizes[0] == sizes[1]
    with pytest.raises(ValueError):
        jobs.sort_job(spark, src, str(tmp_path / "c"), num_partitions=9, splits_path=splits)
