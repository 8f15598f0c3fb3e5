import os
import random

import pytest
from pyspark.sql import functions as F

from sortproof.operators import generate as G
from sortproof.operators import sort as S
from sortproof.sources import fixed_record as FR
from sortproof.sources import key_index as K


def rows(df):
    return sorted((bytes(r.key), bytes(r.value), r.file, r.pos) for r in df.collect())


@pytest.fixture()
def data(spark, out_dir, monkeypatch):
    """6,000 sorted records, some keys repeated over blocks, segments and files."""
    monkeypatch.setattr(K, "SEGMENT_BLOCKS", 16)
    recs = G.generate_records(spark, 6000, num_partitions=2)
    hot = F.when(F.col("row") % 9 == 0, F.lit(b"\x7fHOTKEY\x00\x01\x02")).otherwise(F.col("key"))
    FR.write_fixed_records(S.total_order_sort(recs.withColumn("key", hot), 4, "range"), out_dir)
    K.build_key_index(spark, out_dir, block_rows=20)
    full = rows(FR.read_fixed_records(spark, out_dir, engine="python"))
    return out_dir, full


def read_here(path, **options):
    """(rows that the reader hands over, rows that it reads) without Spark."""
    r = FR.FixedRecordReader({"path": path, **options}, None)
    got = [b for p in r.partitions() for b in r.read(p)]
    return [k for b in got for k in b.column("key").to_pylist()]


def test_ranges_and_points_equal_a_full_scan(spark, data):
    path, full = data
    rng = random.Random(1)
    keys = [full[rng.randrange(len(full))][0] for _ in range(3)]
    spots = keys + [b"", b"\x00" * 10, b"\xff" * 12, b"\x7fHOTKEY\x00\x01\x02", b"\x7f", keys[0][:4], keys[1] + b"x"]
    for lo, hi in [(a, b) for a in spots[2:7] for b in spots[1:8:2]] + [(None, spots[0]), (spots[1], None)]:
        want = [r for r in full if (lo is None or r[0] >= lo) and (hi is None or r[0] <= hi)]
        assert rows(K.read_key_range(spark, path, lo, hi)) == want
    for some in ([], spots, [spots[6]], keys):
        assert rows(K.read_key_range(spark, path, keys=some)) == [r for r in full if r[0] in some]


def test_blocks_read(data):
    path, full = data
    plain = [r[0] for r in full if r[0][:4] != b"\x7fHOT"]
    for k in (plain[7], plain[2500], plain[-1]):
        got = read_here(path, keys=f'["{k.hex()}"]')
        assert k in got and len(got) <= 2 * 20                      # two blocks at most
    a, b = plain[1000], plain[1200]
    n = sum(a <= r[0] <= b for r in full)
    got = read_here(path, key_from=a.hex(), key_to=b.hex())
    assert n <= len(got) <= n + 4 * 20 and len(got) < len(full) / 10
    assert len(read_here(path, key_from=(b"\xff" * 11).hex())) <= 20
    assert len(read_here(path)) == len(full)


def test_pushed_key_predicates(spark, data):
    path, full = data
    k = full[4000][0]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        d = FR.read_fixed_records(spark, path)
        assert rows(d.where(F.col("key") == F.lit(k))) == [r for r in full if r[0] == k]
        q = d.where((F.col("key") > F.lit(k)) & (F.col("key") <= F.lit(full[4100][0])))
        assert rows(q) == [r for r in full if k < r[0] <= full[4100][0]]
        assert q.rdd.getNumPartitions() <= 3            # of some twenty segments
        both = d.where((F.col("key") >= F.lit(k)) & (F.col("pos") < 300))
        assert rows(both) == [r for r in full if r[0] >= k and r[3] < 300]
        some = d.where(F.col("key").isin([full[5][0], k, b"none"]))
        assert rows(some) == [r for r in full if r[0] in (full[5][0], k)]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_lookup_of_a_table_of_keys(spark, data):
    path, full = data
    rng = random.Random(2)
    asked = [full[rng.randrange(len(full))][0] for _ in range(300)] + [b"\x7fHOTKEY\x00\x01\x02", b"", b"\xff" * 10, b"absent...."]
    table = spark.createDataFrame([(bytearray(k),) for k in asked * 2] + [(None,)], "key binary").repartition(3)
    assert rows(K.lookup(spark, path, table)) == [r for r in full if r[0] in set(asked)]
    assert K.lookup(spark, path, table.where("key is null")).count() == 0


def test_changed_files_are_read_in_full(spark, data):
    path, full = data
    k = full[100][0]
    extra = k + b"n" * 90
    with open(os.path.join(path, FR.part_name(9)), "wb") as f:
        f.write(extra)
    got = rows(K.read_key_range(spark, path, keys=[k]))
    assert len(got) == 2 and (k, b"n" * 90) in [r[:2] for r in got]
    with pytest.raises(ValueError, match="no index of its present files"):
        K.lookup(spark, path, spark.createDataFrame([(bytearray(k),)], "key binary"))
    K.build_key_index(spark, path, block_rows=7)
    assert rows(K.read_key_range(spark, path, keys=[k])) == got
    with pytest.raises(ValueError, match="not in key order"):
        K.lookup(spark, path, spark.createDataFrame([(bytearray(k),)], "key binary"))


def test_unsorted_is_refused_and_leaves_the_old_index(spark, out_dir):
    FR.write_fixed_records(G.generate_records(spark, 500, num_partitions=1), out_dir)
    with pytest.raises(ValueError, match="not in key order"):
        K.build_key_index(spark, out_dir, block_rows=10)
    assert K.current(out_dir) is None
    assert K.read_key_range(spark, out_dir, b"\x80").count() == FR.read_fixed_records(spark, out_dir).where(
        F.col("key") >= F.lit(b"\x80")).count()
    FR.write_fixed_records(S.total_order_sort(G.generate_records(spark, 50), 2, "range"), out_dir, mode="overwrite")
    K.build_key_index(spark, out_dir)
    before = K.current(out_dir)
    with pytest.raises(ValueError):
        K.build_key_index(spark, out_dir, block_rows=0)
    assert K.current(out_dir) == before


def test_empty_dataset(spark, out_dir):
    os.makedirs(out_dir)
    assert K.build_key_index(spark, out_dir).count() == 0
    assert K.read_key_range(spark, out_dir, b"a", b"b").count() == 0
    assert K.lookup(spark, out_dir, spark.createDataFrame([(bytearray(b"a"),)], "key binary")).count() == 0
