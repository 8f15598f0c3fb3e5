import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sortproof.operators import generate as G
from sortproof.operators import partition as P


def _counts(df, p, method):
    d = P.assign_partition(df, p, method).groupBy("pid").count().collect()
    return [dict((r.pid, r["count"]) for r in d).get(i, 0) for i in range(p)]


@pytest.mark.parametrize("method,n,p,expected", [
    ("prefix7", 1000, 4, [273, 256, 221, 250]),
    ("prefix7", 1000, 7, [151, 160, 146, 145, 123, 134, 141]),
    ("prefix3", 1000, 4, [273, 256, 221, 250]),
    ("prefix7", 100_000, 4, [25140, 25080, 24905, 24875]),
    ("prefix7", 100_000, 7, [14340, 14306, 14359, 14390, 14186, 14330, 14089]),
    ("prefix3", 100_000, 4, [25140, 25080, 24905, 24875]),
])
def test_prefix_partition_golden(spark, method, n, p, expected):
    assert _counts(G.generate_records(spark, n, num_partitions=4), p, method) == expected


def test_split_points_golden(spark):
    df = G.generate_records(spark, 1000, num_partitions=3).select("key")
    assert [s.hex() for s in P.split_points(df, 4)] == [
        "3acb3eea862445891958", "79b851de662f73feacfe", "c035dfde543669363967"]


def test_split_points_edges(spark):
    empty = spark.createDataFrame([], "key binary")
    assert P.split_points(empty, 4) == []
    two = spark.createDataFrame([(b"\x01",), (b"\x02",)], "key binary")
    with pytest.raises(ValueError):
        P.split_points(two, 3)
    # exact rounding: n=10, p=4 -> positions round(2.5)=3, 5, round(7.5)=8
    ten = spark.createDataFrame([(bytes([i]),) for i in range(10)], "key binary")
    assert [s[0] for s in P.split_points(ten, 4)] == [3, 5, 8]


def test_extreme_keys(spark):
    df = spark.createDataFrame([(b"\xff" * 10,), (b"\x00" * 10,), (b"\xff\xff",), (b"",)],
                               "key binary")
    for method in ("prefix7", "prefix3"):
        got = [r.pid for r in P.assign_partition(df, 4, method).collect()]
        assert got == [3, 0, 3, 0]


def test_binary_search_equals_linear(spark, monkeypatch):
    rnd = random.Random(7)
    splits = sorted({bytes(rnd.getrandbits(8) for _ in range(3)) for _ in range(200)})
    keys = [bytes(rnd.getrandbits(8) for _ in range(rnd.randint(0, 4))) for _ in range(2000)]
    keys += splits[:20]
    df = spark.createDataFrame([(k,) for k in keys], "key binary")
    got = [r.pid for r in df.select(P.range_partition("key", splits).alias("pid")).collect()]
    import bisect
    assert got == [bisect.bisect_right(splits, k) for k in keys]
    few = splits[:5]
    got = [r.pid for r in df.select(P.range_partition("key", few).alias("pid")).collect()]
    assert got == [bisect.bisect_right(few, k) for k in keys]
    monkeypatch.setattr(P, "COLUMN_LOOKUP_MAX", 8)
    with pytest.raises(ValueError):
        P.range_partition("key", splits)


def test_hot_split_keys_spread(spark):
    splits = [b"\x10", b"\x20", b"\x20", b"\x20", b"\x30"]
    assert P.hot_split_keys(splits) == {b"\x20": (1, 3)}
    df = spark.range(300).select(F.lit(b"\x20").alias("key"), F.col("id"))
    pids = {r.pid for r in df.select(P.range_partition("key", splits, F.xxhash64("id"))
                                     .alias("pid")).collect()}
    assert pids == {2, 3, 4}
    # without a salt: the upper-bound rule
    assert {r.pid for r in df.select(P.range_partition("key", splits).alias("pid")).collect()} == {4}


def test_route_clamps(spark):
    df = spark.range(20).select(F.col("id").cast("int").alias("pid"))
    out = P.route(df, 4).select("pid", F.spark_partition_id().alias("part")).collect()
    assert all(r.pid == r.part for r in out)
    assert {r.pid for r in out} == {0, 1, 2, 3}


def test_block_sample_systematic(spark):
    # 3 files of 2500, 1000, 4100 records, blocks of 500 -> 5 + 2 + 9 = 16 blocks
    files = spark.createDataFrame([("a", 2500), ("b", 1000), ("c", 4100)], "file string, rows bigint")
    recs = (spark.createDataFrame([("a", 2500), ("b", 1000), ("c", 4100)], "file string, rows bigint")
            .select("file", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("pos"))
            .withColumn("key", F.unhex(F.lpad(F.hex("pos"), 4, "0"))))
    s = P.block_sample(recs, files, 500, num_samples=4, sample_size=40)
    got = sorted((r.file, r.block, r.pos) for r in s.collect())
    # samples=4 of 16 blocks -> global blocks 0,4,8,12 -> (a,0) (a,4) (c,1) (c,5); 10 each
    want = sorted((f, b, b * 500 + i) for f, b in [("a", 0), ("a", 4), ("c", 1), ("c", 5)]
                  for i in range(10))
    assert got == want


def test_split_point_store(spark, tmp_path):
    df = G.generate_records(spark, 1000, num_partitions=3).select("key")
    path = str(tmp_path / "splits")
    P.save_split_points(P.split_point_table(df, 4), path)
    assert P.load_split_points(spark, path) == P.split_points(df, 4)


def test_join_lookup_equals_bisect(spark, monkeypatch):
    monkeypatch.setattr(P, "LOOKUP_FANOUT", 4)
    rnd = random.Random(5)
    splits = sorted(bytes(rnd.getrandbits(8) for _ in range(rnd.randint(1, 3))) for _ in range(60))
    splits += [splits[10]] * 3          # a hot key: equal split points
    splits.sort()
    keys = [bytes(rnd.getrandbits(8) for _ in range(rnd.randint(0, 4))) for _ in range(3000)]
    keys += splits + [b"", b"\xff" * 6]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, key binary")
    import bisect
    got = {r.i: r.pid for r in P.assign_partition(df, len(splits) + 1, "sampled", splits=splits,
                                                  spread_hot_keys=False).collect()}
    assert got == {i: bisect.bisect_right(splits, k) for i, k in enumerate(keys)}
    spread = P.assign_partition(df, len(splits) + 1, "sampled", splits=splits,
                                salt_columns=["i"]).collect()
    assert len(spread) == len(keys)
    for r in spread:
        lo, hi = bisect.bisect_left(splits, r.key), bisect.bisect_right(splits, r.key)
        assert (r.pid == hi) if hi - lo <= 1 else (lo + 1 <= r.pid <= hi)


def test_spread_sample_covers_every_split(spark, tmp_path):
    from sortproof import jobs
    from sortproof.sources import fixed_record as FR
    gen, srt = str(tmp_path / "gen"), str(tmp_path / "sorted")
    jobs.generate_job(spark, 20_000, gen, num_partitions=2)
    # already-sorted input: the block sample sees only a few key ranges
    jobs.sort_job(spark, gen, srt, num_partitions=4, method="prefix7")
    s = P.file_spread_sample(spark, srt, sample_size=400, split_bytes=100 * 500)
    rows = s.collect()
    files = {r.file for r in rows}
    assert len(files) == 4 and 400 <= len(rows) <= 480
    assert len({r.pos // 500 for r in rows if r.file == sorted(files)[0]}) > 5
    out = str(tmp_path / "resorted")
    got = jobs.sort_job(spark, srt, out, num_partitions=8, method="sampled", sampler="spread",
                        sample_size=2000)
    sizes = [r["count"] for r in FR.read_fixed_records(spark, out).groupBy("file").count().collect()]
    assert got["rows"] == 20_000 and max(sizes) < 2 * 20_000 / 8


def test_join_lookup_keeps_null_keys(spark, monkeypatch):
    monkeypatch.setattr(P, "LOOKUP_FANOUT", 2)
    df = spark.createDataFrame([(None,), (b"\x05",), (b"\xf0",)], "key binary")
    got = {(None if r.key is None else bytes(r.key), r.pid) for r in
           P.assign_partition(df, 5, "sampled", splits=[b"\x01", b"\x10", b"\x80", b"\xa0"],
                              spread_hot_keys=False).collect()}
    assert got == {(None, 0), (b"\x05", 1), (b"\xf0", 4)}


def test_block_sample_reaches_the_end_and_takes_one_at_least(spark):
    files = spark.createDataFrame([("a", 1900)], "file string, rows bigint")
    recs = spark.range(1900).select(F.lit("a").alias("file"), F.col("id").alias("pos"),
                                    F.unhex(F.lpad(F.hex("id"), 4, "0")).alias("key"))
    got = P.block_sample(recs, files, 100, num_samples=10, sample_size=10).collect()
    assert sorted(r.block for r in got) == [i * 19 // 10 for i in range(10)]
    few_df = P.block_sample(recs, files, 100, num_samples=10, sample_size=3)
    few = few_df.collect()
    assert len(few) == 10
    assert len(P.split_points(few_df, 4)) == 3


def test_too_few_keys_raise_in_every_form(spark, tmp_path):
    df = spark.createDataFrame([(b"a",), (b"b",)], "key binary")
    with pytest.raises(ValueError):
        P.split_points(df, 5)
    with pytest.raises(Exception, match="5 partitions need"):
        P.split_point_table(df, 5).collect()
    with pytest.raises(Exception, match="5 partitions need"):
        P.save_split_points(P.split_point_table(df, 5), str(tmp_path / "s"))
    assert P.split_points(df.limit(0), 5) == []


def test_lookup_of_shared_prefixes_and_many_splits(spark):
    import bisect
    rnd = random.Random(9)
    splits = sorted({b"http://www.example.com/" + str(rnd.randrange(10 ** 9)).encode() for _ in range(5000)})
    keys = [b"http://www.example.com/" + str(rnd.randrange(10 ** 9)).encode() for _ in range(2000)] + splits[::97]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i long, key binary")
    d = P.assign_partition(df, len(splits) + 1, "sampled", splits=splits, spread_hot_keys=False)
    assert {r.i: r.pid for r in d.collect()} == {i: bisect.bisect_right(splits, k) for i, k in enumerate(keys)}


def test_tie_breaker_orders_a_hot_key_across_partitions(spark):
    from sortproof.operators import sort as S
    rows = [(b"hot", i * 7919 % 3000, i) for i in range(3000)] + [(b"a%d" % i, i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "key binary, t long, u long").repartition(4)
    splits = [b"a5", b"hot", b"hot", b"hot", b"hot"]
    s = S.sort_with_global_position(df, 6, "sampled", tie_breaker=["t", "u"], splits=splits)
    got = sorted(s.collect(), key=lambda r: r.global_pos)
    assert [(bytes(r.key), r.t, r.u) for r in got] == sorted(rows)
    assert [r.global_pos for r in got] == list(range(len(rows)))
    sizes = {}
    for r in got:
        sizes[r.pid] = sizes.get(r.pid, 0) + 1
    assert len(sizes) == 6 and max(sizes.values()) < 1500
    with pytest.raises(ValueError):
        S.global_position(S.total_order_sort(df, 3, "range", with_position=True))
