import bisect
import random

import pytest
from pyspark.sql import functions as F

from sortproof import jobs
from sortproof.operators import generate as G
from sortproof.operators import hotkeys as H
from sortproof.operators import quantiles as Q


def frame(spark, keys, parts=6):
    return spark.createDataFrame([(None if k is None else bytearray(k),) for k in keys], "key binary").repartition(parts)


def many(seed, n, kind):
    rng = random.Random(seed)
    if kind == "hot":
        return [b"hot" if rng.random() < 0.4 else rng.randbytes(rng.randint(0, 6)) for _ in range(n)]
    keys = [rng.randbytes(4) for _ in range(n)]
    return sorted(keys) if kind == "sorted" else keys


@pytest.mark.parametrize("kind", ["random", "sorted", "hot"])
@pytest.mark.parametrize("k", [16, 256])
def test_split_points_lie_within_the_bound(spark, kind, k):
    keys = many(1, 20_000, kind)
    order = sorted(keys)
    rows = Q.sketch_split_points(Q.key_sketch(frame(spark, keys), k=k), 25).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(1, 25))
    assert [bytes(r.key) for r in rows] == sorted(bytes(r.key) for r in rows)
    for r in rows:
        assert r.n == 20_000 and r.target == (2 * r.n * r.idx + 25) // 50
        low, high = bisect.bisect_left(order, bytes(r.key)), bisect.bisect_right(order, bytes(r.key))
        assert low - r.error <= r.target < high + r.error
    assert rows[0].error <= 20_000 * 14 / k                    # n log2(n / k) / k


def test_exact_while_nothing_is_compacted(spark):
    keys = many(2, 900, "random")
    rows = Q.sketch_split_points(Q.key_sketch(frame(spark, keys), k=1000), 7).orderBy("idx").collect()
    order = sorted(keys)
    assert [bytes(r.key) for r in rows] == [order[r.target] for r in rows] and rows[0].error == 0


def test_sketch_is_small_and_merges(spark):
    k = 64
    a, b = many(3, 30_000, "random"), many(4, 5_000, "hot")
    both = Q.merge_sketches(Q.key_sketch(frame(spark, a), k=k).unionAll(Q.key_sketch(frame(spark, b), k=k)), k=k)
    r = both.first()
    assert r.n == 35_000 and all(len(s) <= k for s in r.steps) and sum(
        len(s) << h for h, s in enumerate(r.steps)) == r.n
    order = sorted(a + b)
    for x in Q.sketch_split_points(both, 10).collect():
        low, high = bisect.bisect_left(order, bytes(x.key)), bisect.bisect_right(order, bytes(x.key))
        assert low - x.error <= x.target < high + x.error


def test_nulls_empty_and_too_few(spark):
    assert Q.split_points(frame(spark, [None, None]), 3) == []
    assert Q.split_points(frame(spark, [b"a"]), 1) == []
    assert Q.split_points(frame(spark, [b"b", None, b"a"]), 2) == [b"b"]
    with pytest.raises(Exception, match="3 partitions need at least as many"):
        Q.split_points(frame(spark, [b"b", None, b"a"]), 3)


def test_sort_job_with_sketched_splits(spark, tmp_path):
    gen, out = str(tmp_path / "gen"), str(tmp_path / "sorted")
    got = jobs.generate_job(spark, 4000, gen, num_partitions=3)
    assert jobs.sort_job(spark, gen, out, num_partitions=5, sampler="sketch") == got
    assert [r.kind for r in jobs.validate_job(spark, out, expected=got).collect()] == ["checksum"]
    from sortproof.sources.fixed_record import list_files
    assert all(abs(size - 80_000) <= 2000 for _, size in list_files(out))


@pytest.mark.parametrize("share", [0.3, 0.02, 0.004, 1.0])
def test_hot_keys_are_exact(spark, share):
    rng = random.Random(5)
    keys = [rng.choice([b"a", b"a", b"b", b"", b"c" * 40]) if rng.random() < 0.5 else b"%d" % int(rng.paretovariate(0.7))
            for _ in range(20_000)]
    keys += [None] * 3000
    n = 20_000
    want = {k: keys.count(k) for k in set(keys) - {None}}
    got = {bytes(r.key): r.rows for r in H.hot_keys(frame(spark, sorted(keys, key=str), 9), share).collect()}
    assert got == {k: c for k, c in want.items() if c > share * n}


def test_loss_is_bounded(spark):
    keys = [b"%d" % (i % 5000) for i in range(40_000)]
    rows = H.frequent_keys(frame(spark, keys), 50).collect()
    total = next(r for r in rows if r.key is None)
    assert total.n == 40_000 and total.lost <= 40_000 / 50 and len(rows) <= 6 * 50 + 1
    assert all(8 - total.lost <= r["count"] <= 8 for r in rows if r.key is not None)


def test_no_hot_keys(spark):
    assert H.hot_keys(frame(spark, []), 0.1).count() == 0
    assert H.hot_keys(frame(spark, [None] * 4), 0.1).count() == 0
    only = H.hot_keys(G.generate_records(spark, 100).withColumn("key", F.lit(b"k")), 0.5).collect()
    assert [(bytes(r.key), r.rows) for r in only] == [(b"k", 100)]
    with pytest.raises(ValueError):
        H.hot_keys(frame(spark, []), 0.0)
