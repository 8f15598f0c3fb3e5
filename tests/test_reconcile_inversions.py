import random
from collections import Counter

import numpy as np
import pytest

from sortproof.operators import generate as G
from sortproof.operators import inversions as I
from sortproof.operators import reconcile as RC

DDL = "k binary, v string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(None if k is None else bytearray(k), v, n) for k, v, n in rows], DDL).repartition(4)


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, b"", rng.randbytes(3)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0, rng.randint(0, 9)]))
            for _ in range(n)]


def plain(df):
    return Counter({(r.side, None if r.k is None else bytes(r.k), r.v, r.n): r.copies for r in df.collect()})


def expected(a, b):
    x, y = Counter(a), Counter(b)
    return Counter({("before", *k): n for k, n in (x - y).items()} | {("after", *k): n for k, n in (y - x).items()})


@pytest.mark.parametrize("drop,add", [(0, 0), (3, 0), (0, 4), (25, 30), (400, 300)])
def test_changed_rows_are_except_all_both_ways(spark, drop, add):
    a = made(1, 4000)
    b = a[drop:] + made(2, add) + a[-1:] * (add // 10)
    random.Random(3).shuffle(b)
    got = RC.changed_rows(frame(spark, a), frame(spark, b))
    assert plain(got) == expected(a, b)
    assert plain(RC.changed_by_counting(frame(spark, a), frame(spark, b), ["k", "v", "n"])) == expected(a, b)


def test_large_difference_is_counted(spark):
    a, b = made(4, 3000), made(5, 3000)
    assert plain(RC.changed_rows(frame(spark, a), frame(spark, b), most=50)) == expected(a, b)


def test_estimate(spark):
    recs = G.generate_records(spark, 20_000)
    assert RC.estimate_differences(recs, recs, ["key", "value"]) == 0
    for n in (1, 40, 3000):
        got = RC.estimate_differences(recs, recs.where(f"row >= {n}"), ["key", "value"])
        assert n / 2 <= got <= 2 * n


def test_peeling_is_exact_or_says_so(spark):
    rng = random.Random(6)
    items = [(rng.randrange(1 << 62), rng.randrange(1 << 62), rng.choice([-3, -1, 1, 1, 2])) for _ in range(300)]

    def cells(m):
        t = {}
        for a, b, n in items:
            for x in RC._places(a, b, m // 3):
                c = t.setdefault(x, [0, 0, 0, 0])
                for i, v in enumerate((1, a, b, RC._check(a, b))):
                    c[i] += n * v
        return [dict(zip(("cell", "count", "a", "b", "c"), (x, *c))) for x, c in t.items()]
    assert RC._peel(cells(900), 900) == ({(a, b): n for a, b, n in items}, True)
    got, emptied = RC._peel(cells(60), 60)
    assert not emptied and all(got.get((a, b), n) == n for a, b, n in items)


def test_empty_and_columns(spark):
    none = frame(spark, [])
    assert RC.changed_rows(none, none).count() == 0
    a = frame(spark, [(b"x", "a", 1), (b"x", "b", 1)])
    b = frame(spark, [(b"x", "c", 1), (b"x", "d", 1)])
    assert RC.changed_rows(a, b, ["k", "n"]).count() == 0
    assert plain(RC.changed_rows(a, none)) == expected([(b"x", "a", 1), (b"x", "b", 1)], [])


def falls(a):
    return sum(x > y for i, x in enumerate(a) for y in a[i + 1:])


def test_merge_count():
    rng = random.Random(7)
    for n in [*range(12), 64, 65, 300]:
        for top in (1, 3, 1000):
            a = [rng.randrange(top) for _ in range(n)]
            assert I.count_inversions(np.array(a, np.int64)) == falls(a)
    assert I.count_inversions(np.arange(100_000)[::-1]) == 100_000 * 99_999 // 2


def test_inversions_of_files(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for f, n in (("a", 700), ("b", 1), ("sorted", 300), ("hot", 500), ("reverse", 90)):
        keys = [rng.choice([None, b"", rng.randbytes(2)]) if f != "hot" else rng.choice([b"h", b"h", rng.randbytes(1)])
                for _ in range(n)]
        order = lambda k: (k is not None, k or b"")
        if f in ("sorted", "reverse"):
            keys.sort(key=order, reverse=f == "reverse")
        pos = sorted(rng.sample(range(3 * n), n))
        rows += [(f, p, None if k is None else bytearray(k)) for p, k in zip(pos, keys)]
        want[f] = (n, falls([order(k) for k in keys]))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, pos long, key binary").repartition(5)
    for group_rows, block_rows in ((40, 64), (1 << 20, 1 << 17), (9, 5000)):
        got = I.inversions(df, group_rows=group_rows, block_rows=block_rows).collect()
        assert {r.file: (r.rows, int(r.inversions)) for r in got} == want
    assert I.inversions(df.where("pos < 0")).count() == 0
    assert [int(r.inversions) for r in I.inversions(df.where("key is null and file = 'a'")).collect()] == [0]
