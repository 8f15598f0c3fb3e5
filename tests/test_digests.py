import random
from collections import Counter

import pytest

from sortproof.operators import digests as DG
from sortproof.operators import sort as S
from sortproof.operators import generate as G
from sortproof.sources import fixed_record as FR
from sortproof.sources import key_index as KI

DDL = "key binary, v string, n int"
SPLITS = [bytes([i]) for i in range(8, 256, 8)]


def frame(spark, rows):
    return spark.createDataFrame([(None if k is None else bytearray(k), v, n) for k, v, n in rows], DDL).repartition(3)


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, b"", b"\x08", *[rng.randbytes(3) for _ in range(9)]]), rng.choice([None, "", "a"]),
             rng.choice([None, rng.randint(0, 9)])) for _ in range(n)]


def leaf(k):
    return 0 if k is None else sum(k >= s for s in SPLITS)


def trees(spark, a, b, fanout=3):
    return [DG.digest_tree(frame(spark, x), SPLITS, fanout=fanout) for x in (a, b)]


@pytest.mark.parametrize("drop,add,fanout", [(0, 0, 3), (1, 0, 2), (0, 3, 16), (6, 5, 64), (900, 500, 3)])
def test_differing_leaves_and_rows_equal_brute_force(spark, drop, add, fanout):
    a = made(1, 1500)
    b = a[drop:] + made(2, add) + a[-1:] * (add // 3)
    random.Random(5).shuffle(b)
    found = DG.differing_leaves(*trees(spark, a, b, fanout))
    x, y = Counter(a), Counter(b)
    lost, new = x - y, y - x
    want = {leaf(k) for k, _, _ in [*lost, *new]}
    bounds = [None, *SPLITS, None]
    rows = [(r.leaf, *[None if v is None else bytes(v) for v in (r.lo, r.hi)], r.rows_before, r.rows_after)
            for r in found.collect()]
    assert sorted(rows) == [(i, bounds[i], bounds[i + 1], sum(leaf(r[0]) == i for r in a), sum(leaf(r[0]) == i for r in b))
                            for i in sorted(want)]
    for most in (2, 64):
        got = DG.changed_in_ranges(frame(spark, a), frame(spark, b), found, ["key", "v", "n"], most=most).collect()
        assert Counter({(r.side, None if r.key is None else bytes(r.key), r.v, r.n): r.copies for r in got}) == Counter(
            {("before", *k): n for k, n in lost.items()} | {("after", *k): n for k, n in new.items()})


def test_parents_are_sums_and_rows_may_lie_anywhere(spark):
    rows = made(7, 400)
    a, b = trees(spark, rows, rows[::-1], 4)
    assert a.height == 3
    nodes = {(r.level, r.node): (r.rows, r.a, r.b) for r in a.nodes.collect()}
    assert nodes == {(r.level, r.node): (r.rows, r.a, r.b) for r in b.nodes.collect()}
    for (level, node), got in nodes.items():
        if level:
            kids = [v for (l, n), v in nodes.items() if l == level - 1 and n // 4 == node]
            assert got == tuple(map(sum, zip(*kids)))
    assert nodes[3, 0][0] == 400


def test_empty_and_refused(spark):
    none, some = [], made(3, 20)
    assert DG.differing_leaves(*trees(spark, none, none)).count() == 0
    assert sum(r.rows_after for r in DG.differing_leaves(*trees(spark, none, some)).collect()) == 20
    one = [DG.digest_tree(frame(spark, x), []) for x in (some, some[1:])]
    assert [(r.leaf, r.lo, r.hi) for r in DG.differing_leaves(*one).collect()] == [(0, None, None)]
    with pytest.raises(ValueError, match="must rise"):
        DG.digest_tree(frame(spark, some), [b"b", b"b"])
    with pytest.raises(ValueError, match="differ in split points"):
        DG.differing_leaves(one[0], trees(spark, some, some)[0])


def test_only_unequal_ranges_are_read(spark, tmp_path):
    recs = G.generate_records(spark, 6000).select("key", "value")
    changed = recs.where("hex(key) not like 'A0%' or crc32(value) % 2 = 0")
    assert 0 < changed.count() < 6000
    read, stored = [], []
    for i, d in enumerate((recs, changed)):
        path, tree = str(tmp_path / f"d{i}"), str(tmp_path / f"t{i}")
        FR.write_fixed_records(S.total_order_sort(d, 3, "prefix7"), path)
        KI.build_key_index(spark, path, block_rows=20)
        DG.save_tree(DG.digest_tree(FR.read_fixed_records(spark, path, columns=["key", "value"]), SPLITS), tree)
        stored.append(DG.load_tree(spark, tree))

        def side(ranges, path=path):
            # what the scan itself hands over, before any filter
            d = FR.read_fixed_records(spark, path, engine="python", key_ranges=ranges, columns=["key", "value"])
            read.append((ranges, d.count()))
            return KI.read_key_ranges(spark, path, ranges, columns=["key", "value"])
        stored.append(side)
    before, side0, after, side1 = stored
    leaves = DG.differing_leaves(before, after)
    got = DG.changed_in_ranges(side0, side1, leaves, ["key", "value"])
    assert sorted(bytes(r.key) + bytes(r.value) for r in got.collect()) == sorted(
        bytes(r.key) + bytes(r.value) for r in recs.exceptAll(changed).collect())
    inside = recs.where("key >= X'A0' and key < X'A8'").count()
    for ranges, rows in read:
        assert ranges == [(b"\xa0", b"\xa8")]
        assert rows <= inside + 3 * 20          # the blocks at its ends
    equal = DG.differing_leaves(before, before)
    assert DG.changed_in_ranges(side0, side0, equal, ["key", "value"]).count() == 0
    assert read[-1] == ([], 0)
