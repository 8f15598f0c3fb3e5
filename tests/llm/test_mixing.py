import hashlib
import random
import re
from collections import defaultdict

import pytest

from sortproof.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, source string, size string, target int, id string, y string"


def fill(sizes, weights, share, cap):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
            open_.discard(s)
        left -= sum(out[s] for s in over)
    return out


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        src = rng.choice(["hot"] * 10 + ["a", "b", "Z", "é", None])
        k = rng.choice([0, 1, 5, 20, 60, 300])
        rows.append((i, " ".join("w%d" % rng.randrange(50) for _ in range(k)) or None, src))
    return rows + [(n, "long " * 4000, "b"), (None, "null id text", "a"), (n + 1, "x y", "tiny"), (n + 2, "", "none")]


def df(spark, rows):
    return spark.createDataFrame([(i, t, s, "q", 1, "i", "y") for i, t, s in rows], DDL)


@pytest.mark.parametrize("weights,share,cap", [((3, 1, 2), 1.5, 2.0), ((1,), 0.4, 1.0), ((5, 1), 2.5, 2.0)])
def test_targets_and_sample(spark, weights, share, cap):
    rows = corpus()
    got = M.mix(df(spark, rows), weights=weights, share=share, cap=cap).collect()
    assert len(got) == len(rows)
    size, by = defaultdict(int), defaultdict(list)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    want = fill(size, weights, share, cap)
    for r in got:
        by[r.source].append(r)
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.copies * r.size and r.taken <= cap * r.size + 1e-9
    for s, rs in by.items():
        # brute force: whole copies, then documents in hash order while over half of one fits
        text = {i: t for i, t, x in rows if x == s}
        sure = int(want[s] / size[s]) if size[s] else 0
        left = rs[0].target - sure * size[s]
        def u(i):
            h = hashlib.md5(f"1:{'' if i is None else i}:{text[i] or ''}".encode()).hexdigest()[:13]
            v = (int(h, 16) + 0.5) / 2 ** 52
            return (v / (1 - v)) / (1 + v / (1 - v))
        ahead, copies = 0, {}
        for r in sorted(rs, key=lambda r: (u(r.id), r.id is not None, r.id or 0)):
            copies[r.id] = sure + (left > 0 and ahead + r.size / 2 <= left)
            ahead += r.size
        assert {r.id: r.copies for r in rs} == copies
        taken = sum(r.taken for r in rs)
        assert abs(taken - want[s]) <= max([r.size for r in rs]) / 2 + 1e-6
    again = M.mix(df(spark, rows[::-1]), weights=weights, share=share, cap=cap).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_inclusion_odds_follow_weights(spark):
    rows = [(i, "a b c d", "s", "q", 1 if i % 2 else 6, "i", "y") for i in range(4000)]
    d = spark.createDataFrame(rows, DDL)
    got = M.mix(d, weights=(1,), share=0.4, cap=1.0, weight_col="target").collect()
    share = [sum(r.copies for r in got if r.id % 2 == k) / 2000 for k in (0, 1)]
    # odds six times as high
    assert share[0] / (1 - share[0]) / (share[1] / (1 - share[1])) == pytest.approx(6, rel=0.25)
    assert sum(r.taken for r in got) == pytest.approx(0.4 * 16000, abs=4)


def test_repeat_rows_and_empty(spark):
    rows = corpus(120) + [(7, "same text twice", "a")] * 3
    d = df(spark, rows)
    out = M.repeat(d)
    assert out.columns == d.columns
    n = defaultdict(int)
    for r in out.collect():
        n[r.doc_id, r.text] += 1
    want = defaultdict(int)
    key = {r.id: r for r in M.mix(d).collect()}
    assert len(key) > 100
    for r in M.mix(d).join(d.selectExpr("doc_id", "text", "xxhash64(text) as k").distinct(),
                           on=[M.F.col("id").eqNullSafe(M.F.col("doc_id")),
                               M.F.col("k") == M.F.col("text_key")]).collect():
        want[r.doc_id, r.text] += r.copies
    assert dict(n) == {k: v for k, v in want.items() if v}
    assert M.mix(spark.createDataFrame([], DDL)).count() == 0
    assert M.repeat(spark.createDataFrame([], DDL)).count() == 0
    zero = M.mix(df(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in zero] == [(0, 0.0, 0)] * 2


def test_one_document_in_two_sources(spark):
    """Copies go to the source that the mix gave them to."""
    rows = [(1, "a b c", "x")] * 4 + [(1, "a b c", "y")] * 4
    d = df(spark, rows)
    for options in ({}, {"weights": (1, 5), "share": 0.7, "cap": 1.0}, {"weights": (5, 2), "share": 1.3}):
        want, got = defaultdict(int), defaultdict(int)
        for r in M.mix(d, **options).collect():
            want[r.source] += r.copies
        for r in M.repeat(d, **options).collect():
            got[r.source] += 1
        assert got == {k: v for k, v in want.items() if v}


def test_equal_rows_are_ranked_once(spark, monkeypatch):
    """A third of all rows equal (null id, null text) or equal and long: dealt out, not windowed."""
    monkeypatch.setattr(M, "_DEAL", 7)
    rows = [(None, None, "x")] * 300 + [(5, "one two three", "x")] * 400 + [(i, "w " * (i % 9), "x") for i in range(10, 200)]
    d = df(spark, rows)
    assert M.shares(d, share=0.6, cap=1.0).count() == 192
    got = M.mix(d, weights=(1,), share=0.6, cap=1.0).collect()
    assert len(got) == len(rows)
    words = sum(len((t or "").split()) for _, t, _ in rows)
    assert abs(sum(r.taken for r in got) - 0.6 * words) <= 4.5
    copies = defaultdict(int)
    for r in got:
        copies[r.id] += r.copies
    back = defaultdict(int)
    for r in M.repeat(d, weights=(1,), share=0.6, cap=1.0).collect():
        back[r.doc_id] += 1
    assert back == {k: v for k, v in copies.items() if v}


def test_repeat_keeps_columns_of_any_name(spark):
    names = "doc_id long, text string, source string, __rows int, __n int, row int, copies int, k int, m map<string,int>"
    rows = [(i % 3, f"t {i % 2}", "s", i, 1, 2, 3, 4, {"a": i % 2}) for i in range(40)]
    d = spark.createDataFrame(rows, names)
    out = M.repeat(d, weights=(1,), share=0.75, cap=1.0)
    assert out.columns == d.columns
    assert set(map(str, out.collect())) <= set(map(str, d.collect()))
    assert out.count() == sum(r.copies for r in M.mix(d, weights=(1,), share=0.75, cap=1.0).collect())
