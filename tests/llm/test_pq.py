import numpy as np
import pytest

from sortproof.llm import pq

DDL = "vec_id long, embedding array<float>, label int, n string, size string, v string, list string"


def brute(rows, t):
    good = {}
    for k, (i, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            a = np.array(v, np.float32).astype(float)
            good[k] = a / np.sqrt((a * a).sum())
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= t:
                links[a].add(b)
                links[b].add(a)
    out, seen = [], {}
    for k in range(len(rows)):
        if k not in seen:
            todo, comp = [k], set()
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp.add(x)
                    todo += links[x]
            ids = [rows[x][0] for x in comp if rows[x][0] is not None]
            for x in comp:
                seen[x] = min(ids) if ids else None
        out.append((rows[k][0], len(links[k]), seen[k]))
    return sorted(out, key=str)


def run(spark, rows, **o):
    df = spark.createDataFrame([(i, v, 1, "n", "s", "v", "l") for i, v in rows], DDL)
    return sorted(((r.id, r.n_links, r.component_id) for r in pq.near_duplicates(df, **o).collect()), key=str)


def vectors(n, dim, seed=0, spread=0.25):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(1, n // 8), dim))
    x = base[rng.integers(0, len(base), n)] + spread * rng.normal(size=(n, dim)) * rng.choice([0.2, 1, 2], (n, 1))
    return x.astype(np.float32)


@pytest.mark.parametrize("o", [dict(per_list=64, sigmas=4.0), dict(), dict(per_list=8, block=16), dict(per_list=400, block=20, subspaces=3), dict(per_list=10, sigmas=None)])
def test_brute_force(spark, o):
    x = vectors(700, 12)
    rows = [(i * 3, [float(a) for a in v]) for i, v in enumerate(x)]
    got = run(spark, rows, threshold=0.9, **o)
    assert got == brute(rows, 0.9)
    assert sum(n for _, n, _ in got) > 1000


def test_hot_copies_and_hot_family(spark):
    rng = np.random.default_rng(1)
    one, fam = rng.normal(size=16), rng.normal(size=16)
    rows = [(i, [float(np.float32(a)) for a in one]) for i in range(150)]
    rows += [(1000 + i, [float(np.float32(a)) for a in fam + 0.05 * rng.normal(size=16)]) for i in range(150)]
    rows += [(2000 + i, [float(np.float32(a)) for a in rng.normal(size=16)]) for i in range(150)]
    got = run(spark, rows, threshold=0.9, per_list=32, block=25)
    assert got == brute(rows, 0.9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-0.0, 5.0]), (11, [0.0, 5.0]),
            (None, [1.0, 0.0]), (None, [0.0, -3.0]), (1, [1.0, 0.0]), (12, [3e38, 3e38]), (13, [1e-38, 1e-38]),
            (14, [5.0]), (15, [7.0]), (16, [-7.0]), (3, None)]
    assert run(spark, rows) == brute(rows, 0.9)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_probes_are_sufficient_and_adc_bounds_hold():
    x = vectors(1500, 16, 3).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ix = pq.Index(x[:600], 40, 4, 32)
    at, codes, err = ix.encode(x)
    r = np.sqrt(0.2)
    row, lists = ix.probes(x, at, r)
    probed = set(zip(row.tolist(), lists.tolist()))
    i, j = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    assert len(i) > 1000
    for a, b in zip(i.tolist(), j.tolist()):
        lo, hi = (a, b) if at[a] <= at[b] else (b, a)
        assert at[lo] == at[hi] or (lo, at[hi]) in probed
    for c in range(3):
        m = np.flatnonzero(at == c)
        d = np.sqrt(np.maximum(ix.adc(x[:200], c, codes[m]), 0))
        true = np.linalg.norm(x[:200, None] - x[m][None], axis=2)
        assert (d - err[m][None] <= true + 1e-9).all()
    assert len(row) < 0.6 * len(x) * 40


def test_recall_on_the_table(spark):
    import os
    from sortproof.llm import queries
    path = "/root/testdata/sf0.01"
    if not os.path.exists(path):
        pytest.skip("driver tables missing")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id)
                  for r in queries.op3_embedding_pq(spark, path).collect()), key=str)
    assert got == brute(rows, 0.9)


def test_recall_of_probes_in_many_dimensions(spark):
    x = vectors(1200, 64, 5, 0.35)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    want = brute(rows, 0.9)
    got = run(spark, rows, threshold=0.9, per_list=10)
    links = sum(n for _, n, _ in want)
    assert links > 400 and sum(n for _, n, _ in got) >= 0.99 * links
    assert all(a[1] <= b[1] for a, b in zip(got, want))
    assert run(spark, rows, threshold=0.9, per_list=10, spread=None) == want


def test_no_pair_is_lost_where_differences_lie_along_few_directions(spark):
    rng = np.random.default_rng(4)
    plane = np.linalg.qr(rng.normal(size=(64, 3)))[0].T         # a few directions of 64
    x = (rng.normal(size=(500, 3)) @ plane).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    want = brute(rows, 0.99)
    assert sum(n for _, n, _ in want) > 1000
    assert run(spark, rows, threshold=0.99, per_list=10) == want


def test_a_stray_long_vector_does_not_shorten_the_step():
    x = vectors(600, 9, 2).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    import pyarrow as pa
    wide = np.column_stack([x, np.zeros((600, 391))])           # padded to a vector of 400
    ix = pq.Index(wide, 30, 4, 32)
    at, _, _ = ix.encode(wide)
    want = ix.probes(wide, at, np.sqrt(0.2))
    sent = type("Sent", (), {"value": ix})
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(600)), pa.array([1] * 600), pa.array([9] * 600, pa.int32()),
        pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "n", "size", "v"])
    got = pa.Table.from_batches(pq._encoder(sent, np.sqrt(0.2), 3.0)([batch])).to_pydict()
    assert {(i, c) for i, c, m in zip(got["id"], got["list"], got["member"]) if not m} == \
        set(zip(*(v.tolist() for v in want)))


def families(n, members, dim, rank, length, seed):
    """n unit vectors and near copies of each; differences of a length along ``rank`` directions."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    way = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:rank]
    d = rng.normal(size=(n, members, rank)) @ way
    d *= length / np.linalg.norm(d, axis=2, keepdims=True)
    return np.concatenate([base, (base[:, None] + d).reshape(-1, dim)]).astype(np.float32)


@pytest.mark.parametrize("rank", [64, 2])
def test_recall_by_queries_against_all_rows(spark, rank):
    """Many lists, differences near the limit: links of every vector whose id is divisible by 50."""
    x = families(1500, 3, 64, rank, 0.43, 6)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    got = {i: n for i, n, _ in run(spark, rows, threshold=0.9, per_list=60)}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    asked = np.arange(0, len(u), 50)
    true = (u[asked] @ u.T >= 0.9).sum(1) - 1
    found = np.array([got[i] for i in asked])
    assert (found <= true).all() and true.sum() > 100 and found.sum() >= 0.99 * true.sum()


def test_measured_directions(spark):
    x = families(400, 3, 32, 2, 0.3, 7)
    d = spark.createDataFrame([(i, 1, 32, [float(a) for a in v]) for i, v in enumerate(x)],
                              "id long, n long, size int, v array<float>")
    m = pq._directions(d, 32, 0.9)
    values = np.sort(np.linalg.eigvalsh(m))[::-1]
    assert values[:2].sum() > 0.9 and abs(values.sum() - 1) < 1e-9
    apart = spark.createDataFrame([(i, 1, 32, [float(k == i) for k in range(32)]) for i in range(32)],
                                  "id long, n long, size int, v array<float>")
    assert pq._directions(apart, 32, 0.9) is None
