import random
import re

import pytest
from xxhash import xxh64_intdigest

from sortproof.llm import components, simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, fp string, id int, component_id string"


def brute_fp(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def df_of(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "c") for i, t in rows], DDL)


def corpus():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "one"), (3, "one two"), (4, "One TWO"), (5, " \n"),
            (6, "é ß 漢字 x"), (7, "É ß 漢字 x")]
    base = [[rng.choice(vocab) for _ in range(rng.randint(30, 300))] for _ in range(25)]
    for i in range(8, 220):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    rows.append((400, " ".join(rng.choice(vocab) for _ in range(60000))))
    return rows


@pytest.mark.parametrize("k,bits", [(3, 2), (5, 3), (3, 0), (3, 5)])
def test_brute_force(spark, k, bits):
    rows = corpus()
    got = {r.id: r for r in S.near_duplicates(df_of(spark, rows), shingle=k, max_bits=bits).collect()}
    fps = [brute_fp(t, k) for _, t in rows]
    comp = brute_components(fps, bits)
    assert [got[i].fp & (2 ** 64 - 1) for i, _ in rows] == fps
    assert [got[i].component_id for i, _ in rows] == [rows[c][0] for c in comp]
    assert len(set(comp)) < len(rows) - 20


def test_links_of_random_bits(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(6):
            g = f
            for _ in range(rng.randint(1, 3)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(sign(f),) for f in fps], "fp long")
    for bits in (1, 2, 3, 4):
        got = {(r.a, r.b) for r in S.links(df, bits).collect()}
        want = {(min(sign(a), sign(b)), max(sign(a), sign(b))) for a in fps for b in fps
                if a < b and bin(a ^ b).count("1") <= bits}
        assert got == want


def test_nulls_ties_empty(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "only null id here"), (9, None)]
    got = sorted(((r.id, r.component_id) for r in S.near_duplicates(df_of(spark, rows)).collect()),
                 key=str)
    assert got == sorted([(None, 3), (3, 3), (3, 3), (None, None), (9, 9)], key=str)
    kept = S.keep_one(df_of(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "id", "component_id"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 9, None]
    assert S.near_duplicates(spark.createDataFrame([], DDL)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)]                       # a chain
    edges += [(1000, 2000 + i) for i in range(300)] + [(7, 7), (None, 3), (5, 2), (2, 5), (2, 5)]
    edges += [(rng.randint(5000, 5400), rng.randint(5000, 5400)) for _ in range(220)]
    got = {r.node: r.component for r in
           components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in parent}


def test_keep_one_keeps_a_row_of_every_group(spark):
    rng = random.Random(6)
    text = [" ".join(f"t{rng.randrange(500)}" for _ in range(60)) for _ in range(12)]
    rows = [(None, text[k]) for k in range(6)] + [(None, text[0])]          # null ids, unrelated texts
    rows += [(7, text[6]), (7, text[7]), (7, text[7])]                      # one id, unrelated texts
    rows += [(5, text[8]), (None, text[8]), (4, text[8]), (4, text[8].upper())]
    rows += [(9, text[9]), (9, text[10]), (8, text[10])]
    comp = brute_components([brute_fp(t, 3) for _, t in rows], 2)
    assert len(set(comp)) == 11
    kept = S.keep_one(df_of(spark, rows)).collect()
    of = {t: c for (_, t), c in zip(rows, comp)}
    assert sorted(of[r.text] for r in kept) == sorted(set(comp))            # one of each, none lost
    least = {c: min((i for (i, _), k in zip(rows, comp) if k == c and i is not None), default=None) for c in comp}
    assert all(r.doc_id == least[of[r.text]] for r in kept)
    again = S.keep_one(df_of(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, kept)) == sorted(map(str, again))                # whatever the order


def test_keep_one_keeps_columns_of_any_name_and_maps(spark):
    names = "doc_id long, text string, __h1 string, h1 int, root int, id int, m map<string,int>"
    rows = [(1, "alpha beta gamma delta", "mine", 5, 6, 7, {"a": 1, "b": 2}),
            (1, "alpha beta gamma delta", "mine", 5, 6, 7, {"a": 1, "b": 3}),
            (2, "something else entirely here", None, None, 6, 7, None)]
    d = spark.createDataFrame(rows, names)
    out = S.keep_one(d)
    assert out.dtypes == d.dtypes
    first = [sorted(map(str, S.keep_one(d.repartition(n)).collect())) for n in (1, 3, 5)]
    assert first[0] == first[1] == first[2] and len(first[0]) == 2
    assert "'mine'" in "".join(first[0])


def test_texts_beyond_a_slice(spark):
    long = "word other thing " * 1_200_000                    # over 16 MB
    d = spark.createDataFrame([(1, long), (2, long), (3, "short text")], "doc_id long, text string")
    got = {r.id: r.component_id for r in S.near_duplicates(d).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
