import random
import re

from sortproof.llm import linededup as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, lang string, id string, removed int"


def words(line):
    return frozenset(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in line)))


def brute(rows, t):
    """(id, text) -> removed line numbers, by comparing every line with all before it."""
    docs = {(i, x or "") for i, x in rows}
    from xxhash import xxh64_intdigest

    def rk(x):
        h = xxh64_intdigest(x.encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    null = {(i, "") for i, x in rows if x is None}
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0,
                                        42 if d in null and (d[0], "") not in
                                        {(i, x) for i, x in rows} else rk(d[1])))
    seen, out = [], {}
    for d in order:
        gone = []
        for no, line in enumerate(d[1].split("\n")):
            w = words(line)
            if not w:
                continue
            if any(len(w & o) >= t * len(w | o) - 1e-9 for o in seen):
                gone.append(no)
            seen.append(w)
        out[d] = gone
    return out


def check(spark, rows, t=0.8):
    df = spark.createDataFrame([(i, x, "en", "clash", 7) for i, x in rows], DDL)
    got = L.removed_lines(df, threshold=t).collect()
    want = brute(rows, t)
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r.removed)
    exp = {}
    for (i, _), gone in want.items():
        exp.setdefault(i, []).append(gone)
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in exp.items()}
    return got


def test_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(1, 14))] for _ in range(60)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rng.shuffle(w)
            lines.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
        rows.append((rng.randint(0, 10 ** 6), "\n".join(lines)))
    got = check(spark, rows)
    assert sum(len(r.removed) for r in got) > 50
    check(spark, rows, 0.6)


def test_edges(spark):
    long_text = "\n".join(f"a{i} b{i} c{i} d{i} e{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, "same line here"), (5, "same line here"),
            (5, "same line here"), (None, "same line here\nother words only once"),
            (6, long_text), (7, "a5 b5 c5 d5 e5 extra\nfresh words stand in this line"),
            (8, "é É ü\né é ü")]
    check(spark, rows)


def test_empty(spark):
    df = spark.createDataFrame([], DDL)
    assert L.removed_lines(df).count() == 0
    assert L.clean(df).count() == 0


def test_clean_keeps_rows_and_columns(spark):
    rows = [(1, "keep this first line\nand a second one", "en", "x", 1),
            (2, "KEEP this first line\nsomething new and longer", "de", "x", 2),
            (3, None, None, None, None), (4, "and a second one", "fr", "y", 3),
            (4, "and a second one", "fr", "y", 3)]
    df = spark.createDataFrame(rows, DDL)
    got = L.clean(df)
    assert got.columns == df.columns
    text = sorted((r.doc_id, r.text) for r in got.collect())
    assert text == [(1, "keep this first line\nand a second one"),
                    (2, "something new and longer"), (3, None), (4, ""), (4, "")]


def test_clean_keeps_columns_of_any_name(spark):
    line = "one two three four five six"
    rows = [(1, f"{line}\nown line of the first", "a", 1, 2, 3, 9), (None, f"other words here\n{line}", "b", 1, 2, 3, 9),
            (2, line, "c", 1, 2, 3, 9), (3, None, "d", 1, 2, 3, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, __removed string, __id int, __rk int, row int, n_chars int")
    got = {r["__removed"]: r for r in L.clean(d, chars_col="n_chars").collect()}
    assert got["a"].text == rows[0][1] and got["a"].n_chars == 9 and got["c"].text == "" and got["c"].n_chars == 0
    assert got["b"].text == "other words here" and got["b"].n_chars == 16 and got["d"].text is None
    assert L.clean(d).dtypes == d.dtypes


def test_variants_in_many_batches_make_few_pairs(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(60)] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    pairs, store = [], L.store

    def spy(df):
        out = store(df)
        if {"x_sig", "y_sig"} <= set(out.columns):
            pairs.append(out.count())
        return out
    monkeypatch.setattr(L, "store", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    got = {r.id: r.removed for r in L.removed_lines(df).collect()}
    assert {i: r for i, r in got.items()} == {k: v for (k, _), v in zip(rows, brute(rows, 0.8).values())}
    assert len(pairs) == 1 and pairs[0] < 10 * len(rows)


def test_large_sets_and_words_that_come_once(spark):
    rng = random.Random(8)
    vocab = [f"t{i}" for i in range(500)]
    base = [rng.sample(vocab, rng.choice([90, 97, 120, 200])) for _ in range(25)]
    rows = []
    for i in range(60):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 5, 11, 30])):
            w[rng.randrange(len(w))] = rng.choice([rng.choice(vocab), f"once{rng.random()}"])
        rows.append((i, " ".join(w)))
    got = check(spark, rows)
    assert sum(len(r.removed) for r in got) > 10


def test_a_slice_is_described_in_small_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    texts = ["\n".join(" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 30)))
                       for _ in range(rng.randint(1, 8))) for _ in range(200)] + [None, "", "x" * 3000]
    batch = pa.RecordBatch.from_pydict({"id": list(range(203)), "rk": list(range(203)), "text": texts})
    rank = type("", (), {"value": np.random.default_rng(1).permutation(1 << L.COUNTER_BITS).astype(np.int32)})
    wanted = type("", (), {"value": bytes([255]) * (1 << L.FILTER_BITS - 3)})
    runs = [L._counter, L._reader(rank, 0.8), L._finder(rank, wanted)]
    whole = [pa.Table.from_batches(list(run(iter([batch])))) for run in runs]
    sizes, sets = [], L._sets

    def spy(lines, order):
        sizes.append(sum(len(x) for x in lines.to_pylist()))
        return sets(lines, order)
    monkeypatch.setattr(L, "_sets", spy)
    monkeypatch.setattr(L, "_TEXT", 4000)
    for run, want in zip(runs, whole):
        assert pa.Table.from_batches(list(run(iter([batch])))).combine_chunks() == want.combine_chunks()
    assert len(sizes) > 20 and max(sizes) <= 8000


def test_word_hashes_are_xxh64():
    import pyarrow as pa
    from xxhash import xxh64_intdigest as xxh
    rng = random.Random(2)
    made = ["", "a\0", "ü", *("x" * n for n in range(1, 80)), "y" * 5000, *(f"word{i}" for i in range(3000)),
            *("".join(chr(rng.randrange(1, 900)) for _ in range(rng.randrange(40))) for _ in range(3000))]
    want = [xxh(w.encode()) for w in made]
    assert L._hashes(pa.array(made)).tolist() == want
    assert L._hashes(pa.array(made).slice(3, 50)).tolist() == want[3:53]
    assert L._hashes(pa.array(["", ""])).tolist() == [xxh(b"")] * 2
    assert len(L._hashes(pa.array([], pa.string()))) == 0


def test_words_are_coded_by_their_hashes():
    import pyarrow as pa
    from xxhash import xxh64_intdigest as xxh
    rng = random.Random(6)
    made = ["a", "a\0", "a\0\0", "ü", "1234567", "12345678", "x" * 40,
            *("".join(chr(rng.randrange(1, 400)) for _ in range(rng.randrange(1, 12))) for _ in range(900))] * 3
    for flat, want in ((pa.array(made), made), (pa.array(made).slice(5, 900), made[5:905]), (pa.array(["b"]), ["b"])):
        h, code = L._coded(flat)
        assert h[code].tolist() == [xxh(w.encode()) for w in want]
        assert len(h) == len(set(want))


def test_a_buckets_pairs_are_those_that_match_and_are_wanted(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = random.Random(7)
    base = [rng.sample(range(400), n) for n in (3, 12, 40, 95, 97, 140, 230)]
    sets = []
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, len(w) // 12, len(w) // 8])):
            w[rng.randrange(len(w))] = rng.randrange(400)
        sets.append(frozenset(f"w{x}" for x in w))
    sets = list(dict.fromkeys(sets))
    rank = type("", (), {"value": np.random.default_rng(2).permutation(1 << L.COUNTER_BITS).astype(np.int32)})
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(sets))), "rk": list(range(len(sets))),
                                        "text": [" ".join(sorted(s)) for s in sets]})
    got = [b for b in L._reader(rank, 0.8)(iter([batch])) if b.column("sig").null_count == 0][0]
    settled = np.array([rng.random() < 0.4 for _ in range(got.num_rows)])
    got = got.append_column("settled", pa.array(settled))
    of = dict(zip(got.column("sig").to_pylist(), range(got.num_rows)))
    least = got.column("least").to_pylist()                 # the set's id: each comes once
    data = {k: np.concatenate([a, a]).tobytes()             # shown by two batches
            for k, a in enumerate(L._word_rows(rank, 1 << L.COUNTER_BITS)(got))}
    want = {tuple(sorted((i, j))) for i in range(len(sets)) for j in range(i)
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    done = {least[k]: bool(settled[k]) for k in range(got.num_rows)}
    want = {p for p in want if not done[max(p)]}
    for compare in (L._COMPARE, 50):
        monkeypatch.setattr(L, "_COMPARE", compare)
        found = set()
        for b in L._word_pairs(0.8)(data):
            for x, y, sx, sy in zip(*(c.to_pylist() for c in b.columns)):
                assert x < y and not (sx and sy)
                found.add(tuple(sorted((least[of[x]], least[of[y]]))))
        assert want <= found and len(want) > 500
        assert all(not done[max(p)] for p in found)


def test_frequent_words_are_joined_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 12)
    seen, frequent = [], L._frequent_pairs

    def spy(*args):
        out = frequent(*args)
        seen.append(out.count())
        return out
    monkeypatch.setattr(L, "_frequent_pairs", spy)
    rng = random.Random(9)
    vocab = [f"w{min(int(rng.paretovariate(0.7)), 90)}" for _ in range(400)]
    rows = [(i, "\n".join(" ".join(rng.sample(vocab, rng.randint(2, 12))) for _ in range(3))) for i in range(120)]
    got = check(spark, rows)
    assert seen and seen[0] > 0 and sum(len(r.removed) for r in got) > 10


def test_a_family_in_many_batches_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        w = [f"w{k}" for k in range(60)]
        for _ in range(6):
            w[rng.randrange(60)] = f"v{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    pairs, store = [], L.store

    def spy(df):
        out = store(df)
        if {"x_sig", "y_sig"} <= set(out.columns):
            pairs.append(out.count())
        return out
    monkeypatch.setattr(L, "store", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = {r.id: r.removed for r in L.removed_lines(df).collect()}
    assert got == {k: v for (k, _), v in zip(rows, brute(rows, 0.8).values())}
    assert len(pairs) == 1 and pairs[0] < 21500
