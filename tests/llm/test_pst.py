import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sortproof.llm import pst

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, key string, score string, n string"


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    return [" ".join(rng.choice(vocab[: rng.choice([5, 50, 200])]) for _ in range(rng.randint(0, 60)))
            + rng.choice(["", "\n", "\t X"]) for _ in range(n)]


def df(spark, texts):
    return spark.createDataFrame([(i, t, "k", "s", "n") for i, t in enumerate(texts)], DDL)


@pytest.mark.parametrize("word_p_min", [1e-6, 0.01, 0.9])
def test_base_score(spark, word_p_min):
    train, test = corpus(1, 80) + [None, ""], corpus(2, 40) + [None, "", "unseen words " + "z" * 500]
    model = pst.fit(df(spark, train), p_min=1e-4, word_p_min=word_p_min)
    c = Counter(w for t in train for w in words(t) + ["\n"])
    n, v = sum(c.values()), len(c)
    assert (model.tokens, model.kinds) == (n, v)
    for r in pst.score(model, df(spark, test)).collect():
        toks = words(test[r.id]) + ["\n"]
        assert r.n_tokens == len(toks) and r.train_tokens == n
        assert r.n_known == sum(c[t] > 0 for t in toks)
        assert math.isclose(r.base_score, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in toks),
                            rel_tol=1e-9)


def test_tree_is_a_distribution_and_matches_a_plain_walk(spark):
    train, test = corpus(1, 150), corpus(1, 5) + corpus(9, 10) + ["", "a" * 3000]
    model = pst.fit(df(spark, train), depth=3, p_min=1e-4)
    tree = model.tree
    assert any(len(s[0]) for s in tree.states)
    # every state's next-symbol probabilities sum to 1
    rng = np.random.default_rng(0)
    for ctx in [0x0A0A0A, *(int(x) for x in rng.choice(tree.states[2][0], 20))]:
        p = 10 ** tree.score(np.array([(ctx << 8) | y for y in range(256)]))
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)

    def walk(code, d):
        if d == 0:
            return tree.root[code & 255]
        code &= (1 << 8 * (d + 1)) - 1
        grams = dict(zip(*(x.tolist() for x in tree.grams[d - 1])))
        states = dict(zip(*(x.tolist() for x in tree.states[d - 1])))
        if code in grams:
            return grams[code]
        return states.get(code >> 8, 0.0) + walk(code, d - 1)
    got = {r.id: r.score for r in pst.score(model, df(spark, test)).collect()}
    memo = {}
    for i, t in enumerate(test):
        s = b" ".join(w.encode() for w in words(t)) + b"\n"
        total, past = 0.0, b"\n\n\n"
        for y in s:
            code = int.from_bytes(past + bytes([y]), "big")
            memo.setdefault(code, None)
            if memo[code] is None:
                memo[code] = walk(code, 3)
            total += memo[code]
            past = past[1:] + bytes([y])
        assert math.isclose(got[i], total, rel_tol=1e-9)


def test_counts_are_exact(spark):
    train = corpus(1, 30) + ["", None]
    counted = Counter()
    for t in train:
        s = b"\n\n" + b" ".join(w.encode() for w in words(t)) + b"\n"
        counted.update(int.from_bytes(s[i - 2:i + 1], "big") for i in range(2, len(s)))
    run = pst.map_arrow(df(spark, train).select("text"), pst._gram_counter(2), "code long, n long")
    got = Counter()
    for r in run.collect():
        got[r.code] += r.n
    assert got == counted


def test_order_beats_the_base_and_empty_training(spark):
    train, test = corpus(1, 300), corpus(1, 300)[::7]
    model = pst.fit(df(spark, train), p_min=1e-5)
    rows = pst.score(model, df(spark, test)).collect()
    uniform = sum(-math.log10(256) * (len(" ".join(words(test[r.id])).encode()) + 1) for r in rows)
    assert sum(r.score for r in rows) > 0.6 * uniform
    empty = pst.fit(spark.createDataFrame([], DDL))
    rows = pst.score(empty, df(spark, ["a b", None])).collect()
    assert [r.n_known for r in rows] == [0, 0] and all(r.train_tokens == 0 for r in rows)
    assert pst.score(model, spark.createDataFrame([], DDL)).count() == 0


def test_contexts_are_kept_by_count_whatever_their_share(spark):
    train, test = corpus(3, 120), corpus(3, 120)[::9] + corpus(5, 6)
    got = []
    for p_min in (0.9, 1e-3, 1e-9):                     # all grams by joins, some, none that was met twice
        model = pst.fit(df(spark, train), p_min=p_min)
        got.append({r.id: r.score for r in pst.score(model, df(spark, test)).collect()})
    assert all(math.isclose(got[0][i], g[i], rel_tol=1e-9) for g in got for i in g)
    tree = model.tree
    assert tree.depth == 6 and len(tree.states[2][0])
    for k in (1, 3, 6):                                 # every context that two equal pairs were met in is weighed
        pairs = Counter()
        for t in train:
            s = b"\n" * k + " ".join(words(t)).encode() + b"\n"
            pairs.update(s[i - k:i + 1] for i in range(k, len(s)))
        want = {int.from_bytes(g[:-1], "big") for g, n in pairs.items() if n >= 2}
        assert {r.ctx for r in model.levels[k - 1].select("ctx").collect()} == want


def test_slices_and_ties_of_texts(spark, monkeypatch):
    train, test = corpus(4, 80), corpus(6, 60) + ["a" * 5000, "", None] + corpus(6, 60)[:20]
    model = pst.fit(df(spark, train), p_min=1e-3)
    assert 0 < len(model.top[0]) <= 1000
    top = pst._table(*model.top)
    assert all(1 << bits == len(keys) == len(vals) for bits, keys, vals in top)
    whole = {r.id: r.score for r in pst.score(model, df(spark, test)).collect()}
    batch = pst._scorer(type("", (), {"value": {
        "depth": model.depth, "top": model.top, "frequent": model.frequent, "texts": model.texts,
        "denominator": 1.0}}))
    import pyarrow as pa
    table = pa.RecordBatch.from_pydict({"key": list(range(len(test))), "id": list(range(len(test))), "text": test})
    monkeypatch.setattr(pst, "REQUEST", 50)
    monkeypatch.setattr(pst, "SLICE", 1000)
    out = [b for n in range(0, len(test), 10) for b in [table.slice(n, 10)]]
    out = pa.Table.from_batches(list(batch(iter(out)))).to_pylist()
    asked, rows = [r for r in out if r["key"] is None], [r for r in out if r["key"] is not None]
    assert len(rows) == len(test) and len({r["slice"] for r in rows}) > 3
    want = {}
    for r in asked:
        assert 0 < len(r["grams"]) <= 50
        assert not want.setdefault(r["slice"], set()) & set(r["grams"])          # asked for once
        want[r["slice"]] |= set(r["grams"])
    tree = model.tree
    for r in rows:
        codes, _ = pst._codes([b" ".join(w.encode() for w in words(test[r["id"]]))], 6)
        known = pst._look_up(top, codes)[1]
        assert set(codes[~known].tolist()) <= want.get(r["slice"], set())
        assert (r["body"] is None) == bool(known.all())
        assert math.isclose(whole[r["id"]], tree.score(codes).sum(), rel_tol=1e-9)


def test_a_text_is_passed_on_as_its_few_rare_grams(spark, monkeypatch):
    import pyarrow as pa
    model = pst.fit(df(spark, ["ab ab ab cd " * 50, "ab cd"] * 5), p_min=1e-3)
    top = pst._table(*model.top)
    sent = type("", (), {"value": {
        "depth": model.depth, "top": model.top, "frequent": model.frequent, "texts": model.texts,
        "denominator": 1.0}})
    test = ["ab ab ab cd " * 50, "ab ab ab cd " * 50 + "xy", "q" * 400, "", None]
    rows = pa.RecordBatch.from_pydict({"key": list(range(len(test))), "id": list(range(len(test))), "text": test})
    out = pa.Table.from_batches(list(pst._scorer(sent)(iter([rows])))).to_pylist()
    bodies = {r["id"]: r for r in out if r["key"] is not None}
    for i, t in enumerate(test):
        text = b" ".join(w.encode() for w in words(t))
        codes, _ = pst._codes([text], 6)
        rest = codes[~pst._look_up(top, codes)[1]]
        body = bodies[i]["body"]
        assert len(body or b"") <= len(text)
        if len(rest):
            assert body == (rest.tobytes() if bodies[i]["packed"] else text)
    assert bodies[1]["packed"] and len(bodies[1]["body"]) < 200
    got = {r.id: r.score for r in pst.score(model, df(spark, test)).collect()}
    tree = model.tree
    for i, t in enumerate(test):
        codes, _ = pst._codes([b" ".join(w.encode() for w in words(t))], 6)
        assert math.isclose(got[i], tree.score(codes).sum(), rel_tol=1e-9)


def test_a_counting_task_keeps_its_frequent_grams(monkeypatch):
    import pyarrow as pa
    rng = random.Random(7)
    texts = ["the same words again " * 4 + "".join(rng.choice("abcdefgh") for _ in range(120)) for _ in range(60)]
    counted = Counter()
    for t in texts:
        codes, _ = pst._codes([b" ".join(w.encode() for w in words(t))], 6)
        counted.update(codes.tolist())
    monkeypatch.setattr(pst, "GRAMS", 1500)
    batches = [pa.RecordBatch.from_pydict({"text": texts[i:i + 3]}) for i in range(0, 60, 3)]
    got, rows = Counter(), Counter()
    for b in pst._gram_counter(6)(iter(batches)):
        assert b.num_rows <= 3000
        for code, n in zip(*(b.column(i).to_pylist() for i in range(2))):
            got[code] += n
            rows[code] += 1
    assert got == counted
    often = [c for c, n in counted.items() if n >= 60]
    assert often and all(rows[c] == 1 for c in often)       # handed on once, not with each full table


def test_codes_and_distinct_codes():
    docs = [b"", b"abc", b"x" * 9 + b"yz"]
    for depth in (1, 2, 3, 4, 5, 6):
        want = []
        for d in docs:
            s = b"\n" * depth + d + b"\n"
            want += [int.from_bytes(s[i:i + depth + 1], "big") for i in range(len(d) + 1)]
        codes, starts = pst._codes(docs, depth)
        assert codes.tolist() == want and starts.tolist() == [0, 1, 5]
        assert pst._distinct(codes).tolist() == sorted(set(want))
    assert pst._distinct(np.zeros(0, np.int64)).tolist() == []
    assert pst._answers(np.array([3, 5, 9]), np.array([.3, .5, .9]), np.array([9, 3, 3, 5])).tolist() == [.9, .3, .3, .5]
