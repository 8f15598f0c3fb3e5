import itertools
import random

import numpy as np
import pyarrow as pa

from sortproof.llm import toxicity as T

DDL = "doc_id long, text string, toxic int, id string, __score string"
BAD = ["grobnik", "sludgehead", "vermox"]


def brute_kernel(s, t, order, decay):
    out = 0.0
    for i in itertools.combinations(range(len(s)), order):
        for j in itertools.combinations(range(len(t)), order):
            if all(s[a] == t[b] for a, b in zip(i, j)):
                out += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return out


def test_kernel():
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(12)]
    got = T.kernel(T._codes(words, -1), T._codes(words[:5], -2), 3, 0.7)
    want = [[brute_kernel(s, t, 3, 0.7) for t in words[:5]] for s in words]
    assert np.allclose(got, want, rtol=1e-4)


def corpus(n, seed, rate=0.3, change=None):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("bdfgklmnorstuaei") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    texts, y = [], []
    for _ in range(n):
        w = [rng.choice(vocab) + rng.choice([""] * 9 + [".", ","]) for _ in range(rng.randint(30, 150))]
        bad = rng.random() < rate
        if bad:
            at = rng.randrange(len(w) - 5)
            for k in (0, 2, 4):
                w.insert(at + k, change(rng.choice(BAD)) if change else rng.choice(BAD))
        texts.append(" ".join(w))
        y.append(int(bad))
    return texts, y


def df(spark, texts, y):
    return spark.createDataFrame([(i, t, k, "i", "s") for i, (t, k) in enumerate(zip(texts, y))], DDL)


def predictions(spark, model, texts):
    got = {r.id: r for r in T.score(model, df(spark, texts, [None] * len(texts))).collect()}
    return [got[i] for i in range(len(texts))]


def test_held_out_accuracy_with_gaps_and_inserted_characters(spark):
    model = T.fit(df(spark, *corpus(500, 1)), per_label=150)
    for change, least in ((None, 0.97), (lambda w: ".".join(w), 0.9), (lambda w: " ".join(w), 0.9),
                          (lambda w: w[:3] + "x" + w[3:], 0.8), (str.upper, 0.97), (lambda w: w + "ing", 0.9)):
        texts, y = corpus(150, 7, change=change)
        got = predictions(spark, model, texts)
        assert np.mean([r.predicted for r, k in zip(got, y) if k]) >= least, change
        assert np.mean([r.predicted for r, k in zip(got, y) if not k]) <= 0.04
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_edges(spark):
    texts, y = corpus(300, 1)
    model = T.fit(df(spark, texts + [None, "", "x"], y + [1, None, 0]), per_label=80)
    odd = [None, "", " \n ", ".", "word " * 50000, "z" * 50000, "clean words\n" * 2000 + "you vermox grobnik vermox",
           "a b c d e"]
    got = predictions(spark, model, odd)
    assert [r.predicted for r in got] == [0, 0, 0, 0, 0, 0, 1, 0]
    kept = T.score(model, df(spark, odd, [None] * len(odd)).drop("__score"), keep_columns=True)
    assert kept.columns == ["doc_id", "text", "toxic", "id", "toxic_score", "toxic_predicted"]
    assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for t in odd)
    assert T.score(model, spark.createDataFrame([], DDL)).count() == 0
    twice = T.score(model, df(spark, ["a vermox grobnik vermox"] * 2, [0, 0])).collect()
    assert twice[0].score == twice[1].score


def test_missing_labels(spark):
    for rows, want in (([], 0), ([("a b c", 0)], 0), ([("a b c", 1)], 1)):
        model = T.fit(df(spark, [r[0] for r in rows], [r[1] for r in rows]))
        assert [r.predicted for r in predictions(spark, model, ["some text", None])] == [want] * 2


def planted(n_toxic, n_clean, insults, seed, each=2):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("bdfgklmnorstuaei") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    texts, y = [], []
    for k in range(n_toxic + n_clean):
        w = [rng.choice(vocab) for _ in range(60)]
        for x in rng.sample(insults, each) if k < n_toxic else ():
            w.insert(rng.randrange(len(w)), x)
        texts.append(" ".join(w))
        y.append(int(k < n_toxic))
    return texts, y


def test_a_long_tail_of_rare_insults():
    rng = random.Random(12)
    insults = ["".join(rng.choice("qwxzjpvyh") for _ in range(8)) for _ in range(60)]
    model = T.fit_texts(*planted(200, 400, insults, 1))         # an insult is in 7 of 200 toxic texts
    held = [x for x in insults if any(m in T.START + x + T.STOP for m in model.landmarks.strings)]
    assert len(held) >= 50                                      # as words or by a part of theirs
    texts, y = planted(150, 150, insults, 5)
    vocab, at, first, rows = T._read(pa.array(texts))
    total = np.add.reduceat(model.word_scores(vocab)[at].astype(float), first) + model.bias
    got = model.probability(T._top_two(total, rows, model.bias)) >= 0.5
    assert got[:150].mean() >= 0.8 and got[150:].mean() <= 0.05
    found, more = T.choose_landmarks({x: 1 for x in insults}, {"plain": 9}, 60, 120)
    assert not found and not more                               # words met once tell nothing by themselves


def test_few_labels():
    model = T.fit_texts(*planted(7, 60, ["grobnik"], 2, each=1))
    assert model.landmarks and any("robni" in x for x in model.landmarks.strings)
    got = model.word_scores(["grobnik", "plainword"])
    assert got[0] > got[1]


def test_substrings_of_words_met_once_count():
    words = {f"{a}grobnik{b}": 1 for a in "abcdef" for b in "uvwxyz"}
    found, _ = T.choose_landmarks(words, {"plain": 9, "other": 12}, 36, 80)
    assert any("grobnik" in x for x in found)


def test_one_text_of_a_repeated_id_reaches_the_driver(spark, monkeypatch):
    got = []
    monkeypatch.setattr(T, "fit_texts", lambda texts, y, *o: got.append((texts, y)))
    docs = spark.createDataFrame([(1, f"copy {i:03d}") for i in range(200)] + [(2, "b")], "doc_id long, text string")
    T.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert got == [(["b", "copy 000"], [0, 1])]


def test_columns_of_any_name_are_kept(spark):
    texts, y = corpus(60, 3)
    model = T.fit_texts(texts, y)
    names = "__text string, __score int, __predicted int, score int, text string, id long, m map<string,int>"
    rows = [(f"own {i}", i, 2, 3, t, i, {"a": i}) for i, t in enumerate(texts)] + [(None, 1, 2, 3, None, None, None)]
    d = spark.createDataFrame(rows, names)
    out = T.score(model, d, keep_columns=True)
    assert out.columns == [*d.columns, "toxic_score", "toxic_predicted"]
    plain = {r.id: r.score for r in T.score(model, d, id_col="id").collect()}
    back = out.collect()
    assert {r.id: r.toxic_score for r in back} == plain
    assert sorted(str(r[:7]) for r in back) == sorted(str(tuple(r)) for r in d.collect())
