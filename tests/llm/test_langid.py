import random

import numpy as np

from sortproof.llm import langid as G

DDL = "doc_id long, text string, lang string, id string, score string"
ALPHA = {"aa": "abcdefg", "bb": "defghij", "cc": "gabhixy"}


def text(lang, rng, n=40):
    return " ".join("".join(rng.choice(ALPHA[lang]) for _ in range(rng.randint(2, 6))) for _ in range(n)).capitalize()


def corpus(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, text(lang, rng), lang, "i", "s") for i in range(n) for lang in [rng.choice(["aa"] * 6 + ["bb", "cc"])]]
    return rows, spark.createDataFrame(rows, DDL)


def test_held_out_accuracy_and_calibration(spark):
    rows, train = corpus(spark, 500, 1)
    test, d = corpus(spark, 200, 2)
    model = G.fit(train, bits=12, per_language=80)
    got = {r.id: r for r in G.predict(model, d).collect()}
    right = [got[i].lang_pred == lang for i, _, lang, *_ in test]
    assert np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert abs(np.mean([r.score for r in got.values()]) - np.mean(right)) < 0.1
    assert (model.weights == 0).mean() > 0.3            # L1 leaves most weights at zero


def test_und_and_edges(spark):
    _, train = corpus(spark, 200, 1)
    train = train.unionAll(spark.createDataFrame(
        [(900, None, "aa", "", ""), (901, "text", None, "", ""), (902, "123 !!", "bb", "", "")], DDL))
    model = G.fit(train, bits=12, per_language=50)
    rows = [(1, None), (2, ""), (3, "12 .. ٣ \n"), (None, "abc fed"), (5, "DEFG abc " * 30000), (6, "漢字"), (6, "漢字")]
    d = spark.createDataFrame([(i, t, "xx", "i", "s") for i, t in rows], DDL)
    got = G.predict(model, d).collect()
    by = {r.id: r for r in got}
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[5].lang_pred in ALPHA and by[6].lang_pred in ALPHA and by[None].lang_pred in ALPHA
    assert len(got) == len(rows)
    none = G.fit(spark.createDataFrame([], DDL), bits=10)
    assert [r.lang_pred for r in G.predict(none, d.limit(3)).collect()] == ["und"] * 3
    assert G.predict(model, spark.createDataFrame([], DDL)).count() == 0


def test_document_frequencies_cover_all_rows(spark):
    rows, train = corpus(spark, 150, 4)
    model = G.fit(train, bits=12, per_language=10)      # few rows for the weights
    df = np.zeros(1 << 12)
    for _, t, *_ in rows:
        df[np.unique(G.grams(t, 12))] += 1
    want = np.where(df > 0, np.log(151 / (1 + df)) + 0.1, 0)
    assert np.allclose(model.idf, want)


def test_grams():
    a = G.grams("Ab, c", 20)
    assert len(a) == len(G.grams("ab  c", 20)) and (a == G.grams("AB...C", 20)).all()
    assert G.grams(" 12", 20) is None and len(G.grams("x", 20)) == 3 + 2 + 1


def test_a_language_of_long_texts_only_is_learned(spark):
    rows, train = corpus(spark, 200, 1)
    rng = random.Random(9)
    long = [(1000 + i, text(lang, rng, 400), lang, "i", "s") for i in range(40) for lang in ["cc"]]
    train = train.where("lang <> 'cc'").unionAll(spark.createDataFrame(long, DDL))
    model = G.fit(train, bits=12, per_language=60, max_chars=600)
    assert model.languages == ["aa", "bb", "cc"]
    test, d = corpus(spark, 100, 2)
    got = {r.id: r.lang_pred for r in G.predict(model, d).collect()}
    assert np.mean([got[i] == lang for i, _, lang, *_ in test]) >= 0.95
