import random
import re

from sortproof.llm import lineclean as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, n int, lines string, id string, w string"


def base(t):
    t = t or ""
    w = WORD.findall(t)
    win = {}
    for i in range(len(w) - 2):
        win.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {k for v in win.values() if len(v) > 1 for i in v for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


def run(spark, texts):
    d = spark.createDataFrame([(i, t, 1, "l", "i", "w") for i, t in enumerate(texts)], DDL)
    return {r.id: r for r in L.clean(d).collect()}


def test_base_figures(spark):
    rng = random.Random(1)
    vocab = ["a", "b", "cé", "d#", "漢", "e|", "f.", "\x0b", "\x85x", " "]
    texts = [None, "", " \n\t ", "x", "x y", "a a a a a", "a b c\na b c\n\na b c"]
    texts += ["".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 120)))
              for _ in range(150)]
    texts += ["same three words " * 9000, " ".join(f"u{i}" for i in range(30000))]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t


def sentence(i, n=30):
    return " ".join(f"word{i}x{k}" for k in range(n)) + "."


def test_line_rules(spark):
    good = [sentence(i) for i in range(6)]
    bad = {"no mark": " ".join(f"p{i}" for i in range(30)),
           "shout": " ".join(f"S{i}!!" for i in range(30)),
           "symbols": " ".join(f"s{i}%%%" for i in range(30)) + ".",
           "navigation": " | ".join(f"Home{i}" for i in range(12)) + " .",
           "boilerplate": "Copyright (C) 2020. All Rights Reserved.",
           "licence": "Released under the MIT License."}
    texts = ["\n".join(good)] + ["\n".join([*good, b]) for b in bad.values()]
    got = run(spark, texts)
    assert all(r.kept for r in got.values())
    assert got[0].n_lines_removed == 0 and got[0].text == texts[0]
    for i in range(1, len(texts)):
        assert got[i].n_lines_removed == 1 and got[i].text == "\n".join(good), list(bad)[i - 1]


def test_verdict(spark):
    lost = "\n".join([sentence(1), "x | y | z | " * 40])
    half = "\n".join([sentence(i) for i in range(4)] + ["\n", "", sentence(9), "Home | " * 8])
    got = run(spark, [lost, half, "too short."])
    assert not got[0].kept and not got[0].base_failed or got[0].base_failed
    assert got[0].text is None
    assert got[1].kept and "Home" not in got[1].text and got[1].text.count("\n") == 7
    assert got[2].base_failed and not got[2].kept


def test_empty_table_and_ids(spark):
    assert L.clean(spark.createDataFrame([], DDL)).count() == 0
    d = spark.createDataFrame([(None, "a", 1, "", "", ""), (1, "a", 1, "", "", ""), (1, "a", 1, "", "", "")], DDL)
    assert sorted(str(r.id) for r in L.clean(d).collect()) == ["1", "1", "None"]
