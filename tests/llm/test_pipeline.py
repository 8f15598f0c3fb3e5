"""The pipeline's stages on a small corpus: each decision against a plain recomputation."""

import hashlib
import random

import pytest

import corpus_pipeline as P

BAD = ["grobnik", "sludgehead", "vermox"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=260, seed=8):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("bdfgklmnorstuaei") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    rows, labels = [], []

    def line(k):
        return " ".join(rng.choice(vocab) for _ in range(k)) + "."
    shared = [line(20) for _ in range(4)]
    for i in range(n):
        lines = [line(rng.randint(8, 25)) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.3:
            lines.insert(0, rng.choice(shared))
        toxic = i % 4 == 0
        if toxic:
            w = lines[-1].split(" ")
            for k in (1, 3, 5):
                w.insert(k, rng.choice(BAD))
            lines[-1] = " ".join(w)
        rows.append((i, "\n".join(lines), "xx", rng.choice(["a", "a", "a", "b", None]), None))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 4]
    for k in range(12):                                    # copies and near copies of whole documents
        src = clean[k]
        rows.append((n + k, src[1] if k % 2 else src[1].upper(), "xx", "b", None))
    rows += [(n + 50, None, None, "b", None), (n + 51, "", "yy", None, 0), (None, "a text of its own without an id.", "x", "a", 1)]
    return [(i, t, la, s, len(t) if t is not None else None) for i, t, la, s, _ in rows], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("pipe")
    rows, labels = corpus()
    spark.createDataFrame(rows, DDL).write.parquet(str(top / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(top / "labels.parquet"))
    docs = spark.read.parquet(str(top / "documents.parquet"))
    out = [("", docs.collect(), docs.columns)]
    for name, stage in P.STAGES:
        got = stage(spark, docs, str(top))
        got.write.parquet(str(top / name))
        docs = spark.read.parquet(str(top / name))
        out.append((name, docs.collect(), docs.columns))
    return str(top), out


def test_names_and_columns(stages):
    _, out = stages
    assert [n for n, *_ in out[1:]] == ["toxicity", "line_dedup", "simhash", "mix", "byte_bpe"]
    assert all(c == out[0][2] for _, _, c in out[:5])


def test_toxicity(stages):
    _, out = stages
    bad = {r.doc_id for r in out[0][1] if r.text and any(b in r.text.lower() for b in BAD)}
    left = {r.doc_id for r in out[1][1]}
    assert len(bad) > 60
    assert len(bad & left) <= 0.05 * len(bad)
    assert len({r.doc_id for r in out[0][1]} - bad - left) <= 6
    by = {(r.doc_id, r.text): tuple(r) for r in out[0][1]}
    assert all(tuple(r) == by[r.doc_id, r.text] for r in out[1][1])


def test_line_dedup(stages):
    from test_linededup import brute
    _, out = stages
    want = brute([(r.doc_id, r.text) for r in out[1][1]], 0.8)
    exp = {}
    for r in out[1][1]:
        gone = want[r.doc_id, r.text or ""]
        text = r.text if not gone else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone)
        exp[r.doc_id] = (text, r.lang, r.source, len(text) if gone else r.n_chars)
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in out[2][1]} == exp
    assert any(r.text == "" for r in out[2][1])


def test_simhash(stages):
    from test_simhash import brute_components, brute_fp
    _, out = stages
    rows = sorted(out[2][1], key=lambda r: (r.doc_id is None, r.doc_id))
    comp = brute_components([brute_fp(r.text, 3) for r in rows], 2)
    want = {rows[i].doc_id for i in range(len(rows)) if comp[i] == i}
    assert {r.doc_id for r in out[3][1]} == want and len(out[3][1]) == len(want) < len(rows)


def test_mix(stages, spark):
    from sortproof.llm import mixing
    top, out = stages
    docs = spark.read.parquet(f"{top}/simhash")
    want = {r.id: r.copies for r in mixing.mix(docs).collect()}
    got = {}
    for r in out[4][1]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_bpe(stages):
    _, out = stages
    text = {r.doc_id: r.text or "" for r in out[4][1]}
    assert len(out[5][1]) == len(out[4][1])
    for r in out[5][1]:
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    top, out = stages
    got = P.run(spark, top)
    assert sorted(map(str, got.collect())) == sorted(map(str, out[5][1]))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
