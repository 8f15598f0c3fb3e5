import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from sortproof.llm import segbpe

DDL = "doc_id long, text string, ids string, id string, n_tokens string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def texts():
    rng = random.Random(5)
    alpha = list("ab .'sT\n\t 1,é　\x1c\x85漢😀́'\x00ß") + [
        "'s", "'ll", "  ", " \n", "<|endoftext|>", "<|endof", "ing", " the", "²", " "]
    out = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    return out + ["", " ", "x" * 40000, "the cat " * 9000, " \n" * 3000, "ab" * 30001,
                  " <|endoftext|> <|endoftext|><|endoftext|>x"]


def test_lowest_rank_leftmost_first():
    rank_of, merged = {0: {0: 0}, 1: {1: 1}, 2: {0: 2}}, [1, 2, 3]
    assert segbpe.merge([0] * 5, rank_of, merged) == [3]         # 11 0 -> 2 0 -> 3
    assert segbpe.merge([0] * 3, rank_of, merged) == [1, 0]
    assert segbpe.merge([], rank_of, merged) == [] and segbpe.merge([7], rank_of, merged) == [7]

    def plain(ids):
        ids = list(ids)
        while True:
            have = [(rank_of[a][b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if b in rank_of.get(a, {})]
            if not have:
                return ids
            r, i = min(have)
            ids[i:i + 2] = [merged[r]]
    rng = random.Random(1)
    for _ in range(500):
        ids = [rng.randint(0, 2) for _ in range(rng.randint(0, 40))]
        assert segbpe.merge(ids, rank_of, merged) == plain(ids)


def test_as_the_library(spark, library):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts())]
    rows += [(None, "a", "", "", ""), (5, None, None, None, None), (5, "b", "", "", ""), (5, "b", "", "", "")]
    df = spark.createDataFrame(rows, DDL)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    got = segbpe.digests(df).collect()
    assert sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_code_points(library):
    codec = segbpe.Codec(segbpe.read_model(P.path("byte_bpe_50k.json")))
    points = [*range(0x3400), *range(0xA000, 0xD800, 7), *range(0xE000, 0x1F000, 3), *range(0x1F000, 0x110000, 997)]
    for a in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in points[a:a + 4096])
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids


def test_ids_and_decoding(spark, library):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts()[:300])]
    enc = segbpe.encode(spark.createDataFrame(rows, DDL))
    by = {r.id: r.ids for r in enc.collect()}
    assert all(by[i] == library.encode(t, add_special_tokens=False).ids for i, t, *_ in rows)
    back = {r.id: r.text for r in segbpe.decode(enc).collect()}
    assert all(back[i] == t for i, t, *_ in rows)
    odd = spark.createDataFrame([(1, [247]), (2, None), (3, [])], "id long, ids array<int>")
    got = {r.id: r.text for r in segbpe.decode(odd).collect()}
    assert got == {1: library.decode([247], skip_special_tokens=False), 2: "", 3: ""}


def test_empty_table_and_other_files(spark):
    empty = spark.createDataFrame([], DDL)
    assert segbpe.digests(empty).count() == 0 and segbpe.encode(empty).count() == 0
    with pytest.raises(ValueError, match="byte-level"):
        segbpe.read_model(P.path("word_bpe_49k.json"))


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(segbpe, "UNITS", 3)
    codec = segbpe.Codec(segbpe.read_model(P.path("byte_bpe_50k.json")))
    text = " ".join(f"word{i}" for i in range(50))
    first = codec.encode(text)
    assert len(codec) == 3 and codec.encode(text) == first
